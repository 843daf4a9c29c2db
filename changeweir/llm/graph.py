"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import saved

#: Rounds of hubs before the exact filter takes over what is left.
HUB_ROUNDS = 2
#: 64-bit words of a set's parities in the exact filter.
PARITY_WORDS = 4


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` (longs) that isn't itself a root; root is the smallest node.

    Each round hangs the larger neighbours of a node, then its smaller ones, below the smallest
    (large star, small star), until nothing moves: about log2 of the longest path in rounds. Minima
    are combined before the shuffle and joined back, so a node with a third of all edges
    is one row on one side and rows that the join may split on the other.
    Each round is written to the scratch folder, so lineage stays short. Loops and repeats are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, seen = saved(edges, label), None
    while True:
        print_of = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if print_of == seen or print_of[0] == 0:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = print_of
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct("u", F.col("m").alias("v")),
                    F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
                )
            ).alias("e")
        )
        state = saved(small.select("e.u", "e.v").where("u <> v").distinct(), label)


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``sets(cid, root, shingles)`` with different roots that can reach a similarity of ``percent``; exact.

    All members stand in one order, the rarest first. Two sets of n and m members that are linked share at least
    percent * (n + m) / (100 + percent) of them, so the first one they share has at least that many members from there on
    (its reach) in both. That bounds where it can be: near the front of the longer set, and nearer still in the shorter
    one, which alone is looked up. Members that no other set has come first in the order and use up a set's reach, so a large
    group of texts that are alike but not alike enough gives few pairs.
    Each set also carries the parity of its shared members in ``PARITY_WORDS`` * 64 classes: where two sets' parities differ,
    one has a member that the other lacks, and so is each member that no other set has. That bounds what they share.
    """
    whole = 100 + percent
    parities = [f"p{w}" for w in range(PARITY_WORDS)]
    parity = lambda w: F.expr(f"bit_xor(if(pmod(shiftright(x, 6), {PARITY_WORDS}) = {w}, shiftleft(1L, cast(x & 63 as int)), 0L))")
    each = sets.select("cid", "root", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("x"))
    counts = each.groupBy("x").agg(F.count("*").alias("f")).where("f > 1")
    ordered = each.join(counts, "x").groupBy("cid", "root", "n").agg(
        F.array_sort(F.collect_list(F.struct("f", "x"))).alias("all"), *[parity(w).alias(p) for w, p in enumerate(parities)]
    )
    size = F.size("all")
    front = F.slice("all", F.lit(1), F.greatest(size - F.ceil(F.col("n") * percent / 100).cast("int") + 1, F.lit(0)))
    rare = ordered.select("cid", "root", "n", size.alias("c"), F.posexplode(front).alias("k", "e"), *parities)
    reach = (F.col("c") - F.col("k")).cast("long").alias("reach")
    rare = saved(rare.select("cid", "root", "n", (F.col("n") - F.col("c")).alias("own"), reach, "e.x", *parities), "bucket-rare")
    shorter = rare.where(F.col("reach") * whole >= F.col("n") * 2 * percent).withColumnRenamed("root", "other")
    # By component first: the members of one never pair up, and a component that can't be reached gives no row.
    # Of a component that has one member with x, that member's parities already bound what is shared.
    sole = {c: F.max(c).alias(f"{c}_s") for c in ["own", *parities]}
    parts = shorter.groupBy("x", "other").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("reach").alias("most"), F.count("*").alias("members"), *sole.values()
    )
    unlike = F.col("own") + F.col("own_s")
    for p in parities:
        unlike = unlike + F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_s")))
    met = rare.withColumnRenamed("cid", "b").join(parts, "x").where(
        (F.col("other") != F.col("root"))
        & (F.col("lo") <= F.col("n"))
        & (F.col("hi") * 100 >= F.col("n") * percent)
        & (F.least("reach", "most") * whole >= (F.col("n") + F.col("lo")) * percent)
        & ((F.col("members") > 1) | ((F.col("n") + F.col("lo") - unlike) * whole >= (F.col("n") + F.col("lo")) * 2 * percent))
    )
    theirs = {"cid": "a", "n": "na", "reach": "reach_a", "own": "own_a"} | {p: f"{p}_a" for p in parities}
    partner = shorter.withColumnsRenamed(theirs)
    differ = F.col("own") + F.col("own_a")
    for p in parities:
        differ = differ + F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_a")))
    met = met.select("b", "root", "n", "own", "reach", "x", *parities, "other")
    pairs = met.join(partner, ["x", "other"]).where(
        ((F.col("na") < F.col("n")) | ((F.col("na") == F.col("n")) & (F.col("a") < F.col("b"))))
        & (F.col("na") * 100 >= F.col("n") * percent)
        & (F.least("reach", "reach_a") * whole >= (F.col("n") + F.col("na")) * percent)
        & ((F.col("n") + F.col("na") - differ) * whole >= (F.col("n") + F.col("na")) * 2 * percent)
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_in_buckets(
    keys: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """Edges ``(a, b)`` that join just what the verified links within the buckets of ``keys(key, cid)`` would join: links, and what
    links have joined as stars.

    ``verify`` takes pairs ``(a, b)`` and returns those that are linked; ``sets_of`` takes ``cid`` and returns
    ``cid, shingles``. A bucket's hub is the member that most others meet in buckets, which among copies of one text is
    the text that they come from. In each round a class is held against the first of its buckets' hubs, where that is of
    another component; so a large group costs a star a round, however many bands it has. After the rounds, what still
    shares a bucket with another component, whether it met that hub or not, goes through an
    exact prefix filter (``prefix_pairs``); no pair is cut off.
    """
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(keys.join(sizes, "key"), "bucket-members")
    fame = members.groupBy("cid").agg(F.sum("size").alias("fame"))
    left = members.select("key", "cid").join(fame, "cid").select("key", "cid", "fame", F.col("cid").alias("root"))
    left, forest = saved(left.withColumn("used", F.lit(False)), "bucket-left"), None
    for _ in range(rounds):
        best = F.max(F.struct("fame", (-F.col("cid")).alias("minus"), "root")).alias("h")
        hubs = left.where("not used").groupBy("key").agg(best)
        hubs = hubs.select("key", (-F.col("h.minus")).alias("hub"), F.col("h.root").alias("hub_root"), F.col("h.fame").alias("hub_fame"))
        stars = left.join(hubs, "key").where("root <> hub_root and not used")
        stars = stars.groupBy("cid").agg(F.max(F.struct("hub_fame", (-F.col("hub")).alias("minus"))).alias("h"))
        stars = stars.select("cid", (-F.col("h.minus")).alias("hub"))
        stars = stars.select(F.least("hub", "cid").alias("a"), F.greatest("hub", "cid").alias("b")).distinct()
        found = verify(stars)
        # Stars of the round before stand for its links: fewer edges, and near to what comes out.
        forest = components(found if forest is None else forest.union(found), "bucket-roots").toDF("a", "b")
        roots = forest.toDF("cid", "r")
        left = left.join(hubs.select("key", "hub"), "key").join(roots, "cid", "left").select(
            "key", "cid", "fame", F.coalesce("r", "cid").alias("root"), (F.col("used") | (F.col("cid") == F.col("hub"))).alias("used")
        )
        several = left.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        left = saved(left.join(several, "key"), "bucket-left")
        if left.isEmpty():
            return forest
    alone = left.select("cid", "root").distinct()
    sets = sets_of(alone.select("cid"))
    return forest.union(verify(prefix_pairs(sets.join(alone, "cid"), percent))).distinct()
