"""The split forms of ranks and in-group order give what the plain windows give."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeweir.operators.ordering import _ranges, number_in_group, percent_rank_over_all, rank_over_all
from changeweir.plans.adhoc import same_amount_chain


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with most rows, ties, NULL values and a NULL key."""
    rng = random.Random(5)
    data = [
        (i, 1 if rng.random() < 0.6 else rng.choice([2, 3, 4, None]), rng.choice([None, *range(40)]), f"r{i}")
        for i in range(600)
    ]
    return spark.createDataFrame(data, "id BIGINT, k BIGINT, v BIGINT, label STRING").repartition(5).cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [2, 7])
def test_rank(skewed, rows, descending, slices):
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
    want = skewed.withColumn("r", F.rank().over(Window.orderBy(order)).cast("bigint"))
    got = rank_over_all(skewed, "v", "r", descending, slices=slices)
    assert rows(got, "id", "r") == rows(want, "id", "r")


def test_percent_rank(skewed, rows):
    want = skewed.withColumn("p", F.percent_rank().over(Window.orderBy(F.asc_nulls_last("v"))))
    assert rows(percent_rank_over_all(skewed, "v", "p", slices=5), "id", "p") == rows(want, "id", "p")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", [1, 2, 7, 200])
@pytest.mark.parametrize("key", [["k"], ["k", "odd"]])
@pytest.mark.parametrize("order", [["v", "id"], ["id"], ["label"]])
def test_number_and_previous(skewed, rows, descending, parts, key, order):
    """Against plain windows; one part cuts no group, many cut all but the smallest."""
    df = skewed.withColumn("odd", F.col("id") % 2)
    nulls = [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in order]
    w = Window.partitionBy(*key).orderBy(*nulls)
    want = df.withColumns({"n": F.row_number().over(w).cast("bigint"), "prev": F.lag("label").over(w), "was": F.lag("v").over(w)})
    got = number_in_group(df, key, order, descending, number="n", previous={"prev": "label", "was": "v"}, parts=parts)
    assert rows(got, "id", "k", "n", "prev", "was") == rows(want, "id", "k", "n", "prev", "was")


def test_large_groups_are_cut(skewed):
    """The window lies over (key, range) of rows that were joined with their cuts, and the largest range is a small share."""
    plan = number_in_group(skewed, "k", ["id"], number="n")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_slice" in plan.split("hashpartitioning(k", 1)[1].split("\n")[0]
    cuts = {r["_k_k"]: r["_cuts"] for r in _ranges(skewed, ["k"], ["id"], 7).collect()}
    assert 1 in cuts and len(cuts) < 7
    sizes = [0] * (len(cuts[1]) + 1)
    for r in skewed.filter("k = 1").collect():
        sizes[sum(c < r.id for c in cuts[1])] += 1
    assert max(sizes) < 2 * sum(sizes) / 7


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id BIGINT, v BIGINT")
    assert rank_over_all(empty, "v", "r", slices=3).count() == 0
    assert number_in_group(empty, "id", ["v"], number="n", parts=9).count() == 0


@pytest.mark.parametrize("parts", [1, 40])
def test_chain_holds_all_pairs(skewed, parts):
    """Following the links gives the pairs a brute-force self join gives."""
    links = {r.id_1: r for r in same_amount_chain(skewed, "id", "v", parts=parts).collect()}
    data = [(r.id, r.v) for r in skewed.collect() if r.v is not None]
    for a, v in data:
        later = sorted(b for b, w in data if w == v and b > a)
        reached, at = [], a
        while at in links:
            at = links[at].id_2
            reached.append(at)
        assert reached == later
        assert (links[a].later_matches if a in links else 0) == len(later)
