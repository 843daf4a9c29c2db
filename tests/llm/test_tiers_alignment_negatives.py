"""Tiered packing, tokenizer alignment and hard negatives against plain versions, with nulls, empties, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeweir.llm import alignment, negatives, queries, tiers
from changeweir.llm.bytelevel import byte_alphabet, byte_level, pieces

BYTES_PATH = queries.tokenizer_path(queries.BYTES_TOKENIZER)
PIECES_PATH = queries.tokenizer_path(queries.PIECES_TOKENIZER)
WORDS = [f"word{i}" for i in range(60)] + ["naïve", "日本語", "🙂", "<|endoftext|>", "</s>", "▁", "\n", "\t", "  ", "it's", "12,000"]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


#: Repeated rows and ids, nulls, empties, blanks, a text of several windows, one without blanks, special tokens' strings.
TEXTS = (
    [(i, prose(i, 5 + 13 * i % 900)) for i in range(120)]
    + [(3, prose(3, 44)), (3, "another text"), (3, "another text"), (None, "no id"), (None, None), (200, None), (201, ""), (202, " "), (203, "\n")]
    + [(204, prose(1, 6000)), (205, "x" * 30_000), (206, "plain words only"), (207, "a▁b"), (208, "<|endoftext|>"), (209, "\x00 odd ​")]
)


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have the names that operators use themselves."""
    rows = [(i, t, "start", 1, 2, "part", "pairs") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, block int, radix int, part string, pairs string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES_PATH)


def test_byte_level_ids_are_the_tokenizers(tokenizer):
    vocabulary = byte_level(BYTES_PATH)
    assert vocabulary.merged is not None
    for text in [t or "" for _, t in TEXTS] + ["".join(chr(c) for c in range(32, 3000)), "a<|endoftext|> b"]:
        assert vocabulary.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(vocabulary.bytes_of[i] for i in vocabulary.plain_ids(text)) == text.encode()
    assert vocabulary.ids("<|endoftext|>").tolist() == [50256]
    assert 50256 not in vocabulary.plain_ids("<|endoftext|>")


# Tiered packing


def plain_ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def whole_documents(rows, texts, tokenizer):
    """Pieces of rows of one doc_id, taken apart into the documents that they make up exactly; what is left over."""
    want = Counter((i, zlib.crc32(plain_ids_of(tokenizer, t).tobytes()), len(plain_ids_of(tokenizer, t))) for i, t in texts)
    ids_of = defaultdict(list)
    for i, t in texts:
        ids_of[i].append(plain_ids_of(tokenizer, t))
    left = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    for doc_id, several in ids_of.items():
        for ids in several:
            at = 0
            while at < len(ids):
                fits = [
                    k for k, n in left.items()
                    if n and k[0] == doc_id and k[1] == at and k[4] == len(ids) and k[3] == zlib.crc32(ids[at : at + k[2]].tobytes())
                ]
                assert fits, (doc_id, at)
                left[fits[0]] -= 1
                at += fits[0][2]
            assert at == len(ids)
    return +left, want


def check_sequences(rows, most):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    padding = 0
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        at = 0
        for r in held:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= most and {r.tier for r in held} == {at}
        padding += 0 if at & (at - 1) == 0 else most - at
    assert padding == 0
    return sequences


@pytest.mark.parametrize("block_tokens", [3000, tiers.BLOCK_TOKENS])
def test_tiered_packing(docs, tokenizer, block_tokens):
    rows = tiers.pack_documents(docs, BYTES_PATH, block_tokens=block_tokens, ranks=4).collect()
    left, _ = whole_documents(rows, TEXTS, tokenizer)
    assert not left
    sequences = check_sequences(rows, 2048)
    groups = defaultdict(dict)
    for number, held in sequences.items():
        groups[held[0].step_group][number] = (held[0].tier, sum(r.length**2 for r in held))
    assert all(len({size for size, _ in g.values()}) == 1 and len(g) <= 4 for g in groups.values())
    # In a task, at most one group of each size (for those of the end: one size each) is not full.
    short = Counter((g >> 32, next(iter(x.values()))[0]) for g, x in groups.items() if len(x) < 4)
    assert max(short.values()) == 1


def test_tiered_packing_of_nothing(empty, spark, tokenizer):
    assert tiers.pack_documents(empty, BYTES_PATH).collect() == []
    rows = tiers.pack_documents(spark.createDataFrame([(5, None)], "doc_id int, text string").coalesce(1), BYTES_PATH).collect()
    assert [tuple(r)[:8] for r in rows] == [(5, 0, 1, zlib.crc32(np.array([1], "<u4").tobytes()), 1, 0, 0, 1)]
    with pytest.raises(ValueError):
        tiers.pack_documents(empty, BYTES_PATH, tiers=(2048, 1000))


def test_tiers_over_the_whole_table(spark, tokenizer):
    rows = queries.op11_tiered_packing(spark, "/root/testdata/sf0.001").collect()
    texts = [(r.doc_id, r.text) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    left, _ = whole_documents(rows, texts, tokenizer)
    assert not left
    check_sequences(rows, 2048)
    # Nearly all documents stay in as few pieces as their length needs.
    pieces_of = Counter(r.doc_id for r in rows)
    assert sum(pieces_of[i] > -(-len(plain_ids_of(tokenizer, t)) // 2048) for i, t in texts) < 0.1 * len(texts)


def test_best_fit_takes_the_smallest_gap():
    pick = random.Random(5)
    lengths = [pick.randrange(1, 2048) for _ in range(400)]
    windows = tiers.best_fit([tiers.Piece(i, 0, n) for i, n in enumerate(lengths)], tiers.TIERS)
    gaps: list[list[int]] = []  # [gap, pieces...] of a plain version
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g[0] >= n]
        if fits:
            best = min(fits, key=lambda g: g[0])
        else:
            best = [min(t for t in tiers.TIERS if t >= n)]
            gaps.append(best)
        best[0] -= n
        best.append(n)
    assert Counter(w.gap for w in windows) == Counter(g[0] for g in gaps)
    full, left = tiers.close_gaps(windows, 2048)
    assert all(w.gap == 0 for w in full)
    parts = sorted((p.doc, p.start, p.length) for p in [p for w in full for p in w.pieces] + left)
    for doc, n in enumerate(lengths):
        at = 0
        for _, start, length in [p for p in parts if p[0] == doc]:
            assert start == at
            at += length
        assert at == n
    assert {w.size for w in tiers.powers(left, 2048)} <= {1 << i for i in range(12)}


def test_like_attention_costs_stand_together():
    windows = [tiers.Window(512, 512, [tiers.Piece(0, 0, k), tiers.Piece(1, 0, 512 - k)]) for k in range(1, 257)]
    random.Random(1).shuffle(windows)
    spread = lambda groups: sum(max(w.attention for w in g) - min(w.attention for w in g) for g in groups)
    groups, left = tiers.step_groups(windows, 8)
    assert len(groups) == 32 and not left
    assert spread(groups) < 0.1 * spread([windows[at : at + 8] for at in range(0, 256, 8)])


# Alignment


def plain_alignment(texts, tokenizer):
    """Rows of the contract, link by link."""
    import sentencepiece

    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES_PATH)
    alphabet = byte_alphabet()
    bytes_a = lambda i: bytes(alphabet[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    counts, found = Counter(), []
    for doc_id, text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, ids_a)) != raw or b"".join(map(bytes_b, ids_b)) != raw:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        i = j = end_a = end_b = 0
        links, groups, ours, theirs = [], [], [], []
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            to_a, to_b = end_a + len(bytes_a(ids_a[i])), end_b + len(bytes_b(ids_b[j]))
            if to_a <= to_b:
                ours.append(str(ids_a[i]))
                i, end_a = i + 1, to_a
            if to_b <= to_a:
                theirs.append(str(ids_b[j]))
                j, end_b = j + 1, to_b
            if to_a == to_b:
                groups.append(",".join(ours) + "|" + ",".join(theirs))
                ours, theirs = [], []
        counts.update(links)
        found.append((doc_id, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (i, n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for i, n_a, n_b, n_groups, links, digest in found
    ]


@pytest.mark.parametrize("options", [{}, {"bits": 2, "block_bytes": 2000, "fan_in": 2}, {"bits": 0, "block_bytes": 1}])
def test_alignment(docs, tokenizer, rows, options):
    if options.get("block_bytes") == 1:  # a block for each row
        docs = docs.where("doc_id < 30 or doc_id is null or doc_id > 200")
    want = plain_alignment([(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert sum(w[4] == 0 for w in want) >= 4
    assert rows(alignment.align(docs, BYTES_PATH, PIECES_PATH, **options)) == sorted(want, key=repr)


def test_alignment_of_the_whole_table(spark, tokenizer, rows):
    texts = [(r.doc_id, r.text) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert rows(queries.op12_tokenizer_alignment(spark, "/root/testdata/sf0.001")) == sorted(plain_alignment(texts, tokenizer), key=repr)


def test_alignment_of_nothing(empty, spark):
    assert alignment.align(empty, BYTES_PATH, PIECES_PATH).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align(blank, BYTES_PATH, PIECES_PATH).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_runs_merge_as_counters(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 5)
    pick = random.Random(9)
    runs = [sorted(Counter(pick.randrange(300) * 7 for _ in range(pick.randrange(200))).items()) for _ in range(12)] + [[]]
    total = sum((Counter(dict(r)) for r in runs), Counter())
    framed = [alignment.framed(np.array([k for k, _ in r], np.uint64), np.array([n for _, n in r], np.uint64)) for r in runs]
    found = list(alignment.merged([alignment.frames(r, 2) for r in framed]))
    assert len(found) > 10
    keys, counts = (np.concatenate(c).tolist() for c in zip(*found, strict=True))
    assert list(zip(keys, counts, strict=True)) == sorted(total.items())


def test_maxima_over_frames():
    side = np.uint64(1 << alignment.ID_BITS)
    entries = [(b, a, n) for b, ns in enumerate([[3], [1, 5, 5, 2], [7, 7], [1, 2, 3, 4, 5, 6, 9]]) for a, n in enumerate(ns)]
    keys = np.array([b * int(side) + a for b, a, _ in entries], np.uint64)
    counts = np.array([n for *_, n in entries], np.uint64)
    for width in (1, 2, 3, 100):
        frames = [(keys[at : at + width], counts[at : at + width]) for at in range(0, len(keys), width)]
        best = np.concatenate([m for *_, m in alignment.maxima(iter(frames))])
        assert best.tolist() == [n == max(m for c, _, m in entries if c == b) for b, _, n in entries]


def test_pieces_give_bytes_back():
    vocabulary = pieces(PIECES_PATH)
    for text in ["a b", "naïve 日本語 🙂", "\n\t x", "a  b"]:
        assert b"".join(vocabulary.bytes_of[i] for i in vocabulary.plain_ids(text)) == b" " + text.encode()


# Hard negatives


def plain_negatives(given, mining):
    """Rows of the contract from all pairs, in Python's integers."""
    rows = {
        (i, label, tuple(math.floor(mining.scale * float(np.float64(x))) for x in v))
        for i, label, v in given
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    held = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    out = []
    for i, label, q in rows:
        if i % mining.anchors:
            continue
        scored = sorted((-held(sum(x * y for x, y in zip(q, v, strict=False))), j, other) for j, other, v in rows if j != i)
        for p, positive, _ in [s for s in scored if s[2] == label][: mining.positives]:
            p = -p
            fits = [s for s in scored if s[2] != label and mining.low * p <= -100 * s[0] <= mining.high * p]
            out += [(i, positive, rank, j, p, -n) for rank, (n, j, _) in enumerate(fits[: mining.negatives], 1)]
    return sorted(out, key=repr)


def vectors(seed, n, width, labels=3, spread=0.1):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, width))
    return [(i, int(pick.integers(labels)), [float(x) for x in centres[i % 6] + spread * pick.normal(size=width)]) for i in range(n)]


ODD = [
    (None, 1, [1.0, 2.0]), (7000, None, [1.0, 2.0]), (7001, 1, None), (7002, 1, [1.0, None]), (7003, 1, [float("nan"), 1.0]),
    (7004, 0, [float("inf")]), (7100, 0, []), (7200, 0, [0.0] * 6), (7201, 1, [0.0] * 6), (7300, 2, [1.0]), (7301, 2, [1.0, 0.5]),
    (300, 0, [9.0] * 6), (300, 1, [9.0] * 6), (300, 1, [9.0] * 6), (100, 2, [1.0, 2.0, 3.0]),
]


def frame(spark, given):
    rows = [(i, label, v, 1, "x", 3) for i, label, v in given]
    return spark.createDataFrame(rows, "vec_id long, label int, vector array<double>, anchor int, shard string, score int").repartition(4)


@pytest.mark.parametrize("shard_rows", [37, 10_000])
def test_hard_negatives(spark, rows, shard_rows):
    mining = negatives.Mining(anchors=50, positives=3, negatives=4)
    ties = [(1000 + i, i % 2, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0]) for i in range(60)]
    given = vectors(3, 400, 6) + ties + ODD
    got = rows(negatives.hard_negatives(frame(spark, given), mining, shard_rows=shard_rows, codes=4))
    assert got == plain_negatives(given, mining) and len(got) > 50


def test_hard_negatives_of_huge_components(spark, rows):
    mining = negatives.Mining(anchors=2, positives=2, negatives=3)
    given = [(i, i % 3 % 2, [2e6 + 3e5 * i + i / 7, float(i), -3.5]) for i in range(12)] + [(50 + i, i % 2, [9e5 + i, 2e6, 1e7]) for i in range(8)]
    given += [(70, 0, [1e17, 0.0, 1.0]), (71, 1, [1e17, -1e300, 1.0]), (72, 0, [-1e17, 0.0, 0.0])]  # products beyond a long
    got = rows(negatives.hard_negatives(frame(spark, given), mining))
    assert got == plain_negatives(given, mining) and got


def test_hard_negatives_of_nothing(spark):
    nothing = spark.createDataFrame([], "vec_id long, label int, vector array<float>")
    assert negatives.hard_negatives(nothing).collect() == []
    alone = spark.createDataFrame([(100, 1, [1.0])], "vec_id long, label int, vector array<float>")
    assert negatives.hard_negatives(alone).collect() == []


def test_walks_end_early_and_visit_by_falling_bound():
    given = vectors(8, 6000, 8, spread=0.02)
    x = np.array([v for *_, v in given])
    x = np.floor(256 * x)
    index = negatives.MultiIndex(np.arange(len(x)), np.array([label for _, label, _ in given]), x, negatives.fitted(x[:, :4]), negatives.fitted(x[:, 4:]))
    seen = []
    for bound, begin, end in index.cells(x[0]):
        assert (index.rows[begin:end] @ x[0]).max() <= bound
        seen.append((bound, end - begin))
    assert [b for b, _ in seen] == sorted((b for b, _ in seen), reverse=True) and sum(n for _, n in seen) == len(x)
    walked = []
    chunks = index.chunks
    index.chunks = lambda q: (walked.append(len(at)) or (bound, at, s) for bound, at, s in chunks(q))
    negatives.positives(index, 0, given[0][1], x[0], 5)
    assert sum(walked) < len(x) / 2
