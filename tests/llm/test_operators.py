"""The text operators against plain versions, with nulls, empty and repeated rows, ties, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeweir.llm import cascade, decontaminate, graph, language, lpf, packing, paragraphs, pii, queries, setsketch, templates, urls

random.seed(11)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def edited(text, every):
    words = text.split()
    for i in range(every // 2, len(words), every):
        words[i] = "changed"
    return " ".join(words)


BASE, LINE = prose(120), prose(60)
TEXTS = [
    (1, BASE),
    (2, BASE.upper()),
    (3, edited(BASE, 90)),
    (4, prose(100) + "\n" + LINE + "\n" + prose(80)),
    (5, prose(90) + "\n" + LINE + "\n" + LINE),
    (6, None),
    (7, ""),
    (8, " \n\t"),
    (9, "one two"),
    (10, "one two"),
    (11, "a" * 3000),
    (12, "word " * 4000),
    (13, "# ! " * 100),
    (14, edited(LINE, 50) + "\n" + "é😀 " * 150),
    (15, prose(3000)),
    (16, prose(30) + " mail a.b@c.example.org, 10.0.0.255, 4111 1111 1111 1111, +1 (555) 123-4567 " + prose(30)),
    (16, prose(30) + " DE89370400440532013000 ssn 123-45-6789 1.2.3.256"),
    (None, BASE),
    (1, BASE),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have the names that operators use themselves."""
    df = spark.createDataFrame(TEXTS, "doc_id LONG, text STRING")
    return df.withColumns({c: F.lit("x") for c in ("kept", "digest", "cid", "n", "line", "tid", "place", "words", "lang", "d1")}).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_near_duplicates(docs, empty):
    got = Counter(tuple(r) for r in setsketch.near_duplicates(docs, k=4).collect())
    sets = [(i, shingle_set(t, 4)) for i, t in TEXTS]
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                x, y = sets[a][1], sets[b][1]
                near = x and y and 100 * len(x & y) >= 80 * len(x | y)
                if near or (sets[a][0] is not None and sets[a][0] == sets[b][0] and x and y):
                    root[a] = root[b] = min(root[a], root[b])
    want = Counter()
    for n, (i, s) in enumerate(sets):
        ids = [sets[m][0] for m in range(len(sets)) if root[m] == root[n] and sets[m][0] is not None]
        component = min(ids) if s and ids else i
        want[(i, len(s), component, i == component)] += 1
    assert got == want
    assert setsketch.near_duplicates(empty).count() == 0
    left = setsketch.without_near_duplicates(docs, k=4)
    assert left.columns == docs.columns and Counter(r.doc_id for r in left.collect())[1] == 1


def test_sketches_merge_and_estimate():
    sketch, rng = setsketch.Sketcher(), np.random.default_rng(1)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate((a[:1500], rng.integers(0, 2**63, 500, dtype=np.uint64)))
    ka, kb = sketch.of(a), sketch.of(b)
    assert (setsketch.merge(ka, kb) == sketch.of(np.union1d(a, b))).all()
    size = np.array([2000.0])
    est = setsketch.likeliest(np.array([(ka > kb).sum()]), np.array([(ka < kb).sum()]), np.array([(ka == kb).sum()]), size, size)
    assert abs(est[0] - 0.6) < 0.15


def test_paragraphs(docs, empty):
    rows = {(r.doc_id, r.kept): r for r in paragraphs.without_repeats(docs, with_text=True).collect()}
    by_id = defaultdict(list)
    for (i, _), r in rows.items():
        by_id[i].append(r)
    assert by_id[4][0].removed_lines == [] and by_id[5][0].removed_lines == [1, 2] and by_id[5][0].copies_of == [4]
    assert by_id[14][0].removed_lines == [0]  # a near copy of the line
    assert by_id[1][0].n_removed == 1 and by_id[None][0].n_removed == 0  # nulls sort first
    assert by_id[6][0].n_paragraphs == 0 and by_id[7][0].kept == "" and by_id[9][0].kept == "one two"
    assert paragraphs.without_repeats(empty).count() == 0


def test_paragraph_cut():
    """Every word but those of stretches under the limit is in one paragraph; joins stop where they must."""
    text = "a b\nc d\n\ne f g h i\nj\n\nk\n \nl m\n\nn o p q\nr\ns\n\nt"
    four = [([0, 1], "a b c d"), ([3], "e f g h i"), ([4, 6, 8], "j k l m"), ([10], "n o p q")]
    assert paragraphs.cut(text, 4) == four
    assert paragraphs.cut(text, 3) == [*four, ([11, 12, 14], "r s t")]
    assert paragraphs.cut(None, 4) == paragraphs.cut("", 4) == paragraphs.cut("a\nb\n\nc", 4) == []


def test_paragraphs_of_short_lines(spark):
    """A shared passage in lines under 20 words is found, wrapped alike or not, and goes with all its lines."""
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    passage, steps = prose(60), "\n\n".join(prose(8) for _ in range(6))
    df = spark.createDataFrame([
        (1, prose(30) + "\n" + wrap(passage, 10)),
        (2, wrap(passage, 10) + "\n" + prose(25)),
        (3, "Title\n\n" + wrap(passage, 12) + "\n\nend"),
        (4, passage),
        (5, steps), (6, steps),
        (7, "one two\nthree"), (8, "one two\nthree"),
    ], "doc_id LONG, text STRING")
    got = {r.doc_id: r for r in paragraphs.without_repeats(df, with_text=True).collect()}
    assert {i: r.removed_lines for i, r in got.items()} == {
        1: [], 2: list(range(6)), 3: [2, 3, 4, 5, 6], 4: [0], 5: [], 6: [0, 2, 4, 6, 8, 10], 7: [], 8: [],
    }
    assert [got[i].n_removed for i in range(1, 9)] == [0, 1, 1, 1, 0, 1, 0, 0]
    assert [got[i].n_paragraphs for i in range(1, 9)] == [2, 2, 1, 1, 1, 1, 0, 0]
    assert got[2].copies_of == [1] and got[3].kept == "Title\n\n\nend" and got[8].kept == "one two\nthree"


def test_byte_repeats(docs, empty):
    raws = [(i, (t or "").encode()) for i, t in TEXTS]
    counts = Counter(r[i : i + 400] for _, r in raws for i in range(len(r) - 399))
    want = Counter()
    for i, r in raws:
        gone = np.zeros(len(r), bool)
        for at in range(len(r) - 399):
            if counts[r[at : at + 400]] > 1:
                gone[at : at + 400] = True
        kept = bytes(c for c, g in zip(r, gone) if not g)
        want[(i, len(r), int(gone.sum()), len(lpf.runs(gone)), hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(tuple(r) for r in lpf.without_repeats(docs).collect()) == want
    assert lpf.without_repeats(empty).count() == 0


def test_shorter_shared_passages(spark):
    """Passages under 400 bytes stay, and are told by the documents that share them; what one document repeats is not."""
    pick = random.Random(8)
    letters = lambda n: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    passages = {n: letters(n) for n in (90, 256, 399)}
    rows = [(10 * n + i, letters(700) + str(i) + p + str(i) + letters(700)) for n, p in passages.items() for i in range(3)]
    twice = letters(300)
    rows += [(1, twice + "<" + letters(500) + ">" + twice), (2, letters(2000)), (3, "short"), (4, None), (5, letters(260)), (6, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lpf.without_repeats(df, length=400, shorter=256).collect()}
    width = lpf.gram_width(400)
    for n in (256, 399):
        assert all(width <= got[10 * n + i].n_shared <= n and not got[10 * n + i].n_removed for i in range(3))
    assert [got[i].n_shared for i in (1, 2, 3, 4, 5, 901, 902)] == [0] * 7
    assert got[6].n_shared == got[900].n_shared > 1000 and got[6].n_removed == got[6].n_bytes
    with pytest.raises(ValueError):
        lpf.without_repeats(df, length=400, shorter=50)


def test_wide_grams():
    """Texts that share only a phrase have no gram of a 400-byte repeat in common (they had with grams of 32 bytes)."""
    pick = random.Random(3)
    phrase = "of the first part and of the second part, each for himself, "
    one, two = (
        "".join("".join(pick.choices("abcdefgh ", k=40)) + phrase for _ in range(30)).encode() for _ in range(2)
    )
    assert not set(lpf.anchors(one, 400)[0].tolist()) & set(lpf.anchors(two, 400)[0].tolist())


def test_anchors_of_pieces(monkeypatch):
    """Texts over a piece: every start has one anchor, whose gram is the least of the string wherever pieces end."""
    for size in (1, 50, 64, 333, 1000):
        raw = "".join(random.choice("abcdefgh") for _ in range(700)).encode()
        raw = raw + raw[100:300] + raw
        whole = lpf.anchors(raw, 60)
        monkeypatch.setattr(lpf, "_PIECE", size)
        gram, first, end = lpf.anchors(raw, 60)
        monkeypatch.undo()
        assert [i for s, e in zip(first, end) for i in range(s, e)] == list(range(len(raw) - 59))
        assert np.repeat(gram, end - first).tolist() == np.repeat(whole[0], whole[2] - whole[1]).tolist()
        of = defaultdict(set)
        for i, g in enumerate(np.repeat(gram, end - first).tolist()):
            of[raw[i : i + 60]].add(g)
        assert all(len(g) == 1 for g in of.values())


def test_byte_repeats_of_a_very_long_text(spark):
    """A text over a piece ends no run, and a repeat over the piece's end is found."""
    pick = random.Random(5)
    raw = bytearray(pick.choices(b"abcdefghijklmnopqrstuvwxyz ", k=lpf._PIECE + 50_000))
    at = lpf._PIECE - 450
    other = b"#" + bytes(raw[at : at + 900]) + b"#"
    raw[at - 1 : at], raw[at + 900 : at + 901] = b"<", b">"
    df = spark.createDataFrame([(1, raw.decode()), (2, other.decode())], "doc_id LONG, text STRING")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in lpf.without_repeats(df).collect()}
    assert got[1] == (len(raw), 900, 1, hashlib.sha256(raw[:at] + raw[at + 900 :]).hexdigest())
    assert got[2] == (902, 900, 1, hashlib.sha256(b"##").hexdigest())


def test_longest_previous():
    for _ in range(100):
        t = np.array([random.choice([0, 1, 2]) for _ in range(random.randint(1, 40))])
        n = random.randint(1, 6)
        before, after = lpf.longest_previous(t, n)
        for i in range(len(t)):
            want = i + n <= len(t) and any((t[i : i + n] == t[j : j + n]).all() for j in range(i))
            assert want == (before[i] >= 0 or after[i] >= 0)


def test_suffix_automaton():
    def plain(words, items, window):
        hit, found = set(), set()
        for item, text in items:
            w = decontaminate.item_words(text)
            n = min(window, len(w))
            for q in range(len(w) - n + 1 if w else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == w[q : q + n]:
                        hit |= set(range(p, p + n))
                        found.add(item)
        return len(hit), found

    for _ in range(200):
        items = [(i, " ".join(random.choice("abc") for _ in range(random.randint(0, 9)))) for i in range(6)] + [(9, None)]
        window = random.choice([2, 3, 4, 5])
        b = decontaminate.Benchmark(items, window)
        words = [random.choice(b"a b c d".split()) for _ in range(random.randint(0, 25))]
        spans, found = b.hits(words)
        assert (sum(e - s for s, e in spans), found) == plain(words, items, window)


def test_decontaminated(spark, docs, empty):
    benchmark = spark.createDataFrame([(1, LINE), (2, None), (3, "")], "item_id LONG, text STRING")
    rows = {(r.doc_id, r.n_words): r for r in decontaminate.report(docs, benchmark).collect()}
    hit = {i for (i, _), r in rows.items() if r.contaminated}
    assert hit == {4, 5, 14}
    assert rows[(6, 0)].items_sha256 == hashlib.sha256(b"").hexdigest()
    left = {r.doc_id: r.text for r in decontaminate.cleaned(docs, benchmark).collect()}
    assert 5 not in left and LINE not in left[4] and left[6] is None and left[9] == "one two"
    assert decontaminate.report(empty, benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(docs, benchmark.limit(0)).collect())


def test_personal_data(docs, empty):
    rows = [r for r in pii.report(docs).collect() if r.doc_id == 16]
    assert sorted((r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows) == [(0, 0, 0, 0), (1, 1, 1, 1)]
    assert sorted(re.sub(r":\d+", "", r.spans) for r in rows) == ["email,ip,card,phone", "iban,ssn"]
    assert pii.report(empty).count() == 0
    assert any("[EMAIL]" in (r.text or "") for r in pii.redact(docs).collect())


def test_long_runs_take_linear_time(spark):
    texts = ["1 " * 40000, "a" * 80000 + "@" + "b" * 40000, "+1" + " " * 40000, "1." * 40000, "12345678901234567 " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert pii.report(df).count() == len(texts)


def test_quality(docs, empty):
    for r in cascade.statistics(docs).collect():
        texts = [t or "" for i, t in TEXTS if i == r.doc_id]
        wanted = []
        for t in texts:
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
            again = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
            lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            wanted.append((len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in wanted
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert cascade.statistics(empty).count() == 0
    kept = cascade.kept_only(docs)
    assert kept.columns == docs.columns and {1, 3, 15} <= {r.doc_id for r in kept.collect()} and 13 not in {r.doc_id for r in kept.collect()}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    rows = packing.pack_documents(docs, path).collect()
    tokenizer, want = Tokenizer.from_file(path), Counter()
    for i, t in TEXTS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 4096
    assert packing.pack_documents(empty, path).count() == 0


def test_every_capacity_binds():
    for fit in ("norm", "dot"):
        bins = packing.Bins(packing.Capacity(tokens=100, documents=3, attention=4000, fit=fit))
        held = defaultdict(list)
        for n in sorted((random.randint(1, 60) for _ in range(300)), reverse=True):
            held[bins.place(n)[0]].append(n)
        assert all(sum(x) <= 100 and len(x) <= 3 and sum(n * n for n in x) <= 4000 for x in held.values())


def test_language(spark, empty):
    words = {"xx": "ba be bi bo bu".split(), "yy": "kra kre kri kro kru".split()}
    rows = [(i, " ".join(random.choice(words[lang]) for _ in range(30)), lang) for i in range(120) for lang in [random.choice(["xx", "yy"])]]
    rows += [(1000, None, "xx"), (1001, "123 !?", "yy"), (None, "ba be bu", None)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert all(got[i].lang_pred == lang for i, t, lang in rows if i is not None and i < 1000)
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1000].score == 0 and got[None].lang_pred == "xx"
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    assert language.identify(empty).count() == 0


PAGE = (
    '<html><head><title>t</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="cookie-notice">ok?</div>'
    "<article><h1>A &amp; B</h1><p>One<br>two &lt;three&gt;<p>Four  five<script>var a='</p>';</script><div class=comments><p>no</p></div>"
    "<form><p>mail</p></form></article><footer>f</footer>"
)


def test_extraction(spark):
    plain = "<html><body><div><p>Our site. All rights</p></div><p>Story number {0} is long</p><p>Second {0}</p></body></html>"
    rows = [(i, f"http://Host.example/{i}", plain.format(i)) for i in range(30)]
    rows += [(100, "http://other.example/", PAGE), (101, None, None), (102, "x", ""), (103, "http://h/", "<p>cut <b>off"), (103, "http://h/", "<p>cut <b>off")]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").withColumn("text", F.lit("x"))
    got = {r.page_id: r for r in templates.extract(df).collect()}
    assert got[100].text == "A & B\n\nOne two <three>\n\nFour five"
    assert got[3].text == "Story number 3 is long\n\nSecond 3"  # the block that recurs on the host is gone
    assert got[101].text == got[102].text == "" and got[103].text == "cut off" and got[103].n_chars == 7
    assert templates.extract(df).count() == len(rows) and templates.extract(df.limit(0)).count() == 0


def test_templates_of_a_section(spark):
    """A menu on many pages goes although they are under a tenth of the host's; one on few of them stays."""
    page = "<html><body>{1}<p>Story {0}</p></body></html>"
    menus = lambda i: "<div>Section menu</div>" if i < 1100 else "<div>Rare box</div>" if i < 1900 else ""
    df = spark.createDataFrame([(i, "http://big.example/", page.format(i, menus(i))) for i in range(12_000)], "page_id LONG, url STRING, html STRING")
    got = {r.page_id: r.text for r in templates.extract(df).collect()}
    assert got == {i: "Rare box\n\n" * (1100 <= i < 1900) + f"Story {i}" for i in range(12_000)}


def test_urls(spark):
    rows = [
        (1, "http://Free-Casino.example.org/a?x", "free-casino.example.org", "/a", None, "block"),
        (2, "https://good.example.org/en/1#t", "good.example.org", "/en/1", None, "allow"),
        (3, "http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (4, "http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        (5, "http://a.example.com/fr/1", "a.example.com", "/fr/1", "com/", "allow"),
        (6, "http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
        (7, "http://a.com", "a.com", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "no scheme", "", "", None, "allow"),
        (9, "no scheme", "", "", None, "allow"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "page_id LONG, url STRING").withColumn("html", F.lit("<p>good words here</p>"))
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(df.withColumn("score", F.lit(1))).collect())
    assert got == Counter((r[0], *r[2:]) for r in rows)
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.Segmenter({"free": 10, "casino": 5, "bets": 5, "fr": 1}).split("freecasinobets") == ["free", "casino", "bets"]


def test_urls_know_every_word(spark):
    """Words past any rank of frequency are known, and each token has its own odds."""
    frequent = ["".join(random.choice("bcdfg") for _ in range(9)) for _ in range(52_000)]
    html = " ".join(w + " " + w for w in frequent) + " quartz lantern"
    names = [("xyzzy" + "".join(random.choice("klmnp") for _ in range(8))) for _ in range(3000)]
    rows = [(i, f"http://casino.{n}.org/", "") for i, n in enumerate(names)] + [(i + 5000, f"http://{n[::-1]}.org/", "") for i, n in enumerate(names)]
    df = spark.createDataFrame([(9000, "http://quartzlantern.org/", html), *rows], "page_id LONG, url STRING, html STRING")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert got[9000].words == "quartz lantern org"
    tokens = [(r.page_id < 5000, [("t:" if i == len(r.words.split()) - 1 else "h:") + w for i, w in enumerate(r.words.split())]) for r in got.values()]
    count = {b: Counter(t for bad, x in tokens if bad == b for t in x) for b in (True, False)}
    count[True].update("h:" + w for w in urls.SEEDS)
    n = {b: sum(c.values()) for b, c in count.items()}
    pages = Counter(bad for bad, _ in tokens)

    def share(t, b):
        return (count[b][t] + urls.PRIOR * (count[True][t] + count[False][t]) / (n[True] + n[False])) / (n[b] + urls.PRIOR)

    for (_, x), r in zip(tokens, got.values()):
        want = np.log((pages[True] + 1) / (pages[False] + 1)) + sum(np.log(share(t, True)) - np.log(share(t, False)) for t in x)
        assert abs(r.score - want) < 1e-9


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf).collect()
    ids = {r.doc_id for r in rows}
    docs = queries.table(spark, sf, "documents")
    alone = {r.doc_id for r in setsketch.near_duplicates(cascade.kept_only(docs)).where("kept").collect()}
    assert ids <= alone and len(ids) > 0.95 * len(alone)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_prefix_pairs_lose_no_link(spark, percent):
    """Every pair of sets of different components that reaches the threshold is among the pairs; none comes from one component."""
    pick = random.Random(percent)
    sets = []
    for group in range(6):
        base = pick.sample(range(group * 1000, group * 1000 + 900), pick.choice([5, 20, 45]))
        for _ in range(12):
            kept = [x for x in base if pick.random() > 0.08]
            mine = kept + [10_000_000 * len(sets) + i for i in range(1, pick.randint(1, 6))]
            sets.append((len(sets), len(sets) // 2 * 2 if pick.random() < 0.2 else len(sets), sorted(set(mine))))
    sets += [(len(sets), len(sets), [7]), (len(sets) + 1, len(sets) + 1, [7])]
    found = graph.prefix_pairs(spark.createDataFrame(sets, "cid long, root long, shingles array<long>"), percent)
    found = {tuple(r) for r in found.collect()}
    wanted = set()
    for a, ra, sa in sets:
        for b, rb, sb in sets:
            common = len(set(sa) & set(sb))
            if a < b and ra != rb and common * 100 >= percent * (len(sa) + len(sb) - common):
                wanted.add((a, b))
    assert wanted and wanted <= found
    root = {cid: r for cid, r, _ in sets}
    assert all(root[a] != root[b] for a, b in found)


def test_benchmark_of_many_parts(spark, docs, rows, monkeypatch):
    """A benchmark that is split gives the rows of one automaton, cut texts too."""
    items = [(i, prose(random.Random(i).randrange(1, 40))) for i in range(40)] + [(50, LINE), (51, BASE), (None, prose(12)), (50, LINE)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [rows(decontaminate.report(docs, benchmark)), rows(decontaminate.cleaned(docs, benchmark))]
    monkeypatch.setattr(decontaminate, "PART_BYTES", 800)
    assert len(list(decontaminate.item_parts(benchmark))) > 4
    assert [rows(decontaminate.report(docs, benchmark)), rows(decontaminate.cleaned(docs, benchmark))] == got
    assert any(r[-1] for r in got[0])


def test_training_takes_rows_not_ids(spark):
    """20,000 rows of one id are no more than the bound of rows that the driver gets."""
    many = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.concat(F.lit("the quick fox "), "id").alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(1, "der schnelle Fuchs", "de")] * 50, "doc_id int, text string, lang string")
    seen = []
    fit = language.Classifier.fit
    try:
        language.Classifier.fit = classmethod(lambda cls, flags, langs: seen.append(langs) or fit(flags, langs))
        assert language.train(many.union(few), per_language=40) is not None
    finally:
        language.Classifier.fit = fit
    assert sorted(set(seen[0])) == ["de", "en"] and seen[0].count("en") == 40 and seen[0].count("de") == 1


def test_shared_passages_are_found_and_clean_documents_left(spark):
    """Against all windows of 51 words of sf0.01: who shares one is told so, who shares not even 12 words isn't, and what is left
    shares far fewer."""
    documents = queries.table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text or "" for r in documents.collect()}

    def sharing(of, width):
        count = Counter()
        windows = {i: {tuple(w[k : k + width]) for w in [lower(t).split()] for k in range(len(w) - width + 1)} for i, t in of.items()}
        for one in windows.values():
            count.update(one)
        return {i for i, one in windows.items() if any(count[x] > 1 for x in one)}

    result = paragraphs.without_repeats(documents, with_text=True).collect()
    holders, loosely = sharing(texts, 51), sharing(texts, 12)
    told = {r.doc_id for r in result if r.n_shared_words}
    assert len(holders & told) >= 0.95 * len(holders)
    assert not told - loosely
    assert len(sharing({r.doc_id: r.kept for r in result}, 51)) <= 0.05 * len(holders)


def test_large_groups_of_strings(spark):
    """A passage of more different texts than one suffix array takes: counted string by string, with the same result."""
    passage = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz", k=460))
    rows = [(i, f"{i:03d}" * 20 + chr(33 + i) + passage + chr(33 + i) + f"{i * 7:04d}" * 30) for i in range(lpf.GROUP_TEXTS + 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lpf.without_repeats(df).collect()}
    for i, text in rows:
        assert (got[i].n_removed, got[i].n_spans) == (460, 1), i
        assert got[i].kept_sha256 == hashlib.sha256(text.replace(passage, "").encode()).hexdigest()


def test_large_groups_either_way(spark, monkeypatch):
    """A group of many texts gives the same in one suffix array and string by string; the former while it is small in bytes."""
    passage = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz", k=460))
    rows = [(i, f"{i:03d}" * 20 + passage[i % 7 :] + f"{i * 7:04d}" * 30) for i in range(lpf.GROUP_TEXTS + 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = sorted(lpf.without_repeats(df).collect())
    counted = []
    strings = lpf._strings
    monkeypatch.setattr(lpf, "GROUP_BYTES", 0)
    monkeypatch.setattr(lpf, "_strings", lambda length: counted.append(length) or strings(length))
    assert sorted(lpf.without_repeats(df).collect()) == whole and counted
    assert all(r.n_removed >= 453 for r in whole)
