"""Personal data, URL words and site templates against plain Python, over whole small tables and made cases."""

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changeweir.llm import cascade, pii, queries, templates, urls

SF = "/root/testdata/sf0.001"


def luhn(text):
    ds = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(ds)) % 10 == 0


def plain_base(text):
    """The contract's base kinds, as it words them."""
    n_digits = lambda m: len(re.sub("[^0-9]", "", m))
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= n_digits(m) <= 19 and luhn(m)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= n_digits(m) <= 15),
    }
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(m.group())] for k, (p, ok) in kinds.items()}


def plain_row(text):
    found = plain_base(text or "")
    listed = ",".join(f"{k}:{s}:{e}" for k, spans in found.items() for s, e in spans)
    return tuple(map(len, found.values())), hashlib.sha256(listed.encode()).hexdigest()


CASES = [
    "7536784127813050 4845168114407329", "4111 1111 1111 1111 5500-0000-0000-0004", "4111111111111111", "1 4111111111111111",
    "a@b.c@d.e.f x@y z@.q %@a.b..c", "1.2.3.4.5.6.7.8", "999.1.1.1 001.02.3.4 1.2.3", "+1 (555) 123-4567+49 30 123456", "+12", "é😀 10.0.0.1 😀a@b.cd",
    "token 0123456789ABCDEF0123456789abcdef", "0123456789ABCDEF0123456789ABCDEF", "12345678901234567890 4111111111111111", "", None,
]


def test_personal_data_like_the_plain_version(spark):
    made = spark.createDataFrame([(-i, t) for i, t in enumerate(CASES)] + [(None, CASES[0]), (-1, CASES[1])], "doc_id LONG, text STRING")
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select(F.col("doc_id").cast("long"), "text").union(made)
    want = Counter((r.doc_id, *plain_row(r.text)) for r in docs.collect())
    rows = pii.report(docs).collect()
    assert Counter((r.doc_id, (r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) for r in rows) == want
    assert all(sum(k[1][i] * n for k, n in want.items()) > 5 for i in range(4))  # every kind occurs


def test_cards_side_by_side_and_secrets_in_capitals(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id LONG, text STRING")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert got[0].n_card == 0 and got[0].spans == "card_group:0:16,card_group:17:33"
    assert got[1].n_card == 0 and got[1].spans == "card_group:0:19,card_group:20:39"
    assert got[2].spans == "card:0:16" and "card_group:2:18" in got[3].spans
    assert got[10].spans == "secret:6:38" and got[11].spans == ""  # no word beside it
    assert got[12].spans == "card_group:21:37"
    assert {r.doc_id: r.text for r in pii.redact(df).collect()}[0] == "[CARD_GROUP] [CARD_GROUP]"


def test_every_split_is_the_cheapest():
    """Against all segmentations of short names; unknown stretches of any length are one word."""
    pick = random.Random(3)
    for _ in range(200):
        counts = {"".join(pick.choices("ab", k=pick.randint(1, 4))): pick.randint(1, 50) for _ in range(pick.randint(0, 6))}
        name = "".join(pick.choices("abc", k=pick.randint(1, 9)))
        s = urls.Segmenter(counts)
        price = lambda words: sum(s.cost.get(w, s.unknown + 2.0 * len(w)) for w in words)  # noqa: B023, E731
        cuts = [c for n in range(len(name)) for c in itertools.combinations(range(1, len(name)), n)]
        least = min(price([name[a:b] for a, b in zip((0, *c), (*c, len(name)))]) for c in cuts)
        got = s.split(name)
        assert "".join(got) == name and math.isclose(price(got), least)


def test_words_of_any_length(spark):
    """Words over ``MAX_WORD`` letters are whole words of the dictionary, and a very long part is split."""
    long, like = "donaudampfschifffahrtsgesellschaftskapitaen", "donaudampfschifffahrtsgesellschaftsmuetze"
    html = f"{(long + ' ') * 50} {(like + ' ') * 50} {'blue ' * 90} {'red ' * 90}"
    deep = "".join(random.Random(1).choices("blue red".split(), k=3000)) * 10
    rows = [(1, f"http://blue{long}red.example/", html), (2, f"http://{like}blue.example/{deep}", None), (3, f"http://{'q' * 60}.example/", ""), (3, None, None)]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    got = {(r.page_id, r.host != ""): r for r in urls.judge(df).collect()}
    assert got[1, True].words == f"blue {long} red example"
    assert got[2, True].words == " ".join([like, "blue", "example", *re.findall("blue|red", deep)])
    assert got[3, True].words == "q" * 60 + " example" and got[3, False].words == ""


def test_subtree_hashes():
    """Equal hashes stand for equal sources but for white space; the deepest page is read once."""
    pick, source = random.Random(2), defaultdict(set)
    for _ in range(300):
        parts, depth = [], 0
        for _ in range(pick.randint(1, 12)):
            kind = pick.choice(["<div>", "</div>", "<p>", "<ul class=x>", "</ul>", "text", "<b>bold</b>", "other\n  words", "<nav><div>n</div></nav>"])
            parts.append(kind)
        page = templates.Page("".join(parts))
        for s, e, h in page.candidates():
            source[h].add(re.sub(r"\s", "", page.source[s:e]))
    assert len(source) > 100 and all(len(x) == 1 for x in source.values())
    seen = Counter(x for one in source.values() for x in one)
    assert max(seen.values()) == 1
    same = [templates.Page(f"<section>\n <div>a{gap}b</div></section>").candidates() for gap in (" ", "\n\t ", "")]
    assert [x[2] for x in same[0]] == [x[2] for x in same[1]] != [x[2] for x in same[2]]
    began = time.perf_counter()
    assert len(templates.Page("<div>" * 20_000 + "x " * 100_000).candidates()) == 20_000
    assert time.perf_counter() - began < 5


def test_nested_templates_go_once():
    page = templates.Page("<body><div>a<div>b</div><p>c</p></div><p>d</p><div>e</div><p>f</p></body>")
    hashes = {page.source[s:e]: h for s, e, h in page.candidates()}
    assert page.main_text(set()) == "a\n\nb\n\nc\n\nd\n\ne\n\nf"
    outer = hashes["<div>a<div>b</div><p>c</p></div>"]
    assert page.main_text({outer, hashes["<div>b</div>"], hashes["<div>e</div>"]}) == "d\n\nf"
    assert page.main_text({hashes["<div>b</div>"]}) == "a\n\nc\n\nd\n\ne\n\nf"


@pytest.mark.parametrize("rules", [cascade.RULES, cascade.RULES[::-1]])
def test_kept_by_statistics_and_by_the_cascade(spark, rules):
    """Measures taken from columns give the verdicts of the rules that compute them; their order changes none."""
    docs = queries.table(spark, SF, "documents")
    first = {r.doc_id: r.kept for r in cascade.statistics(docs).collect()}
    assert first == {r.doc_id: r.rejected_by is None for r in cascade.judged(docs, rules).collect()}
