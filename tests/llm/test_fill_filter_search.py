"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import fill_middle, shared, tiered_search, url_filter


def cut_units(text: str, together) -> list[str]:
    """Units by looking at every two neighbours."""
    out: list[str] = []
    for i, c in enumerate(text):
        same = i > 0 and any(re.fullmatch(a, text[i - 1], re.S) and re.fullmatch(b, c, re.S) for a, b in together)
        if same:
            out[-1] += c
        else:
            out.append(c)
    return out


@pytest.mark.parametrize("grammar", [fill_middle.CODE_POINTS, fill_middle.WORDS, fill_middle.LINES, fill_middle.SPACED_WORDS])
def test_units_join_to_the_text(spark, grammar):
    texts = ["", "a", " ", "\n", "two words", "a\n\nb\r\nc\n", "🙂🙃 漢字\n🙂", "  x  y ", "tab\tand\x0bmore", "\n".join("line %d" % i for i in range(300))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fill_middle.units(F.col("text"), grammar).alias("u")).collect()
    ascii_space = [(a.replace(r"\S", r"[^ \t\n\x0b\f\r]").replace(r"\s", r"[ \t\n\x0b\f\r]"), b.replace(r"\S", r"[^ \t\n\x0b\f\r]").replace(r"\s", r"[ \t\n\x0b\f\r]")) for a, b in grammar.together]
    for i, u in rows:
        assert "".join(u) == texts[i] and list(u) == cut_units(texts[i], ascii_space)


def fill_by_hand(key, text: str, seed=1) -> tuple:
    n = len(text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", a, b - a
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", a, b - a


def test_fill_middle_of_odd_texts(spark, odd_docs):
    more = [(100 + i, t) for i, t in enumerate(["has <M> in it", "almost <P", "<", "S>", "🙂", "<S", "M><P", "x" * 7, " \u0085"] * 6)]
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string")).withColumns({"n": F.lit("x"), "form": F.lit("y"), "output": F.lit(1)})
    done = fill_middle.transform(docs.select("doc_id", "text"), "doc_id", "text")
    rows = done.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    assert len(rows) == docs.count() and {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r["n"], r["form"], r["output"], r["prefix_units"], r["middle_units"]) == fill_by_hand(r["doc_id"], r["text"] or "")
        assert r["back"] == (r["text"] or "")
    assert fill_middle.transform(docs.limit(0), "doc_id").count() == 0
    # columns with the names of the result are only looked at where they are asked for
    assert fill_middle.transform(docs, "doc_id").columns == ["doc_id", "n", "form", "output", "prefix_units", "middle_units"]


def test_fill_middle_other_units_and_marks(spark):
    text = "one two  three four five six seven\nand eight nine ten"
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    marks = fill_middle.Marks("[pre*]", "[suf+]", "[mid.]")
    rows = fill_middle.transform(docs, "doc_id", grammar=fill_middle.SPACED_WORDS, marks=marks, plain_percent=0, spm_percent=50).withColumn("back", fill_middle.restore(F.col("output"), F.col("form"), marks)).collect()
    assert {r["back"] for r in rows} == {text} and {r["form"] for r in rows} == {"psm", "spm"}
    words = cut_units(text, [(r"\S", r"\S"), (r"\s", r".")])
    for r in rows:
        a, m = r["prefix_units"], r["middle_units"]
        assert f"[mid.]{''.join(words[a : a + m])}" in r["output"] and f"[pre*]{''.join(words[:a])}" in r["output"]


def glob_regex(glob: str) -> str:
    out = ""
    for kind, c in url_filter.glob_parts(glob):
        out += {"c": re.escape(c), "?": "[^/]", "*": "[^/]*", "**": ".*"}[kind]
    return out


def test_automaton_against_regular_expressions():
    draw = random.Random(5)
    globs = ["", "*", "**", "?", "a", "*a*b", "**/x", "\\*a", "a?c", ".*.com/**", "é*", "**" + "abcdefghij" * 20]  # the last one spans several words
    globs += ["".join(draw.choices(["a", "b", "/", ".", "?", "*", "**", "é"], k=draw.randint(1, 9))) for _ in range(150)]
    urls = ["", "a", "/", "*a", "é", "🙂", "a/b", "x" * 5000 + "abcdefghij" * 20, ".www.x.com/a/b"] + ["".join(draw.choices("ab/.é🙂", k=draw.randint(0, 14))) for _ in range(150)]
    auto = url_filter.compile_globs(globs)
    assert auto.words > 5
    got = url_filter.run_automaton(auto, urls)
    for i, u in enumerate(urls):
        for k, g in enumerate(globs):
            assert got[i, k] == bool(re.fullmatch(glob_regex(g), u, re.S)), (g, u)
    assert url_filter.run_automaton(auto, []).shape == (0, len(globs))


def judge_by_hand(url, rules, blocked):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p))(r.rule.split("/")[0], "/" + r.rule.split("/", 1)[1])]
    best = min(fits, key=lambda r: (-len(r.rule), not r.blocks, r.rule), default=None)
    own = bool(host or path) and any(re.fullmatch(glob_regex(g), f".{host}{path}", re.S) for g in blocked)
    return host, path, best and best.rule, "block" if (best.blocks if best else own) else "allow"


URLS = [
    None, "", "no scheme", "http://", "://", "http:///path", "HTTP://WWW.Example.COM/en/a", "http://example.com/EN/a", "http://example.com/en", "http://example.com/en/", "http://xexample.com/en/",
    "http://a.example.com/en/x?y=/en/", "http://b.net/es/1", "http://b.net?/es/1", "http://b.net#x", "http://net/es/", "http://b.net/fr/://c.com/", "http://casino.b.org/x", "http://x.casino-win.org/", "http://x.org/casino.",
    "ftp://best-pills.org", "http://a.best-pills.org/q", "http://m.ads-track.x.org/1", "http://a.org/sitemap1.xml", "http://É.com/ÀB", "http://a.org/" + "x" * 200_000, "http://" + "a." * 30_000 + "com/", "http://a\nb.com/x\ny", "http://COMPANY.com/*",
]


def test_url_filter_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS + URLS[:9])], "page_id long, url string, host string, verdict string")
    rows = url_filter.judge(pages, "page_id").orderBy("page_id").collect()
    want = [judge_by_hand(u, url_filter.HOST_RULES, url_filter.BLOCKED) for u in URLS + URLS[:9]]
    assert [tuple(r)[1:] for r in rows] == want
    assert {w[2] for w in want} == {None, "com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/"} and {w[3] for w in want if w[2] is None} == {"allow", "block"}
    assert url_filter.judge(pages.limit(0), "page_id").count() == 0
    free = url_filter.judge(pages, "page_id", rules=(), blocked=()).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in free] == [(None, "allow")]


def test_url_filter_many_rules_and_ties(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "STATE_WORDS", 200)  # a few URLs at a time
    rules = [url_filter.HostRule(f"h{i}.org/{'p' * (i % 5)}", i % 2 == 0) for i in range(400)] + [url_filter.HostRule("h7.org/pp", True), url_filter.HostRule("h*.org/", True)]
    urls = [f"http://w.h{i}.org/{'p' * (i % 7)}" for i in range(420)] + ["http://h7.org/pp", "http://h*.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge(pages, "page_id", rules=rules).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in rows] == [judge_by_hand(u, rules, url_filter.BLOCKED) for u in urls]


def terms_of(text) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def search_by_hand(docs, items) -> dict:
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        asked, scored = Counter(terms_of(text)), []
        for i, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n_docs // words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, q in asked.items() if t in bag)
            if score > 0:
                scored.append((-score, math.inf if i is None else i))
        out[item] = [(r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:10], 1)]
    return out


def searched(index, items) -> dict:
    out = defaultdict(list)
    for r in tiered_search.search(index, items).collect():
        out[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def corpus():
    """Frequent and rare words, copies, and two documents that one item is about."""
    draw = random.Random(2)
    common, rare = [f"c{i}" for i in range(40)], [f"R{i}" for i in range(3000)]
    docs = [(i, " ".join(draw.choices(common, k=draw.randint(1, 60)) + draw.choices(rare, k=draw.randint(0, 20)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(7, docs[9][1]), (None, docs[3][1]), (None, None), (500, ""), (501, "... --"), (502, "x" * 50_000 + " R1 " + "c1 c2 " * 9000), (503, "r1 R2 r3 r4 R5")]
    items = [(i, " ".join(draw.choices(common, k=8) + draw.choices(rare, k=4))) for i in range(30)]
    items += [(90, docs[3][1]), (91, "r1 r2 r3 r4 r5"), (92, "nothing known"), (93, ""), (94, None), (95, "c1 c1 C1"), (96, " ".join(common * 50))]
    return docs, items


@pytest.mark.parametrize("cuts", [(0.2, 0.1), (), (0.6, 0.4, 0.2, 0.05)])
def test_search_against_brute_force(spark, corpus, cuts, monkeypatch):
    monkeypatch.setattr(tiered_search, "COUNTS", 500)  # counts are handed on in pieces
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({"row": F.lit("x"), "tier0": F.lit(1), "_text": F.lit("")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "term": F.lit("x")})
    index = tiered_search.build(d, cuts)
    want = {k: v for k, v in search_by_hand(docs, items).items() if v}
    assert searched(index, i) == want
    # many items a block or few, much or little room for candidates
    monkeypatch.setattr(tiered_search, "ITEMS", 10)
    monkeypatch.setattr(tiered_search, "CANDIDATES", 10**6)
    assert searched(index, i) == want


def test_items_are_proven_in_upper_tiers(spark, monkeypatch):
    draw = random.Random(4)
    common = [f"c{i}" for i in range(30)]
    docs = [(i, " ".join(draw.choices(common, k=50) + [f"topic{i % 150}"] * (1 + i % 4) + [f"w{i}"])) for i in range(3000)]
    items = [(i, f"topic{i} c{i} c{i + 1}") for i in range(20)]
    index = tiered_search.build(spark.createDataFrame(docs, "doc_id long, text string"))
    found = tiered_search.search(index, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["tiers"] for r in found} & {1, 2}  # not all by reading all tiers
    want = search_by_hand(docs, items)
    for item in want:
        assert sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["item_id"] == item) == want[item]


def test_search_without_documents_or_items(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, "-")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "x")], "item_id string, text string")
    some = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for docs in (none, blank):
        assert tiered_search.search(tiered_search.build(docs), items).count() == 0
    found = tiered_search.search(tiered_search.build(some), items).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [("a", 1, 1)]
    assert tiered_search.search(tiered_search.build(some), items.limit(0)).count() == 0


def test_index_moves_no_postings(spark, few_docs):
    index = tiered_search.build(few_docs)
    assert "Exchange" not in index.documents._jdf.queryExecution().toString()
    # a tier that is not read is not in the scan
    asked = tiered_search.Asked(np.array([1]), np.array([0, 1]), np.array([0]), np.array([5]), np.zeros((3, 1), np.int64))
    plan = tiered_search.scan(index, asked, np.zeros(1, np.int64), 0)._jdf.queryExecution().executedPlan().toString()
    assert "tier0" in plan and "tier1" not in plan.split("ReadSchema")[1]


def test_broadcast_of_counts_is_checked(spark, few_docs, monkeypatch):
    index = tiered_search.build(few_docs)
    items = few_docs.limit(5).select(F.col("doc_id").alias("item_id"), F.substring("text", 1, 80).alias("text"))
    want = searched(index, items)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 1)
    assert searched(index, items) == want
