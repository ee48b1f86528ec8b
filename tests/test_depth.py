"""Searches that skip blocks, scans that stop, rules as rows, records with line breaks: against plainer ways."""

import csv
import io
import random
import zipfile
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from folio import model
from folio.functions import similarity
from folio.operators import events, load, matching, rules, search
from folio.sources import adapters, readers, staging


# --- search


def corpus(n: int, seed: int = 3):
    """Documents of very different lengths over words of very different frequency, copies and blank ones."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    heavy = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(draw.choices(words, heavy, k=int(2 ** draw.uniform(0, 9))))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, docs[5][1]), (n + 3, docs[5][1].upper())]


@pytest.mark.parametrize("k", [1, 7, 60, 5000])
@pytest.mark.parametrize("coverage", [None, 0.9])
def test_best_hits_as_plain_ones(spark, k, coverage):
    docs = spark.createDataFrame(corpus(700), "id long, document string")
    draw = random.Random(k)
    texts = [" ".join(draw.choices([f"w{i}" for i in range(60)] + ["w1.", "2x", "zz", "x"], k=draw.randint(1, 7))) for _ in range(25)]
    tokens = search.query_tokens(spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0], "", "w300 w301"])], "q_id long, query string"))
    index = search.block_index(docs)
    found = search.best_hits(index, tokens, k, coverage)
    plain = search.top_hits(search.index(docs), tokens, docs.count(), k, coverage)
    rows = lambda df: sorted((r.q_id, r.rank, r.id, round(r.score, 6)) for r in df.collect())
    assert rows(found.hits) == rows(plain)
    assert 0 < found.read <= found.asked


def test_scores_are_exact_sums(spark):
    """Sums of doubles depend on their order: a score is the exact sum of its terms, rounded once, in any partitioning."""
    texts = corpus(120)
    docs = spark.createDataFrame(texts, "id long, document string")
    words = [w for i in range(40) for w in [f"w{i}"] * (1 + i % 3)]
    tokens = search.query_tokens(spark.createDataFrame([(0, " ".join(words))], "q_id long, query string"), names=0)
    idf = {r.token: Fraction(r.idf) for r in search.weights(search.index(docs), docs.count()).collect()}
    bags = {i: Counter((t or "").lower().split()) for i, t in texts}
    exact = {i: float(sum(bag[w] * idf[w] for w in words if w in bag)) for i, bag in bags.items() if set(bag) & set(words)}
    for rows in (docs, docs.repartition(7, "id")):
        assert {r.id: r.score for r in search.best_hits(search.block_index(rows), tokens, 500).hits.collect()} == exact
    # here a word's repeats are multiplied by its sum, which is rounded before
    plain = {r.id: r.score for r in search.top_hits(search.index(docs), tokens, docs.count(), 500).collect()}
    assert plain.keys() == exact.keys() and all(abs(plain[i] - exact[i]) < 1e-11 for i in exact)
    assert len({plain[i] for i in (5, 122, 123)}) == 1


def test_blocks_are_skipped(spark):
    """Of the postings of all tokens asked for, less than half are read."""
    draw = random.Random(5)
    words, heavy = [f"w{i}" for i in range(400)], [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(draw.choices(words, heavy, k=int(20 * draw.paretovariate(2))))) for i in range(6000)]
    docs = spark.createDataFrame(docs, "id long, document string").repartition(3)
    asked = spark.createDataFrame([(i, " ".join(f"w{draw.randrange(200)}" for _ in range(draw.randint(2, 12)))) for i in range(20)], "q_id long, query string")
    tokens = search.query_tokens(asked, names=0)
    found = search.best_hits(search.block_index(docs), tokens, 10, 0.9)
    plain = search.top_hits(search.index(docs), tokens, docs.count(), 10, 0.9)
    rows = lambda df: sorted((r.q_id, r.rank, r.id) for r in df.collect())
    assert rows(found.hits) == rows(plain) and found.read < 0.5 * found.asked


def test_only_texts_and_sums_are_shuffled(spark, monkeypatch):
    """Postings stay where their texts were dealt to, and no place of a query's word is part of a shuffle's key."""
    plans, one = [], staging.materialise
    monkeypatch.setattr(staging, "materialise", lambda df, *by: plans.append(df._jdf.queryExecution().executedPlan().toString()) or one(df, *by))
    docs = spark.createDataFrame(corpus(40), "id long, document string")
    index = search.block_index(docs)
    assert len(plans) == 1 or "Generate" not in plans[1]
    assert sum("Exchange " in line for line in plans[0].splitlines()) == 1
    tokens = search.query_tokens(spark.createDataFrame([(0, "w1 w2 w2 w9")], "q_id long, query string"), names=0)
    assert search.best_hits(index, tokens, 3, 0.9).hits.count() == 3
    keys = [line[line.index("partitioning(") :] for plan in plans for line in plan.splitlines() if "Exchange " in line and "partitioning(" in line]
    assert len(keys) > 3 and not any(name in key for key in keys for name in ("pos#", "md5"))


def test_searches_of_nothing(spark):
    none = spark.createDataFrame([], "id long, document string")
    some = spark.createDataFrame([(1, "a b")], "id long, document string")
    ask = search.query_tokens(spark.createDataFrame([(1, "ab b")], "q_id long, query string"))
    assert search.best_hits(search.block_index(none), ask).hits.count() == 0
    assert search.best_hits(search.block_index(some), ask.limit(0)).hits.count() == 0
    assert [r.id for r in search.best_hits(search.block_index(some), ask).hits.collect()] == [1]


def decisions(spark, n: int, whole: bool):
    draw = random.Random(n)
    names, prevs = ["ann", "anne", "bob", "rob", ""], ["nan", "", "lee", "leigh"]
    pick = lambda: (draw.choice(names), draw.choice(names), draw.choice(prevs), draw.choice(["010280", "010281", "111190"]), draw.choice(["5551234", "5551235", ""]))
    rows = []
    for q in range(n):
        mine = pick()
        for rank in range(1, draw.randint(2, 40)):
            other = mine if draw.random() < 0.02 else pick()
            rows.append((q, q * 1000 + rank, rank, draw.choice([3.5, 6.0, 20.0] + [60.0] * (draw.random() < 0.05)), draw.random(), mine, other, draw.random() > 0.05))
    fields = "struct<first:string,last:string,prev:string,dob:string,phone:string>"
    hits = spark.createDataFrame(rows, f"q_id long, id long, rank int, score double, model_score double, row {fields}, master {fields}, whole boolean")
    return hits if whole else hits.drop("whole")


@pytest.mark.parametrize("whole", [True, False])
def test_the_scan_stops_at_the_first_acceptance(spark, whole):
    hits = decisions(spark, 60, whole)
    queries = spark.range(63).withColumnRenamed("id", "q_id")
    got = search.first_accepted(hits, queries)
    plain = search.decide(hits.withColumns(search.field_outcome(F.col("score"), F.col("model_score"), whole=F.col("whole") if whole else None)), queries)
    rows = lambda df: sorted((r.q_id, r.id or 0, r.found, r.confidence) for r in df.collect())
    assert rows(got) == rows(plain)
    sums = got.agg(F.sum("hits_read"), F.sum("ratios"), F.count_if(F.col("found") == "Yes")).first()
    assert sums[2] > 10 and sums[0] < hits.count() and sums[1] < hits.count()  # not three for each hit
    assert got.filter("q_id = 62").first()["hits_read"] == 0


def test_equal_rows_are_fitted_once_and_documents_put_to_distinct_queries(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(a := draw.randint(0, 1), draw.choice([1.5, 2.5, 7.0]), float(draw.random() < 0.2 + 0.5 * a)) for _ in range(3000)]
    pairs = spark.createDataFrame(rows, "a int, b double, y double")
    vector = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(pairs)
    plain = LogisticRegression(featuresCol="v", labelCol="y", maxIter=25, regParam=1e-4).fit(vector)
    given, one = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df: given.append(df.count()) or one(self, df))
    monkeypatch.setattr(matching, "SHARES", 500)
    model = matching.fit_rescorer(pairs, ["a", "b"], "y")
    assert given[0] <= 500 + 12
    assert model.coefficients.toArray().tolist() == pytest.approx(plain.coefficients.toArray().tolist(), rel=1e-4)
    docs = spark.createDataFrame([(i, f"{draw.choice('ab')} {draw.choice('cde')}") for i in range(60)], "id long, document string")
    asked = spark.createDataFrame([(i, ["c a", "b d"][i % 2]) for i in range(30)], "q_id long, query string")
    found = search.best_hits(search.block_index(docs), search.query_tokens(asked, names=0), 5)
    assert found.best.count() == 10
    sides = found.beside(docs, asked).select("q_id", "id", "score", "rank", "document", "query")
    assert sorted(sides.collect()) == sorted(found.hits.join(docs, "id").join(asked, "q_id").select(*sides.columns).collect())


def test_a_ratio_is_remembered(monkeypatch):
    calls = []
    monkeypatch.setattr(similarity, "ratio", lambda x, y: calls.append(1) or 0)
    walk = search._Walk()
    for i in range(20):
        walk.step(search._Hit(1, True, i, 1.0, 0.1, True, False, "", "", "555", "556", "ann", "bob"))
    walk.end()
    assert len(calls) == 1 and walk.done == [(1, None, "No", 99, 20, 20)]


def test_ratio_of_one_pair(spark):
    pairs = [("abc", "abd"), ("", "x"), (None, "x"), ("ABC", "abc"), ("a b c", "c b a")]
    got = spark.createDataFrame(pairs, "a string, b string").select(similarity.sequence_ratio("a", "b")).collect()
    assert [r[0] for r in got] == [similarity.ratio(a, b) for a, b in pairs]


# --- rules as rows


RULES = {
    "c1": [("name", "string", "3", "8", "[A-Z][a-z ]+", "true", "false"), ("code", "string", "x", " 5 ", None, "#/", "true"), ("born", "date", None, None, None, None, None, "mm/dd/yyyy", "01/01/1950", "today"), ("free", None, "", "", "", None, "FALSE")],
    "c2": [("born", "date", None, None, None, None, "true", "yyyy-mm-dd", "1990-01-01", "junk"), ("name", "string", None, None, "b|c", " -", "x"), ("late", "date", None, None, None, None, "false", "dd/mm/yyyy", "TODAY", None), ("odd", "date", None, None, None, None, "false", "yy", "01/01/2000", "12/31/2001")],
    "c3": [],
}


def config(spark, review="false"):
    fields = lambda rows: [(f[0], f[0], f[1], None, None, [], tuple((list(f[2:]) + [None] * 8)[:8])) for f in rows]
    shaped = {c: [(n, kind, lo, hi, pattern, special, null, *rest) for n, kind, lo, hi, pattern, special, null, *rest in rows] for c, rows in RULES.items()}
    return spark.createDataFrame([("acc", [(c, review, True, fields(rows)) for c, rows in shaped.items()])], model.CONFIG)


VALUES = [None, "", "  ", "Abc", "abc", "b-1 x", "Ann Lee", "A#/", "a\tb", "'\"’", "longer than eight", "02/30/2001", "2/3/2001", "31/12/2030", "1990-01-01", "1989-12-31", "2001-6-1", "06/15/2000", "12/31/2001", "01/01/2002"]


def test_rules_as_rows_equal_compiled_ones(spark):
    import json

    draw, docs = random.Random(8), []
    for i in range(400):
        pairs = {}
        for field in ("name", "code", "born", "free", "late", "odd"):
            if draw.random() < 0.9:
                pairs[field] = draw.choice(VALUES)
            if draw.random() < 0.95:
                pairs[f"{field}_s"] = draw.choice(["99", "80", "79.9", "x", None, "100"])
        if draw.random() < 0.05:
            pairs["error"] = "E1"
        docs.append((i, draw.choice(["c1", "c2", "c3", "c9"]), draw.choice([json.dumps(pairs)] * 20 + [None, "no json", "[1]"])))
    frame = spark.createDataFrame(docs, "doc long, collection string, key_value_pairs string").withColumn("_pairs", F.lit("kept"))
    for review in ("false", "True"):
        found = readers.collections(config(spark, review))
        got = rules.validate_by(frame, rules.rule_rows(found), "2024-05-06")
        assert got.columns[-3:] == ["results", "validation_passed", "data_is_valid"] and got.filter("_pairs = 'kept'").count() == 400
        got = {r.doc: (r.results, r.validation_passed, r.data_is_valid) for r in got.collect()}
        for c in RULES:
            compiled = readers.field_rules(readers.collection(found, c))
            want = rules.validate(frame.filter(F.col("collection") == c), compiled, "2024-05-06", audit=review == "True")
            for r in want.collect():
                assert got[r.doc] == (r.results, r.validation_passed, r.data_is_valid), (c, r.key_value_pairs)
        assert all(got[i][0] == [] for i, c, _ in docs if c == "c9")
    messages = {e.split("'")[0] for v in got.values() for x in v[0] for e in x.ValidationErrors}
    assert len(messages) >= 9  # every kind of message came up


def test_rules_as_rows_are_not_in_the_plan(spark):
    frame = spark.createDataFrame([("c1", "{}")], "collection string, key_value_pairs string")
    plan = rules.validate_by(frame, rules.rule_rows(readers.collections(config(spark))), "2024-05-06")._jdf.queryExecution().executedPlan().toString()
    assert "[A-Z][a-z ]+" not in plan.split("Project")[1] and plan.count("from_json") == 1


# --- records


def written(rows) -> str:
    out = io.StringIO()
    csv.writer(out, delimiter="|", quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    return out.getvalue()


def test_manifest_with_line_breaks_in_cells(spark, tmp_path, monkeypatch):
    draw = random.Random(1)
    pieces = ["a", "b\nc", '"', "|", "\n", "\n\n", '""', 'x"\ny', "plain words", "~", "end\n"]
    cell = lambda: "".join(draw.choices(pieces, k=draw.randint(1, 5)))
    rows = [(str(i), cell().replace("~", "~~"), cell().replace("~", "~~")) for i in range(400)]
    (tmp_path / "a.csv").write_text(written([("Row Id", "First Cell", "SecondCell"), *rows]))
    # the same columns in another order, and one of its own; cells without quotes, quotes inside them
    (tmp_path / "b.csv").write_text('﻿SecondCell|Row Id|Extra\nsize 5" pipe|x1|e~|1\n"two\nlines"|x2|\n|x3|"say ""hi"""\nto|o|many|cells\n"never closed|x5|\nrest of it\n')
    # small splits: states have to be carried over their bounds
    for size in ("64", "1000", "10m"):
        monkeypatch.setattr(readers, "RECORD_LINES", 50)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = readers.manifest(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got[0].asDict().keys() == {"row_id", "first_cell", "second_cell", "extra"}
        own = {r.row_id: r for r in got}
        blank = lambda v: None if v in readers.MISSING else v
        want = {i: (blank(a.replace("~~", "~")), blank(b.replace("~~", "~")), None) for i, a, b in rows}
        want |= {"x1": (None, 'size 5" pipe', "e|1"), "x2": (None, "two\nlines", None), "x3": (None, None, 'say "hi"')}
        assert {i: (r.first_cell, r.second_cell, r.extra) for i, r in own.items()} == want and len(got) == len(want)


def test_shared_folder_of_a_cluster(spark):
    from types import SimpleNamespace

    for master in ("spark://h:1", "local-cluster[2,1,512]"):
        nowhere = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: None), sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError):
            staging.shared_folder(nowhere)


def test_variants_are_read_and_not_parsed(spark):
    texts = ['{"k": "5", "n": 7, "it\'s": "x", "deep": {"a": 1}}', '{"k": "x"}', "{}", "no json", None, "[1]", '{"k": null, "error": "E"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string").withColumn("_p", F.lit("kept"))
    fields = {"k": "integer", "n": "integer", "it's": "string"}
    parsed, variant = load.explode_fields(rows, "v", fields), load.explode_fields(load.as_variant(rows, "v"), "v", fields)
    pick = lambda df: sorted(tuple(r) for r in df.select("i", "_p", "k", "n", "`it's`").fillna(-1).fillna("").collect())
    assert pick(parsed) == pick(variant) and pick(parsed)[0] == (0, "kept", 5, 7, "x")
    stored = staging.materialise(load.as_variant(rows, "v"))
    plan = load.explode_fields(stored, "v", fields)._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "from_json" not in plan
    for docs in (rows, stored):
        got = rules.validate(docs, [model.FieldRule("k", allow_null=True)], "2024-01-01", pairs="v", threshold=0).select("i", "validation_passed").collect()
        assert [r[1] for r in sorted(got)] == ["True", "True", "True", "False", "False", "False", "False"]


def test_archives_larger_than_a_piece(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "PIECE", 1000)
    draw, want = random.Random(2), {}
    for a in ("one", "two"):
        with zipfile.ZipFile(tmp_path / f"{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("folder/", b"")
            for i in range(12):
                want[a, f"folder/m{i}.bin"] = draw.randbytes(draw.choice([0, 1, 999, 1000, 1001, 25_000]))
                z.writestr(f"folder/m{i}.bin", want[a, f"folder/m{i}.bin"])
    found = adapters.members(spark, str(tmp_path)).collect()
    assert {(r.archive.split("/")[-1][:3], r.name): r.size for r in found} == {k: len(v) for k, v in want.items()}
    got = {}
    for r in sorted(adapters.expand(spark, str(tmp_path), tasks=5).collect(), key=lambda r: r.part):
        assert len(r.content) <= 1000
        got.setdefault((r.archive.split("/")[-1][:3], r.name), []).append((r.part, bytes(r.content)))
    assert {k: b"".join(c for _, c in v) for k, v in got.items()} == want
    assert all([p for p, _ in v] == list(range(len(v))) for v in got.values())


def test_clashing_names_are_kept(spark):
    odd = {c: F.lit("kept") for c in ("_p", "_o", "_t", "_rank", "_parts", "_paths", "_blocks", "_lines", "_answer", "_fields", "_parsed")}
    rows = spark.createDataFrame([(1, "b", '{"k": "5"}'), (2, "b", '{"k": "6"}')], "i int, b string, v string").withColumns(odd)
    kept = lambda df: df.select(*odd).distinct().collect() == [tuple(["kept"] * len(odd))]
    assert kept(load.explode_fields(rows, "v", {"k": "integer"})) and kept(matching.extract_json(rows, "v", ["k"]))
    assert kept(adapters.append_lookup(rows, "v", lambda asked: asked, {"k": "k"}))
    assert kept(adapters.read_images(rows.withColumn("image_path", F.lit("x")), lambda asked: ["[]"] * len(asked)))
    (message,) = events.review_messages(rows.withColumn("BatchId", F.lit("x"))).collect()
    assert message.message.count('"_parts":"kept"') == 2
    assert load.grouped_text(rows, ["b", "_o"], "i", "v").first()["_o"] == "kept"
