import pytest
from conftest import prose

from folio.llm import bpe, toxicity


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    passage = "This very long line is found in many documents of all kinds"
    bench = prose(500, 30)
    rows = []
    for i in range(240):
        text = prose(i, 60) + "\n" + prose(1000 + i, 40)
        if i % 4 == 0:
            text += " grobbel."
        if i % 3 == 1:
            text = passage + "\n" + text
        if i in (50, 51):
            text += " " + bench
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
    rows += [(300, rows[1][1] + " more", "en", "s1", 1), (301, rows[2][1].upper(), "en", "s1", 1), (302, None, "en", "s1", 0), (303, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, passage, bench


def test_stages_against_brute_force(spark, tables):
    import corpus_pipeline as c

    folder, rows, passage, bench = tables
    source = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train_for(source, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(source, model, "doc_id").filter(f"score >= {toxicity.THRESHOLD}").collect()}
    assert len(toxic & {i for i in range(240) if i % 4 == 0}) >= 55 and not {i for i in toxic if i % 4}
    left = {i: t or "" for i, t, *_ in rows if i not in toxic}
    keeper = max(i for i, t in left.items() if passage in t.split("\n"))
    left = {i: t if i == keeper else "\n".join(x for x in t.split("\n") if x != passage) for i, t in left.items()}
    for copy, first in ((300, 1), (301, 2)):
        if first in left and copy in left:
            del left[copy]
    left = {i: t for i, t in left.items() if bench not in t}
    enc = bpe.encoder(*bpe.default_vocabulary())
    want = {i: ("en", f"s{i % 5}" if i < 300 else "s1", enc.encode(t)) for i, t in left.items()}
    got = c.run(spark, folder)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids"]
    assert {r.doc_id: (r.lang, r.source, r.token_ids) for r in got.collect()} == want


def test_odd_tables(spark, odd_docs, tables, tmp_path):
    """Repeated rows, nulls, a very long text, further columns with clashing names, and no rows at all."""
    import corpus_pipeline as c

    labels, bench = (spark.read.parquet(f"{tables[0]}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, docs in (("odd", odd_docs), ("none", odd_docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        got = c.run(spark, folder)
        assert got.columns == [*(x for x in odd_docs.columns if x != "text"), "n_tokens", "token_ids"]
        ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in got.collect())
        # 7 repeats itself and 8 repeats 7; the rest stays
        assert ids == ([] if name == "none" else [(False, 0), *((True, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 11))])


def test_stages_keep_the_columns(spark, tables):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), tables[0]).count() == 0
