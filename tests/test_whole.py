"""Registered queries over rows that a cut of the input would lose."""

import random

import numpy as np
import pytest

from folio.functions import editing
from folio.operators import load, matching
from folio.plans import catalogue, linkage

LONG = "the same sixty characters begin every text of this small table and then "
TEXTS = {
    2: ("en", LONG + "one goes on about rivers, bridges and boats"),
    4: ("en", LONG + "one goes on about rivers, bridges and boots"),
    6: ("en", LONG + "0123456789 9876543210 1357924680 2468013579 " * 4),
    7: ("de", "Der Hund schläft heute im Garten hinter dem Haus"),
    9: (None, "Der Hund schläft heute im Garten hinter dem Haus."),
    11: ("fr", "xy"),
}


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    spark.createDataFrame([(i, text, lang) for i, (lang, text) in TEXTS.items()], "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, text.upper()) for i, (_, text) in TEXTS.items() if i != 4], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def cleaned():
    keys = {i: " ".join("".join(c for c in t if c.isascii() and (c.isalnum() or c.isspace())).split()).lower() for i, (_, t) in TEXTS.items()}
    return {i: {k[x : x + 3] for x in range(len(k) - 2)} for i, k in keys.items() if len(k) >= 3}


def test_linkage_takes_whole_texts_of_all_documents(spark, documents, monkeypatch):
    grams = cleaned()
    distance = {(i, j): 1 - len(a & b) / len(a | b) for i, a in grams.items() for j, b in grams.items()}
    close = {p: round(d, 6) for p, d in distance.items() if d <= 0.8}
    listed = {p: d for p, d in close.items() if p[0] != 4}  # the list lacks one text
    run = lambda name: catalogue.QUERIES[name](spark, documents).collect()
    assert {(r.id, r.n) for r in run("q44_ngrams")} == {(i, len(g)) for i, g in grams.items()}
    monkeypatch.setattr(matching, "BLOCK_BYTES", 100)
    assert {(r.l_id, r.r_id): r.distance for r in run("q45_gram_pairs")} == listed
    assert {(2, 2), (2, 4), (6, 6), (7, 7), (7, 9), (9, 7), (9, 9)} <= {(r.ref_id, r.transaction_id) for r in run("q46_match_keys")} <= set(listed)
    assert {(2, 2), (2, 4), (7, 9)} <= {(r.l_id, r.r_id) for r in run("q49_lsh_pairs")} <= set(listed)
    keys = linkage.whole_keys(spark, documents)
    found = matching.gram_pairs(keys, keys).filter("l_id < r_id")
    assert {(r.l_id, r.r_id): round(r.distance, 6) for r in found.collect()} == {p: d for p, d in close.items() if p[0] < p[1]}
    assert {(r.ref_id, r.transaction_id) for r in matching.match_pairs(found, "text").collect()} == {(2, 4), (7, 9)}


@pytest.mark.parametrize("hot", [2000, 3])
@pytest.mark.parametrize("distance", [0.8, 0.5, 0.2])
def test_gram_pairs_as_brute_force(spark, monkeypatch, hot, distance):
    """Short keys, with frequent n-grams in one piece and in several."""
    monkeypatch.setattr(matching, "HOT", hot)
    rng = random.Random(6)
    words = ["anna", "annas", "maria", "mario", "stone", "stones", "street", "0123", "0124"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 4)))) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, key string")
    grams = {i: {k[x : x + 3] for x in range(len(k) - 2)} for i, k in rows}
    want = {(i, j) for i, a in grams.items() for j, b in grams.items() if i < 45 <= j and 1 - len(a & b) / len(a | b) <= distance + 1e-9}
    got = matching.gram_pairs(df.filter("id < 45"), df.filter("id >= 45"), distance)
    assert {(r.l_id, r.r_id) for r in got.collect()} == want


def test_column_matches_of_all_customers(spark, tmp_path):
    spark.createDataFrame([(7,), (47,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(7,), (367,), (907,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    found = catalogue.QUERIES["q47_match_columns"](spark, str(tmp_path)).collect()
    want = {(s, c, f) for s in (7, 47) for c in (7, 367, 907) for f in ("name", "title")}
    assert {(r.ref_id, r.transaction_id, r.matched_on_field) for r in found} == want


def test_search_gives_and_decides_over_the_reference_limit(spark, tmp_path):
    # equal scores, so ids rank; for supplier 0, part 150 is the first that agrees in first name and phone
    ids = [(i, "red bolt", "Brand#0", "SMALL" if i == 150 else "SMALL ", 60) for i in range(1, 301) if i % 10 or i == 150]
    ids = [(i, n, b, t if i == 150 else "small", s) for i, n, b, t, s in ids]
    spark.createDataFrame(ids, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    hits = catalogue.QUERIES["q50_search"](spark, str(tmp_path)).collect()
    assert sorted(r["rank"] for r in hits) == list(range(1, 211))
    assert [r.id for r in sorted(hits, key=lambda r: r["rank"])].index(150) > 100
    (decision,) = catalogue.QUERIES["q51_ranked_decision"](spark, str(tmp_path)).collect()
    assert (decision.q_id, decision.id, decision.found) == (0, 150, "Yes")


def test_corrections_and_dimension_are_whole(spark, smallest):
    documents = spark.read.parquet(f"{smallest}/documents.parquet").count()
    corrected = catalogue.QUERIES["q11_reenter"](spark, smallest).collect()
    assert len(corrected) == documents and all(r.corrected == "v" + r.image_path.rsplit("/")[-1][:-4] for r in corrected)
    names = {r.n_nationkey: r.n_name for r in spark.read.parquet(f"{smallest}/nation.parquet").collect()}
    nation = {r.c_custkey: r.c_nationkey for r in spark.read.parquet(f"{smallest}/customer.parquet").collect()}
    assert {r.c_custkey: r.box for r in catalogue.QUERIES["q13_dimension"](spark, smallest).collect()} == {c: names[n] for c, n in nation.items()}


def test_keys_without_a_partner(spark):
    rows = spark.createDataFrame([("a", "t", "root/1.jpg"), ("a", "t", "root/2.jpg")], "batch_name string, transaction_id string, image_path string")
    fixed = spark.createDataFrame([("a", "t", "2.jpg", "v2"), ("a", "u", "1.jpg", "v1")], "batch_name string, transaction_id string, image_filename string, corrected string")
    assert [(r.image_path, r.corrected) for r in load.reenter(rows, fixed).collect()] == [("root/2.jpg", "v2")]
    boxes = spark.createDataFrame([("a", "box a")], "k string, box string")
    found = load.with_dimension(spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string"), boxes, "k").collect()
    assert {(r.id, r.box) for r in found} == {(1, "box a"), (2, None)}


def test_names_are_searched_as_a_list_and_copies_once(spark, monkeypatch):
    """Copies on both sides come out whole; no joined n-grams, and no table of a size unknown is sent to all tasks."""
    rng = random.Random(3)
    words = ["anna", "annas", "maria", "mario", "stone", "stones"]
    keys = [" ".join(rng.choices(words, k=2)) for _ in range(12)]
    rows = [(i, rng.choice(keys)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, name string")
    grams = {i: {k[x : x + 3] for x in range(len(k) - 2)} for i, k in rows}
    near = {(i, j) for i, a in grams.items() for j, b in grams.items() if i < 40 <= j and 1 - len(a & b) / len(a | b) <= 0.8 + 1e-9}
    for most in (1 << 16, 4):
        monkeypatch.setattr(matching, "BLOCK_KEYS", most)
        monkeypatch.setattr(matching, "TEXT_BYTES", 1000)  # rows of copies come out in several batches
        found = matching.match_columns(df.filter("id < 40"), df.filter("id >= 40"), ["name"], 0.0)
        got = [(r.ref_id, r.transaction_id) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == near
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "ngrams" not in plan and "SortMergeJoin" not in plan


def test_ids_are_laid_out_after_keys_have_met(spark):
    """A key meets its pairs once, whatever its copies; scores are rounded before that and compared as they are."""
    left = spark.createDataFrame([(i, "abcdef") for i in range(50)] + [(50, "uvwxyz")], "id long, name string")
    right = spark.createDataFrame([(i, "abcdex") for i in range(70)] + [(70, "uvwxyz"), (71, "abcdxx")], "id long, name string")
    found = matching.match_columns(left, right, ["name"], 5 / 6, digits=6)
    got = [(r.ref_id, r.transaction_id, r.ref_value, r.input_value, r.score) for r in found.collect()]
    assert sorted(got) == [(i, j, "abcdef", "abcdex", 0.833333) for i in range(50) for j in range(70)] + [(50, 70, "uvwxyz", "uvwxyz", 1.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(ids") < plan.index("BroadcastHashJoin") < plan.index("round(score")


def test_words_of_state_go_together_and_texts_are_cleaned_once(spark, smallest, monkeypatch):
    """Patterns of several lengths are one chunk; no text is cleaned for a filter too."""
    calls, one = [], editing._distances
    monkeypatch.setattr(editing, "_distances", lambda *given: calls.append(1) or one(*given))
    keys = [editing.codes("ab " * n) for n in (1, 20, 40, 70, 100)]
    p, t = (x.ravel() for x in np.meshgrid(range(5), range(5)))
    got = editing.edit_distances(keys, keys, p, t)
    assert got.tolist() == [abs(len(keys[i]) - len(keys[j])) for i, j in zip(p, t, strict=True)] and len(calls) == 1
    plan = linkage.whole_keys(spark, smallest)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(regexp_replace") == 1


def test_texts_at_the_edge_of_a_threshold(spark):
    """Only texts out of reach of every key are left out beforehand."""
    left = spark.createDataFrame([(1, "abcd" * 5), (2, "abcd" * 10)], "id long, key string")
    right = spark.createDataFrame([(n, "abcd" * n) for n in range(1, 24)], "id long, key string")
    got = {(r.l_id, r.r_id): r.score for r in matching.block_pairs(left, right, threshold=0.5).collect()}
    assert got == {(i, n): 1 - abs(n - m) / max(n, m) for i, m in ((1, 5), (2, 10)) for n in range(1, 24) if 1 - abs(n - m) / max(n, m) >= 0.5}


def test_longer_lists_than_are_broadcast_are_merged(spark, monkeypatch):
    from folio.sources import staging

    monkeypatch.setattr(staging, "BROADCAST_ROWS", 2)
    people = spark.createDataFrame([(i, f"Ann{'abcdefgh'[i]}", "Stone") for i in range(8)], "id long, FirstName string, LastName string")
    found = matching.match_persons(people, people)
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.m_id, r.i_id) for r in found.collect()} == {(i, j) for i in range(8) for j in range(8)}


def test_a_list_of_several_blocks_is_sent_a_block_at_a_time(spark, monkeypatch):
    """No pair is shuffled to meet a master longer than what is broadcast: its blocks are short."""
    monkeypatch.setattr(matching.staging, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(matching, "BLOCK_KEYS", 8)
    people = spark.createDataFrame([(i, f"Ann{'abcdefgh'[i % 8]}", f"Stone{'abcdefgh'[i // 8]}") for i in range(40)], "id long, FirstName string, LastName string")
    found = matching.match_persons(people, people)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") > 2 and "SortMergeJoin" not in plan
    got = {(r.m_id, r.i_id): (r.m_first, r.m_last, r.i_first, r.i_last) for r in found.collect()}
    names = {r.id: (r.FirstName.lower(), r.LastName.lower()) for r in people.collect()}
    assert got == {(i, j): names[i] + names[j] for i in names for j in names}


def test_sums_of_bitmaps_count_as_a_plain_count(monkeypatch):
    """Long lists of names are counted by bits: the same pairs, and no cell for each text and key."""
    draw = random.Random(2)
    words = ["".join(draw.choices("abcd", k=draw.randint(3, 14))) for _ in range(900)]
    read = [editing.codes(w) for w in words]
    cells, plain = [], np.bincount
    for distance in (0.0, 0.3, 0.8, 0.95):
        monkeypatch.setattr(matching, "BIT_KEYS", 10**9)
        want = matching._KeyList.of(words, np.arange(900), 3).near(read[:150], 3, distance)
        monkeypatch.setattr(matching, "BIT_KEYS", 1)
        listed = matching._KeyList.of(words, np.arange(900), 3)
        with monkeypatch.context() as seen:
            seen.setattr(np, "bincount", lambda x, **more: cells.append(more.get("minlength", 0)) or plain(x, **more))
            got = listed.near(read[:150], 3, distance)
        rows = lambda found: sorted(zip(*(x.tolist() for x in found), strict=True))
        assert rows(got) == rows(want) and len(want[0]) >= 150 and max(cells) <= 150


def test_edit_pairs_look_up_the_rarest_segments(spark, monkeypatch):
    """A segment that all keys hold is not looked up where enough others are held."""
    keys = spark.createDataFrame([(i, f"{a}{b} brand brand brand {c}{d}") for i, (a, b, c, d) in enumerate((a, b, c, d) for a in "pqr" for b in "stu" for c in "vwx" for d in "yz")], "id long, key string")
    stored, keep = [], matching.staging.materialise
    monkeypatch.setattr(matching.staging, "materialise", lambda df, *p: stored.append(keep(df, *p)) or stored[-1])
    found = {(r.l_id, r.r_id) for r in matching.edit_pairs(keys, keys, 0.9).collect()}
    texts = {r.id: r.key for r in keys.collect()}
    assert found == {(i, j) for i, a in texts.items() for j, b in texts.items() if sum(x != y for x, y in zip(a, b, strict=True)) <= 2}
    (segments,) = stored
    assert {r["count"] for r in segments.groupBy("l_hash", "bucket").count().collect()} == {3}


def test_items_of_a_language_are_not_put_in_one_task(spark, smallest):
    plan = catalogue.QUERIES["q60_existing_item"](spark, smallest)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(transaction_id" not in plan and "hashpartitioning(lang" not in plan and "BroadcastHashJoin" in plan


def test_banded_pairs_move_no_text_and_keep_copies(spark, smallest, monkeypatch):
    left, right = linkage.listed_keys(spark, smallest), linkage.whole_keys(spark, smallest)
    right = right.unionAll(left.selectExpr("id + 100000 AS id", "key")).unionAll(left.selectExpr("id + 200000 AS id", "key"))
    exact = {(r.l_id, r.r_id): round(r.distance, 9) for r in matching.block_pairs(left, right, 0.7, texts=False).collect()}
    for most in (2 << 20, 2000):
        monkeypatch.setattr(matching, "BLOCK_BYTES", most)
        found = matching.banded_pairs(left, right, 0.7, recall=1 - 1e-6, texts=False)
        assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert {(r.l_id, r.r_id): round(r.distance, 9) for r in found.collect()} == exact
    whole = matching.banded_pairs(left, right, 0.7).filter("l_key = r_key AND r_id >= 100000").select("l_id", "r_id").distinct().count()
    assert whole >= 2 * left.count() and matching.banded_pairs(left.limit(0), right).count() == 0
