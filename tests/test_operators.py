import json
import zipfile

import pytest
from pyspark.sql import functions as F

from folio import model
from folio.functions import text
from folio.model import FieldRule, JobParameters
from folio.operators import align, events, load, matching, rules, search
from folio.sources import adapters, readers, sinks
from folio.streaming import event_stream


def errors(spark, value, rule, score="95", today="2024-01-01"):
    df = spark.createDataFrame([(value, score)], "v string, s string")
    return df.select(rules.field_errors(F.col("v"), F.col("s"), rule, today)).first()[0]


@pytest.mark.parametrize(
    ("value", "rule", "want"),
    [
        ("abc", FieldRule("f", min_length="4"), ["Length '3' < MinLength '4'"]),
        ("abc", FieldRule("f", max_length=2, pattern="x"), ["Length '3' > MaxLength '2'", "Pattern validation failed"]),
        ("abc", FieldRule("f", min_length="", pattern="ab"), []),
        ("abc", FieldRule("f", min_length="many"), ["Invalid MinLength configuration"]),
        ("a-b#c-", FieldRule("f"), ["Special characters not allowed: -, #"]),
        ("a-b#", FieldRule("f", special="#"), ["Special characters not allowed: -"]),
        ("a-b#\t", FieldRule("f", special=True), []),
        ("a\tb", FieldRule("f"), ["Special characters not allowed: \t"]),
        ("a|b~", FieldRule("f"), []),
        (" ", FieldRule("f"), ["Null value not allowed"]),
        (" ", FieldRule("f", allow_null=True), []),
        (None, FieldRule("f"), ["Null values are not allowed for this field"]),
        (None, FieldRule("f", allow_null=True), []),
        ("02/30/2020", FieldRule("f", "date"), ["Invalid date format. Expected: 'mm/dd/yyyy', got: '02/30/2020'"]),
        ("2020-02-01", FieldRule("f", "date", date_format="yyyy-mm-dd", max_date="2020-01-31"), ["Date after MaxDate 2020-01-31"]),
        ("01/02/2024", FieldRule("f", "date", max_date="today"), ["Date after MaxDate today"]),
        ("01/01/2024", FieldRule("f", "date", min_date="today", max_date="today"), []),
        ("01/01/2024", FieldRule("f", "date", min_date="soon"), []),
    ],
)
def test_rules(spark, value, rule, want):
    assert errors(spark, value, rule) == want


def test_confidence_comes_first(spark):
    for score in ("79.9", None, "high"):
        assert "below threshold" in errors(spark, "abc", FieldRule("f", min_length=9), score)[0]


def test_validate_documents(spark):
    docs = spark.createDataFrame([('{"a": "x", "a_s": 90}',), ('{"a": "x", "a_s": 9}',), ('{"error": "e"}',), ("{broken",), (None,)], "key_value_pairs string")
    got = [r.validation_passed for r in rules.validate(docs, [FieldRule("a", allow_null=True)], "2024-01-01").collect()]
    assert got == ["True", "False", "False", "False", "False"]
    assert {r.data_is_valid for r in rules.validate(docs, [], "2024-01-01", audit=True).collect()} == {"False"}


def test_rules_from_configuration(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"account_id": "1", "collections": [{"collection": "p", "field_list": [{"FieldName": "a", "Type": "date", "Validation": {"AllowNull": "true", "AllowSpecialChars": "#", "MinLength": "2"}}]}]}')
    config = readers.configuration(spark, str(tmp_path / "c.json"))
    (rule,) = readers.field_rules(readers.collection(config, "p"))
    assert (rule.name, rule.kind, rule.allow_null, rule.special, rule.min_length) == ("a", "date", True, "#", "2")
    with pytest.raises(LookupError):
        readers.collection(config, "q")


def test_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text('"Image Path"|"Ref1 (Auto Extracted)"|"BoxNote"\n"a\\b.jpg"|"NA"|"say ""hi"""\n"c.jpg"|""|"x|y"\n"too"|"many"|"cells"|"here"\nd.jpg|e~"f|g\n')
    got = sorted(readers.manifest(spark, str(tmp_path / "m.csv")).collect())
    assert [tuple(r) for r in got] == [("a\\b.jpg", None, 'say "hi"'), ("c.jpg", None, "x|y"), ("d.jpg", 'e"f', "g")]
    assert got[0].asDict().keys() == {"image_path", "ref1", "box_note"}
    (tmp_path / "e.csv").write_text('"A"|"B"\n')
    with pytest.raises(ValueError):
        readers.manifest(spark, str(tmp_path / "e.csv"))


def test_listing_archives_and_image_names(spark, tmp_path):
    (tmp_path / "i").mkdir()
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("b/2.txt", "two")
        z.writestr("a/1.txt", "one")
    (tmp_path / "i" / "c1_code_7.JPG").write_bytes(b"x")
    (tmp_path / "i" / "notes.txt").write_bytes(b"x")
    assert [(r.name, bytes(r.content)) for r in adapters.unzip(spark, str(tmp_path / "a.zip")).collect()] == [("a/1.txt", b"one"), ("b/2.txt", b"two")]
    (row,) = readers.image_manifest(readers.listing(spark, str(tmp_path / "i")), "b_coll_proj_REF5", "t").collect()
    assert (row.account_id, row.item_code, row.item_code_id, row.collection, row.project) == ("c1", "code", "7.JPG", "coll", "proj")


def test_service_errors_stay_with_their_row(spark):
    def service(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([("a",), ("bad",), ("c",)], "t string")
    got = {r.t: (r.answer, r.error) for r in adapters.call_service(rows, "t", service).collect()}
    assert got == {"a": ("A", None), "bad": (adapters.FAILED, "RuntimeError: no"), "c": ("C", None)}


def test_align_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b1", "x", 1), ("b2", "y", 2)], "batch_name string, a string, extra int")
    target = ["a", "missing", "batch_name"]
    assert align.to_target(df, target).columns == target
    assert align.column_changes(df.columns, target) == (["missing"], ["extra"])
    path = str(tmp_path / "t")
    sinks.append(df, path, target)
    table = spark.read.parquet(path)
    sinks.overwrite_read(spark, table.filter("batch_name = 'b1'").withColumn("a", F.lit("new")), path)
    spark.catalog.refreshByPath(path)
    assert sorted((r.a, r.batch_name) for r in spark.read.parquet(path).collect()) == [("new", "b1"), ("y", "b2")]
    sinks.csv(df, str(tmp_path / "c"), ";")
    assert readers.typed_csv(spark, str(tmp_path / "c"), "batch_name string, a string, extra int", ";").count() == 2
    with pytest.raises(ValueError):
        align.single_value(df, "a")
    assert align.single_value(df.filter("a = 'x'"), "a") == "x"


def test_job_parameters():
    p = JobParameters("t", "b.1.zip", workflow="w-retrigger", filters={"zip_key_prefix": "pre"})
    assert (p.key, p.batch_name, p.target_prefix("out"), p.retrigger) == ("pre/b.1.zip", "b.1", "out/b.1", True)
    assert JobParameters.parse_filters("{oops") == {} and JobParameters.parse_filters('{"a": 1}') == {"a": 1}
    assert model.flag("False") is False and model.flag("#") == "#"


def test_gram_pairs_are_all_pairs(spark):
    words = ["alpha", "alphas", "alpine", "beta", "betas", "gamma", "gammas", "ab", "alpha"]
    rows = spark.createDataFrame(list(enumerate(words)), "id int, key string")
    grams = lambda w: {w[i : i + 3] for i in range(len(w) - 2)}
    for distance in (0.8, 0.5, 0.2):
        want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if grams(a) and grams(b) and 1 - len(grams(a) & grams(b)) / len(grams(a) | grams(b)) <= distance}
        assert {(r.l_id, r.r_id) for r in matching.gram_pairs(rows, rows, distance).collect()} == want


def test_match_persons(spark):
    schema = "id int, FirstName string, LastName string, Phone1 string, DOB string"
    master = spark.createDataFrame([(1, "Ann", "Meyer", "555-1", "01/02/1990"), (2, "Bob", "Stone", "", "")], schema)
    inputs = spark.createDataFrame([(7, "ANN", "Meyer", "5551", "01/02/1990"), (8, "Bob", "Stone", "", "02/02/2000"), (9, "", "", "", "")], schema)
    got = {r.i_id: (r.m_id, r.match, r.error) for r in matching.match_persons(master, inputs).collect()}
    assert got == {7: (1, "Yes", ""), 8: (2, "No", "Phone1, DOB")}


def test_decisions(spark):
    hits = spark.createDataFrame([(1, 10, 1, False, "No", 5), (1, 11, 2, True, "Yes", 80), (1, 12, 3, True, "Yes", 90), (2, 10, 1, False, "No", 7)], "q_id int, id int, rank int, accept boolean, found string, confidence int")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "q_id int")
    assert sorted(tuple(r) for r in search.decide(hits, queries).fillna(-1).collect()) == [(1, 11, "Yes", 80), (2, -1, "No", 7), (3, -1, "No", 0)]


def test_messages_and_records(spark):
    items = spark.createDataFrame([("b", i, "x") for i in range(2500)], "BatchId string, Id int, Status string")
    parts = events.review_messages(items).collect()
    assert sum(p.n_items for p in parts) == 2500 and max(p.n_items for p in parts) < 1200
    with pytest.raises(ValueError):
        events.telemetry(items, "m", F.lit("Ready"), F.current_timestamp(), F.lit(1), Source=F.lit("s"))
    dims = {k: F.lit(k) for k in events.REQUIRED}
    made = events.telemetry(items.limit(1), "m", F.lit("Ready"), F.lit("1970-01-01 00:00:01").cast("timestamp"), F.lit(1), **dims)
    assert '"Time":"1000"' in events.as_records(made).first()[0]


def test_routes_and_loading(spark):
    df = spark.createDataFrame([("x", "True"), ("y", "False")], "image_path string, data_is_valid string")
    assert [r.image_path for r in load.load_rows(df, None, False, False).collect()] == ["x"]
    assert load.load_rows(df, None, False, True).count() == 2
    parsed = load.explode_fields(spark.createDataFrame([('{"n": "5", "d": 3}',), ("{",)], "j string"), "j", {"n": "integer", "d": "string"})
    assert [(r.n, r.d) for r in parsed.collect()] == [(5, "3"), (None, None)]


def test_event_stream(spark, tmp_path):
    rows = spark.range(100).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("event_type"), F.lit(1.0).alias("value"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    counts = event_stream.state_counts(event_stream.read(spark, str(tmp_path / "in"), rows.schema))
    q = counts.writeStream.outputMode("append").format("memory").queryName("hourly").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None


def test_stored_index_and_delta(spark, tmp_path):
    docs = spark.createDataFrame([(1, "ann meyer 555"), (2, "bob stone")], "id long, document string")
    path = str(tmp_path / "index")
    search.store_index(docs, path)
    search.store_index(spark.createDataFrame([(3, "anna stone"), (2, "bob stone")], "id long, document string"), path, delta=True)
    postings = search.open_index(spark, path)
    queries = spark.createDataFrame([(7, "an. sto stone"), (8, "zzz qqq none")], "q_id long, query string")
    got = [(r.q_id, r.id, r["rank"]) for r in search.top_hits(postings, search.query_tokens(queries), 3, 2).collect()]
    assert sorted(got) == [(7, 2, 2), (7, 3, 1)]


def test_rescoring_by_a_stored_model(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([i / 10.0, 1 - i / 10.0]), float(i > 5)) for i in range(10)]
    LogisticRegression().fit(spark.createDataFrame(rows, ["features", "label"])).write().overwrite().save(str(tmp_path / "m"))
    got = matching.rescore(spark.createDataFrame([(0.9, 0.1), (0.1, 0.9)], "a double, b double"), ["a", "b"], str(tmp_path / "m"))
    assert got.columns == ["a", "b", "model_score"] and [r.model_score > 0.5 for r in got.collect()] == [True, False]


def test_weighted_score(spark):
    df = spark.createDataFrame([("Ann", "ann", "1", "1"), ("Ann", None, "1", "2")], "l_name string, r_name string, l_phone string, r_phone string")
    fields = {"name": (0.6, "sequence_matcher"), "phone": (0.4, "exact")}
    assert [round(r[0], 6) for r in df.select(matching.weighted_score(fields)).collect()] == [1.0, 0.0]


def test_derived_images_and_catalog_columns(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"good")
    (tmp_path / "b.png").write_bytes(b"bad")

    def derive(content):
        if content == b"bad":
            raise ValueError("no image")
        return {"": b"0", "_rot90": b"1"}

    got = sorted((r.path.rsplit("/")[-1], r.error) for r in adapters.derive_images(spark, str(tmp_path), derive).collect())
    assert got == [("a.png", None), ("a_rot90.png", None), ("b.png", "ValueError: no image")]
    spark.sql("CREATE TABLE IF NOT EXISTS folio_t (a STRING, b STRING) USING parquet PARTITIONED BY (b)")
    assert readers.table_columns(spark, "folio_t") == (["a", "b"], ["b"])
    spark.sql("DROP TABLE folio_t")


def test_prompt_and_payloads(spark):
    df = spark.createDataFrame([("x",), (None,)], "t string")
    assert '["a", "a_s"]' in df.select(adapters.prompt(["a"], F.col("t"))).first()[0]
    assert [r[0] for r in adapters.payloads(df, "t").collect()] == ['{"t":"x"}', "{}"]
    assert readers.override_rows(spark, {"f.jpg": {"a": "1"}, "zip_key_prefix": "p"}, "t", "b").count() == 1


def test_grouped_text(spark):
    rows = [(None, 2, "b"), (None, 1, "a"), ("x", 1, None), ("y", 2, "long " * 300), ("y", 1, "first"), ("y", 1, "earlier")] + [("z", i, "w") for i in range(2000)]
    got = {r.k: (r.text, r.first_path) for r in load.grouped_text(spark.createDataFrame(rows, "k string, o int, t string"), ["k"], "o", "t").collect()}
    assert got == {None: ("a b", 1), "x": ("", 1), "y": (("earlier first " + "long " * 300)[:900], 1), "z": (("w " * 2000)[:900], 0)}


def test_parameters_as_literals():
    parse = model.JobParameters.parse_filters
    assert parse("{'k': 'v', 'n': 3, 'on': True, 'none': None}") == {"k": "v", "n": 3, "on": True, "none": None}
    assert parse('{"k": true}') == {"k": True} and parse(None) == parse("") == parse("[1]") == parse("{broken") == parse("f(1)") == {}


def test_overrides_of_batches(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], "batch_name string, box string")
    assert sorted(r.box for r in align.override_batches(df, "box", {"a": "X"}).collect()) == ["2", "3", "X"]
    assert align.override_batches(df, "box", {}) is df


def test_manifest_keeps_rows_that_equal_its_header(spark, tmp_path):
    (tmp_path / "one.txt").write_text("Image Path|Ref\nImage Path|Ref\na|1\n")
    (tmp_path / "two.txt").write_text("Image Path|Ref\nb|2\n")
    got = readers.manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("Image Path", "Ref"), ("a", "1"), ("b", "2")]


def test_configuration_under_other_names(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"owner": "1", "collections": [{"collection": "p", "check": "true", "field_list": []}, {"collection": "q"}]}')
    got = readers.configuration(spark, str(tmp_path / "c.json"), {"account_id": "owner", "review_all": "check"})
    assert sorted((r.account_id, r.collection, r.review_all) for r in got.collect()) == [("1", "p", "true"), ("1", "q", None)]


def test_json_text_functions(spark):
    df = spark.createDataFrame([('{"a":=*, "b": "x"}',), ('{"a": "1"',), ("{}",), (None,)], "t string")
    found = text.parsed_json(F.col("t"))
    got = [(r.p, r.e) for r in df.select(found["pairs"].alias("p"), found["error"].alias("e")).collect()]
    assert got[0] == ({"a": "invalid_value", "b": "x"}, None) and got[2] == ({}, None)
    assert got[1] == (None, 'Invalid JSON encountered: {"a": "1"') and got[3] == (None, "Invalid JSON encountered: null")
    for pairs in ({}, {"a": 'é "q" \\ \n', "b": None, "c": "[1]"}):
        (row,) = spark.createDataFrame([(pairs,)], "m map<string,string>").select(text.pretty_json(F.col("m")).alias("j")).collect()
        assert row.j == json.dumps(pairs, indent=4, ensure_ascii=False)


def test_rescued_scores(spark):
    df = spark.createDataFrame([("", "no 7", "80"), (None, "no 7", None), ("x", "no 7", "80"), (None, "none", "80")], "v string, t string, s string")
    got = [r[0] for r in df.select(text.rescued_score(F.col("v"), F.col("t"), r"\d", F.col("s"))).collect()]
    assert got == ["10", None, "80", "80"]


def test_lookups_beside_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "bad")], "id long, k string")

    def service(asked):
        if "bad" in asked:
            raise RuntimeError("500")
        return [json.dumps({"code": f"C-{k}", "id": f"{k}1"}) for k in asked]

    got = adapters.append_lookup(rows, "k", service, {"ItemCode": "code", "ItemCodeID": "id"})
    assert got.columns == ["id", "k", "ItemCode", "ItemCodeID"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", "C-a", "a1"), (2, "b", "C-b", "b1"), (3, "bad", "Error: RuntimeError: 500", "Error: RuntimeError: 500")]


def test_batch_properties(spark, tmp_path):
    df = spark.createDataFrame([("acc", "p"), ("acc", "p")], "account string, project string")
    assert sinks.put_properties(df, str(tmp_path / "x"), "account", "project") == {"account": "acc", "project": "p"}
    assert sinks.properties(spark, str(tmp_path / "x"), "account", "project") == {"account": "acc", "project": "p"}
    with pytest.raises(ValueError):
        sinks.put_properties(spark.createDataFrame([("a",), ("b",)], "account string"), str(tmp_path / "y"), "account")


def test_template_becomes_a_dictionary(spark):
    rows = spark.createDataFrame([("1", "2")], "a string, b string")
    fields = spark.createDataFrame([("a", "REF3"), ("b", None), ("b", "other"), ("absent", "REF4")], "name string, ref string")
    assert load.apply_template(rows, fields).columns == ["a", "b", "REF3"]


def test_items_and_payloads(spark):
    rows = spark.createDataFrame([("file-1.jpg", "p/file-1.jpg", "BOX", "G", "t" * 950, "c", "7")], "image_filename string, image_path string, box_barcode string, box_id string, ocr_liquid_text string, item_code string, item_code_id string")
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    new, old = load.new_item_columns(rows, "acc", now), load.existing_item_columns(rows, "b_x_File.zip_ref5.zip", "acc", now)
    assert len(new.columns) - len(rows.columns) == 18 and len(old.columns) - len(rows.columns) == 15
    assert len(load.new_payload(new).columns) == 10 and len(load.existing_payload(old, "b_x_File.zip_ref5.zip").columns) == 8
    a, b = new.first(), old.first()
    assert (a.itemType, a.parentId, len(a.REF10), a.REF30) == ("FILE", "G", 900, "2024-01-02 03:04") and (b.itemType, len(b.REF5), b.ItemCodeID) == ("FILE", 900, "7")


def test_master_is_cleaned(spark):
    row = ("Ann Types", "O(x)", None, "e@x", "(555) 1-2", "01/02/1980", 3.0)
    df = spark.createDataFrame([row, row], "FirstName string, LastName string, PrevLastName string, Email string, Phone1 string, DOB string, n double")
    (got,) = matching.clean_master(df).collect()
    assert (got.FirstName, got.LastName, got.PrevLastName, got.Email, got.NORMALIZED_PHONE, got.NORMALIZED_DOB) == ("ann", "ox", "", "", "55512", "010280")


def test_discovery_as_the_library_of_sequences(spark):
    import difflib

    cases = [("anna", "annas"), ("12.0", "12"), ("stone", "zebra"), ("", "x"), ("same", "same"), ("x", None)]
    got = matching.discover(spark.createDataFrame(cases, "f string, m_f string"), ["f"]).collect()
    for (own, other), r in zip(cases, got, strict=True):
        other, clean = other or "", own.replace(".0", "")
        alike = bool(clean and other) and int(difflib.SequenceMatcher(None, clean.lower(), other.lower()).ratio() * 100) > 61
        assert r.machine_f == (clean if clean != other else "") and r.machine_f_simm == int(alike)
        assert r.machine_f_diff == (abs(len(own) - len(other)) if clean != other else 0) and r.f == (other if alike and clean != other else own)


def test_weighted_matches_are_routed(spark):
    rows = [("anna", "anna", "1", "1"), ("anna", "anne", "1", "1"), ("anna", "zed", "1", "1")]
    df = spark.createDataFrame(rows, "l_name string, r_name string, l_phone string, r_phone string")
    got = matching.weighted_match(df, {"name": (0.6, "sequence_matcher"), "phone": (0.4, "exact")}).collect()
    assert [(round(r.score, 2), r.is_match, r.route) for r in got] == [(1.0, True, "route_downstream"), (0.85, True, "route_downstream"), (0.4, False, "route_to_review")]


def outcome(spark, row, hit, score, model_score, whole=True):
    fields = "struct<first:string,last:string,prev:string,dob:string,phone:string>"
    df = spark.createDataFrame([(row, hit)], f"row {fields}, master {fields}")
    made = search.field_outcome(F.lit(score), F.lit(model_score), whole=F.lit(whole))
    r = df.select(*(c.alias(n) for n, c in made.items())).first()
    return r.accept, r.stop, r.confidence, r.note


def test_decision_tree_of_one_hit(spark):
    me = ("anna", "stone", "nan", "010280", "5551234")
    assert outcome(spark, me, ("zed", "x", "nan", "1", "2"), 60.0, 0.1) == (True, True, 100, "")
    assert outcome(spark, me, ("zed", "x", "nan", "1", "2"), 60.0, 0.1, whole=False) == (False, True, 0, "Column mismatched")
    assert outcome(spark, me, ("zed", "x", "nan", "010280", "2"), 3.0, 0.95) == (True, True, 100, "")  # the model, dates alike
    assert outcome(spark, me, ("anna", "x", "nan", "1", "5551234"), 3.0, 0.8) == (True, True, 54, "")  # phone and first name
    assert outcome(spark, me, ("anna", "stone", "nan", "010280", "2"), 3.0, 0.3) == (True, True, 99, "")  # names and date
    assert outcome(spark, me, ("anna", "x", "nan", "010280", "2"), 3.0, 0.8) == (False, False, 54, "")  # no previous names
    assert outcome(spark, me, ("anna", "x", "smith", "010280", "2"), 3.0, 0.8) == (False, False, 22, "")
    was = ("anna", "new", "stone", "010280", "5551234")
    assert outcome(spark, was, ("anna", "old", "stone", "010280", "2"), 3.0, 0.8) == (True, True, 54, "")  # previous name
    assert search.no_hit_error(["FirstName", "LastName", "DOB"], "E1") == "E1: FirstName, LastName"


def test_queries_without_a_second_name_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "An. Stone x"), (2, "An. 7th x"), (3, "An.")], "q_id long, query string")
    got = sorted((r.q_id, r.token, r.prefix, r.boost) for r in search.query_tokens(df).collect())
    assert got == [(1, "an", True, 2.0), (1, "stone", True, 2.0), (1, "x", False, 1.0), (2, "7th", False, 1.0), (2, "an.", False, 1.0), (2, "x", False, 1.0), (3, "an.", False, 1.0)]


def test_coverage_raises_what_holds_more_of_a_query(spark):
    docs = spark.createDataFrame([(1, "red red red red red"), (2, "red bolt"), (3, "blue ring")], "id long, document string")
    queries = spark.createDataFrame([(1, "4 red bolt"), (2, "4 red bolt")], "q_id long, query string")
    ranked = lambda c: [(r.q_id, r.id) for r in search.top_hits(search.index(docs), search.query_tokens(queries), 3, 5, c).orderBy("q_id", "rank").collect()]
    assert ranked(None) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    scores = {r.id: r.score for r in search.top_hits(search.index(docs), search.query_tokens(queries), 3, 5, 0.9).filter("q_id = 1").collect()}
    plain = {r.id: r.score for r in search.top_hits(search.index(docs), search.query_tokens(queries), 3, 5).filter("q_id = 1").collect()}
    assert scores[2] == pytest.approx((plain[2] + 1 / (2 - 0.9) ** 2) / 2) and scores[1] == pytest.approx(plain[1] / 2)


def test_a_delta_replaces_documents_whole(spark, tmp_path):
    path = str(tmp_path / "index")
    make = lambda rows: spark.createDataFrame(rows, "id long, document string")
    assert search.store_index(make([(1, "old words"), (2, "kept"), (3, "gone")]), path) == 0
    assert search.store_index(make([(1, "new words"), (3, "")]), path, delta=True) == 1
    assert sorted((r.token, r.id) for r in search.open_index(spark, path).collect()) == [("kept", 2), ("new", 1), ("words", 1)]


def test_types_are_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,score\n1,x,0.5\n2,,1\n")
    got = readers.inferred_csv(spark, str(tmp_path / "a.csv"))
    assert got.dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "x", 0.5), (2, None, 1.0)]


def test_facts_of_batches(spark):
    from folio.operators import batches

    rows = spark.createDataFrame([(1, 2, "b/y"), (1, 1, "c/x"), (1, 3, "c/x"), (1, 4, None), (2, 1, None), (None, 1, "a/z")], "k int, at int, v string")
    texts = {r.k: r.text for r in batches.distinct_text(rows, ["k"], "at", "v").collect()}
    assert texts == {1: "c/x b/y", 2: "", None: "a/z"}
    first = {r.k: (r.at, r.v) for r in batches.first_row(rows, ["k"], ["at"]).collect()}
    assert first == {1: (1, "c/x"), 2: (1, None), None: (1, "a/z")}
    values = {r.k: (r.n_v, r.v) for r in batches.distinct_values(rows, ["k"], "v").collect()}
    assert values == {1: (2, "b/y"), 2: (0, None), None: (1, "a/z")}
    out = {r.k: tuple(r)[1:] for r in batches.outcomes(rows, ["k"], F.col("v") == "c/x", F.col("at") > 2).collect()}
    assert out == {1: (False, True, 2, 4), 2: (None, None, 0, 1), None: (False, False, 0, 1)}
    named = rows.filter("v IS NOT NULL")
    assert [r.v for r in batches.in_path_order(named, path="v", by_name=True).collect()] == ["c/x", "c/x", "b/y", "a/z"]
    assert [r.v for r in batches.in_path_order(named, path="v").collect()] == ["a/z", "b/y", "c/x", "c/x"]
    assert batches.distinct_text(rows.limit(0), ["k"], "at", "v").count() == 0


def test_images_are_read_with_their_variants(spark):
    def service(paths):
        if any("bad" in p for p in paths):
            raise RuntimeError("no")
        line = lambda t: {"type": "LINE", "text": t, "corners": [{"x": 0, "y": 0}] * 4}
        return ["no json" if "odd" in p else json.dumps([] if "blank" in p else [line('a "b" ü'), line(""), line('a "b" ü'), line("c")]) for p in paths]

    rows = spark.createDataFrame([("x/1.png", "k"), ("x/bad.png", "k"), ("x/odd.png", "k"), ("x/blank.png", "k")], "image_path string, other string")
    got = {r.image_path: r for r in adapters.read_images(rows, service).collect()}
    good = got["x/1.png"]
    assert good.ocr_liquid_text == 'a "b" ü c' and good.other == "k"
    assert json.loads(good.ocr_spatial_info) == [['a "b" ü', [0, 0]], ["", [0, 0]], ['a "b" ü', [0, 0]], ["c", [0, 0]]]
    assert all(got[f"x/{p}.png"].ocr_liquid_text == got[f"x/{p}.png"].ocr_spatial_info == adapters.FAILED for p in ("bad", "odd"))
    assert (got["x/blank.png"].ocr_liquid_text, got["x/blank.png"].ocr_spatial_info) == ("", "[]")
    turned = adapters.read_images(rows.limit(1), service, rotated=True).first()
    assert turned.ocr_liquid_text == good.ocr_liquid_text and len(json.loads(turned.ocr_spatial_info)) == 16


def test_rows_of_images_have_the_tables_columns(spark):
    paths = spark.createDataFrame([("a/c_i_7_x.png",), ("a/c.jpg",), ("a/n.txt",)], "path string")
    names = [f"n{i}" for i in range(15)]
    found = {r.n2: tuple(r) for r in readers.image_rows(paths, "b", "t", names, F.lit("2024-12-01 00:00:00").cast("timestamp")).collect()}
    assert found["c_i_7_x.png"] == ("", "a/c_i_7_x.png", "c_i_7_x.png", "t", "null", "null", "", "12/1/24 00:00", "", "", "", "i", "7", "c", "b")
    assert set(found) == {"c_i_7_x.png", "c.jpg"} and found["c.jpg"][11:14] == (None, None, "c.jpg")
    with pytest.raises(ValueError):
        readers.image_rows(paths, "b", "t", names[:3], F.current_timestamp())
