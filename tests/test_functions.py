import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.functions import costs, dates, similarity, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, value, f):
    return values(spark, [(value,)], "c string", f(F.col("c")))[0][0]


@pytest.mark.parametrize(
    ("value", "f", "want"),
    [
        ("(555) 12-3", text.clean_phone, "555123"),
        (None, text.clean_phone, ""),
        (" 1/2-3x ", text.clean_date_text, "1/2-3"),
        (" Ab-12 ", text.clean_id, "ab12"),
        ("  A  b,\tC ", text.clean_text, "a b c"),
        ("NoClub Ann: O'Hara (types)", text.person_name, "anno'hara"),
        ("1/2/3 ", text.slashless, "123"),
        ("a", text.mask, "a***a"),
        ("abcdef", text.mask, "ab***ef"),
        ("", text.mask, "BLANK"),
        (None, text.mask, "BLANK"),
        ("x/y/z.jpg", text.file_name, "z.jpg"),
        ("z.jpg", text.file_name, ""),
        ("o'neil mc-donald ab1cd", lambda c: text.force_case(c, "PROPER"), "O'Neil Mc-Donald Ab1Cd"),
        ("in/x/b.1.zip", text.batch_name, "b.1"),
        ("in/x/b.zip", lambda c: text.target_prefix(c, "out"), "out/x/b"),
        ("a.zip", lambda c: text.full_key(c, "pre/"), "pre/a.zip"),
        ("in/a.zip", lambda c: text.full_key(c, "pre"), "in/a.zip"),
        ("a/b.JPG", text.is_image, True),
        ("a/bjpg", text.is_image, False),
        ("r/old/x.png", lambda c: text.swap_folder(c, "old", "new"), "r/new/x.png"),
        ("hello", text.md5_uuid, "5d41402a-bc4b-2a76-b971-9d911017c592"),
    ],
)
def test_text(spark, value, f, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(("name", "cleaner"), [("HomePhone", text.clean_phone), ("dob", text.clean_date_text), ("provider", text.clean_id), ("name", text.clean_text), ("phone_id", text.clean_phone)])
def test_cleaner_for(name, cleaner):
    assert text.cleaner_for(name) is cleaner


@pytest.mark.parametrize(("header", "want"), [("Ref1 (Auto Extracted)", "ref1"), ("ImagePath", "image_path"), ("Box Barcode", "box_barcode"), ("a.b-c  d", "a_b_c_d"), ("HTTPCode", "http_code")])
def test_snake_case(header, want):
    assert text.snake_case(header) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("1/2/2020", "01/02/2020"),
        ("01/02/75", "01/02/1975"),
        ("01/02/68", "01/02/1968"),  # 2068 lies after today
        ("13-02-2020", "02/13/2020"),
        ("2020.3.4", "03/04/2020"),
        ("1 january 2020", "01/01/2020"),
        ("4, Mar 2021", "03/04/2021"),
        ("2020-12-31", "12/31/2020"),
        ("31/12/99", "12/31/1999"),
        ("5-Jun-98", "06/05/1998"),
        ("Jun 5, 1998", "06/05/1998"),
        ("1/1/2020x", "1/1/2020x"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_date(spark, value, want):
    assert one(spark, value, lambda c: dates.normalize_date(c, "2025-06-01", "today")) == want


def test_similarities(spark):
    rows = [("jonathan", "jon"), ("martha", "marhta"), ("", ""), (None, "a"), ("abc", ""), ("smith", "smyth")]
    got = values(spark, rows, "a string, b string", similarity.edit_similarity(F.col("a"), F.col("b")), similarity.sequence_ratio(F.col("a"), F.col("b")), similarity.within_edits(F.col("a"), F.col("b"), 0.8))
    assert [g[0] for g in got] == pytest.approx([0.375, 1 - 2 / 6, 1.0, None, 0.0, 0.8])
    assert [g[1] for g in got] == [int(difflib.SequenceMatcher(None, a or "", b or "").ratio() * 100) if a and b else 0 for a, b in rows]
    assert [g[2] for g in got] == [False, False, True, None, False, True]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("abc", max_size=6), st.text("abc", max_size=6)), min_size=1, max_size=20))
def test_similarity_is_symmetric_and_bounded(spark, rows):
    a, b = F.col("a"), F.col("b")
    for x, y in values(spark, rows, "a string, b string", similarity.edit_similarity(a, b), similarity.edit_similarity(b, a)):
        assert x == y and 0 <= x <= 1


def test_ngrams(spark):
    assert one(spark, "aaaab", similarity.ngrams) == ["aaa", "aab"]
    assert one(spark, "ab", similarity.ngrams) == []


def test_costs(spark):
    got = values(spark, [(1000.0, 2000.0, 0.1)], "i double, o double, r double", costs.token_cost(F.col("i"), F.col("o")), costs.monthly_requests(F.col("r")), costs.european(F.lit(1234567.891)))
    assert got[0] == (pytest.approx(0.01215), pytest.approx(86400.0), "1.234.567,89")
    keys = ["name", "dob", "Name_s"]
    assert [r[0] for r in values(spark, [(k,) for k in keys], "c string", costs.value_chars(F.col("c")))] == [43, 12, 3]


def test_rotations_and_rescue(spark):
    assert one(spark, "a/b.png", text.rotations) == ["a/b.png", "a/b_rot90.png", "a/b_rot180.png", "a/b_rot270.png"]
    got = values(spark, [("x", "id 12"), ("", "id 12 13"), (None, "none")], "v string, t string", text.rescue(F.col("v"), F.col("t"), r"\d+"))
    assert [g[0] for g in got] == ["x", "12", None]
