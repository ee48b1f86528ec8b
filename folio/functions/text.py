"""Scalar text functions as column expressions; all of them stay in code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What person names lose.
NAME_CHARS = '#:> <$"^=()'
NAME_WORDS = ("types", "noclub", "club")
#: Image endings that are read.
IMAGE_ENDINGS = ("tif", "jpeg", "jpg", "png", "tiff")


def _or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_phone(c: Column) -> Column:
    """Digits only; null becomes empty."""
    return F.regexp_replace(_or_blank(c), "[^0-9]", "")


def clean_date_text(c: Column) -> Column:
    """Digits, dashes and slashes, trimmed."""
    return F.trim(F.regexp_replace(_or_blank(c), "[^0-9/-]", ""))


def clean_id(c: Column) -> Column:
    """ASCII letters and digits in lower case."""
    return F.lower(F.trim(F.regexp_replace(_or_blank(c), "[^A-Za-z0-9]", "")))


def clean_text(c: Column) -> Column:
    """ASCII letters, digits and single spaces in lower case."""
    kept = F.regexp_replace(_or_blank(c), r"[^A-Za-z0-9\s]", "")
    return F.lower(F.trim(F.regexp_replace(kept, r"\s+", " ")))


def cleaner_for(name: str):
    """The cleaner that a column's name asks for; phone before dates before ids before text.

    Any name that holds ``id`` counts as an id, ``provider`` too.
    """
    low = name.lower()
    for marks, cleaner in ((("phone",), clean_phone), (("dob", "date"), clean_date_text), (("mrn", "id"), clean_id)):
        if any(m in low for m in marks):
            return cleaner
    return clean_text


def person_name(c: Column) -> Column:
    """A name for matching: lower case without the marks and words above, inner spaces gone too."""
    out = F.translate(F.lower(_or_blank(c)), NAME_CHARS, "")
    for word in NAME_WORDS:
        out = F.replace(out, F.lit(word), F.lit(""))
    return F.trim(out)


def slashless(c: Column) -> Column:
    """A date's text without slashes."""
    return F.trim(F.replace(_or_blank(c), F.lit("/"), F.lit("")))


def mask(c: Column) -> Column:
    """First and last two characters around ``***``; ``BLANK`` for null or empty."""
    return F.when(c.isNull() | (c == ""), "BLANK").otherwise(F.concat(F.left(c, F.lit(2)), F.lit("***"), F.right(c, F.lit(2))))


def md5_uuid(c: Column) -> Column:
    """The MD5 of the text, dashed like a UUID."""
    return F.regexp_replace(F.md5(c), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def file_name(path: Column) -> Column:
    """What follows the last slash; empty without one."""
    return F.regexp_extract(path, "(?s).*/(.*)$", 1)


def leading_part(name: Column, separator: str = "-") -> Column:
    return F.upper(F.substring_index(name, separator, 1))


def capped(c: Column, most: int = 900) -> Column:
    return F.substring(c, 1, most)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def force_case(c: Column, how: str) -> Column:
    """UPPER, PROPER (a capital behind anything that is no letter) or AS-IS."""
    if how == "UPPER":
        return F.upper(c)
    if how == "AS-IS":
        return c
    if how != "PROPER":
        raise ValueError(f"no such case: {how}")
    # split before every run of letters and behind it; capitals start the runs
    parts = F.split(F.regexp_replace(c, r"(\p{L}+)", "\x01$1\x01"), "\x01")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1_000_000)))), "")


def remove_pattern(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def rescue(value: Column, text: Column, pattern: str) -> Column:
    """The value, or if it is null or empty the first match of the pattern in the text."""
    found = F.regexp_extract(text, f"({pattern})", 1)
    return F.when(value.isNull() | (value == ""), F.when(found != "", found)).otherwise(value)


def rescued_score(value: Column, text: Column, pattern: str, score: Column) -> Column:
    """The score that goes with ``rescue``: 10 where the pattern gave the value and there is a score, else as it was."""
    found = F.regexp_extract(text, f"({pattern})", 1) != ""
    missing = value.isNull() | (value == "")
    return F.when(missing & found & score.isNotNull(), F.lit("10")).otherwise(score.cast("string"))


#: A malformed token of answers in JSON, and what stands for it.
BAD_TOKEN, GOOD_TOKEN = r":=[*~\-.:|\\\[\]]", ': "invalid_value"'


def sanitized_json(c: Column) -> Column:
    """JSON text with each malformed token replaced."""
    return F.regexp_replace(c, BAD_TOKEN, GOOD_TOKEN)


def parsed_json(c: Column) -> dict[str, Column]:
    """``pairs`` (a map of texts) of sanitized JSON, and ``error`` where it is no JSON object."""
    pairs = F.from_json(sanitized_json(c), "map<string,string>")
    return {"pairs": pairs, "error": F.when(pairs.isNull(), F.concat(F.lit("Invalid JSON encountered: "), F.coalesce(c, F.lit("null"))))}


def pretty_json(pairs: Column) -> Column:
    """A map of texts as JSON with four spaces before each pair; characters stand for themselves."""
    quoted = lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1)
    lines = F.transform(F.map_entries(pairs), lambda e: F.concat(F.lit("    "), quoted(e["key"]), F.lit(": "), F.when(e["value"].isNull(), "null").otherwise(quoted(e["value"]))))
    return F.when(F.size(pairs) == 0, "{}").otherwise(F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}")))


def rotations(path: Column) -> Column:
    """The path and its three rotated variants, ending kept."""
    stem, ending = F.regexp_extract(path, r"^(.*)\.[^./]*$", 1), F.regexp_extract(path, r"(\.[^./]*)$", 1)
    return F.transform(F.array(*map(F.lit, ("", "_rot90", "_rot180", "_rot270"))), lambda turn: F.concat(stem, turn, ending))


def swap_folder(path: Column, old: str, new: str) -> Column:
    return F.regexp_replace(path, f"(^|/){re.escape(old)}/", f"$1{new}/")


def batch_name(key: Column) -> Column:
    """Last part of a key without its last ending."""
    return F.regexp_replace(F.substring_index(key, "/", -1), r"\.[^.]*$", "")


def target_prefix(key: Column, root: str) -> Column:
    """The key's folder below another root, with the batch name behind it."""
    folder = F.regexp_replace(F.regexp_extract(key, r"^(.*/)?[^/]*$", 1), "^[^/]*/", "")
    return F.concat(F.lit(f"{root}/"), F.coalesce(folder, F.lit("")), batch_name(key))


def full_key(key: Column, prefix: str) -> Column:
    """A key with a folder as it is, another below the prefix."""
    base = prefix if prefix.endswith("/") else f"{prefix}/"
    return F.when(F.instr(key, "/") > 0, key).otherwise(F.concat(F.lit(base), key))


def customer_from_name(name: Column, source: str) -> Column:
    """What stands between the source's name and ``input`` in a file name."""
    return F.regexp_extract(name, f"{re.escape(source)}(.*?)input", 1)


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(rf"\.({'|'.join(IMAGE_ENDINGS)})$")


def name_parts(path: Column) -> dict[str, Column]:
    """Customer, item code and item id of ``customer_code_id`` at the end of a path; an ending stays with the last part."""
    parts = F.split(F.substring_index(path, "/", -1), "_")
    return {"account_id": F.get(parts, F.lit(0)), "item_code": F.get(parts, F.lit(1)), "item_code_id": F.get(parts, F.lit(2))}


def search_document(*fields: Column) -> Column:
    """Fields in lower case with a space between; the word ``nan`` counts as missing."""
    return F.concat_ws(" ", *(F.when(F.lower(f) == "nan", " ").otherwise(F.lower(f)) for f in fields))


def snake_case(name: str) -> str:
    """Column names as the manifests' headers are stored."""
    name = re.sub(r"\(auto extracted\)", "", name, flags=re.IGNORECASE)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.strip())
    name = re.sub(r"[\s\-.]+", "_", name).lower()
    return re.sub(r"_+", "_", name).strip("_")
