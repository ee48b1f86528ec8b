"""Dates in the formats of scanned documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats in the order they are tried, as a shape and Spark's pattern.
FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", "M-d-yy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^\d{1,2} [A-Za-z]+ \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}, [A-Za-z]{3} \d{4}$", "d, MMM yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
)
#: The formats that rules may name.
RULE_FORMATS = {"mm/dd/yyyy": "MM/dd/yyyy", "dd/mm/yyyy": "dd/MM/yyyy", "yyyy-mm-dd": "yyyy-MM-dd"}
_RULE_SHAPES = {"mm/dd/yyyy": "M/d/yyyy", "dd/mm/yyyy": "d/M/yyyy", "yyyy-mm-dd": "yyyy-M-d"}
_TWO_DIGITS = r"[-/]\d{2}$"


def _pivoted(parsed: Column, two_digits: Column) -> Column:
    """Two-digit years 69 to 99 belong to the last century."""
    return F.when(two_digits & (F.year(parsed) >= 2069), F.add_months(parsed, -1200)).otherwise(parsed)


def parse_any(c: Column) -> Column:
    """The date in the first format that fits, or null."""
    text = c.cast("string")
    tries = [F.when(text.rlike(shape), F.to_date(F.try_to_timestamp(F.initcap(text) if "MMM" in pattern else text, F.lit(pattern)))) for shape, pattern in FORMATS]
    return _pivoted(F.coalesce(*tries), text.rlike(_TWO_DIGITS))


def normalize_date(c: Column, today: str, max_date: str | None = None) -> Column:
    """``mm/dd/yyyy`` of any format; what fits none stays as it is.

    A two-digit year that lies after ``today``'s year and after the greatest date
    allowed is taken a century back.
    """
    text, bound = c.cast("string"), today if (max_date or "").lower() == "today" else max_date
    parsed = parse_any(c)
    if bound:
        late = text.rlike(_TWO_DIGITS) & (F.year(parsed) > F.year(F.lit(today).cast("date"))) & (parsed > F.lit(bound).cast("date"))
        parsed = F.when(late, F.add_months(parsed, -1200)).otherwise(parsed)
    return F.coalesce(F.date_format(parsed, "MM/dd/yyyy"), text)


def parse_rule_date(c: Column, rule_format: str | None) -> Column:
    """The date in a rule's format, or null."""
    name = rule_format if rule_format in RULE_FORMATS else "mm/dd/yyyy"
    shape = r"^\d{4}-\d{1,2}-\d{1,2}$" if name == "yyyy-mm-dd" else r"^\d{1,2}/\d{1,2}/\d{4}$"
    return F.when(c.rlike(shape), F.to_date(F.try_to_timestamp(c, F.lit(_RULE_SHAPES[name]))))


def compact_date(c: Column) -> Column:
    """``mmddyy`` of a date's text; without slashes where it is none."""
    return F.coalesce(F.date_format(parse_any(c), "MMddyy"), F.replace(c.cast("string"), F.lit("/"), F.lit("")))
