"""Similarities of strings: three different numbers, kept apart."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 1 for two empty strings; null if one is null."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def edit_percent(a: Column, b: Column) -> Column:
    return 100.0 * edit_similarity(a, b)


def within_edits(a: Column, b: Column, least: float) -> Column:
    """Whether the edit similarity is ``least`` or more; distances are not worked out beyond the bound."""
    longest = F.greatest(F.length(a), F.length(b))
    most = F.floor((1.0 - least) * longest + 1e-9).cast("int")
    near = F.abs(F.length(a) - F.length(b)) <= most
    return near & (longest.isNotNull()) & (F.levenshtein(a, b) <= most)


def ngrams(c: Column, n: int = 3) -> Column:
    """Distinct runs of n characters; none for shorter texts."""
    # one pass that looks ahead from every character: a substring by its number walks from the start of the text
    runs = F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return F.coalesce(F.array_distinct(runs), F.array().cast("array<string>"))


def ratio(x: str | None, y: str | None) -> int:
    """100 times the matching-blocks ratio of two texts in lower case, cut; 0 if one is empty."""
    return int(difflib.SequenceMatcher(None, x.lower(), y.lower()).ratio() * 100) if x and y else 0


@F.pandas_udf(T.IntegerType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times the matching-blocks ratio of the texts in lower case, cut; 0 if one is empty.

    There is no expression for it, so batches go to Python by Arrow.
    """
    memo: dict[tuple, int] = {}

    def one(x, y) -> int:
        if (x, y) not in memo:
            memo[x, y] = ratio(x, y)
        return memo[x, y]

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


#: Bounds of the verdicts on a sequence ratio.
VALUE_OVER, EXACT_FROM, FUZZY_OVER = 61, 90, 66


def verdicts(ratio: Column) -> dict[str, Column]:
    return {"similar_value": ratio > VALUE_OVER, "similar_exact": ratio >= EXACT_FROM, "similar_fuzzy": ratio > FUZZY_OVER}
