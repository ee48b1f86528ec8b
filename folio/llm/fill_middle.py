"""Fill-in-the-middle transformation by lookaround splitting.

A unit grammar says which neighbouring characters stay together.  It is translated to
a regular expression of lookarounds only, which matches the empty string between
two characters unless one of the grammar's pairs of classes holds both.  Spark's
``split`` at these boundaries takes nothing away, so the pieces joined are the text.
``split`` makes one empty piece of an empty text, so that case is handled apart: it has no unit.

A document's cuts, form and marks are drawn from the SHA-256 of a seed and its id,
so they are the same whatever the partitions are and whichever task is run again.
There is no shuffle and no Python in the plan.

Defined results: a null text is an empty one; empty texts and texts that hold a mark
stay plain, and so do those drawn for it; a text of fewer units than cuts has empty
parts; a null id is drawn as the empty text; rows that repeat an id are cut by the same
numbers, each in its own text; a text of any length is split whole; an empty table gives
an empty result; further columns, whatever their names, are kept or not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import shared


@dataclass(frozen=True)
class Grammar:
    """Pairs of character classes, written as in regular expressions: neighbours in such classes are in one unit."""

    together: tuple[tuple[str, str], ...] = ()

    def boundary(self) -> str:
        """The empty string between two characters that are in different units."""
        kept = "".join(f"(?!(?<={before})(?={after}))" for before, after in self.together)
        return f"(?s)(?<=.)(?=.){kept}"


#: Every code point; words and the white space between them; lines with their line breaks; words with the blanks before them.
CODE_POINTS = Grammar()
WORDS = Grammar(((r"\S", r"\S"), (r"\s", r"\s")))
LINES = Grammar(((r"[^\n]", r"."),))
SPACED_WORDS = Grammar(((r"\S", r"\S"), (r"\s", r".")))


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def units(text: Column, grammar: Grammar = CODE_POINTS) -> Column:
    """The units of a text in order; none for an empty or a null one."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, grammar.boundary(), -1))


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits for a key: the beginnings of the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, *keep: str, grammar: Grammar = CODE_POINTS, marks: Marks = Marks(), seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, key: str = "doc_id") -> DataFrame:
    """The columns named and ``n, form, output, prefix_units, middle_units`` of every row.

    ``form`` is ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) or ``spm``
    (suffix, prefix, middle); the parts have no size where it is plain.
    """
    text, cut = shared.hidden("text"), shared.hidden("cut")
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text), *(d.alias(shared.hidden(f"h{i}")) for i, d in enumerate(draws(F.col(key), seed), 1)))
    h1, h2, h3, h4 = (F.col(shared.hidden(f"h{i}")) for i in range(1, 5))
    whole = F.col(text)
    marked = F.lit(False)
    for mark in marks.all():
        marked = marked | F.contains(whole, F.lit(mark))
    plain = (whole == "") | marked | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")

    def parts(pieces: Column) -> Column:
        n = F.size(pieces)
        a, b = h1 % (n + 1), h2 % (n + 1)
        first, second = F.least(a, b).cast("int"), F.greatest(a, b).cast("int")
        join = lambda start, count: F.when(~plain, F.array_join(F.slice(pieces, start + 1, count), ""))
        return F.struct(n.cast("long").alias("n"), first.alias("a"), (second - first).alias("m"), join(F.lit(0), first).alias("p"), join(first, second - first).alias("i"), join(second, n - second).alias("s"))

    rows = rows.select(*keep, text, form.alias("form"), shared.let(units(whole, grammar), parts).alias(cut))
    p, i, s = (F.col(f"{cut}.{c}") for c in "pis")
    put = {"psm": F.concat(F.lit(marks.prefix), p, F.lit(marks.suffix), s, F.lit(marks.middle), i), "spm": F.concat(F.lit(marks.suffix), s, F.lit(marks.prefix), p, F.lit(marks.middle), i)}
    output = F.when(F.col("form") == "psm", put["psm"]).when(F.col("form") == "spm", put["spm"]).otherwise(F.col(text))
    size = lambda c: F.when(F.col("form") != "plain", F.col(f"{cut}.{c}")).cast("long")
    return rows.select(*keep, F.col(f"{cut}.n").alias("n"), "form", output.alias("output"), size("a").alias("prefix_units"), size("m").alias("middle_units"))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made of."""
    any_mark = "|".join("\\Q" + m + "\\E" for m in marks.all())
    parts = F.split(output, any_mark, -1)
    at = lambda *order: F.concat(*(F.get(parts, F.lit(i)) for i in order))
    # the text holds no mark and marks do not overlap, so there are three, with nothing before the first
    return F.when(form == "psm", at(1, 3, 2)).when(form == "spm", at(2, 3, 1)).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restore(F.col("output"), F.col("form")), 256)}
    return done.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), *(v.alias(k) for k, v in digests.items()))


SQL = r"""
WITH d AS (
  SELECT doc_id, t, length(t) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents)
), f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), o AS (
  SELECT doc_id, t, n, form, a, b, left(t, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""
