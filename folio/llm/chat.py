"""Chat formatting by quotation linking, in DataFrame operations only.

A line's quote level is the number of ``>`` marks it starts with.  Lines of one level
without a blank between them are a passage.  Passages and single lines are
normalised (lower case, one space for white space) and hashed; those that a message
writes itself (level 0) are looked up for those that other messages quote.  The
message of the same conversation that first wrote the most characters of the
level-1 quotes is what is replied to; without such a message it is the message of
the turn before.  A reply always comes after what it replies to, so the turns are a
reply order; messages come out without their quotes, with their role marked.

The first writer of a hash is one row for each conversation and hash, found with
partial aggregation, so neither frequent phrases nor long conversations gather in a
task: every join has unique rows on one side and keys below the conversation.

``position`` numbers the turns of a conversation in reply order from 1.  Turns are
numbered in pieces of ``PIECE`` turns first, and the pieces' sizes added up, so a
conversation of any length does not gather in a task.

Defined results: a null or empty text is an empty message; blank lines are no
passages; rows that repeat a turn are formatted each and share a position; a null
conversation is one of its own for positions and links nothing; a null turn has no
position; a null role is written as ``user``; a text of any length is parsed whole; an
empty table gives an empty result; further columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import shared

#: Turns that are numbered in one task.
PIECE = 4096
#: Positions of a conversation that are written into one row.
PART = 64
#: Possessive, so that Java's matcher takes marks one after the other in a loop and not by recursion.
_MARKS = r"^[ \t]*+(?:>[ \t]?+)++"
_BREAK, _AFTER = "\x01", "\x02"


def quote_levels(text: Column) -> Column:
    """``level, body, norm`` of each line."""

    def one(line: Column) -> Column:
        level = F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))
        body = F.regexp_replace(line, _MARKS, "")
        norm = F.btrim(F.regexp_replace(F.lower(body), r"[\x00-\x20]+", " "))
        return F.struct(level.alias("level"), body.alias("body"), norm.alias("norm"))

    return F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1), one)


def without_quotes(marked: Column) -> Column:
    own = F.transform(F.filter(marked, lambda x: x["level"] == 0), lambda x: x["body"])
    return F.btrim(F.array_join(own, "\n"), F.lit("\n"))


def passages(marked: Column) -> Column:
    """Distinct passages and lines as texts ``level, _AFTER, norm``: texts are told apart by hashing, structs by comparing all pairs."""

    def piece(x: Column, i: Column) -> Column:
        before = F.get(marked, i - 1)
        goes_on = (i > 0) & (before["norm"] != "") & (before["level"] == x["level"])
        start = F.concat(F.lit(_BREAK), x["level"].cast("string"), F.lit(_AFTER))
        return F.when(x["norm"] == "", "").otherwise(F.concat(F.when(goes_on, " ").otherwise(start), x["norm"]))

    # blank lines leave no text; a normalised text holds no control characters
    runs = F.split(F.array_join(F.transform(marked, piece), ""), _BREAK)
    lines = F.transform(F.filter(marked, lambda x: x["norm"] != ""), lambda x: F.concat(x["level"].cast("string"), F.lit(_AFTER), x["norm"]))
    return F.array_distinct(F.array_remove(F.concat(runs, lines), ""))


def positions(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, position`` of every distinct turn."""
    piece = F.floor(F.col("turn") / PIECE)
    turns = messages.filter("turn IS NOT NULL").select("conv_id", "turn").distinct().withColumn("piece", piece)
    within = turns.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "piece").orderBy("turn")))
    sizes = turns.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), before.alias("offset"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    return within.join(offsets, same).select("conv_id", "turn", (F.col("offset") + F.col("nth")).cast("long").alias("position"))


def link(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, position, role, text`` (without quotes)``, n_quotes, n_linked, reply_to`` of every row."""
    parsed = messages.select("conv_id", "turn", "role", F.xxhash64("text").alias("version"), quote_levels(F.col("text")).alias("marked"))
    units = parsed.select("conv_id", "turn", "version", F.explode(shared.let(F.col("marked"), passages)).alias("p"))
    units = units.select("conv_id", "turn", "version", F.substring_index("p", _AFTER, 1).cast("int").alias("level"), F.substring_index("p", _AFTER, -1).alias("norm"))
    units = units.select("conv_id", "turn", "version", "level", F.length("norm").alias("size"), F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"))
    writers = units.filter("level = 0").groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("origin"))
    quoted = units.filter("level > 0").distinct()
    found = quoted.join(writers, ["conv_id", "h1", "h2"], "left").withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    votes = found.groupBy("conv_id", "turn", "version", "origin").agg(F.count("*").alias("n"), F.sum(F.when(F.col("level") == 1, F.col("size"))).alias("size"))
    best = F.max_by("origin", F.when(F.col("origin").isNotNull() & F.col("size").isNotNull(), F.struct("size", "origin")))
    replies = votes.groupBy("conv_id", "turn", "version").agg(F.sum("n").alias("n_quotes"), F.sum(F.when(F.col("origin").isNotNull(), F.col("n"))).alias("n_linked"), best.alias("quoted_turn"))
    earlier = messages.select("conv_id", (F.col("turn") + 1).alias("turn")).distinct().withColumn("follows", F.lit(True))
    texts = parsed.select("conv_id", "turn", "role", "version", without_quotes(F.col("marked")).alias("text"))
    joined = texts.join(replies, ["conv_id", "turn", "version"], "left").join(earlier, ["conv_id", "turn"], "left")
    places = positions(messages).toDF("_conv", "_turn", "position")
    joined = joined.join(places, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    before = F.when(F.col("follows"), F.col("turn") - 1)
    return joined.select("conv_id", "turn", "position", "role", "text", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("quoted_turn", before).alias("reply_to"))


def format_messages(linked: DataFrame) -> DataFrame:
    """The same with ``message``, the text between marks of role and end."""
    role = F.coalesce(F.lower("role"), F.lit("user"))
    return linked.withColumn("message", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")))


def transcripts(messages: DataFrame) -> DataFrame:
    """``conv_id, part, n_messages, conversation``: the messages in reply order, ``PART`` positions in a row.

    Rows that repeat are one; a message without a position is in no conversation.  Parts keep
    a conversation of any length from gathering in one task.
    """
    placed = messages.filter("position IS NOT NULL").select("conv_id", "position", "message").distinct()
    pieces = placed.groupBy("conv_id", F.floor((F.col("position") - 1) / PART).cast("long").alias("part")).agg(F.array_sort(F.collect_list(F.struct("position", "message"))).alias("m"))
    return pieces.select("conv_id", "part", F.size("m").cast("long").alias("n_messages"), F.array_join(F.transform("m", lambda x: x["message"]), "\n").alias("conversation"))


COLUMNS = ["conv_id", "turn", "position", "role", "reply_to", "n_quotes", "n_linked", "message"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_messages(link(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).select(*COLUMNS)


def with_quotes(messages: DataFrame) -> DataFrame:
    """Each message with the text of the turn before it quoted on top, and of the turn before that quoted twice."""
    key = ["conv_id", "turn"]

    def earlier(by: int, mark: str) -> DataFrame:
        lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.concat(F.lit(mark), x))
        return messages.select("conv_id", (F.col("turn") + by).alias("turn"), F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias(f"quote{by}"))

    joined = messages.join(earlier(1, "> "), key, "left").join(earlier(2, ">> "), key, "left")
    text = F.concat(F.coalesce("quote2", F.lit("")), F.coalesce("quote1", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    return joined.select("conv_id", "turn", "role", text.alias("text"))


def quoted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over all messages with quotes written into them: the table's own hold none."""
    return format_messages(link(with_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet")))).select(*COLUMNS)


def transcript_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations, without the quotes that were written into them."""
    return transcripts(format_messages(link(with_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet")))))


SQL = r"""
WITH l AS (
  SELECT conv_id, turn, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT conv_id, turn, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations)
), m AS (
  SELECT conv_id, turn, pos,
         length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+'), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]*(?:>[ \t]?)+', '') AS body,
         trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*(?:>[ \t]?)+', '')), '[\x00-\x20]+', ' ', 'g'), ' ') AS norm FROM l
), g AS (
  SELECT *, lag(norm) OVER w AS norm_before, lag(level) OVER w AS level_before
  FROM m WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos)
), r AS (
  SELECT *, sum(CASE WHEN norm = '' OR norm_before IS NULL OR norm_before = '' OR level_before <> level THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id, turn ORDER BY pos) AS run FROM g
), u AS (
  SELECT conv_id, turn, level, norm FROM m WHERE norm <> ''
  UNION SELECT conv_id, turn, level, norm FROM (
    SELECT conv_id, turn, level, string_agg(norm, ' ' ORDER BY pos) AS norm FROM r WHERE norm <> '' GROUP BY conv_id, turn, level, run)
), o AS (
  SELECT conv_id, norm, min(turn) AS origin FROM u WHERE level = 0 GROUP BY conv_id, norm
), q AS (
  SELECT u.conv_id, u.turn, u.level, length(u.norm) AS size, CASE WHEN o.origin < u.turn THEN o.origin END AS origin
  FROM u LEFT JOIN o ON u.conv_id = o.conv_id AND u.norm = o.norm WHERE u.level > 0
), v AS (
  SELECT conv_id, turn, origin, count(*) AS n, sum(size) FILTER (level = 1) AS size FROM q GROUP BY conv_id, turn, origin
), b AS (
  SELECT conv_id, turn, sum(n) AS n_quotes, sum(n) FILTER (origin IS NOT NULL) AS n_linked FROM v GROUP BY conv_id, turn
), c AS (
  SELECT conv_id, turn, origin FROM v WHERE origin IS NOT NULL AND size IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY size DESC, origin DESC) = 1
), t AS (
  SELECT conv_id, turn, trim(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (level = 0), ''), chr(10)) AS own FROM m GROUP BY conv_id, turn
)
SELECT x.conv_id, x.turn, dense_rank() OVER (PARTITION BY x.conv_id ORDER BY x.turn) AS position, x.role, coalesce(c.origin, p.turn) AS reply_to,
       CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked,
       '<|' || coalesce(lower(x.role), 'user') || '|>' || chr(10) || own || chr(10) || '<|end|>' AS message
FROM conversations x JOIN t ON x.conv_id = t.conv_id AND x.turn = t.turn
LEFT JOIN b ON x.conv_id = b.conv_id AND x.turn = b.turn LEFT JOIN c ON x.conv_id = c.conv_id AND x.turn = c.turn
LEFT JOIN conversations p ON x.conv_id = p.conv_id AND p.turn = x.turn - 1
"""

_QUOTED = r"""
WITH quoted AS (
  SELECT c.conv_id, c.turn, c.role,
         coalesce('>> ' || replace(b.text, chr(10), chr(10) || '>> ') || chr(10), '') || coalesce('> ' || replace(a.text, chr(10), chr(10) || '> ') || chr(10), '')
         || chr(10) || coalesce(c.text, '') AS text
  FROM conversations c
  LEFT JOIN (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations) a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
  LEFT JOIN (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations) b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2
), l AS ("""
QUOTED_SQL = _QUOTED + SQL.split("WITH l AS (", 1)[1].replace("conversations", "quoted")

TRANSCRIPT_SQL = f"""
SELECT conv_id, CAST((position - 1) // 64 AS BIGINT) AS part, count(*) AS n_messages, string_agg(message, chr(10) ORDER BY position, message) AS conversation
FROM (SELECT DISTINCT conv_id, position, message FROM ({QUOTED_SQL}) x) GROUP BY 1, 2
"""
