"""Scans: batch tables, manifests, listings, JSON configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio import model
from folio.functions import text
from folio.sources import staging

#: Cells of a manifest that mean "missing".
MISSING = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a", "#N/A")


def batch_rows(table: DataFrame, batch_name: str, transaction_id: str, *columns: str) -> DataFrame:
    """Rows of one batch; both conditions and the columns reach the scan."""
    found = table.filter((F.col("batch_name") == batch_name) & (F.col("transaction_id") == transaction_id))
    return found.select(*columns) if columns else found


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def table_columns(spark: SparkSession, name: str) -> tuple[list[str], list[str]]:
    """Columns of a catalog table in their order, and those it is partitioned by."""
    found = spark.catalog.listColumns(name)
    return [c.name for c in found], [c.name for c in found if c.isPartition]


def typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, sep=sep)


def inferred_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The same with types worked out of the rows, which reads the files twice."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=sep)


#: Lines that one record may have; a quote that stays open for longer makes a bad record.
RECORD_LINES = 1000
_OPEN = r'(?s)(^|\|)"(?:[^"~]|~.|"")*+"(?:[^|~]|~.)*+'


def _opens(line: Column) -> Column:
    """Whether a quoted cell is open at the end of a line that begins outside of one."""
    # whole quoted cells go; what is left of a quote at a cell's start is open
    return F.regexp_replace(line, _OPEN, "$1").rlike(r'(^|\|)"')


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, nth, value``: the records of pipe-separated files, of which quoted cells may hold line breaks.

    Files are read in splits, and whether a line begins inside a quoted cell depends on
    all lines before it.  So each line is first seen both ways: it leaves the state as it
    is, turns it, or sets it, whatever it was.  The splits' sums of that, a row for each, give
    the state that a split begins in; within splits the same sums give the state of each
    line.  Lines that begin outside begin a record.  Only lines of records that have
    several are grouped, at most ``RECORD_LINES``; a record of more is a quote that was never closed, and left out.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    if_out, if_in = _opens(F.col("value")), _opens(F.concat(F.lit('"x'), F.col("value")))
    seen = lines.withColumns({"sets": F.when(if_out == if_in, if_out.cast("int")), "turns": (if_out & ~if_in).cast("int")})
    seen = staging.materialise(seen)
    split, in_split = ["file", "start"], Window.partitionBy("file", "start").orderBy("n")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)

    def state(window: WindowSpec, sets: str, turns: str) -> tuple[Column, Column]:
        """What the rows before set last, and whether those since then turn it."""
        turned = F.coalesce(F.sum(turns).over(window), F.lit(0))
        at = F.last(F.when(F.col(sets).isNotNull(), F.struct(F.col(sets).alias("to"), F.col("_turned").alias("turned"))), ignorenulls=True).over(window)
        return at["to"], F.pmod(turned - F.coalesce(at["turned"], F.lit(0)), F.lit(2))

    counted = seen.withColumn("_turned", F.sum("turns").over(in_split))
    last = F.max_by(F.struct(F.col("sets").alias("to"), F.col("_turned").alias("turned")), F.when(F.col("sets").isNotNull(), F.col("n")))
    sums = counted.groupBy(*split).agg(last.alias("last"), F.sum("turns").alias("all"))
    sums = sums.select(*split, F.pmod(F.coalesce("last.to", F.lit(0)) + F.col("all") - F.coalesce("last.turned", F.lit(0)), F.lit(2)).alias("end"), F.col("last").isNull().alias("relative"))
    in_file = Window.partitionBy("file").orderBy("start")
    # a split that sets nothing turns what it finds if its end is 1
    splits = sums.withColumns({"sets": F.when(~F.col("relative"), F.col("end").cast("int")), "turns": F.when(F.col("relative"), F.col("end")).otherwise(0)})
    splits = splits.withColumn("_turned", F.sum("turns").over(in_file))
    to, turned = state(in_file.rowsBetween(Window.unboundedPreceding, -1), "sets", "turns")
    begins = splits.select(*split, F.pmod(F.coalesce(to, F.lit(0)) + turned, F.lit(2)).alias("begin"))
    to, turned = state(before, "sets", "turns")
    placed = counted.join(begins, split).withColumn("inside", F.pmod(F.coalesce(to, F.col("begin")) + turned, F.lit(2)) == 1)
    placed = staging.materialise(placed.select(*split, "n", "value", "inside", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(in_split).alias("at")))
    sizes = placed.groupBy(*split).agg(F.count_if(~F.col("inside")).alias("k"))
    offsets = sizes.select(*split, F.coalesce(F.sum("k").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    numbered = placed.join(offsets, split).select("file", "start", "n", "value", (F.col("at") + F.col("offset")).alias("nth"), "inside")
    many = staging.materialise(numbered.filter("inside").groupBy("file", "nth").agg(F.count("*").alias("more")))
    single = numbered.filter("NOT inside").join(many, ["file", "nth"], "left_anti").select("file", "nth", "value")
    parts = numbered.join(many.filter(F.col("more") < RECORD_LINES).select("file", "nth"), ["file", "nth"])
    whole = parts.groupBy("file", "nth").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "n", "value"))), lambda x: x["value"]), "\n").alias("value"))
    # the last record of a file may be open at its end: its quote was never closed
    return single.unionAll(whole).filter(~_opens(F.col("value")))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated batch manifests with quoted cells, all strings.

    Quotes inside cells may be doubled or behind ``~``, which takes any character as it is; quoted cells may hold separators and
    line breaks.  Each file begins with its own header; the columns are those of all headers,
    in the order in which they appear by file name, and null where a file has none.  Records with more cells than
    their header and records whose quote is not closed are left out.  Raises ValueError if no row is left.
    """
    found = staging.materialise(records(spark, path).filter(F.trim("value") != ""))
    first = found.groupBy("file").agg(F.min_by("value", "nth").alias("head"), F.min("nth").alias("nth"))
    # distinct headers are configuration: a few, whatever the number of files
    heads = [r[0] for r in first.groupBy("head").agg(F.min("file").alias("file")).orderBy("file").select("head").collect()]
    if not heads:
        raise ValueError("the manifest is empty")
    called = lambda cell: text.snake_case(cell.strip().strip('"').strip())
    names = {h: [called(c) for c in h.lstrip("\ufeff").split("|")] for h in heads}
    columns = list(dict.fromkeys(n for h in heads for n in names[h]))
    of_file = first.select("file", F.col("nth").alias("_nth"), "head")
    rows = found.join(staging.checked_broadcast(of_file, F.lit(200) + F.octet_length("head")), "file").filter(F.col("nth") > F.col("_nth")).select("head", _cells(F.col("value")).alias("cells"))
    out = None
    for head in heads:
        at = {n: i for i, n in reversed(list(enumerate(names[head])))}
        mine = rows.filter((F.col("head") == head) & (F.size("cells") <= len(names[head])))
        cells = mine.select(*((_present(F.get("cells", F.lit(at[c]))) if c in at else F.lit(None).cast("string")).alias(c) for c in columns))
        out = cells if out is None else out.unionAll(cells)
    if out.isEmpty():
        raise ValueError("the manifest has no row")
    return out


_CELL = r'(?s)\|("(?:[^"~]|~.|"")*+"(?:[^|~]|~.)*+|(?:[^|~]|~.)*+)'


def _cells(record: Column) -> Column:
    """Cells of a record: quoted ones keep separators; escaped and doubled quotes become plain ones."""
    found = F.regexp_extract_all(F.concat(F.lit("|"), record), F.lit(_CELL), F.lit(1))
    inside = lambda c: F.regexp_replace(F.regexp_replace(c, r'(?s)^"((?:[^"~]|~.|"")*+)"', "$1"), r'(?s)(?:"(?=")|~)(.)', "$1")
    return F.transform(found, lambda c: F.when(F.startswith(c, F.lit('"')), inside(c)).otherwise(F.regexp_replace(c, "(?s)~(.)", "$1")))


def _present(c: Column) -> Column:
    return F.when(~c.isin(*MISSING), c)


def listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, length`` of the files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return found.select("path", "length")


def _batch_part(batch: str, i: int) -> Column:
    parts = batch.split("_")
    return F.lit(parts[i] if i < len(parts) else "null")


def image_rows(paths: DataFrame, batch: str, transaction_id: str, columns: list[str], as_of: Column) -> DataFrame:
    """The whole table row of each image, 15 texts under the table's own ``columns`` in their order.

    What neither name nor batch tell is the empty text; ``as_of`` is written like ``3/9/24 08:05``.
    """
    if len(columns) != 15:
        raise ValueError("an image's row has 15 columns")
    path, blank, names = F.col("path"), F.lit(""), text.name_parts(F.col("path"))
    about = [path, F.substring_index(path, "/", -1), F.lit(transaction_id), _batch_part(batch, 2), _batch_part(batch, 1)]
    cells = [blank, *about, blank, F.date_format(as_of, "M/d/yy HH:mm"), blank, blank, blank, names["item_code"], names["item_code_id"], names["account_id"], F.lit(batch)]
    return paths.filter(text.is_image(path)).select(*(c.alias(n) for c, n in zip(cells, columns, strict=True)))


def image_manifest(paths: DataFrame, batch: str, transaction_id: str) -> DataFrame:
    """Manifest rows from image names ``customer_code_id`` and a batch name ``_collection_project_REF``."""
    return paths.filter(text.is_image(F.col("path"))).select(
        F.col("path").alias("image_path"),
        F.lit(batch).alias("batch_name"),
        F.lit(transaction_id).alias("transaction_id"),
        F.substring_index("path", "/", -1).alias("image_filename"),
        _batch_part(batch, 1).alias("collection"),
        _batch_part(batch, 2).alias("project"),
        *(c.alias(n) for n, c in text.name_parts(F.col("path")).items()),
    )


def configuration(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """One row for each account and collection of JSON configuration files.

    ``names`` says what the files call ``account_id`` and ``review_all`` if not so.
    """
    called = lambda schema: T.StructType([T.StructField((names or {}).get(f.name, f.name), f.dataType) for f in schema])
    inner = T.ArrayType(called(model.COLLECTION))
    schema = T.StructType([T.StructField(f.name, inner if f.name == "collections" else f.dataType) for f in called(model.CONFIG)])
    found = spark.read.schema(schema).option("multiLine", "true").json(path)
    return collections(found.select(*(F.col(a).cast(f.dataType).alias(f.name) for a, f in zip(found.columns, model.CONFIG, strict=True))))


def collections(config: DataFrame) -> DataFrame:
    """``account_id`` and the columns of a collection, a row for each, of configuration rows."""
    return config.select("account_id", F.explode("collections").alias("c")).select("account_id", "c.*")


def collection(config: DataFrame, name: str) -> DataFrame:
    """The configuration row of a collection; LookupError if there is none."""
    found = config.filter(F.col("collection") == name).limit(1)
    if found.isEmpty():
        raise LookupError(f"no collection named {name}")
    return found


def field_rules(config_row: DataFrame) -> list[model.FieldRule]:
    """The rules of a collection's fields; configuration is a few rows by its nature."""
    fields = config_row.select(F.explode("field_list").alias("f")).select("f.*")
    return [model.FieldRule.from_config(r.asDict(recursive=True)) for r in fields.collect()]


def inline(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def override_rows(spark: SparkSession, filters: dict, transaction_id: str, batch_name: str) -> DataFrame:
    """Corrected values given with a job: ``file -> {field: value}`` as re-entry rows."""
    import json

    rows = [(transaction_id, batch_name, name, json.dumps(values, sort_keys=True)) for name, values in filters.items() if isinstance(values, dict)]
    return spark.createDataFrame(rows, model.strings("transaction_id", "batch_name", "image_filename", "corrected"))
