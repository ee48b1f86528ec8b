"""Joining and shaping of validated rows for loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import text
from folio.sources import staging

_READ, _ORDER, _TEXT, _RANK = (staging.hidden(c) for c in ("read", "order", "text", "rank"))


def reenter(items: DataFrame, corrected: DataFrame) -> DataFrame:
    """Rows for which corrected values came back, by transaction, batch and file name."""
    keys = ["transaction_id", "batch_name", "image_filename"]
    named = items.withColumn("image_filename", text.file_name(F.col("image_path")))
    return named.join(corrected, keys, "inner")


def with_manifest(enriched: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows with the columns of their manifest row; keys and batch are taken once."""
    extra = [c for c in manifest.columns if c not in enriched.columns or c in ("transaction_id", "image_path")]
    return enriched.join(manifest.select(*extra), ["transaction_id", "image_path"], "inner")


def with_dimension(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows with their key's dimension values, null where it has none; the left side is never lost."""
    return rows.join(dimension.dropDuplicates([key]), key, "left")


def as_variant(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with a JSON column parsed once, to be stored; a text that is no JSON is null."""
    return rows.withColumn(column, F.try_parse_json(column))


def explode_fields(rows: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """One typed column for each field of a JSON column; texts of numbers count as numbers.

    Of a variant column the paths of the fields are read, and nothing is parsed.
    """
    if isinstance(rows.schema[column].dataType, T.VariantType):
        # a path takes a name between quotes of the kind that it does not hold
        path = lambda f: f"$['{f}']" if "'" not in f else f'$["{f}"]'
        cast = {"integer": "int", "date": "string", "string": "string"}
        return rows.select("*", *(F.try_variant_get(F.col(column), path(f), "string").try_cast(cast.get(k, k)).alias(f) for f, k in fields.items()))
    parsed = rows.withColumn(_READ, F.from_json(column, ", ".join(f"`{f}` string" for f in fields)))
    cast = {"integer": "int", "date": "string", "string": "string"}
    return parsed.select("*", *(F.col(f"{_READ}.`{f}`").try_cast(cast.get(k, k)).alias(f) for f, k in fields.items())).drop(_READ)


def grouped_text(rows: DataFrame, keys: list[str], order: str, value: str, most: int = 900) -> DataFrame:
    """Texts of each group joined in order, capped, and the group's first ``order`` value.

    Every text adds at least a separator, so only a group's first ``most`` texts, and
    the cap's worth of each, can count: the rank limit runs before the shuffle too, and
    no group of any size is gathered.
    """
    ranked = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(order).alias(_ORDER), F.left(F.col(value), F.lit(most)).alias(_TEXT))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(_ORDER, _TEXT))
    few = ranked.withColumn(_RANK, rank).filter(F.col(_RANK) <= most)
    pieces = F.array_sort(F.collect_list(F.struct(_RANK, _TEXT)))
    joined = F.array_join(F.transform(pieces, lambda p: p[_TEXT]), " ")
    own = [staging.hidden(f"key{i}") for i in range(len(keys))]
    texts = few.groupBy(*keys).agg(text.capped(joined, most).alias("text")).toDF(*own, "text")
    first = rows.groupBy(*keys).agg(F.min(order).alias("first_path"))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)]
    return first.join(texts, same, "left").select(*keys, F.coalesce("text", F.lit("")).alias("text"), "first_path")


def mapped(rows: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """Source columns under their targets' names; sources that are absent become null."""
    have = set(rows.columns)
    return rows.select(*((F.col(s) if s in have else F.lit(None).cast("string")).alias(d) for s, d in mapping))


def mask_references(rows: DataFrame, start: str = "REF") -> DataFrame:
    return rows.withColumns({c: text.mask(F.col(c)) for c in rows.columns if c.upper().startswith(start)})


def type_code(kind: Column) -> Column:
    """FILE is 3, BOX is 2, all else 1."""
    return F.when(kind == "FILE", 3).when(kind == "BOX", 2).otherwise(1)


def template_fields(template: DataFrame, content: str) -> DataFrame:
    """``name, ref`` of the template's entity for a content type, in any case; of several the last."""
    entity = F.element_at(F.filter("entities", lambda e: F.lower(e["entity"]) == content.lower()), -1)
    return template.select(F.explode(entity["fields"]).alias("f")).select("f.name", "f.ref")


def apply_template(rows: DataFrame, fields: DataFrame) -> DataFrame:
    """Rows with a copy of each column that the template gives a reference, under the reference's name.

    ``fields`` are the ``name, ref`` of one entity (``template_fields``): configuration, a
    few rows by its nature, so they become a dictionary of the plan and no join.  Names
    without a column and references that are null or no ``REF`` are left out; of several
    names with one reference the last in order of the names counts.
    """
    known = set(rows.columns)
    found = {r.name: r.ref for r in fields.filter(F.col("ref").contains("REF")).orderBy("name").collect() if r.name in known}
    return rows.withColumns({ref: F.col(name) for name, ref in found.items()})


#: Columns that are blank in every item, and those of the payloads; a loader with other names renames them.
BLANK = ("Customer File Barcode", "customerFileBarcode", "locationId", "departmentId", "Department", "File Barcode")
NEW_PAYLOAD = ("customerId", "locationId", "parentId", "attachment", "customerSchemaType", "itemType", "departmentId", "sourcePath", "REF10", "REF30")
EXISTING_PAYLOAD = ("customerId", "locationId", "customerSchemaType", "itemType", "departmentId", "sourcePath")


def new_item_columns(rows: DataFrame, account: str, as_of: Column) -> DataFrame:
    """``rows`` (``image_filename, image_path, box_barcode, box_id, ocr_liquid_text``) with the 18 columns of a new item."""
    kind, now = text.leading_part(F.col("image_filename")), text.minute_text(as_of)
    made = {c: F.lit("") for c in BLANK} | {"customerSchemaType": kind, "itemType": kind, "customerId": F.lit(account), "parentId": F.col("box_id")}
    made |= {"parentItemCode": F.col("box_barcode"), "Box Barcode": F.col("box_barcode"), "sourcePath": F.col("image_path"), "action": F.lit("4"), "attachment": F.lit("false")}
    return rows.withColumns(made | {"REF10": text.capped(F.col("ocr_liquid_text")), "Index Date": now, "REF30": now})


def batch_part(batch: str, i: int) -> str:
    """A part of a batch's name in upper case, without an ending."""
    return batch.split("_")[i].split(".")[0].upper()


def existing_item_columns(rows: DataFrame, batch: str, account: str, as_of: Column) -> DataFrame:
    """``rows`` (``image_path, ocr_liquid_text, item_code, item_code_id``) with the 15 columns of an item that exists.

    Its type and the column that takes the text are parts 2 and 3 of the batch's name.
    """
    kind, now = F.lit(batch_part(batch, 2)), text.minute_text(as_of)
    made = {c: F.lit("") for c in BLANK} | {"customerSchemaType": kind, "itemType": kind, "customerId": F.lit(account), "sourcePath": F.col("image_path")}
    made |= {batch_part(batch, 3): text.capped(F.col("ocr_liquid_text")), "Index Date": now, "REF30": now}
    return rows.withColumns(made | {"ItemCode": F.col("item_code"), "ItemCodeID": F.col("item_code_id")})


def new_payload(items: DataFrame) -> DataFrame:
    """The ten columns that are sent for a new item."""
    return items.select(*NEW_PAYLOAD)


def existing_payload(items: DataFrame, batch: str) -> DataFrame:
    """The eight columns that are sent for an item that exists."""
    return items.select(*EXISTING_PAYLOAD, batch_part(batch, 3), "REF30")


def with_configuration(rows: DataFrame, collections: DataFrame, key: str = "batch_name") -> DataFrame:
    """Rows with ``account`` and ``mode`` of the collection that their key names, ``none`` where there is none.

    ``collections`` are rows of ``readers.collections``; of several accounts with a
    collection of one name the smallest counts.  A configuration that is not small is not
    broadcast, as nothing here asks for it.
    """
    flat = collections.groupBy(F.col("collection").alias(key)).agg(F.min(F.struct(F.col("account_id").alias("account"), F.col("review_all").alias("mode"))).alias("c"))
    joined = rows.join(flat, key, "left")
    return joined.withColumns({"account": F.coalesce("c.account", F.lit("none")), "mode": F.coalesce("c.mode", F.lit("none"))}).drop("c")


def route(key: Column, has_config: Column, bypass: Column | None = None, indexed: str = "indexed", images: str = "image-extract") -> dict[str, Column]:
    """The way each stage takes for a key; ``indexed`` and ``images`` mark the two kinds of source in it."""
    indexed, images = F.contains(key, F.lit(indexed)), F.contains(key, F.lit(images))
    source = F.when(indexed, "csv").when(images, "per_image").otherwise("error")
    extract = F.when(indexed | (images & has_config), "run").when(images, "skip").otherwise("error")
    skip = F.lit(False) if bypass is None else bypass
    load = F.when(indexed & has_config, "new_items").when(images & has_config, "existing_items").otherwise("partial_update")
    return {"connect": source, "extract": extract, "validate": F.when(skip, "skip").otherwise(extract), "load": load}


def load_rows(rows: DataFrame, corrected: DataFrame | None, retrigger: bool, bypass: bool) -> DataFrame:
    """What is loaded: corrected rows on a retrigger, all rows on a bypass, else valid rows."""
    if retrigger and corrected is not None:
        return reenter(rows, corrected)
    return rows if bypass else rows.filter(F.col("data_is_valid") == "True")
