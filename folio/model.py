"""Schemas and configuration of a document batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    """A schema of nullable strings, as tables of scanned batches are stored."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ENRICHMENT = strings("image_path", "batch_name", "transaction_id", "ocr_liquid_text", "ocr_spatial_info", "key_value_pairs", "data_is_valid")
OCR_LINES = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("center", T.ArrayType(T.DoubleType()))]))

#: Collection configuration: collections, their fields, and the rules of each field.
VALIDATION = strings("MinLength", "MaxLength", "Pattern", "AllowSpecialChars", "AllowNull", "Format", "MinDate", "MaxDate")
FIELD = T.StructType(
    [
        *strings("FieldName", "FieldLabel", "Type", "ForceCase", "RemoveChars"),
        T.StructField("AlternativeLabels", T.ArrayType(T.StringType())),
        T.StructField("Validation", VALIDATION),
    ]
)
COLLECTION = T.StructType(
    [*strings("collection", "review_all"), T.StructField("load_to_system_of_records", T.BooleanType()), T.StructField("field_list", T.ArrayType(FIELD))]
)
CONFIG = T.StructType([*strings("account_id"), T.StructField("collections", T.ArrayType(COLLECTION))])


def flag(value: object) -> object:
    """``true`` and ``false`` in any case and type as booleans, other values as they are."""
    return {"true": True, "false": False}.get(str(value).strip().lower(), value)


@dataclass(frozen=True)
class FieldRule:
    """The rules of one field; limits may be texts, blank ones are off."""

    name: str
    kind: str = "string"
    min_length: object = None
    max_length: object = None
    pattern: str | None = None
    special: object = False  # False: none allowed, True: all, else the characters allowed
    allow_null: object = False
    date_format: str = "mm/dd/yyyy"
    min_date: str | None = None
    max_date: str | None = None

    @classmethod
    def from_config(cls, row: dict) -> FieldRule:
        v = row.get("Validation") or {}
        special = v.get("AllowSpecialChars")
        return cls(
            row["FieldName"],
            row.get("Type") or "string",
            v.get("MinLength"),
            v.get("MaxLength"),
            v.get("Pattern") or None,
            flag(False if special is None else special),
            flag(v.get("AllowNull") or False),
            v.get("Format") or "mm/dd/yyyy",
            v.get("MinDate") or None,
            v.get("MaxDate") or None,
        )


@dataclass(frozen=True)
class JobParameters:
    """What a stage is started with, and what follows from it."""

    transaction_id: str
    zip_key: str
    stage: str = "connect"
    workflow: str = ""
    filters: dict = field(default_factory=dict)

    @property
    def key(self) -> str:
        """The zip key, below the prefix of the filters if it names no folder."""
        prefix = str(self.filters.get("zip_key_prefix", "input/"))
        return self.zip_key if "/" in self.zip_key else f"{prefix.rstrip('/')}/{self.zip_key}"

    @property
    def batch_name(self) -> str:
        return self.key.rsplit("/", 1)[-1].rsplit(".", 1)[0]

    def target_prefix(self, root: str) -> str:
        folders = self.key.split("/")[1:-1]
        return "/".join([root, *folders, self.batch_name])

    @property
    def retrigger(self) -> bool:
        return self.workflow.endswith("-retrigger")

    @staticmethod
    def parse_filters(text: str | None) -> dict:
        """The dict that a text writes as JSON or as Python literals; anything else gives an empty one."""
        import ast
        import json

        for read in (json.loads, ast.literal_eval):
            try:
                found = read((text or "{}").strip())
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                continue
            return found if isinstance(found, dict) else {}
        return {}
