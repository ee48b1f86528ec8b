"""Outside services as functions over batches of rows, and archives and images as files.

A service is a callable from a list of requests to a list of answers.  It runs in the
executors, a bounded batch at a time; an answer that raises becomes that row's error
and no other's.  Tests give tables or plain functions as services.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text
from folio.sources import staging

_ANSWER, _FIELDS, _PATHS, _LINES = (staging.hidden(c) for c in ("answer", "fields", "paths", "lines"))
FAILED = "Could Not be Processed"


def call_service(rows: DataFrame, request: str, service: Callable[[list[str]], list[str]], answer: str = "answer", batch: int = 50) -> DataFrame:
    """``rows`` with the service's answer and an ``error`` column."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, `{answer}` string, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers, errors = [], []
            asked = frame[request].tolist()
            for i in range(0, len(asked), batch):
                part = asked[i : i + batch]
                try:
                    got, bad = list(service(part)), [None] * len(part)
                except Exception:  # one by one, so that an error stays with its row
                    got, bad = [], []
                    for one in part:
                        try:
                            got.append(service([one])[0])
                            bad.append(None)
                        except Exception as e:
                            got.append(FAILED)
                            bad.append(f"{type(e).__name__}: {e}")
                answers += got
                errors += bad
            yield frame.assign(**{answer: answers, "error": errors})

    return rows.mapInPandas(run, schema)


def lookup(rows: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """A point lookup as a left join; rows without an answer keep nulls and are not lost."""
    return rows.join(answers, on, "left")


def append_lookup(rows: DataFrame, request: str, service: Callable[[list[str]], list[str]], fields: dict[str, str], batch: int = 50) -> DataFrame:
    """``rows`` with one column for each field of the service's JSON answer, beside them.

    ``fields`` names the columns and the answer's keys; a call that fails gives its error
    in every field and is that row's only.
    """
    called = call_service(rows, request, service, _ANSWER, batch)
    parsed = called.withColumn(_FIELDS, F.from_json(_ANSWER, "map<string,string>"))
    failed = F.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), "error"))
    return parsed.withColumns({c: F.coalesce(failed, F.try_element_at(_FIELDS, F.lit(k))) for c, k in fields.items()}).drop(_ANSWER, _FIELDS, "error")


def unzip(spark: SparkSession, path: str) -> DataFrame:
    """``archive, name, content`` of all files in archives, names sorted within each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in sorted(z.infolist(), key=lambda i: i.filename):
                        if not info.is_dir():
                            yield pd.DataFrame({"archive": [archive], "name": [info.filename], "content": [z.read(info)]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, name string, content binary")


#: Bytes of a member that come out in one row.
PIECE = 4 << 20


def _place(path: str):
    """The file system of a path, of those that Arrow knows, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _opened(path: str):
    """A file that can be read from any place."""
    storage, place = _place(path)
    return storage.open_input_file(place)


def pack(rows: DataFrame, folder: str) -> int:
    """Writes ``archive, name, content`` as archives in a shared folder, names sorted within each; returns how many.

    An archive is written by one task, a file at a time, beside its place and then moved
    there, so one that is written again after a lost executor replaces itself.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        storage, root = _place(folder)
        storage.create_dir(root, recursive=True)
        mine, z, out, begun = uuid.uuid4().hex, None, None, None

        def end() -> pd.DataFrame:
            z.close()
            out.close()
            storage.move(f"{root}/{begun}.{mine}", f"{root}/{begun}")
            return pd.DataFrame({"archive": [begun]})

        for frame in frames:
            for archive, name, content in zip(frame["archive"], frame["name"], frame["content"], strict=True):
                if archive != begun:
                    if z:
                        yield end()
                    out = storage.open_output_stream(f"{root}/{archive}.{mine}")
                    z, begun = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED), archive
                z.writestr(zipfile.ZipInfo(name), content or b"", zipfile.ZIP_DEFLATED)
        if z:
            yield end()

    dealt = rows.select("archive", "name", "content").repartition("archive").sortWithinPartitions("archive", "name")
    return dealt.mapInPandas(run, "archive string").count()


def members(spark: SparkSession, path: str) -> DataFrame:
    """``archive, name, packed, size``: the files in archives, of which only the directories at their ends are read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive in frame["path"]:
                with _opened(archive) as file, zipfile.ZipFile(file) as z:
                    found = [(archive, i.filename, i.compress_size, i.file_size) for i in z.infolist() if not i.is_dir()]
                yield pd.DataFrame(found, columns=["archive", "name", "packed", "size"])

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(run, "archive string, name string, packed long, size long")


def expand(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """``archive, name, part, content``: the files in archives of any size, in pieces of ``PIECE`` bytes.

    An index of members is made first and dealt to tasks by member, so one large archive is
    expanded by many tasks; each reads only the ranges of its members, and holds one piece.
    A file without bytes has one empty piece.
    """
    found = staging.materialise(members(spark, path))
    n = tasks or max(1, min(found.count(), spark.sparkContext.defaultParallelism * 4))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, mine in frame.groupby("archive"):
                with _opened(archive) as file, zipfile.ZipFile(file) as z:
                    for name in mine["name"]:
                        with z.open(name) as member:
                            part, content = 0, member.read(PIECE)
                            while content or not part:
                                yield pd.DataFrame({"archive": [archive], "name": [name], "part": [part], "content": [content]})
                                part, content = part + 1, member.read(PIECE)

    return found.select("archive", "name").repartition(n, "archive", "name").mapInPandas(run, "archive string, name string, part int, content binary")


def ocr_lines(blocks: Column) -> Column:
    """``text, center`` of LINE blocks with four corners; the center is their mean to four places."""
    lines = F.filter(blocks, lambda b: (b["type"] == "LINE") & (F.size(b["corners"]) == 4))
    mean = lambda b, axis: F.round(F.aggregate(b["corners"], F.lit(0.0), lambda s, p: s + p[axis]) / 4, 4)
    return F.transform(lines, lambda b: F.struct(b["text"].alias("text"), F.array(mean(b, "x"), mean(b, "y")).alias("center")))


#: What a reading service answers, as JSON.
BLOCKS = "array<struct<type string, text string, corners array<struct<x double, y double>>>>"


def read_images(rows: DataFrame, service: Callable[[list[str]], list[str]], path: str = "image_path", rotated: bool = False, batch: int = 50) -> DataFrame:
    """``rows`` with ``ocr_liquid_text``, the distinct lines of an image in order, and ``ocr_spatial_info``, all lines with their centers as JSON.

    The service answers each path with its blocks (``BLOCKS``).  With ``rotated`` the three
    turned variants are read too, and their lines follow.  All variants of an image are
    read in one task, so nothing is shuffled; an image of which one variant fails has
    ``FAILED`` in both columns.
    """

    def read(requests: list[str]) -> list[str]:
        wanted = [json.loads(r) for r in requests]
        answers = iter(service([p for paths in wanted for p in paths]))
        return [json.dumps([block for _ in paths for block in json.loads(next(answers))]) for paths in wanted]

    paths = text.rotations(F.col(path)) if rotated else F.array(path)
    called = call_service(rows.withColumn(_PATHS, F.to_json(paths)), _PATHS, read, _ANSWER, batch)
    lines = called.withColumn(_LINES, ocr_lines(F.from_json(_ANSWER, BLOCKS)))
    found = F.filter(F.transform(_LINES, lambda line: line["text"]), lambda t: t != "")
    quoted = lambda t: F.regexp_extract(F.to_json(F.array(t)), r"(?s)^\[(.*)\]$", 1)
    center = lambda c: F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ", "), F.lit("]"))
    pairs = F.transform(_LINES, lambda line: F.concat(F.lit("["), quoted(line["text"]), F.lit(", "), center(line["center"]), F.lit("]")))
    failed = F.col("error").isNotNull() | F.col(_LINES).isNull()
    made = {"ocr_liquid_text": F.array_join(F.array_distinct(found), " "), "ocr_spatial_info": F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]"))}
    return lines.withColumns({n: F.when(failed, FAILED).otherwise(c) for n, c in made.items()}).drop(_PATHS, _ANSWER, _LINES, "error")


def prompt(keys: list[str], about: Column) -> Column:
    """The request of an extraction: keys with confidence keys, then the text."""
    wanted = json.dumps([k for key in keys for k in (key, f"{key}_s")])
    return F.concat_ws("\n", F.lit(f"Return one JSON object with these keys: {wanted}. Missing values are null."), F.coalesce(about, F.lit("")))


def payloads(rows: DataFrame, *columns: str) -> DataFrame:
    """The bodies of writing calls, one JSON text each."""
    return rows.select(F.to_json(F.struct(*columns)).alias("payload"))


def grayscale_turns(content: bytes) -> dict[str, bytes]:
    """A grayscale copy of an image and its quarter turns, in the image's own format; needs an imaging library."""
    try:
        from PIL import Image
    except ImportError as e:
        raise RuntimeError("no imaging library is installed") from e
    with Image.open(io.BytesIO(content)) as image:
        gray, kind, out = image.convert("L"), image.format, {}
        for turn in (0, 90, 180, 270):
            made = io.BytesIO()
            gray.rotate(-turn, expand=True).save(made, format=kind)
            out[f"_rot{turn}" if turn else ""] = made.getvalue()
    return out


def derive_images(spark: SparkSession, path: str, derive: Callable[[bytes], dict[str, bytes]] = grayscale_turns) -> DataFrame:
    """``path, content, error`` of what is derived from each file: its path with the variant before the ending."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                stem, dot, ending = name.rpartition(".")
                try:
                    made = derive(content)
                    yield pd.DataFrame({"path": [f"{stem}{k}{dot}{ending}" for k in made], "content": list(made.values()), "error": [None] * len(made)})
                except Exception as e:  # an image that cannot be read is that row's error
                    yield pd.DataFrame({"path": [name], "content": [None], "error": [f"{type(e).__name__}: {e}"]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, content binary, error string")
