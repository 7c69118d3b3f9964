"""Rows of ZIP archives that hold one same-named CSV each.

DEFLATE cannot be entered in the middle, so one archive is read by one task, as a stream of blocks, never whole. `ArchiveLines` is a Python data source:
archives are planned into partitions by size, and blocks are cut into lines and fields by Arrow. Everything after it (parsing, checks) is
JVM-side and freely partitioned.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import ArrowInvalid, fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.functions.scalars import from_epoch, strict_bool, strict_decimal

# Fields of a row, in order, in archives of single and of aggregated trades.
TRADE_FIELDS = ["id", "price", "qty", "quote_qty", "time_ms", "is_buyer_maker"]
AGG_TRADE_FIELDS = ["id", "price", "qty", "first_trade_id", "last_trade_id", "time_ms", "is_buyer_maker"]

#: Bytes of unpacked text that are cut at once.
BLOCK_BYTES = 4 << 20
#: Bytes of archives that one partition holds at most, if it is not one larger archive.
PARTITION_BYTES = 64 << 20
LINE_SCHEMA = "path string, member string, row_no long, cells array<string>, reason string, before struct<id:string,time_ms:string>"


def _batch(path: str, member: str | None, first: int | None, cells: pa.ListArray, reason: str | None, before: list[pa.Array]) -> pa.RecordBatch:
    n = len(cells)
    numbers = pa.nulls(n, pa.int64()) if first is None else pa.array(np.arange(first, first + n))
    known = pa.array(np.arange(n) > 0) if first == 0 else pa.repeat(pa.scalar(first is not None), n)
    text = [pa.repeat(pa.scalar(v, pa.string()), n) for v in (path, member, reason)]
    return pa.RecordBatch.from_arrays(
        [text[0], text[1], numbers, cells, text[2], pa.StructArray.from_arrays(before, ["id", "time_ms"], mask=pc.invert(known))],
        ["path", "member", "row_no", "cells", "reason", "before"])


def _note(path: str, member: str | None, reason: str) -> pa.RecordBatch:
    """One row that says why an archive gave no rows, or no more of them."""
    return _batch(path, member, None, pa.nulls(1, pa.list_(pa.string())), reason, [pa.nulls(1, pa.string())] * 2)


def _field(cells: pa.ListArray, i: int) -> pa.Array:
    """Field `i` of every line, null where a line has fewer."""
    starts = cells.offsets.to_numpy()
    short = np.diff(starts) <= i
    return cells.values.take(pa.array(np.where(short, 0, starts[:-1] + i), mask=short))


def _cut(text: bytes) -> pa.ListArray:
    """Fields of the lines of `text`, which ends with a line feed. The lines share one buffer; white space is kept but for carriage returns at line ends."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    offsets = np.concatenate([[0], ends + 1]).astype(np.int32)
    lines = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text))
    lines.validate(full=True)  # raises on text that is not UTF-8
    return pc.split_pattern(pc.utf8_rtrim(lines, "\r\n"), ",")


def _lines(path: str, member: str, stream: io.BufferedIOBase, keys: list[int]) -> Iterator[pa.RecordBatch]:
    row, rest, last = 0, b"", [pa.nulls(1, pa.string())] * 2
    while True:
        block = stream.read(BLOCK_BYTES)
        text = rest + block if block else rest + b"\n" if rest else b""
        if not text:
            break
        whole = text.rfind(b"\n") + 1
        rest = text[whole:]
        if whole:
            cells = _cut(text[:whole])
            now = [_field(cells, i) for i in keys]
            yield _batch(path, member, row, cells, None, [pa.concat_arrays([was, values.slice(0, len(values) - 1)]) for was, values in zip(last, now, strict=True)])
            row, last = row + len(cells), [values.slice(len(values) - 1) for values in now]
    if row == 0:
        yield _note(path, member, "empty_member")


def _archive(path: str, keys: list[int]) -> Iterator[pa.RecordBatch]:
    system, place = fs.FileSystem.from_uri(path)
    member = None
    try:
        with system.open_input_file(place) as raw, zipfile.ZipFile(raw) as archive:
            names = archive.namelist()
            stem = place.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            if len(names) != 1:
                yield _note(path, None, "not_one_member")
                return
            member = names[0]
            if member != f"{stem}.csv":
                yield _note(path, member, "member_name")
                return
            with archive.open(member) as data:
                yield from _lines(path, member, data, keys)
    except (zipfile.BadZipFile, EOFError, zlib.error, ArrowInvalid) as broken:  # a failing read of the store still raises
        yield _note(path, member, "crc_mismatch" if "CRC" in str(broken) else "unreadable")


@dataclass
class _Archives(InputPartition):
    paths: list[str]


class _ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.keys, self.tasks = options["path"], [int(options["id"]), int(options["time"])], int(options.get("tasks", 1))

    def partitions(self) -> list[_Archives]:
        """Archives by size, largest first: each opens a partition of its own, or joins the last one while that has room. Few archives are spread over all tasks."""
        system, place = fs.FileSystem.from_uri(self.root)
        scheme = self.root[: self.root.index(place)] if place in self.root else ""
        found = sorted(((f.size or 0, f.path) for f in system.get_file_info(fs.FileSelector(place, recursive=True)) if f.is_file and f.path.endswith(".zip")), reverse=True)
        parts, room, most = [], 0, min(PARTITION_BYTES, sum(size for size, _ in found) // self.tasks)
        for size, path in found:
            if size > room:
                parts.append(_Archives([]))
                room = max(most, size)
            parts[-1].paths.append(scheme + path)
            room -= size
        return parts

    def read(self, partition: _Archives) -> Iterator[pa.RecordBatch]:
        for path in getattr(partition, "paths", []):  # a table without archives has one empty partition
            yield from _archive(path, self.keys)


class ArchiveLines(DataSource):
    """`spark.read.format("archive_lines").option("id", i).option("time", j).load(root)`: i and j are the places of key and time in a line,
    `tasks` how many tasks there should be at least."""

    @classmethod
    def name(cls) -> str:
        return "archive_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(dict(self.options))


WRITTEN_SCHEMA = "name string, n_lines long"


def line_archives(root: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Writer for `mapInPandas`: each Arrow batch of column `line` becomes one archive, so its size is bounded.

    Names come from the content: a task that runs again writes the same archive over itself.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = "\n".join(batch["line"]) + "\n"
            stem = hashlib.sha256(text.encode()).hexdigest()[:32]
            system, place = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
            system.create_dir(place, recursive=True)
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{stem}.csv", text)
            with system.open_output_stream(f"{place}/{stem}.zip") as out:
                out.write(packed.getvalue())
            yield pd.DataFrame({"name": [f"{stem}.zip"], "n_lines": [len(batch)]})

    return write


def read_archive_members(spark: SparkSession, root: str, fields: list[str] = TRADE_FIELDS) -> DataFrame:
    """Every line of every archive below `root` (a URI, or a path that all nodes share) with its number, its fields, and key and time of the line before it.

    The reader sees the physical order, so checks against the row before need no sort later. Listing reads no content.
    """
    spark.dataSource.register(ArchiveLines)
    options = {"tasks": spark.sparkContext.defaultParallelism, "id": fields.index("id"), "time": fields.index("time_ms")}
    return spark.read.format("archive_lines").options(**options).load(root).withColumn("line", F.array_join("cells", ",", ""))


def with_identity(df: DataFrame, path: str = "path") -> DataFrame:
    """`symbol`, `object` and `member_date` as the archive name SYMBOL-object-YYYY-MM-DD.zip states them; null where it does not.

    The name decides what a member is, never its rows: a row of another day is then a finding, and an archive that
    cannot be read still has a symbol and a day to be missing from.
    """
    name = F.element_at(F.split(path, "/"), -1)

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, r"^([^-]+)-([^-]+)-(\d{4}-\d{2}-\d{2})\.zip$", i), F.lit(""))

    return df.select("*", part(1).alias("symbol"), part(2).alias("object"), part(3).try_cast("date").alias("member_date"))


def parse_trades(lines: DataFrame, fields: list[str] = TRADE_FIELDS) -> DataFrame:
    """Typed trade columns from raw lines: id, price, qty, quote_qty, time_ms, is_buyer_maker; bad rows keep null and a reason. `archive_reason` says why a member could not be read to its end.

    `lines` come from `read_archive_members` with the same fields. `before` is struct(k, t): key and time of the line before in the same member. With `AGG_TRADE_FIELDS` a row also
    names the first and last trade in it, which must not be reversed.
    """
    def piece(field: str) -> Column:
        return F.get("cells", F.lit(fields.index(field)))

    numbers = [f for f in ("price", "qty", "quote_qty") if f in fields]
    ids = [f for f in ("id", "first_trade_id", "last_trade_id") if f in fields]

    key_before, time_before = F.col("before.id").try_cast("bigint"), F.col("before.time_ms").try_cast("bigint")
    typed = lines.select(
        "path", "member", "row_no", "line", F.size("cells").alias("n_fields"),
        *[piece(f).try_cast("bigint").alias(f) for f in ids], *[strict_decimal(piece(f)).alias(f) for f in numbers],
        from_epoch(piece("time_ms").try_cast("bigint"), "ms").alias("ts"), strict_bool(piece("is_buyer_maker")).alias("is_buyer_maker"),
        F.col("reason").alias("archive_reason"),
        F.when(F.col("before").isNotNull(), F.struct(key_before.alias("k"), from_epoch(time_before, "ms").alias("t"))).alias("before"))
    open_row = F.col("row_no").isNotNull()

    def any_null(names: list[str]) -> Column:
        return reduce(Column.__or__, [F.col(n).isNull() for n in names])

    checks = {
        "field_count": open_row & (F.col("n_fields") != len(fields)), "id_syntax": open_row & any_null(ids), "number_syntax": open_row & any_null(numbers),
        "time_syntax": open_row & F.col("ts").isNull(), "boolean_syntax": open_row & F.col("is_buyer_maker").isNull(),
        "price_not_positive": F.col("price") <= 0, "quantity_not_positive": F.col("qty") <= 0,
        **({"quote_negative": F.col("quote_qty") < 0} if "quote_qty" in numbers else {}),
        **({"trade_id_order": F.col("first_trade_id") > F.col("last_trade_id")} if "first_trade_id" in ids else {}),
    }
    named = F.array_compact(F.array(F.col("archive_reason"), *[F.when(check, name) for name, check in checks.items()]))
    # Nearly all rows are sound: one pass over the checks says so, and only for the others a list is made.
    broken = reduce(Column.__or__, [F.coalesce(check, F.lit(False)) for check in checks.values()], F.col("archive_reason").isNotNull())
    reasons = F.when(broken, named).otherwise(F.array().cast("array<string>"))
    return typed.withColumn("reasons", reasons)
