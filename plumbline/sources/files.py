"""File inventory and strict text readers. Every line is classed and counted, none is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import FILE_FORMATS

EXCLUDED = r"/(\.[^/]+|__pycache__|[^/]*(cache|backup|fixture|demo|sample)[^/]*)(/|$)"


def file_inventory(spark: SparkSession, roots: list[str], formats: dict[str, str] = FILE_FORMATS,
                   exclude: str = EXCLUDED) -> DataFrame:
    """Candidate files by metadata alone: the content column of the binary reader is never selected."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    names = F.lit(None).cast("string")
    for ending, name in formats.items():
        names = F.when(suffix == ending, name).otherwise(names)
    return found.withColumn("format", names).filter(F.col("format").isNotNull() & ~F.lower("path").rlike(exclude))


def read_delimited_strict(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Columns of `schema`, the file, the raw line where it is malformed, and `line_class`: ok / malformed / blank.

    The text is parsed as one value with the whole schema: the CSV file reader would skip blank
    lines, and would not notice a malformed value in a column that a later `select` prunes.
    """
    full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "raw_line string"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "raw_line", "sep": sep}
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    blank = F.trim("value") == ""
    parsed = lines.select("file", blank.alias("blank"), F.from_csv("value", full, options).alias("cells"))
    status = F.when(F.col("blank"), "blank").when(F.col("cells.raw_line").isNull(), "ok").otherwise("malformed")
    return parsed.select("file", *[F.col(f"cells.{f.name}") for f in schema], "cells.raw_line", status.alias("line_class"))


def delimited_counts(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Lines, blank lines, malformed lines, lines of a wrong width and blank fields per file.

    Blank lines never reach the CSV parser, so they are counted on the text.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    quoted = F.from_csv(F.col("value"), ", ".join(f"c{i} string" for i in range(len(schema) + 1)), {"sep": sep})
    cells = F.array(*[quoted[f"c{i}"] for i in range(len(schema) + 1)])
    # The parser pads short rows with null and keeps blanks as null, so width is read from the raw separators outside quotes.
    width = F.size(F.split(F.regexp_replace("value", r'"[^"]*"', "q"), sep.replace("|", "\\|")))
    line = text.select("file", "value", (F.trim("value") == "").alias("blank"), width.alias("width"), cells.alias("cells"))
    field_blanks = F.size(F.filter(F.slice("cells", 1, len(schema)), lambda c: c.isNull() | (F.trim(c) == "")))
    right = ~F.col("blank") & (F.col("width") == len(schema))
    return line.groupBy("file").agg(
        F.count("*").alias("n_lines"), F.count_if("blank").alias("n_blank_lines"),
        F.count_if(~F.col("blank") & (F.col("width") != len(schema))).alias("n_wrong_width"),
        F.coalesce(F.sum(F.when(right, field_blanks)), F.lit(0)).alias("n_blank_fields"))


def json_class(c: Column) -> Column:
    """blank / illegal / non_object / object."""
    parsed = F.try_parse_json(c)
    return (
        F.when(c.isNull() | (F.trim(c) == ""), "blank").when(parsed.isNull(), "illegal")
        .when(F.schema_of_variant(parsed).startswith("OBJECT"), "object").otherwise("non_object")
    )


def read_jsonl_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Each line with its file and class; field union and counts are aggregates over it."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return lines.withColumn("line_class", json_class(F.col("line")))


def jsonl_counts(spark: SparkSession, path: str | list[str], unit: Column | None = None) -> DataFrame:
    """Lines per class and duplicate objects per file; duplicates compare the canonical JSON (sorted keys, no blanks).

    `unit`, an expression of `file`, counts several part files as one (for example by their folder).
    """
    lines = read_jsonl_strict(spark, path)
    if unit is not None:
        lines = lines.withColumn("file", unit)
    canonical = F.when(F.col("line_class") == "object", F.to_json(F.try_parse_json("line")))
    per_record = lines.groupBy("file", "line_class", F.sha2(canonical, 256).alias("__f")).agg(F.count("*").alias("__n"))

    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("line_class") == name, F.col("__n"))), F.lit(0))

    return per_record.groupBy("file").agg(
        F.sum("__n").alias("n_lines"), *[count(c).alias(f"n_{c}") for c in ("object", "blank", "illegal", "non_object")],
        F.coalesce(F.sum(F.when(F.col("line_class") == "object", F.col("__n") - 1)), F.lit(0)).alias("n_duplicate"))
