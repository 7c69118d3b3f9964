"""What several operators of this subpackage need: the word rule, stored tables, distributed running totals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.session import fresh_folder

#: Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and go on from the files: lineage ends there, a lost executor costs
    a re-read, and the shuffle files of the job that made it go as soon as it is written."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def order_first(*names: str) -> list[Column]:
    """Ascending with nulls last, as sources and ids are ordered here."""
    return [F.col(n).asc_nulls_last() for n in names]


def running(df: DataFrame, order: list[Column], name: str, **totals: Column) -> DataFrame:
    """Add, for every row, its place (1, 2, ...) in the given order and, per named total, the sum over the rows before it.

    The order is a distributed one: rows are range-partitioned, the cut is fixed in a stored table, each
    part is summed on its own, and a table with one row per part (as many as there are partitions) gives the
    offsets. Order columns must tell rows apart, or the place among equal rows is arbitrary.
    """
    cut = store(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    parts = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__{k}") for k, c in totals.items()])
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("__part", *[F.coalesce(F.sum(f"__{k}").over(before), F.lit(0)).alias(f"__{k}") for k in ("n", *totals)])
    inside = W.partitionBy("__part").orderBy(*order)
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    out = cut.join(F.broadcast(offsets), "__part").withColumn("place", F.col("__n") + F.row_number().over(inside))
    for k, c in totals.items():
        out = out.withColumn(k, F.col(f"__{k}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)))
    return out.drop("__part", "__n", *[f"__{k}" for k in totals])


def span_names(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit names of all spans of k values: names of spans of 1, 2, 4, ... are paired at growing offsets up to k.

    Equal spans have equal names; different ones differ but for a chance of 2^-64 a pair.
    """
    h, span = values.astype(np.uint64) + np.uint64(1), 1
    while span < k:
        step = min(span, k - span)
        h = paired_names(h[: len(h) - step], h[step:])
        span += step
    return h


def paired_names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The name of a pair of names; not symmetric."""
    mixed = second ^ second >> np.uint64(29)
    h = first * np.uint64(0x9E3779B97F4A7C15) + mixed * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(31)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` adjacent values."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = np.minimum(values[: len(values) - step], values[step:])
        span += step
    return values
