"""Metadata and bounded reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.filters import project_allowed


def catalog_metadata(spark: SparkSession, frames: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Column name, type, position, nullability and declared key position of each table beside its row count.

    The facts come from the schemas and from declared keys, never from names or values; the
    only scan is `count(*)`, which Parquet answers from its footers without reading a column.
    """
    out = None
    for table, df in frames.items():
        declared = (keys or {}).get(table, [])
        cells = F.array(*[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.lit(i).alias("position"), F.lit(f.nullable).alias("nullable"),
                     F.lit(declared.index(f.name) if f.name in declared else None).cast("int").alias("key_position"))
            for i, f in enumerate(df.schema)
        ])
        rows = df.agg(F.count("*").alias("n_rows")).select(F.lit(table).alias("table"), "n_rows", F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out


def declared_catalog(spark: SparkSession, tables: list[str]) -> DataFrame:
    """The same facts for tables of the session catalog."""
    return catalog_metadata(spark, {t: spark.table(t) for t in tables})


def time_candidates(columns: DataFrame) -> DataFrame:
    """Columns whose name or type suggests a time: candidates only, the contract stays undetermined."""
    named = F.col("column").rlike(r"(?i)(^|_)(event_time|arrival_time|collected_at|created_at|updated_at|ts|time|date|.*date)(_ms|_sec)?$")
    typed = F.col("type").rlike("^(timestamp|date)")
    return columns.filter(named | typed).withColumn(
        "evidence", F.when(typed, "typed").otherwise("named")).withColumn("time_contract", F.lit("undetermined"))


def scan_bounded(df: DataFrame, key: tuple[str, str], ts: str, lo: str, hi: str, cols: list[str]) -> DataFrame:
    """One key value, a half-open time range and fixed columns; both predicates reach the file scan."""
    kind = df.schema[ts].dataType
    inside = (F.col(ts) >= F.lit(lo).cast(kind)) & (F.col(ts) < F.lit(hi).cast(kind))
    return project_allowed(df.filter((F.col(key[0]) == key[1]) & inside), cols)


def missing_objects(listing: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    """Objects of the official listing that are not held yet; nothing else is to be fetched."""
    return listing.join(have.select(*on).distinct(), on, "left_anti")
