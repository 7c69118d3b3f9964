"""Structure of tables as facts: columns and indexes in one form, their fingerprints, and declared against observed.

A fact is a row (table, kind, name, seq, what, flag, more): for a column its position, type, nullability and place in the key; for
an index its sequence number, column, non-uniqueness and type. Facts are rows like others, so any number of tables is one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.aggregates import fingerprint_sums

FACT = ["kind", "name", "seq", "what", "flag", "more"]
#: What a read of a table's metadata can end with; anything else counts as failed.
READ, DENIED = "read", "denied"


def column_facts(columns: DataFrame) -> DataFrame:
    """Facts of (table, column, type, position, nullable, key_position), as `catalog_metadata` gives them. Names are folded to
    lower case; a null key position says that the column is in no key."""
    return columns.select(
        "table", F.lit("column").alias("kind"), F.lower("column").alias("name"), F.col("position").cast("int").alias("seq"),
        F.col("type").alias("what"), F.col("nullable").cast("boolean").alias("flag"),
        F.coalesce(F.col("key_position").cast("string"), F.lit("-")).alias("more"))


def index_facts(indexes: DataFrame) -> DataFrame:
    """Facts of (table, index, seq, column, non_unique, index_type), a row per column of an index. Names are folded to lower case
    and types to upper case, so that spelling is no drift."""
    return indexes.select(
        "table", F.lit("index").alias("kind"), F.lower("index").alias("name"), F.col("seq").cast("int").alias("seq"),
        F.lower("column").alias("what"), F.col("non_unique").cast("boolean").alias("flag"), F.upper("index_type").alias("more"))


def structure_sha(facts: DataFrame) -> DataFrame:
    """Number of facts and fingerprint per table and kind. Positions and sequence numbers are part of every fact, so order counts,
    though the rows may come in any; a repeated fact counts again."""
    return fingerprint_sums(facts, FACT, ["table", "kind"]).withColumnRenamed("n_rows", "n_facts")


def compare_structure(declared: DataFrame, observed: DataFrame, reads: DataFrame) -> DataFrame:
    """One state per table from facts of both sides and `reads` (table, outcome): what reading the observed side ended with.

    undeclared (no declared fact), failed (a read ended otherwise than `read` or `denied`), undetermined (denied, never read, or a
    fact of either side is unknown), not_found (read, and nothing is there), drift, match. Asked in this order, so that nothing but
    two known and equal sides is a match. A column is told by its name, an index row by index and sequence number; facts of one side
    that contradict each other are drift, repeated equal ones are not. Null tables and names are keys like others.
    """
    sides = declared.withColumn("side", F.lit("declared")).unionByName(observed.withColumn("side", F.lit("observed")))
    value = F.struct("seq", "what", "flag", "more")
    place = F.when(F.col("kind") == "index", F.col("seq")).otherwise(0)
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("name", "seq", "what", "flag", "more")])
    per_fact = sides.groupBy("table", "kind", "name", place.alias("place")).agg(
        F.count_if(F.col("side") == "declared").alias("d"), F.count_if(F.col("side") == "observed").alias("o"),
        F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(unknown).alias("unknown"))
    differs = (F.col("d") == 0) | (F.col("o") == 0) | ~F.col("low").eqNullSafe(F.col("high"))
    per_table = per_fact.groupBy("table").agg(
        F.count_if(F.col("d") > 0).alias("declared_n"), F.count_if(F.col("o") > 0).alias("observed_n"),
        F.count_if(F.col("unknown") > 0).alias("unknown_n"),
        *[F.count_if(differs & (F.col("kind") == k)).alias(name) for k, name in (("column", "columns_differing"), ("index", "indexes_differing"))])
    worst = F.max(F.when(F.col("outcome") == READ, 0).when(F.col("outcome") == DENIED, 1).otherwise(2)).alias("__worst")
    ended = reads.groupBy(F.col("table").alias("__read")).agg(worst)
    both = per_table.join(ended, F.col("table").eqNullSafe(F.col("__read")), "full_outer")
    counts = ["declared_n", "observed_n", "unknown_n", "columns_differing", "indexes_differing"]
    known = both.select(F.coalesce("table", "__read").alias("table"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "__worst")
    state = (
        F.when(F.col("declared_n") == 0, "undeclared").when(F.col("__worst") == 2, "failed")
        .when(F.col("__worst").isNull() | (F.col("__worst") == 1), "undetermined").when(F.col("observed_n") == 0, "not_found")
        .when(F.col("unknown_n") > 0, "undetermined")
        .when(F.col("columns_differing") + F.col("indexes_differing") > 0, "drift").otherwise("match")
    )
    return known.select("table", *counts, state.alias("structure_state"))
