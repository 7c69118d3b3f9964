"""Top-n, canonical order, bounds and ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.ordering import earlier, over_order, place_all


def latest_n(df: DataFrame, by: list[str], ts: str, row_id: str, n: int, cutoff: Column | None = None) -> DataFrame:
    """Latest n rows per key at or before the cutoff, in total order (time, id) descending.

    Each task keeps at most n rows per key before the shuffle. Rows that share an identity
    are labelled `duplicate_identity`; they fail the batch, they are not dropped.
    """
    rows = df if cutoff is None else df.filter(F.col(ts) <= cutoff)
    w = W.partitionBy(*by).orderBy(F.desc(ts), F.desc(row_id))
    # Rows that tie with the n-th stay until their identity is counted, or a repetition at the cut would go unseen.
    tied = rows.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n)
    same = F.count("*").over(W.partitionBy(*by, ts, row_id)) > 1
    known = tied.withColumn("identity_status", F.when(same, "duplicate_identity").otherwise("unique"))
    return known.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def canonical_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Ordinal of each row in the canonical total order of the whole table, without a single-task sort; keys of any type, nulls first."""
    return place_all(df, order, "ordinal")


def daily_top(df: DataFrame, day: list[str], score: str, tie: str, passed: Column, k: int = 2) -> DataFrame:
    """After all gates, at most k rows per day by score; a day may have none."""
    w = W.partitionBy(*day).orderBy(F.desc(score), tie)
    return df.filter(passed).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def member_bounds(df: DataFrame, by: list[str], row_no: list[str], cols: list[str], ts: str, lo: Column, hi: Column) -> DataFrame:
    """First and last row of each member, and whether its times stay inside the declared bounds."""
    at, row = F.struct(*row_no), F.struct(*cols)
    found = df.groupBy(*by).agg(
        F.min_by(row, at).alias("first_row"), F.max_by(row, at).alias("last_row"), F.count("*").alias("n_rows"),
        F.count_if(~F.coalesce(F.col(ts).between(lo, hi), F.lit(False))).alias("outside"))
    return found.select(
        *by, *[F.col("first_row")[c].alias(f"first_{c}") for c in cols], *[F.col("last_row")[c].alias(f"last_{c}") for c in cols],
        "n_rows", "outside", F.when(F.col("outside") == 0, "in_bounds").otherwise("out_of_bounds").alias("bound_status"))


def percent_rank(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Share of the other rows of the group with a smaller value (nulls are the smallest, ties share a rank, a single row has 0).

    Rows are first counted by value, which settles ties and reduces crowds of them; running counts over the values of a group come from
    range-partitioned chunks, and rows read their rank by value. Neither a group nor a crowd of equal values has to fit one task.
    """
    counts = df.groupBy(*by, F.col(value).alias("__value")).agg(F.count("*").alias("__n"))
    below = over_order(counts, by, [F.col("__value")], {"__count": (F.col("__n"), "sum")},
                       {"__below": lambda w: F.coalesce(F.sum("__count").over(earlier(w)), F.lit(0))})
    sizes = counts.groupBy(*by).agg(F.sum("__n").alias("__size"))
    share = F.when(F.col("__size") > 1, F.col("__below") / (F.col("__size") - 1)).otherwise(0.0)
    ranks = _null_safe(below, sizes, by).withColumn(name, share).select(*by, "__value", name)
    return _null_safe(df, ranks, by, (F.col(f"l.{value}"), F.col("r.__value")), "left").drop("__value")


def _null_safe(left: DataFrame, right: DataFrame, by: list[str], more: tuple[Column, Column] | None = None, how: str = "inner") -> DataFrame:
    """Join in which a null key meets a null key; the columns of `by` come from the left."""
    pairs = [(F.col(f"l.{c}"), F.col(f"r.{c}")) for c in by] + ([more] if more else [])
    on = reduce(Column.__and__, [a.eqNullSafe(b) for a, b in pairs], F.lit(True))
    return left.alias("l").join(right.alias("r"), on, how).select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in by])


def rank_factors(df: DataFrame, by: list[str], factors: dict[str, float]) -> DataFrame:
    """Percent rank of every factor inside its group of bars, and the weighted sum as score."""
    ranked = df
    for name in factors:
        ranked = percent_rank(ranked, by, name, f"{name}_rank")
    score = sum((F.col(f"{name}_rank") * weight for name, weight in factors.items()), F.lit(0.0))
    return ranked.withColumn("score", score)
