"""Selections and row checks. Rows that fail are labelled or handed back, never lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import OUTCOME_WINDOWS_M, STATE_SCALES_H
from plumbline.ordering import skew_join
from plumbline.rules import RuleSet


def select_units(inv: DataFrame, kinds: list[str], formats: list[str], kind: str = "asset_type",
                 fmt: str = "format") -> tuple[DataFrame, DataFrame]:
    """Validation units, and counts per kind and format of everything that is not read."""
    wanted = F.col(kind).isin(kinds) & F.col(fmt).isin(formats)
    rest = inv.filter(~F.coalesce(wanted, F.lit(False))).groupBy(kind, fmt).agg(F.count("*").alias("n"))
    return inv.filter(wanted), rest


def check_inventory(inv: DataFrame, required: list[str], key: str, batch: str, formats: list[str], fmt: str,
                    path: str, roots: list[str]) -> DataFrame:
    """Reason codes per row: missing or duplicate id, second batch (no batch is one), bad format, relative or escaping path, outside roots."""
    missing = [c for c in required if c not in inv.columns]
    if missing:
        raise ValueError(f"inventory lacks columns {missing}")
    repeated = inv.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key, F.lit(True).alias("repeated"))
    inside = F.lit(False)
    for root in roots:
        inside = inside | F.col(path).startswith(root.rstrip("/") + "/")
    code = F.when
    reasons = F.array_compact(F.array(
        code(F.col(key).isNull(), "missing_id"),
        code(F.col("repeated"), "duplicate_id"),
        code(~F.col(batch).eqNullSafe(inv.agg(F.min(batch)).scalar()), "second_batch"),
        code(~F.coalesce(F.col(fmt).isin(formats), F.lit(False)), "bad_format"),
        code(~F.coalesce(F.col(path).startswith("/"), F.lit(False)), "relative_path"),
        code(F.col(path).rlike(r"(^|/)\.\.(/|$)"), "path_escape"),
        code(~F.coalesce(inside, F.lit(False)), "outside_roots"),
    ))
    return (
        skew_join(inv, repeated, [key]).withColumn("reasons", reasons).drop("repeated")
    )


def domain_rules(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Reason codes of row rules; all rules in one projection."""
    return df.withColumn("reasons", rules.reasons())


def visible_at(df: DataFrame, cutoff: Column, visible: str = "source_visible_at", collected: str = "collected_at") -> DataFrame:
    return df.filter((F.col(visible) <= cutoff) & (F.col(collected) <= cutoff))


def label_visibility(df: DataFrame, cutoff: Column, visible: str = "source_visible_at",
                     collected: str = "collected_at", strict: bool = False) -> DataFrame:
    """Keep every member; those past the cutoff are `time_boundary_rejected`, unknown clocks `undetermined`.

    `strict=True` is the older rule: the read fails on the first late member.
    """
    late = (F.col(visible) > cutoff) | (F.col(collected) > cutoff)
    label = F.when(late, "time_boundary_rejected").when(~late, "visible").otherwise("undetermined")
    if strict:
        label = F.when(late, F.raise_error(F.lit("member after the cutoff"))).otherwise(label)
    return df.withColumn("visibility", label)


def label_scope(df: DataFrame, symbols: list[str], symbol: str = "symbol") -> DataFrame:
    """Flag `in_scope`; rows of other or unknown symbols stay as history but are refused as new input."""
    return df.withColumn("in_scope", F.coalesce(F.col(symbol).isin(symbols), F.lit(False)))


def scope_filter(df: DataFrame, symbols: list[str], symbol: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Rows of allowed symbols, and the refused rest."""
    labelled = label_scope(df, symbols, symbol)
    return labelled.filter("in_scope").drop("in_scope"), labelled.filter("NOT in_scope").drop("in_scope")


def is_fresh(evidence: Column, observed: Column, max_age: str = "1 HOUR") -> Column:
    """Evidence is not after the observation and not older than `max_age`; unknown times are not fresh."""
    fresh = (evidence <= observed) & (observed - evidence <= F.expr(f"INTERVAL {max_age}"))
    return F.coalesce(fresh, F.lit(False))


def inside_segment(df: DataFrame, segments: DataFrame, by: list[str], day: str, lookback_days: int) -> DataFrame:
    """Whether the look-back window of each row lies in one continuous segment.

    Segments are exploded to their days, so the join is an equi-join on key and day.
    """
    days = segments.select(
        *by, F.col("seg_start"), F.explode(F.sequence("seg_start", "seg_end")).alias(day)
    )
    joined = skew_join(df, days, [*by, day])
    ok = F.date_sub(F.col(day), lookback_days) >= F.col("seg_start")
    return joined.withColumn("inside", F.coalesce(ok, F.lit(False))).drop("seg_start")


def project_allowed(df: DataFrame, allow: list[str]) -> DataFrame:
    """Only allowed columns leave; a wanted column that is absent is an error."""
    unknown = sorted(set(allow) - set(df.columns))
    if unknown:
        raise ValueError(f"columns not in the input: {unknown}")
    return df.select(*allow)


def check_scale(df: DataFrame, role: str, minutes: str) -> DataFrame:
    """15 m and 1 h are outcome windows only; states live on the main scales."""
    is_state, is_outcome = F.col(role) == "state", F.col(role) == "outcome"
    main = F.col(minutes).isin([h * 60 for h in STATE_SCALES_H])
    short = F.col(minutes).isin(OUTCOME_WINDOWS_M)
    verdict = (
        F.when(is_state & short, "reject_observation_window")
        .when(is_state & main, "accept").when(is_outcome & (main | short), "accept")
        .otherwise("reject_unknown_scale")
    )
    return df.withColumn("scale_verdict", verdict)
