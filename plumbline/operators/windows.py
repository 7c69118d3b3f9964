"""Order-aware audits on raw rows and on days.

Row-level audits use `plumbline.ordering`, so a key of any size is split; windows written
out here run on tables already reduced to one row per day or per member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.ordering import earlier, micros, ordinal, over_order, prior


def key_order(df: DataFrame, by: list[str], row_no: str, key: str, whole: bool = False) -> DataFrame:
    """The business key must rise strictly in physical order: ok / repeat / regression per row."""
    seen = prior(df, by, [F.col(row_no)], [key], "__before", whole)
    before = F.col("__before")[key]
    status = F.when(before.isNull(), "ok").when(F.col(key) == before, "repeat").when(F.col(key) < before, "regression")
    return seen.withColumn("key_status", status.otherwise("ok")).drop("__before")


def time_regression(df: DataFrame, by: list[str], row_no: str, ts: str, whole: bool = False) -> DataFrame:
    """Event time may repeat but may not go back in physical order."""
    seen = prior(df, by, [F.col(row_no)], [ts], "__before", whole)
    back = F.coalesce(F.col(ts) < F.col("__before")[ts], F.lit(False))
    return seen.withColumn("time_status", F.when(back, "regression").otherwise("ok")).drop("__before")


def boundary_conflicts(members: DataFrame, by: list[str], order: str, first_key: str, last_key: str) -> DataFrame:
    """The first key of a member must exceed every last key before it (one row per member)."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    highest = members.withColumn("highest_before", F.max(last_key).over(w))
    conflict = F.coalesce(F.col(first_key) <= F.col("highest_before"), F.lit(False))
    return highest.withColumn("boundary_status", F.when(conflict, "conflict").otherwise("ok"))


def latency_disorder(df: DataFrame, by: list[str], event: str, arrival: str, row_id: str,
                     whole: bool = False) -> DataFrame:
    """Arrival latency in seconds and inversions of arrival order; `undetermined` unless both times are known."""
    known = F.col(event).isNotNull() & F.col(arrival).isNotNull()
    seen = over_order(
        df, by, [micros(arrival), F.col(row_id)], {"__event": (F.when(known, micros(event)), "max")},
        {"__newest": lambda w: F.max("__event").over(earlier(w))}, whole,
    )
    inverted = F.coalesce(micros(event) < F.col("__newest"), F.lit(False))
    return seen.select(
        *df.columns, F.when(known, (micros(arrival) - micros(event)) / 1_000_000).alias("latency_s"),
        F.when(~known, "undetermined").when(inverted, "out_of_order").otherwise("in_order").alias("order_status"))


def segments(df: DataFrame, by: list[str], day: str, extra: list[Column] | None = None) -> DataFrame:
    """Runs of consecutive days per group. With `extra`, `df` already has one row per group and day."""
    days = df if extra else df.select(*by, F.to_date(day).alias(day)).distinct()
    w = W.partitionBy(*by).orderBy(day)
    run = days.withColumn("__run", F.date_sub(F.col(day), F.row_number().over(w)))
    return run.groupBy(*by, "__run").agg(
        F.min(day).alias("seg_start"), F.max(day).alias("seg_end"), F.count("*").alias("days"), *(extra or [])
    ).drop("__run")


def transition_audit(df: DataFrame, key: str, seq: str, state: str, edges: list[tuple[str, str]],
                     starts: list[str], whole: bool = False) -> DataFrame:
    """Each step against the allowed edges: start / ok / illegal_start / illegal."""
    seen = prior(df, [key], [F.col(seq)], [state], "__before", whole)
    before = F.col("__before")[state]
    legal = F.concat_ws(">", before, F.col(state)).isin([f"{a}>{b}" for a, b in edges])
    status = (
        F.when(F.col("__before").isNull(), F.when(F.col(state).isin(starts), "start").otherwise("illegal_start"))
        .when(legal & before.isNotNull(), "ok").otherwise("illegal")
    )
    return seen.select(*df.columns, before.alias("from_state"), status.alias("step_status"))


def timeline_audit(df: DataFrame, steps: list[str], visible: str | None = None) -> DataFrame:
    """Step times of one row must not fall and none may precede the visible bound; names the first bad step."""
    times = F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("at")) for s in steps])
    pairs = F.zip_with(F.slice(times, 1, len(steps) - 1), F.slice(times, 2, len(steps) - 1),
                       lambda a, b: F.when(b["at"] < a["at"], b["step"]))
    bad = F.get(F.array_compact(pairs), F.lit(0))
    known = F.forall(times, lambda t: t["at"].isNotNull())
    early = F.col(steps[0]) < F.col(visible) if visible else F.lit(False)
    status = F.when(~known, "unknown").when(early, "before_visible").when(bad.isNotNull(), "regression").otherwise("ok")
    return df.withColumn("bad_step", bad).withColumn("timeline_status", status)


def warm(df: DataFrame, by: list[str], order: list[Column], k: int, whole: bool = False) -> DataFrame:
    """A row is usable only after `k` rows of its own segment (`by` includes the segment)."""
    return ordinal(df, by, order, "segment_row", whole).withColumn("is_warm", F.col("segment_row") > k)


def current_declaration(df: DataFrame, key: list[str], version: str, payload: list[str],
                        revocations: DataFrame | None = None) -> DataFrame:
    """Latest version per key that no revocation fact names."""
    live = df if revocations is None else df.join(revocations.select(*key, version).distinct(), [*key, version], "left_anti")
    best = live.groupBy(*key).agg(F.max(F.struct(version, *payload)).alias("b"), F.count("*").alias("n_versions"))
    return best.select(*key, "b.*", "n_versions")


def declarations_as_of(df: DataFrame, key: list[str], version: str, payload: list[str], visible: str, revocations: DataFrame,
                       revoked: str, cutoffs: list[Column]) -> DataFrame:
    """Latest version per key and cutoff, by what was visible at the cutoff: versions seen by then, less those whose revocation was seen by then.

    A revocation that became visible later changes no earlier answer. `revocations` (key, version, `revoked`) may name a version more than once: the
    first visible one counts, and one of unknown time never does. A key without a live version at a cutoff has no row there.
    """
    first = revocations.groupBy(*key, version).agg(F.min(revoked).alias("__revoked"))
    known = df.join(first, [*key, version], "left").select(*key, version, *payload, F.col(visible).alias("__visible"), "__revoked", F.explode(F.array(*cutoffs)).alias("cutoff"))
    live = known.filter((F.col("__visible") <= F.col("cutoff")) & ~F.coalesce(F.col("__revoked") <= F.col("cutoff"), F.lit(False)))
    best = live.groupBy(*key, "cutoff").agg(F.max(F.struct(version, *payload)).alias("b"), F.count("*").alias("n_versions"))
    return best.select(*key, "cutoff", "b.*", "n_versions")


def revisions(df: DataFrame, key: list[str], seen: list[Column], content: Column,
              whole: bool = False) -> DataFrame:
    """Same key seen again: `repeat` with equal content, `revision` with other content; nothing is overwritten."""
    hashed = prior(df.withColumn("__content", content), key, seen, ["__content"], "__before", whole)
    before = F.col("__before")["__content"]
    kind = F.when(F.col("__before").isNull(), "first").when(before == F.col("__content"), "repeat").otherwise("revision")
    return hashed.withColumn("seen_as", kind).drop("__before", "__content")
