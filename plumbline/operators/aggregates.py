"""Profiles, counts, verdict roll-ups and fingerprints. Everything combines map-side before a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import COST_COMPONENTS, STATUSES
from plumbline.functions.scalars import record_sha
from plumbline.functions.verdicts import status_rank
from plumbline.rules import RuleSet


def profile(df: DataFrame, cols: list[str] | None = None, rules: RuleSet | None = None) -> DataFrame:
    """Rows, nulls, blanks and non-finite values of every column in one pass, one output row per column.

    With `rules`, the same pass counts the rows that break each rule (array `broken`, equal on every row).
    """
    cols = cols or df.columns
    kinds = {f.name: f.dataType for f in df.schema}
    facts = []
    for c in cols:
        text = isinstance(kinds[c], T.StringType)
        real = isinstance(kinds[c], (T.DoubleType, T.FloatType))
        blank = F.count_if(F.trim(F.col(c)) == "") if text else F.lit(0).cast("bigint")
        odd = F.count_if(F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))) if real else F.lit(0).cast("bigint")
        facts.append(F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c].simpleString()).alias("type"), F.count("*").alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("n_null"), blank.alias("n_blank"), odd.alias("n_non_finite"),
        ).alias(c))
    per_column = F.inline(F.array(*[F.col(f"`{c}`") for c in cols]))
    if rules is None:
        return df.agg(*facts).select(per_column)
    broken = F.array(*[F.struct(F.lit(r.reason).alias("anomaly"), F.count_if(r.broken()).alias("n")) for r in rules.rules])
    return df.agg(*facts, broken.alias("broken")).select("broken", per_column)


def record_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Whole records that occur more than once, by fingerprint (not a business key)."""
    return df.groupBy(record_sha(cols or df.columns).alias("record_sha")).agg(
        F.count("*").alias("copies")).filter("copies > 1")


def duplicate_verdict(df: DataFrame, by: list[str], fingerprint: Column) -> DataFrame:
    """Duplicate rows per group and whether there are any, at every size."""
    per_record = df.groupBy(*by, fingerprint.alias("__f")).agg(F.count("*").alias("__n"))
    totals = per_record.groupBy(*by).agg(
        F.sum("__n").alias("n_rows"), F.sum(F.col("__n") - 1).alias("n_duplicate"))
    verdict = F.when(F.col("n_duplicate") > 0, "duplicates").otherwise("unique")
    return totals.withColumn("duplicate_verdict", verdict)


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def reason_counts(df: DataFrame, by: list[str], reasons: str = "reasons") -> DataFrame:
    """Rows per group and reason code."""
    return df.select(*by, F.explode(reasons).alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("n"))


def worst_status(df: DataFrame, by: list[str], status: str, order: list[str] = STATUSES) -> DataFrame:
    """One final status per group: the worst by the fixed order. Also the ceiling of a roll-up."""
    names = F.array(*[F.lit(s) for s in order])
    low = F.min(status_rank(status, order))
    return df.groupBy(*by).agg(F.get(names, low).alias(status), F.count("*").alias("n_units"))


member_status = worst_status


def rollup_floor(df: DataFrame, levels: list[str], status: str, order: list[str]) -> DataFrame:
    """Status per unit and per higher level; a summary never exceeds its lowest unit.

    Units are reduced before the roll-up, which would otherwise copy every input row per level.
    """
    names = F.array(*[F.lit(s) for s in order])
    units = df.groupBy(*levels).agg(F.min(status_rank(status, order)).alias("__rank"))
    return units.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level"), F.get(names, F.min("__rank")).alias("floor_status"))


def conservation(df: DataFrame, by: list[str], status: str, states: list[str]) -> DataFrame:
    """Population, sum over the declared states, and their difference per group."""
    counted = F.count_if(F.col(status).isin(states))
    return df.groupBy(*by).agg(
        F.count("*").alias("population"), counted.alias("in_states"), (F.count("*") - counted).alias("difference"))


def assert_conserved(df: DataFrame, by: list[str], status: str, states: list[str]) -> DataFrame:
    """Groups whose states do not add up; empty when the population is conserved."""
    return conservation(df, by, status, states).filter("difference <> 0")


def denominators(df: DataFrame, dims: list[str], formal: Column, rejected: Column) -> DataFrame:
    """Formal, rejected and total counts for every level of the dimensions, with grouping id.

    The finest counts are taken first; only they are copied per level.
    """
    finest = df.groupBy(*dims).agg(
        F.count("*").alias("__t"), F.count_if(formal).alias("__f"), F.count_if(rejected).alias("__r"))
    return finest.rollup(*dims).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("__t").alias("total"),
        F.sum("__f").alias("formal"), F.sum("__r").alias("rejected"))


def coverage_record(df: DataFrame, by: list[str], ts: str, version: str = "1", totals: dict[str, Column] | None = None) -> DataFrame:
    """Bounds, rows, covered and missing days, segments and research flag per group.

    One pass: rows are reduced to days (together with `totals`, sums of further measures),
    and the window sees at most one row per calendar day.
    """
    from plumbline.operators.windows import segments

    totals = totals or {}
    sums = ["n", *totals]
    daily = df.groupBy(*by, F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"), *[F.sum(c).alias(name) for name, c in totals.items()])
    seg = segments(daily, by, "day", extra=[*[F.sum(c).alias(c) for c in sums], F.min("lo").alias("lo"), F.max("hi").alias("hi")])
    covered = F.sum("days")
    span = F.datediff(F.max("seg_end"), F.min("seg_start")) + 1
    return seg.groupBy(*by).agg(
        F.lit(version).alias("version"), F.min("lo").alias("first_ts"), F.max("hi").alias("last_ts"),
        F.sum("n").alias("n_rows"), covered.alias("days_covered"), (span - covered).alias("days_missing"),
        F.count("*").alias("n_segments"), F.max("days").alias("longest_segment"),
        (span == covered).alias("research_ready"), *[F.sum(c).alias(c) for c in totals])


def leaf_verdict(gates: DataFrame, leaves: DataFrame, leaf: list[str], required: list[str],
                 gate: str = "gate", state: str = "state") -> DataFrame:
    """A leaf passes only if every required gate passes; an absent gate row counts as unknown.

    `first_gate` is the first gate in the required order that does not pass.
    """
    positions = F.lit(len(required))
    for i, g in reversed(list(enumerate(required))):
        positions = F.when(F.col(gate) == g, i).otherwise(positions)
    seen = gates.filter(F.col(gate).isin(required)).groupBy(*leaf, gate).agg(
        F.min((F.col(state) == "pass").cast("int")).alias("__ok"))
    per_leaf = seen.groupBy(*leaf).agg(
        F.sum(F.coalesce(F.col("__ok"), F.lit(0))).alias("passed"),
        F.array_sort(F.collect_set(F.when(F.col("__ok") == 1, positions))).alias("__passed_at"))  # at most one per gate
    wanted = F.array(*[F.lit(i) for i in range(len(required))])
    joined = leaves.select(*leaf).distinct().join(per_leaf, leaf, "left")
    passed = F.coalesce(F.col("passed"), F.lit(0)).cast("bigint")
    missing = F.array_min(F.array_except(wanted, F.coalesce(F.col("__passed_at"), F.array().cast("array<int>"))))
    names = F.array(*[F.lit(g) for g in required])
    return joined.select(
        *leaf, passed.alias("gates_passed"), F.when(passed == len(required), "pass").otherwise("blocked").alias("verdict"),
        F.get(names, missing).alias("first_gate"))


def remaining_gap(gates: DataFrame, leaf: list[str], reason: str = "reason", release: str = "release") -> DataFrame:
    """Unmet gates by reason and release condition; the largest group (then the first name) is next."""
    unmet = gates.filter(F.col("state") != "pass").groupBy(reason, release).agg(
        F.count("*").alias("n_gates"), F.count_distinct(*leaf).alias("n_leaves"))
    return unmet.orderBy(F.desc("n_gates"), reason, release).limit(1)


def fingerprint_sums(df: DataFrame, cols: list[str], by: list[str], only: Column | None = None) -> DataFrame:
    """Order-free fingerprint of each group's rows as a multiset; rows outside `only` are counted but not hashed.

    Of each row's digest 180 bits are cut into nine words of 20 and each word is summed apart; the number of rows with
    the nine sums is hashed once. The state of a group is ten whole numbers, which hold 8 * 10^12 rows, so all but one row
    per task and group is combined before the shuffle, and copies weigh as often as they occur. It tells changed data from
    unchanged; it is no proof against someone who searches for rows of equal sums.
    """
    digest = record_sha(cols) if only is None else F.when(only, record_sha(cols))
    rows = df.select(*by, digest.alias("__sha"))
    rows = rows.select(*by, *[F.conv(F.substring("__sha", at, 15), 16, 10).cast("bigint").alias(f"__w{at}") for at in (1, 16, 31)])
    words = [F.shiftright(f"__w{at}", down).bitwiseAND(F.lit(0xFFFFF)) for at in (1, 16, 31) for down in (0, 20, 40)]
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count("__w1").alias("__n"), *[F.coalesce(F.sum(w), F.lit(0)).alias(f"__s{i}") for i, w in enumerate(words)])
    parts = [F.col(c).cast("string") for c in ("__n", *[f"__s{i}" for i in range(len(words))])]
    return sums.select(*by, "n_rows", F.sha2(F.concat_ws(":", *parts), 256).alias("fingerprint"))


def set_fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fingerprint of the whole set: equal for equal multisets, whatever the partitioning."""
    return fingerprint_sums(df, cols or df.columns, [])


def table_coverage(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_rows"))


def terminal_counts(df: DataFrame, by: list[str], state: str, states: list[str]) -> DataFrame:
    """One column per terminal state."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(state) == s).alias(f"n_{s}") for s in states], F.count("*").alias("n_all"))


def session_stats(bars: DataFrame, by: list[str], hit: Column, ret: Column) -> DataFrame:
    """Hit rate and volatility per group, with the sample behind each."""
    return bars.groupBy(*by).agg(
        F.count("*").alias("n_bars"), F.count(hit).alias("n_known"), F.avg(hit.cast("double")).alias("hit_rate"),
        F.stddev_samp(ret).alias("volatility"))


def merge_conflicts(df: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Identical rows of a key merge; a field that differs becomes null and is named in `conflicts`.

    Compares lowest, highest and known values, so it needs no distinct and no input order.
    """
    facts = [F.count("*").alias("n_merged")]
    for f in fields:
        facts += [F.min(f).alias(f"__lo_{f}"), F.max(f).alias(f"__hi_{f}"), F.count(f).alias(f"__k_{f}")]
    merged = df.groupBy(*key).agg(*facts)

    def clash(f: str) -> Column:
        return (F.col(f"__k_{f}") > 0) & ((F.col(f"__lo_{f}") != F.col(f"__hi_{f}")) | (F.col(f"__k_{f}") < F.col("n_merged")))

    named = F.array_compact(F.array(*[F.when(clash(f), F.lit(f)) for f in fields]))
    return merged.select(
        *key, "n_merged", *[F.when(~clash(f), F.col(f"__lo_{f}")).alias(f) for f in fields],
        F.concat_ws(",", named).alias("conflicts"),
        F.when(F.size(named) > 0, "metadata_conflict").otherwise("merged").alias("merge_status"))


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that do not occur exactly once; empty when the assertion holds."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n <> 1")


def bar_columns(price: str = "price", qty: str = "qty", maker: str = "buyer_maker", row_id: str = "trade_id") -> list[Column]:
    """Aggregates of a bar. A buyer that is the maker means the taker sold.

    First and last trade go by the business key, which rises with time in proven rows; one
    integer as order keeps the aggregation in hash tables (a struct would force a sort).
    """
    return [
        F.min_by(price, row_id).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, row_id).alias("close"),
        F.sum(qty).alias("volume"), F.sum(F.when(~F.col(maker), F.col(qty)).otherwise(0)).alias("taker_buy"),
        F.sum(F.when(F.col(maker), F.col(qty)).otherwise(0)).alias("taker_sell"), F.count("*").alias("n_trades"),
    ]


def ohlcv(ticks: DataFrame, width: str, by: list[str] | None = None, ts: str = "ts", **names: str) -> DataFrame:
    """Open, high, low, close, volume and taker sides per key and bar of `width` (for example `1 hour`)."""
    by = by or ["symbol"]
    bars = ticks.groupBy(*by, F.window(ts, width).alias("__w")).agg(*bar_columns(**names))
    return bars.select(*by, F.col("__w")["start"].alias("bar_ts"), *[c for c in bars.columns if c not in (*by, "__w")])


def hit_rate(df: DataFrame, state: list[str], outcome: Column) -> DataFrame:
    """Share of true outcomes by state, with denominator and unknowns; descriptive only."""
    known = F.count(outcome)
    return df.groupBy(*state).agg(
        F.count("*").alias("n"), known.alias("denominator"), F.count_if(outcome.isNull()).alias("n_unknown"),
        F.count_if(outcome).alias("n_hit"), F.avg(outcome.cast("double")).alias("rate"))


def cost_coverage(df: DataFrame, grid: DataFrame, by: list[str], components: list[str] = COST_COMPONENTS) -> DataFrame:
    """Each component of each cell is covered only by its own rows; components never stand in for one another."""
    counts = df.groupBy(*by).agg(*[F.count(c).alias(f"n_{c}") for c in components], F.count("*").alias("n_rows"))
    joined = grid.select(*by).distinct().join(counts, by, "left")
    rows = F.coalesce(F.col("n_rows"), F.lit(0))
    cells = F.array(*[F.struct(F.lit(c).alias("component"), F.coalesce(F.col(f"n_{c}"), F.lit(0)).alias("n_covered")) for c in components])
    long = joined.select(*by, rows.alias("n_rows"), F.inline(cells))
    state = F.when((F.col("n_rows") > 0) & (F.col("n_covered") == F.col("n_rows")), "covered").otherwise("missing")
    return long.withColumn("cost_state", state)
