"""Evidence joins. Full outer joins reduce both sides to one row per key first, so no pair explosion can occur."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.ordering import micros, numbered, over_order, skew_join, upto


def _per_key(df: DataFrame, on: list[str], fields: list[str], tag: str) -> DataFrame:
    """One row per key: how often it occurs, and the field values (of interest only where it occurs once)."""
    return df.groupBy(*on).agg(F.count("*").alias(f"{tag}_n"), *[F.min(f).alias(f"{tag}_{f}") for f in fields])


def _present(tag: str) -> Column:
    return F.coalesce(F.col(f"{tag}_n"), F.lit(0))


def pair_files(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Archives against checksum files by name: paired, unpaired on either side, or not unique."""
    joined = _per_key(a, on, [], "left").join(_per_key(b, on, [], "right"), on, "full_outer")
    left, right = _present("left"), _present("right")
    status = (
        F.when(right == 0, "right_missing").when(left == 0, "left_missing")
        .when((left > 1) | (right > 1), "not_unique").otherwise("paired")
    )
    return joined.select(*on, left.alias("left_n"), right.alias("right_n"), status.alias("pair_status"))


def match_listing(local: DataFrame, listing: DataFrame, on: list[str], size: str, listed_size: str) -> DataFrame:
    """The key is listed and the byte size agrees. The listing is unique on `on`."""
    joined = skew_join(local, listing.select(*on, F.col(listed_size), F.lit(True).alias("listed")), on)
    status = F.when(F.col("listed").isNull(), "not_listed").when(
        F.col(size) == F.col(listed_size), "match").otherwise("size_mismatch")
    return joined.withColumn("listing_status", status).drop("listed")


def match_digest(a: DataFrame, b: DataFrame, on: list[str], computed: Column, declared: str) -> DataFrame:
    """Recomputed digest of `a` against the digest declared in `b` (unique on `on`)."""
    joined = skew_join(a.withColumn("computed", computed), b.select(*on, declared), on)
    status = F.when(F.col(declared).isNull(), "undeclared").when(
        F.col("computed") == F.col(declared), "match").otherwise("digest_mismatch")
    return joined.withColumn("digest_status", status)


def match_etag(files: DataFrame, listing: DataFrame, on: list[str], content: Column, etag: str) -> DataFrame:
    """MD5 of a file's bytes against the ETag of its listing (unique on `on`), quotes and case aside.

    An ETag of another form (`...-n` after an upload in parts) is no MD5 of the file: `undetermined`.
    """
    joined = skew_join(files.withColumn("computed", F.md5(content)), listing.select(*on, etag), on)
    plain = F.lower(F.regexp_replace(etag, '"', ""))
    status = F.when(plain.isNull(), "undeclared").when(~plain.rlike("^[0-9a-f]{32}$"), "undetermined").when(
        F.col("computed") == plain, "match").otherwise("etag_mismatch")
    return joined.withColumn("etag_status", status)


def classify_drift(frozen: DataFrame, current: DataFrame, key: list[str], raw: str, normalised: str,
                   in_scope: Column | None = None) -> DataFrame:
    """same / normalised_equal / changed / missing / new / not_unique / out_of_scope per key, by two content hashes."""
    joined = _per_key(frozen, key, [raw, normalised], "a").join(
        _per_key(current, key, [raw, normalised], "b"), key, "full_outer")

    def equal(f: str) -> Column:
        return F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}"))

    state = (
        F.when(_present("b") == 0, "missing").when(_present("a") == 0, "new")
        .when((_present("a") > 1) | (_present("b") > 1), "not_unique")
        .when(equal(raw), "same").when(equal(normalised), "normalised_equal").otherwise("changed")
    )
    if in_scope is not None:
        state = F.when(~F.coalesce(in_scope, F.lit(False)), "out_of_scope").otherwise(state)
    return joined.select(*key, state.alias("drift"))


def compare_schema(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Rows (table, column, type, position) on both sides -> one status per table.

    match / drift / not_found / undetermined (a declared fact is null); undeclared tables are `undeclared`.
    """
    both = (
        declared.select("table", "column", F.lit(1).alias("d"), F.col("type").alias("d_type"), F.col("position").alias("d_pos"))
        .join(observed.select("table", "column", F.lit(1).alias("o"), F.col("type").alias("o_type"),
                              F.col("position").alias("o_pos")), ["table", "column"], "full_outer")
    )
    unsure = F.col("d").isNotNull() & (F.col("d_type").isNull() | F.col("d_pos").isNull())
    differs = (
        F.col("d").isNull() | F.col("o").isNull()
        | (F.col("d_type") != F.col("o_type")) | (F.col("d_pos") != F.col("o_pos"))
    )
    per_table = both.groupBy("table").agg(
        F.count("d").alias("declared_n"), F.count("o").alias("observed_n"),
        F.count_if(unsure).alias("unsure"), F.count_if(F.coalesce(differs, F.lit(False))).alias("differing"),
    )
    status = (
        F.when(F.col("declared_n") == 0, "undeclared").when(F.col("observed_n") == 0, "not_found")
        .when(F.col("unsure") > 0, "undetermined").when(F.col("differing") > 0, "drift").otherwise("match")
    )
    return per_table.select("table", "declared_n", "observed_n", "differing", status.alias("schema_status"))


def cover_all(units: DataFrame, results: DataFrame, on: list[str], result: str, default: str = "not_executed") -> DataFrame:
    """Every unit keeps exactly one result; units without one get an explicit reason. Results are unique on `on`."""
    return skew_join(units, results.select(*on, result), on).withColumn(result, F.coalesce(F.col(result), F.lit(default)))


def bind_evidence(records: DataFrame, bindings: DataFrame, key: str, shared: list[str]) -> DataFrame:
    """One record to one binding, equal (null-safe) on every shared field; otherwise a reason per id."""
    joined = _per_key(records, [key], shared, "r").join(_per_key(bindings, [key], shared, "b"), [key], "full_outer")
    equal = reduce(lambda x, y: x & y, [F.col(f"r_{f}").eqNullSafe(F.col(f"b_{f}")) for f in shared])
    status = (
        F.when(_present("r") == 0, "record_missing").when(_present("b") == 0, "binding_missing")
        .when((_present("r") > 1) | (_present("b") > 1), "not_unique")
        .when(equal, "bound").otherwise("field_conflict")
    )
    return joined.select(key, status.alias("binding_status"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, right_id: str,
              cols: list[str], visible_ts: str | None = None, tolerance: str | None = None,
              whole: bool = False) -> DataFrame:
    """Last right row whose event and visible time are both known and not after the left row.

    Both sides go through one shuffle as one ordered sequence: a right row stands at
    the moment it becomes usable, before left rows of the same moment. The greatest
    event time wins, so an old row that arrives late displaces nothing.
    Adds struct `matched` (event, right id, `cols`).
    """
    visible = F.col(visible_ts) if visible_ts else F.col(right_ts)
    usable = F.greatest(micros(right_ts), micros(visible))
    known = F.col(right_ts).isNotNull() & visible.isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    candidate = F.struct(F.col(right_ts).alias("event"), F.col(right_id).alias("id"), *[F.col(c) for c in cols])
    sources = right.filter(known).select(*by, usable.alias("__at"), F.lit(0).alias("__side"), candidate.alias("__cand"))
    targets = left.withColumn("__at", micros(left_ts)).withColumn("__side", F.lit(1))
    merged = over_order(
        targets.unionByName(sources, allowMissingColumns=True), by, [F.col("__at"), F.col("__side")],
        {"__best": (F.col("__cand"), "max")}, {"matched": lambda w: F.max("__best").over(upto(w))}, whole,
    )
    found = F.col("matched")
    fits = F.col("__at").isNotNull()
    if tolerance:
        fits = fits & (F.col(left_ts) - found["event"] <= F.expr(f"INTERVAL {tolerance}"))
    return merged.filter("__side = 1").select(*left.columns, F.when(fits, found).alias("matched"))


def forward_outcome(df: DataFrame, by: list[str], ts: str, row_id: str, value: str,
                    horizons_minutes: list[int], whole: bool = False) -> DataFrame:
    """First value at or after t + h inside the same `by` group, one row per input row and horizon.

    Put the segment into `by` to keep outcomes from crossing a gap: beyond the last row of
    the segment the outcome is null. The sequence is read backwards, so the running minimum
    is the next row; horizons multiply rows by a fixed list, not by pairs.
    """
    rows = df.select(*by, row_id, ts, micros(ts).alias("__at"), F.col(value).alias("base"))
    asks = rows.select(
        "*", F.explode(F.array(*[F.lit(h) for h in horizons_minutes])).alias("horizon_min"), F.lit(1).alias("__side")
    ).withColumn("__at", F.col("__at") + F.col("horizon_min").cast("bigint") * 60_000_000)
    answers = rows.select(
        *by, "__at", F.lit(0).alias("__side"),
        F.struct(F.col(ts).alias("ts"), F.col(row_id).alias("id"), F.col("base").alias("value")).alias("__cand"),
    )
    merged = over_order(
        asks.unionByName(answers, allowMissingColumns=True), by, [-F.col("__at"), F.col("__side")],
        {"__next": (F.col("__cand"), "min")}, {"__hit": lambda w: F.min("__next").over(upto(w))}, whole,
    )
    return merged.filter("__side = 1").select(
        *by, row_id, ts, "base", "horizon_min",
        F.col("__hit")["ts"].alias("outcome_ts"), F.col("__hit")["value"].alias("outcome"),
    )


def phase_conflict(schema_phase: DataFrame, content_phase: DataFrame, key: list[str], identity: list[str]) -> DataFrame:
    """Content rows whose identity differs from the schema phase are `version_conflict` and unusable.

    The schema phase is unique on `key`.
    """
    frozen = schema_phase.select(*key, F.struct(*identity).alias("__frozen"))
    joined = skew_join(content_phase, frozen, key)
    same = F.col("__frozen").eqNullSafe(F.struct(*identity))
    return joined.withColumn("phase_status", F.when(same, "usable").otherwise("version_conflict")).drop("__frozen")


def reconcile_one_to_one(a: DataFrame, b: DataFrame, key: list[str], attr_a: str, attr_b: str) -> DataFrame:
    """Each key once on each side with agreeing attribute; otherwise the reason."""
    joined = _per_key(a, key, [attr_a], "a").join(_per_key(b, key, [attr_b], "b"), key, "full_outer")
    status = (
        F.when(_present("b") == 0, "missing_right").when(_present("a") == 0, "missing_left")
        .when((_present("a") > 1) | (_present("b") > 1), "duplicate")
        .when(F.col(f"a_{attr_a}").eqNullSafe(F.col(f"b_{attr_b}")), "ok").otherwise("wrong_section")
    )
    return joined.select(*key, _present("a").alias("left_n"), _present("b").alias("right_n"), status.alias("reconciled"))


def adopt(candidates: DataFrame, proven: DataFrame, on: list[str]) -> DataFrame:
    """Candidates with flag `adopted`: true where a proven, identical re-verification exists; the others stay counted."""
    keys = proven.select(*on).distinct().withColumn("adopted", F.lit(True))
    return skew_join(candidates, keys, on).withColumn("adopted", F.coalesce("adopted", F.lit(False)))


def with_grid(df: DataFrame, **axes: list) -> DataFrame:
    """Each row times every combination of the given literal lists (an explode per axis, no join)."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def leaf_grid(symbols: DataFrame, scales: list[int], scale: str = "scale_h") -> DataFrame:
    return with_grid(symbols.distinct(), **{scale: scales})


def scenario_grid(members: DataFrame, sides: list[str], kinds: list[str], clocks: list[str]) -> DataFrame:
    return with_grid(members, side=sides, kind=kinds, clock=clocks)


def missing_days(df: DataFrame, by: list[str], day: str) -> DataFrame:
    """Calendar days between the first and last day of a group on which the group has no row.

    Rows are reduced to their distinct days first; the hole after a day is read off the next
    day, so the calendar is never joined.
    """
    days = df.select(*by, F.to_date(day).alias("__day")).distinct()
    following = F.lead("__day").over(W.partitionBy(*by).orderBy("__day"))
    holes = days.select(*by, "__day", following.alias("__next")).filter(F.datediff("__next", "__day") > 1)
    return holes.select(*by, F.explode(F.sequence(F.date_add("__day", 1), F.date_sub("__next", 1))).alias("day"))


#: Bar numbers that one row of an event stands for before it is spread out: no array is longer, however long the window.
SPAN = 4096


def event_window_join(events: DataFrame, bars: DataFrame, by: list[str], event_ts: str, bar_ts: str,
                      pre_minutes: int, post_minutes: int) -> DataFrame:
    """Bars in [event - pre, event + post], without candidate pairs: work is events plus bars plus rows of the result.

    Bars are numbered by time within their key. Running counts at both ends of a window say which numbers lie in it, and the
    event meets exactly these by an equi-join on (key, number), where each number is one bar. Crowds of events or bars at one
    moment that lie outside each other's windows never meet. Rows without key or time are in no window.
    """
    at = F.col("__at")
    placed = numbered(bars.filter(F.col(bar_ts).isNotNull()), by, [micros(bar_ts)], "__no")
    points = placed.select(*by, micros(bar_ts).alias("__at"), F.lit(1).alias("__side"))

    def bars_until(rows: DataFrame, minutes: int, side: int, name: str) -> DataFrame:
        # At equal times the lower end sorts before the bars and the upper end after them.
        ends = rows.withColumn("__at", micros(event_ts) + minutes * 60_000_000).withColumn("__side", F.lit(side))
        merged = over_order(
            ends.unionByName(points, allowMissingColumns=True), by, [at, F.col("__side")],
            {"__one": ((F.col("__side") == 1).cast("bigint"), "sum")}, {name: lambda w: F.sum("__one").over(upto(w))})
        return merged.filter("__side <> 1").drop("__at", "__side")

    known = events.filter(F.col(event_ts).isNotNull())
    ranged = bars_until(bars_until(known, -pre_minutes, 0, "__from"), post_minutes, 2, "__to").filter("__to > __from")
    spans = ranged.withColumn("__span", F.explode(F.sequence(F.floor(F.col("__from") / SPAN), F.floor((F.col("__to") - 1) / SPAN))))
    first, last = F.greatest("__from", F.col("__span") * SPAN), F.least(F.col("__to"), (F.col("__span") + 1) * SPAN) - 1
    wanted = spans.withColumn("__no", F.explode(F.sequence(first, last))).drop("__from", "__to", "__span")
    return skew_join(wanted, placed, [*by, "__no"], "inner").drop("__no")


def event_window_totals(events: DataFrame, rows: DataFrame, by: list[str], event_ts: str, event_id: str,
                        row_ts: str, amount: Column, pre_minutes: int, post_minutes: int,
                        whole: bool = False) -> DataFrame:
    """Rows and sum of `amount` in [event - pre, event + post] without forming pairs.

    Running totals are read at both ends of each window; their difference is the window.
    """
    def end(minutes: int, side: int, sign: int) -> Column:
        return F.struct((micros(event_ts) + minutes * 60_000_000).alias("__at"), F.lit(side).alias("__side"), F.lit(sign).alias("__sign"))

    # At equal times the lower end sorts before the rows and the upper end after them.
    ends = events.select(*by, event_id, F.inline(F.array(end(-pre_minutes, 0, -1), end(post_minutes, 2, 1))))
    points = rows.select(*by, micros(row_ts).alias("__at"), F.lit(1).alias("__side"), amount.alias("__m"))
    merged = over_order(
        ends.unionByName(points, allowMissingColumns=True), by, [F.col("__at"), F.col("__side")],
        {"__cnt": ((F.col("__side") == 1).cast("bigint"), "sum"), "__sum": (F.col("__m"), "sum")},
        {"__run_n": lambda w: F.sum("__cnt").over(upto(w)), "__run_sum": lambda w: F.sum("__sum").over(upto(w))}, whole,
    )
    return merged.filter("__side <> 1").groupBy(*by, event_id).agg(
        F.sum(F.col("__sign") * F.col("__run_n")).alias("rows_in_window"),
        F.sum(F.col("__sign") * F.coalesce(F.col("__run_sum"), F.lit(0))).alias("sum_in_window"),
    )


def resolve_aliases(columns: DataFrame, aliases: dict[str, list[str]], table: str = "table", column: str = "column") -> DataFrame:
    """Logical field per table: exactly one physical column each way, else the reason it fails.

    Aliases are disjoint by contract, so a column can match one field only.
    """
    seen: set[str] = set()
    for names in aliases.values():
        if seen & set(names):
            raise ValueError(f"alias used twice: {sorted(seen & set(names))}")
        seen |= set(names)
    pairs = [F.when(F.col(column).isin(names), F.lit(field)) for field, names in aliases.items()]
    matched = columns.withColumn("field", F.coalesce(*pairs)).filter(F.col("field").isNotNull())
    found = matched.groupBy(table, "field").agg(F.count("*").alias("n"), F.min(column).alias("first_column"))
    wanted = with_grid(columns.select(table).distinct(), field=list(aliases))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "multiple").otherwise("resolved")
    return wanted.join(found, [table, "field"], "left").select(
        table, "field", F.when(F.col("n") == 1, F.col("first_column")).alias("resolved_column"), status.alias("alias_status"))
