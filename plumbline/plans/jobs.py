"""Composite jobs: each one public function built from the operators."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from plumbline.contracts import CLOCKS, LIFECYCLE_EDGES, ORDER_KINDS, PERMISSION_GATES, SIDES
from plumbline.functions import book, scalars, verdicts
from plumbline.operators import aggregates, features, filters, joins, ranking, sets, windows
from plumbline.ordering import over_order
from plumbline.rules import RuleSet
from plumbline.session import fresh_folder, materialise
from plumbline.sources import catalog, sinks


# ---- K01 ----
@dataclass(frozen=True)
class UnitContract:
    """What is declared about one unit: its rules, and its day column when the frequency is daily."""

    rules: RuleSet
    day: str | None = None
    critical_rule: str | None = None


@dataclass(frozen=True)
class Audit:
    quality: DataFrame
    gaps: DataFrame
    anomalies: DataFrame


def _unit_facts(name: str, df: DataFrame, contract: UnitContract) -> DataFrame:
    """One row with everything the content of a unit says, from one scan of it.

    Records are reduced to one row per digest with what is wrong in them, these to one row per day (a single one where no day is
    declared), and days to the unit, so that copies, counts and missing days come from the same reading. A unit without rows
    has zeros and no missing day.
    """
    def tally(hits: list[Column]) -> Column:
        return reduce(lambda x, y: x + y, [F.coalesce(h, F.lit(False)).cast("bigint") for h in hits], F.lit(0).cast("bigint"))

    cells = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    texts, reals = ([c for c, kind in cells if isinstance(kind, kinds)] for kinds in (T.StringType, (T.DoubleType, T.FloatType)))
    counts = {
        "n_null": tally([c.isNull() for c, _ in cells]), "n_blank": tally([F.trim(c) == "" for c in texts]),
        "n_non_finite": tally([F.isnan(c) | c.isin(float("inf"), float("-inf")) for c in reals]),
        **{f"broken_{i}": r.broken().cast("bigint") for i, r in enumerate(contract.rules.rules)}}
    day = F.to_date(contract.day) if contract.day else F.lit(None).cast("date")
    rows = df.select(scalars.record_sha([f"`{c}`" for c in df.columns]).alias("sha"), day.alias("day"), *[c.alias(k) for k, c in counts.items()])
    per_record = rows.groupBy("sha", "day").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in counts])
    per_day = per_record.groupBy("day").agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_duplicate"), *[F.sum(k).alias(k) for k in counts])
    whole = per_day.agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n_rows", "n_duplicate", *counts)],
        F.coalesce(F.datediff(F.max("day"), F.min("day")) + 1 - F.count("day"), F.lit(0)).cast("bigint").alias("n_missing"))
    broken = F.array(*[F.struct(F.lit(r.reason).alias("anomaly"), F.col(f"broken_{i}").alias("n")) for i, r in enumerate(contract.rules.rules)])
    duplicate = F.struct("n_duplicate", F.when(F.col("n_duplicate") > 0, "duplicates").otherwise("unique").alias("duplicate_verdict"))
    return whole.select(
        F.lit(name).alias("asset_id"), "n_rows", "n_null", "n_blank", "n_non_finite", broken.cast("array<struct<anomaly:string,n:bigint>>").alias("broken"),
        duplicate.alias("copies"), F.lit("measured" if contract.day else "undetermined").alias("gap_status"),
        (F.col("n_missing") if contract.day else F.lit(None).cast("bigint")).alias("n_missing_days"), F.lit(contract.rules.sha).alias("rule_sha"))


def audit_inventory(spark: SparkSession, units: DataFrame, frames: dict[str, DataFrame],
                    contracts: dict[str, UnitContract]) -> Audit:
    """Two-phase audit: schemas and frozen rules first, then the content of each unit, stored as one row per unit.

    `units` holds `asset_id`; every unit appears in all three outputs, with `not_executed` where no content could be read.
    Each unit is one scan and one job, which appends its row to a facts table in the shared folder; no plan grows with the
    number of units.
    """
    schema = [(name, f.name, f.dataType.simpleString()) for name, df in frames.items() for f in df.schema]
    columns = spark.createDataFrame(schema, "table string, column string, type string")
    times = catalog.time_candidates(columns).groupBy(F.col("table").alias("asset_id")).agg(F.count("*").alias("time_candidates"))
    path = fresh_folder(spark, "unit-facts")
    kind = _unit_facts("", spark.createDataFrame([], "x int"), UnitContract(RuleSet.freeze([]))).schema
    for name, df in frames.items():
        _unit_facts(name, df, contracts[name]).write.mode("append").parquet(path)
    facts = spark.read.schema(kind).parquet(path) if frames else spark.createDataFrame([], kind)
    found = units.select("asset_id").distinct().join(facts, "asset_id", "left")

    critical = [c.critical_rule for c in contracts.values() if c.critical_rule]
    failed = F.exists("broken", lambda b: b["anomaly"].isin(critical) & (b["n"] > 0))
    # The evidence of a unit is complete only with a measured gap.
    verdict_of_copies = F.col("copies")["duplicate_verdict"]
    open_evidence = F.col("n_rows").isNull() | (F.col("gap_status") != "measured")
    verdict = verdicts.availability(failed, open_evidence, F.col("n_null") + F.col("n_blank") > 0, F.lit(False), F.lit(False))
    scanned = F.when(F.col("n_rows").isNull(), "not_executed").otherwise("scanned")
    structure = F.array(F.struct(F.lit("blank_field").alias("anomaly"), F.col("n_blank").alias("n")),
                        F.struct(F.lit("non_finite").alias("anomaly"), F.col("n_non_finite").alias("n")))
    nothing = F.array(F.struct(F.lit("not_executed").alias("anomaly"), F.lit(None).cast("bigint").alias("n")))
    listed = F.when(F.col("n_rows").isNull(), nothing).otherwise(F.concat(structure, F.filter("broken", lambda b: b["n"] > 0)))
    return Audit(
        found.join(times, "asset_id", "left").select(
            "asset_id", scanned.alias("scan_status"), "n_rows", "n_null", "n_blank", "n_non_finite", F.col("copies")["n_duplicate"].alias("n_duplicate"),
            verdict_of_copies.alias("duplicate_verdict"), F.coalesce("time_candidates", F.lit(0)).alias("time_candidates"), "rule_sha",
            verdict.alias("availability")),
        found.select("asset_id", F.coalesce("gap_status", F.lit("not_executed")).alias("gap_status"), "n_missing_days"),
        found.select("asset_id", F.inline(listed)),
    )


# ---- K02 ----
def prove_members(archives: DataFrame, checksums: DataFrame, listing: DataFrame, identity: Column) -> DataFrame:
    """Final provenance status per archive name.

    archives(name, size, sha256, identity fields...), checksums(name, line), listing(name, listed_size).
    Each side is reduced to one row per name, so the joins share one partitioning and cannot multiply rows.
    """
    held = archives.groupBy("name").agg(
        F.count("*").alias("n_archive"), F.min("size").alias("size"), F.min("sha256").alias("sha256"), F.min(identity).alias("identity"))
    parsed = scalars.parse_checksum("line")
    declared = checksums.groupBy("name").agg(
        F.count("*").alias("n_checksum"), F.min(parsed["sha256"]).alias("declared_sha"), F.min(parsed["name"]).alias("declared_name"))
    listed = listing.groupBy("name").agg(F.count("*").alias("n_listed"), F.min("listed_size").alias("listed_size"))
    all_three = held.join(declared, "name", "full_outer").join(listed, "name", "left")
    reason = (
        F.when(F.col("n_archive").isNull(), "archive_missing").when(F.col("n_checksum").isNull(), "checksum_missing")
        .when((F.col("n_archive") > 1) | (F.col("n_checksum") > 1) | (F.coalesce("n_listed", F.lit(0)) > 1), "not_unique")
        .when(F.col("declared_sha").isNull(), "checksum_malformed").when(F.col("declared_name") != F.col("name"), "checksum_name_mismatch")
        .when(F.col("declared_sha") != F.col("sha256"), "digest_mismatch").when(F.col("n_listed").isNull(), "not_listed")
        .when(F.col("listed_size") != F.col("size"), "size_mismatch").when(F.col("identity") != "proven", "identity_open")
    )
    status = (
        F.when(F.col("reason").isNull(), "proven")
        .when(F.col("reason").isin("checksum_missing", "archive_missing", "not_listed", "identity_open"), "undetermined").otherwise("rejected")
    )
    return all_three.select("name", reason.alias("reason")).withColumn("status", status)


# ---- K03 ----
@dataclass(frozen=True)
class Scan:
    members: DataFrame
    segments: DataFrame
    missing: DataFrame


def scan_rows(rows: DataFrame, group: list[str], day: str, row_no: str, key: str, ts: str, rules: RuleSet,
              before: str | None = None, failed: Column | None = None, unit: list[str] | None = None) -> Scan:
    """Row audit in one ordered pass per member, then boundaries, segments and missing days on the members.

    `before` names a struct(k, t) of the row before, where the reader knew the physical order
    (archives): then the rows are neither shuffled nor sorted, only counted per member.

    `failed` marks rows that say that their member could not be read to its end: they are not counted as rows, all that
    was read of it is `failed` with it and its keys bound no other member. `unit` names what fails together: by default
    `group`, on every day; `[*group, day]` where the day is the member's own, from its name.

    Order checks stay inside a member (and inside chunks of a large one); only one row per
    member goes on, and it is stored, so the rows are read once for all three results.
    """
    member = [*group, day]
    if before:
        seen = rows.withColumn("__before", F.col(before))
    else:
        seen = over_order(
            rows, member, [F.col(row_no)], {"__row_state": (F.struct(F.col(key).alias("k"), F.col(ts).alias("t")), "last")},
            {"__before": lambda w: F.lag("__row_state").over(w)},
        )
    last = F.col("__before")
    checks = {
        "key_repeat": F.col(key) == last["k"], "key_regression": F.col(key) < last["k"],
        "time_regression": F.col(ts) < last["t"], "date_mismatch": ~scalars.date_matches(ts, day),
        "rule_violation": F.size(rules.reasons()) > 0,
    }
    fault = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    per_member = seen.groupBy(*member).agg(
        F.count_if(~fault).alias("n_rows"), F.count_if(fault).alias("n_faults"), F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        *[F.count_if(F.coalesce(c, F.lit(False)) & ~fault).alias(n) for n, c in checks.items()])
    judged = per_member.withColumn("__broken", F.max("n_faults").over(W.partitionBy(*(unit or group))) > 0).withColumns(
        {c: F.when(~F.col("__broken"), F.col(c)) for c in ("first_key", "last_key")})
    bounded = windows.boundary_conflicts(judged, group, day, "first_key", "last_key").drop("highest_before")
    bad = sum((F.col(n) for n in checks), F.lit(0))
    status = F.when(F.col("__broken"), "failed").when((bad > 0) | (F.col("boundary_status") == "conflict"), "rejected").otherwise("proven")
    members = materialise(bounded.withColumn("status", status).drop("n_faults", "__broken"), "scan-members")
    good = members.filter("status = 'proven'").select(*group, day)
    return Scan(members, windows.segments(good, group, day), joins.missing_days(good, group, day))


# ---- K04 ----
def decision(members: DataFrame, cutoff: Column, group: list[str], key: list[str]) -> DataFrame:
    """What is decided on members under a cutoff: per group all counts, and a fingerprint of the members that are visible."""
    labelled = filters.label_visibility(members, cutoff)
    prints = aggregates.fingerprint_sums(  # the counts of all states come with it
        labelled, [*group, *key], [*group, "visibility"], only=F.col("visibility") == "visible")
    state = F.col("visibility")

    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.when(state == name, F.col("n_rows"))), F.lit(0))

    return prints.groupBy(*group).agg(
        F.sum("n_rows").alias("total"), count("visible").alias("formal"), count("time_boundary_rejected").alias("rejected"),
        count("undetermined").alias("undetermined"), F.max(F.when(state == "visible", F.col("fingerprint"))).alias("decision_sha"))


def freeze(members: DataFrame, root: str, cutoff: str, group: list[str], key: list[str], rule_version: str) -> str:
    """Publish members, cutoff (UTC time) and rules as an intent, and return its id, which follows from its content. An intent that is there already stays."""
    spark = members.sparkSession
    wanted = [*group, *key, "source_visible_at", "collected_at"]
    staged = materialise(members.select(*wanted), "intent")  # what is hashed is what is published
    content = aggregates.set_fingerprint(staged).first()["fingerprint"]
    said = {"kind": "intent", "cutoff": cutoff, "rule_version": rule_version, "group": group, "key": key}
    intent = "intent-" + hashlib.sha256(json.dumps([said, content], sort_keys=True).encode()).hexdigest()[:32]
    if not sinks.is_published(spark, root, intent):
        sinks.publish_batch(staged, root, intent, said)
    return intent


def _decide_frozen(spark: SparkSession, root: str, intent: str) -> DataFrame:
    """The decision on an intent, from its batch alone: members, cutoff and rules are the published ones, and are checked to be."""
    said = sinks.read_manifest(spark, root, intent)
    return decision(sinks.read_batch(spark, root, intent), F.lit(said["cutoff"]).cast("timestamp"), said["group"], said["key"])


def decide_frozen(spark: SparkSession, root: str, intent: str) -> str:
    """Decide on a published intent and publish the decision; returns its id."""
    name = intent.replace("intent-", "decision-")
    if not sinks.is_published(spark, root, name):
        facts = sinks.read_manifest(spark, root, intent)
        sinks.publish_batch(_decide_frozen(spark, root, intent), root, name, {"kind": "decision", "intent": intent, "intent_fingerprint": facts["fingerprint"]})
    return name


def prove_frozen(spark: SparkSession, root: str, decided: str, attempt: int) -> str:
    """Decide again, from the intent that a decision names, compare with the decision row by row and publish the proof; returns its id."""
    facts = sinks.read_manifest(spark, root, decided)
    name = f"{decided.replace('decision-', 'proof-')}-{attempt}"
    if sinks.is_published(spark, root, name):
        return name
    intent = sinks.read_manifest(spark, root, facts["intent"])
    if intent["fingerprint"] != facts["intent_fingerprint"]:
        raise sinks.BatchAltered(f"{facts['intent']} is not the intent that {decided} was made of")
    group, first, again = intent["group"], sinks.read_batch(spark, root, decided), _decide_frozen(spark, root, facts["intent"])
    told = [c for c in first.columns if c not in group]
    # One row per group and side: the union keeps null groups and groups of one side only.
    sides = first.select(*group, F.struct(*told).alias("decided"), F.lit(None).cast(first.select(F.struct(*told)).schema[0].dataType).alias("replayed")).unionByName(
        again.select(*group, F.lit(None).cast(first.select(F.struct(*told)).schema[0].dataType).alias("decided"), F.struct(*told).alias("replayed")))
    both = sides.groupBy(*group).agg(F.max("decided").alias("decided"), F.max("replayed").alias("replayed"))
    same = F.col("decided").eqNullSafe(F.col("replayed"))
    proof = both.select(*group, "decided.*", F.col("replayed.decision_sha").alias("replay_sha"), F.when(same, "equal").otherwise("different").alias("replay_status"))
    sinks.publish_batch(proof, root, name, {"kind": "proof", "decision": decided, "attempt": attempt})
    return name


def batch_state(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """Whether a batch can be used: `intact`, or `altered` with the rows it states and those it holds."""
    facts = sinks.read_manifest(spark, root, batch_id)
    held = aggregates.set_fingerprint(spark.read.parquet(f"{root}/batch_id={batch_id}/{facts['data']}"))
    intact = (F.col("n_rows") == facts["n_rows"]) & (F.col("fingerprint") == facts["fingerprint"])
    return held.select(F.lit(facts.get("kind")).alias("kind"), F.lit(facts["n_rows"]).cast("bigint").alias("n_stated"), F.col("n_rows").alias("n_held"),
                       F.when(intact, "intact").otherwise("altered").alias("batch_state"))


def freeze_decide_replay(first: DataFrame, second: DataFrame, cutoff: Column, group: list[str], key: list[str],
                         rule_version: str) -> DataFrame:
    """Decide on member evidence under a frozen intent, decide again from the re-read evidence, compare.

    One row per group of either evidence: formal, rejected and total counts of the first, both fingerprints and the
    replay verdict. A group that only one of them holds is `different`.
    """
    def decide(members: DataFrame, tag: str) -> DataFrame:
        return decision(members, cutoff, group, key).withColumnRenamed("decision_sha", tag)

    # Both decisions have one row per group; the union keeps null groups together and loses none.
    first_rows = decide(first, "decision_sha").withColumn("decided", F.lit(1))
    both = first_rows.unionByName(decide(second, "replay_sha").select(*group, "replay_sha", F.lit(1).alias("replayed")), allowMissingColumns=True)
    counts = ["total", "formal", "rejected", "undetermined"]
    joined = both.groupBy(*group).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts], *[F.max(c).alias(c) for c in ("decision_sha", "replay_sha", "decided", "replayed")])
    status = F.when(F.col("decided").isNotNull() & F.col("replayed").isNotNull() & F.col("decision_sha").eqNullSafe(F.col("replay_sha")), "equal").otherwise("different")
    return joined.withColumn("replay_status", status).drop("decided", "replayed").withColumn(
        "intent_sha", scalars.input_version([cutoff, F.lit(rule_version)])).withColumn(
        "difference", F.col("total") - F.col("formal") - F.col("rejected") - F.col("undetermined"))


# ---- K05 ----
@dataclass(frozen=True)
class FinalGate:
    leaves: DataFrame
    floors: DataFrame
    gap: DataFrame


def final_gate(leaves: DataFrame, gates: DataFrame, symbol: str, leaf: list[str], required: list[str]) -> FinalGate:
    """Verdict per leaf, floor per symbol (never better than its worst leaf) and the next gap to close."""
    verdict = aggregates.leaf_verdict(gates, leaves, leaf, required)
    floors = aggregates.worst_status(verdict, [symbol], "verdict", ["blocked", "pass"])
    blocked = verdict.withColumn("state", F.when(F.col("verdict") == "pass", "pass").otherwise("unmet")).withColumn(
        "reason", F.col("first_gate")).withColumn("release", F.concat(F.lit("prove_"), F.col("first_gate")))
    return FinalGate(verdict, floors, aggregates.remaining_gap(blocked, leaf))


# ---- K06 ----
def lifecycle_events(snapshots: DataFrame, n: int, cutoff: Column) -> DataFrame:
    """Scenario steps of the latest snapshots: one row per (snapshot, scenario, step).

    snapshots(symbol, snapshot_id, capture_ts, event_ts, bids, asks).
    """
    latest = ranking.latest_n(snapshots, ["symbol"], "capture_ts", "snapshot_id", n, cutoff)
    checked = latest.select(
        "symbol", "snapshot_id", "capture_ts", "identity_status", book.book_valid("bids", "asks").alias("valid_book"),
        scalars.time_gate("event_ts", "capture_ts").alias("time_gate"))
    grid = joins.scenario_grid(checked, SIDES, ORDER_KINDS, CLOCKS)
    verdict = verdicts.fill_verdict("kind", "valid_book")
    pace = F.when(F.col("clock") == "stress", 5).otherwise(1)  # relative milliseconds of a step
    named = grid.withColumn("v", verdict).withColumn(
        "order_id", F.concat_ws("|", "symbol", F.col("snapshot_id").cast("string"), "side", "kind", "clock"))
    steps = F.array(*[
        F.struct(F.lit(i).alias("seq"), state.alias("state"), (pace * i).cast("bigint").alias("clock_ms"))
        for i, state in enumerate([F.lit("created"), F.lit("sent"), F.lit("acknowledged"), F.lit("evaluated"), F.col("v")["terminal_state"]])
    ])
    return named.select("order_id", "symbol", "kind", "clock", "time_gate", F.col("v")["reason"].alias("reason"), F.inline(steps))


def lifecycle_evidence(snapshots: DataFrame, n: int, cutoff: Column) -> DataFrame:
    """Terminal states per symbol, kind and clock, with the number of illegal or backward steps."""
    events = lifecycle_events(snapshots, n, cutoff)
    audited = windows.transition_audit(events, "order_id", "seq", "state", LIFECYCLE_EDGES, ["created"], whole=True)
    ended = F.col("seq") == 4
    return audited.groupBy("symbol", "kind", "clock").agg(
        *[F.count_if(ended & (F.col("state") == end)).alias(f"n_{end}") for end in ("filled", "canceled", "unknown")],
        F.count_if(ended).alias("n_all"), F.count_if(~F.col("step_status").isin("start", "ok")).alias("illegal_steps"))


# ---- K07 ----
def missing_data_audit(df: DataFrame, by: list[str], ts: str, status: str, states: list[str]) -> DataFrame:
    """Coverage per group with missing days, segments, counts and conservation."""
    coverage = aggregates.coverage_record(df, by, ts, totals={"in_states": F.col(status).isin(states).cast("bigint")})
    kept = coverage.withColumn("in_states", F.coalesce("in_states", F.lit(0))).withColumn("population", F.col("n_rows")).withColumn(
        "difference", F.col("population") - F.col("in_states"))
    return kept.withColumn("audit_status", F.when(
        (F.col("difference") == 0) & (F.col("days_missing") == 0), "complete").otherwise("gaps"))


# ---- K08 ----
def cost_evidence(books: DataFrame, grid: DataFrame, by: list[str], notional: float, components: list[str]) -> DataFrame:
    """Which cost components every leaf has, from order books and charged costs; then the leaf verdict.

    books(by..., bids, asks, and a column per charged component).
    """
    mid = (F.col("bids")[0]["price"] + F.col("asks")[0]["price"]) / 2
    measured = books.select(
        *by, *[c for c in components if c in books.columns], book.spread("bids", "asks").alias("spread"),
        book.depth("asks", notional).alias("depth"), book.impact("asks", notional, mid).alias("impact"))
    cover = aggregates.cost_coverage(measured, grid, by, components)
    gates = cover.select(*by, F.col("component").alias("gate"), F.when(F.col("cost_state") == "covered", "pass").otherwise("unknown").alias("state"))
    return aggregates.leaf_verdict(gates, grid, by, components)


# ---- K09 ----
def session_study(bars: DataFrame, horizon_minutes: int) -> DataFrame:
    """Per symbol and session: bars, share that rose over the horizon, volatility, breaks and false breaks."""
    broken = features.range_break(features.number_bars(bars))
    labelled = materialise(broken.withColumn("session", scalars.session_label("bar_ts")), "labelled")
    later = joins.forward_outcome(labelled, ["symbol"], "bar_ts", "bar_no", "close", [horizon_minutes]).select("symbol", "bar_no", "outcome")
    known = labelled.join(later, ["symbol", "bar_no"])
    ret = F.ln(F.col("outcome").cast("double") / F.col("close").cast("double"))
    return known.groupBy("symbol", "session").agg(
        F.count("*").alias("n_bars"), F.count("outcome").alias("n_known"),
        F.avg((F.col("outcome") > F.col("close")).cast("double")).alias("hit_rate"), F.stddev_samp(ret).alias("volatility"),
        F.count("break_side").alias("n_breaks"), F.count_if("false_break").alias("n_false_breaks"))


# ---- K10 ----
def compression_features(bars: DataFrame, oi: DataFrame, needed: int = 4, n: int = 14) -> DataFrame:
    """Every sign of compression and release on each bar. Both inputs are read several times: hand in stored bars."""
    rows = features.number_bars(bars)
    means = features.macd(rows.select("symbol", features.ROW, "close")).drop("close")
    x = features.bounded_features(rows, n).join(means, ["symbol", features.ROW]).join(features.oi_change(oi), ["symbol", "bar_ts"])
    state = verdicts.compression_state(
        F.col("volume_falling"), F.col("volatility_falling"), F.col("body_shrinking"), features.macd_near_zero(), F.col("oi_contracting"), needed)
    x = x.withColumn("s", state).select("*", "s.*").drop("s")
    taker_up, taker_down = F.col("taker_buy") > F.col("taker_sell"), F.col("taker_sell") > F.col("taker_buy")
    x = x.withColumn("direction", verdicts.release_direction(
        F.col("break_side") == "up", F.col("break_side") == "down", F.col("volume_ratio") > 1, taker_up, taker_down,
        F.col("oi_turned_up"), F.col("oi_step") > 0, F.col("retest_held")))
    marked = materialise(x.withColumn("qualified", F.coalesce(F.col("volume_ratio") > 1, F.lit(False))), "marked")
    return features.first_release(marked)


def compression_study(bars: DataFrame, oi: DataFrame, horizon_minutes: int, needed: int = 4) -> DataFrame:
    """Outcome rate after compressed and other bars, per symbol and first-release mark."""
    x = materialise(compression_features(bars, oi, needed), "features")
    later = joins.forward_outcome(x, ["symbol"], "bar_ts", "bar_no", "close", [horizon_minutes]).select("symbol", "bar_no", "outcome")
    joined = x.join(later, ["symbol", "bar_no"])
    return aggregates.hit_rate(joined, ["symbol", "compressed", "is_first_release"], F.col("outcome") > F.col("close"))


def run_length_outcomes(marked: DataFrame, horizon_minutes: int) -> DataFrame:
    """Per symbol and length of a run of compressed bars: runs, releases, and how often a release went on in its own direction.

    `marked` are the stored rows of `compression_features`. A run that reaches the last bar of its symbol is `censored`: its length is
    only a lower bound, and it is counted apart. A release goes on when the close `horizon_minutes` later lies beyond its close in the
    direction of its body; without such a bar the outcome is unknown, and a body without direction never goes on.
    """
    inside, number = F.col("compressed"), F.col("bar_no")
    runs = marked.filter("compression_run > 0").groupBy("symbol", "compression_run").agg(
        F.count_if(inside).alias("run_length"), (F.max(number) == F.max(F.when(inside, number))).alias("censored"),
        F.min(F.when(F.col("is_first_release"), F.struct("bar_no", "open", "close"))).alias("release"))
    later = joins.forward_outcome(marked, ["symbol"], "bar_ts", "bar_no", "close", [horizon_minutes]).select("symbol", F.col("bar_no").alias("release_no"), "outcome")
    known = runs.withColumn("release_no", F.col("release")["bar_no"]).join(later, ["symbol", "release_no"], "left")
    begun, ended, then = F.col("release")["open"], F.col("release")["close"], F.col("outcome")
    went_on = ((then > ended) & (ended > begun)) | ((then < ended) & (ended < begun))
    return known.groupBy("symbol", "run_length", "censored").agg(
        F.count("*").alias("n_runs"), F.count("release").alias("n_released"), F.count("outcome").alias("n_known"),
        F.count_if(went_on).alias("n_continued"), F.avg(F.when(F.col("outcome").isNotNull(), F.coalesce(went_on, F.lit(False)).cast("double"))).alias("rate"))


# ---- K11 ----
def decision_card(candidates: DataFrame, gates: dict[str, Column], day: str, score: str, tie: str, k: int = 2,
                  order: list[str] = PERMISSION_GATES) -> DataFrame:
    """Permission per candidate (first failing gate is the reason, size 0) and at most k picks per day."""
    judged = candidates.withColumn("p", verdicts.permission(gates, order)).select("*", "p.*").drop("p")
    picks = ranking.daily_top(judged, [day], score, tie, F.col("allowed"), k).select(day, tie, F.col("rank"))
    return judged.join(picks, [day, tie], "left").withColumn("size", F.when(F.col("rank").isNotNull(), 1).otherwise(0))
