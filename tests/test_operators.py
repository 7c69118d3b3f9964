"""Rules that must refuse, and small fixtures with known answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.contracts import DECLARATION_ALIASES, LIFECYCLE_EDGES, SENSITIVE_PATTERNS
from plumbline.functions import book as K
from plumbline.functions import scalars as S
from plumbline.functions import verdicts as V
from plumbline.operators import aggregates as D
from plumbline.operators import features as X
from plumbline.operators import filters as B
from plumbline.operators import joins as C
from plumbline.operators import ranking as R
from plumbline.operators import sets as G
from plumbline.operators import structure
from plumbline.operators import windows as E
from plumbline.plans import jobs
from plumbline.rules import Rule, RuleSet


def ts(text):
    return F.lit(text).cast("timestamp")


def test_cutoff_to_the_microsecond(spark):
    rows = [("a", "2026-01-01 00:00:00.999999"), ("b", "2026-01-01 00:00:01"), ("c", "2026-01-01 00:00:01.000001")]
    df = spark.createDataFrame(rows, "m string, t string").select(
        "m", F.col("t").cast("timestamp").alias("source_visible_at"), F.lit(None).cast("timestamp").alias("x"), F.col("t").cast("timestamp").alias("collected_at"))
    cut = ts("2026-01-01 00:00:01")
    assert {r.m for r in B.visible_at(df, cut).collect()} == {"a", "b"}
    assert {r.m: r.visibility for r in B.label_visibility(df, cut).collect()} == {"a": "visible", "b": "visible", "c": "time_boundary_rejected"}
    assert {r.m: r.s for r in df.select("m", S.after_cutoff("collected_at", cut).alias("s")).collect()} == {"a": "before", "b": "before", "c": "after_ambiguous"}
    with pytest.raises(Exception, match="after the cutoff"):
        B.label_visibility(df, cut, strict=True).collect()
    unknown = B.label_visibility(df.withColumn("collected_at", F.col("x")), cut).collect()
    assert {r.m: r.visibility for r in unknown} == {"a": "undetermined", "b": "undetermined", "c": "time_boundary_rejected"}


def test_projection_and_inventory_contracts(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="secret"):
        B.project_allowed(df, ["id", "secret"])
    with pytest.raises(ValueError, match="lacks"):
        B.check_inventory(df, ["asset_id"], "asset_id", "batch", [], "format", "location", [])


def test_scope_refuses_unknown_symbols(spark):
    df = spark.createDataFrame([("BTC",), ("SOL",), (None,)], "symbol string")
    inside, outside = B.scope_filter(df, ["BTC", "ETH"])
    assert (inside.count(), outside.count()) == (1, 2)


def test_freshness(spark):
    rows = [("2026-01-01 00:00:00", "2026-01-01 01:00:00", True), ("2026-01-01 00:00:00", "2026-01-01 01:00:00.000001", False),
            ("2026-01-01 00:00:01", "2026-01-01 00:00:00", False), (None, "2026-01-01 00:00:00", False)]
    df = spark.createDataFrame(rows, "e string, o string, want boolean")
    assert df.filter(B.is_fresh(F.col("e").cast("timestamp"), F.col("o").cast("timestamp")) != F.col("want")).count() == 0


def test_rules_are_frozen_independent_of_order():
    a, b = Rule("a", "x > 1", "big"), Rule("b", "x IS NULL", "void")
    assert RuleSet.freeze([a, b]).sha == RuleSet.freeze([b, a]).sha != RuleSet.freeze([a]).sha
    with pytest.raises(ValueError):
        RuleSet.freeze([a, a])


def test_undecidable_rule_counts_as_broken(spark):
    rules = RuleSet.freeze([Rule("r", "price <= 0", "price")])
    got = rules.apply(spark.createDataFrame([(None,), (1.0,), (-1.0,)], "price double")).collect()
    assert [r.reasons for r in got] == [["price"], [], ["price"]]


def test_sensitive_text_is_found_and_never_shown(spark):
    samples = ["-----BEGIN PRIVATE KEY-----", "password=smoke-only-secret", "token: smoke-only-token-value", "AKIA" + "A" * 16, "ghp_" + "a" * 24, "host 10.1.2.3 up"]
    df = spark.createDataFrame([(s,) for s in [*samples, "plain text"]], "t string")
    assert df.filter(S.is_sensitive("t")).count() == len(samples)
    clean = [r.c for r in df.select(S.redact("t").alias("c")).collect()]
    assert all(s not in c for s, c in zip(samples, clean)) and clean[-1] == "plain text"
    hits = df.select(*[F.sum(c).alias(n) for n, c in S.sensitive_counts("t").items()]).first().asDict()
    assert hits == dict.fromkeys(SENSITIVE_PATTERNS, 1) | {"assignment": 2}


def test_strict_parsing(spark):
    cases = [("1", True), ("-0.5", True), ("1e3", False), ("NaN", False), ("Infinity", False), (" 1", False), ("01", False), ("1.", False), ("", False)]
    df = spark.createDataFrame(cases, "t string, want boolean")
    assert df.filter(S.strict_decimal("t").isNotNull() != F.col("want")).count() == 0
    zoned = [("2026-01-01T00:00:00Z", True), ("2026-01-01T08:00:00.123456+08:00", True), ("2026-01-01T00:00:00", False), ("2026-01-01 00:00:00Z", False)]
    df = spark.createDataFrame(zoned, "t string, want boolean")
    assert df.filter(S.parse_zoned("t").isNotNull() != F.col("want")).count() == 0
    assert df.filter(S.parse_zoned("t", ts("2025-12-31 00:00:00")).isNotNull()).count() == 0


def test_clocks_never_stand_in_for_one_another(spark):
    df = spark.createDataFrame([('{"E": 5}', 1), ("{}", 1), ('{"E": 5, "T": 6}', 1)], "p string, capture long")
    event = S.unique_json_long("p", ["$.E", "$.T"])
    assert [(r.e, r.g) for r in df.select(event.alias("e"), S.time_gate(event, "capture").alias("g")).collect()] == [
        (5, "pass"), (None, "unknown"), (None, "unknown")]


def test_source_visible_time_needs_both(spark):
    df = spark.createDataFrame([("2026-01-01", "2026-01-02"), ("2026-01-01", None)], "a string, b string")
    assert [r[0] for r in df.select(S.source_visible_at("a", "b")).collect()] == ["2026-01-02", None]


def levels(*pairs):
    return [(float(p), float(q)) for p, q in pairs]


BOOK = "b array<struct<price:double,qty:double>>, a array<struct<price:double,qty:double>>"


def test_book_checks(spark):
    books = [
        (levels((10, 1), (9, 1)), levels((11, 1), (12, 1)), True), (levels((9, 1), (10, 1)), levels((11, 1)), False),
        (levels((10, 1)), levels((12, 1), (11, 1)), False), (levels((10, -1)), levels((11, 1)), False), (levels((11, 1)), levels((11, 1)), False),
        ([], levels((11, 1)), False), (levels((10, 0)), levels((11, 0)), True)]
    df = spark.createDataFrame([(b, a, w) for b, a, w in books], BOOK + ", want boolean")
    assert df.filter(K.book_valid("b", "a") != F.col("want")).count() == 0


def test_depth_and_impact(spark):
    df = spark.createDataFrame([(levels((9, 1)), levels((10, 1), (20, 1)))], BOOK)
    got = df.select(K.depth("a", 20.0).alias("d"), K.depth("a", 31.0).alias("thin"), K.impact("a", 20.0, F.lit(9.5)).alias("i")).first()
    assert got.d == 1.5 and got.thin is None and abs(got.i - (20 / 1.5 - 9.5) / 9.5) < 1e-12


def test_illegal_transition_and_passive_orders(spark):
    steps = [("x", 0, "created"), ("x", 1, "filled"), ("y", 0, "created"), ("y", 1, "sent"), ("y", 2, "acknowledged"), ("y", 3, "evaluated"), ("y", 4, "canceled"), ("z", 0, "sent")]
    got = {(r.o, r.n): r.step_status for r in E.transition_audit(
        spark.createDataFrame(steps, "o string, n int, s string"), "o", "n", "s", LIFECYCLE_EDGES, ["created"]).collect()}
    assert got[("x", 1)] == "illegal" and got[("z", 0)] == "illegal_start"
    assert {got[("y", i)] for i in range(1, 5)} == {"ok"}
    verdict = spark.range(1).select(V.fill_verdict(F.lit("passive_limit_cancel"), F.lit(True)).alias("v")).first().v
    assert (verdict.terminal_state, verdict.reason) == ("canceled", "QUEUE_IDENTITY_UNAVAILABLE")


def test_lifecycle_replays_alike(spark):
    snaps = spark.createDataFrame([("s", i, i * 10, levels((10, 1)), levels((11 - i % 3, 1))) for i in range(30)],
                                  "symbol string, snapshot_id long, at long, bids array<struct<price:double,qty:double>>, asks array<struct<price:double,qty:double>>")
    snaps = snaps.withColumn("capture_ts", F.timestamp_seconds("at")).withColumn("event_ts", F.col("capture_ts"))
    runs = [jobs.lifecycle_events(snaps.repartition(n), 20, F.timestamp_seconds(F.lit(1000))) for n in (1, 7)]
    assert runs[0].count() == 20 * 12 * 5
    assert G.replay_equal(runs[0], runs[1], runs[0].columns).first().replay_status == "equal"
    assert D.set_fingerprint(runs[0]).first() == D.set_fingerprint(runs[1]).first()


def test_latest_n_names_duplicate_identities(spark):
    df = spark.createDataFrame([("s", 5, 1), ("s", 5, 1), ("s", 4, 1), ("s", 9, 1)], "k string, at long, id long").withColumn("ts", F.timestamp_seconds("at"))
    got = R.latest_n(df, ["k"], "ts", "id", 2, F.timestamp_seconds(F.lit(6))).collect()
    assert [r.at for r in got] == [5, 5] and {r.identity_status for r in got} == {"duplicate_identity"}


def test_missing_gate_blocks_only_its_leaf(spark):
    leaves = C.leaf_grid(spark.createDataFrame([("BTC",), ("ETH",)], "symbol string"), [4, 8, 24, 48])
    gates = C.with_grid(leaves, gate=["source", "time", "cost"]).withColumn("state", F.lit("pass")).filter(
        "NOT (symbol = 'BTC' AND scale_h = 8 AND gate = 'time')")
    got = jobs.final_gate(leaves, gates, "symbol", ["symbol", "scale_h"], ["source", "time", "cost"])
    blocked = got.leaves.filter("verdict = 'blocked'").collect()
    assert [(r.symbol, r.scale_h, r.first_gate) for r in blocked] == [("BTC", 8, "time")]
    assert {r.symbol: r.verdict for r in got.floors.collect()} == {"BTC": "blocked", "ETH": "pass"}
    assert got.gap.first().reason == "time"


@pytest.mark.parametrize("state", ["reject", "unknown", "failed", "immature", "expired", None])
def test_any_other_gate_state_blocks(spark, state):
    gates = spark.createDataFrame([("a", "g", "pass"), ("a", "h", state)], "leaf string, gate string, state string")
    got = D.leaf_verdict(gates, gates.select("leaf"), ["leaf"], ["g", "h"]).first()
    assert (got.verdict, got.first_gate) == ("blocked", "h")


def test_worst_status_and_unlisted_status(spark):
    df = spark.createDataFrame([("a", "proven"), ("a", "rejected"), ("b", "proven"), ("c", "odd"), ("c", "proven")], "m string, status string")
    assert {r.m: r.status for r in D.worst_status(df, ["m"], "status").collect()} == {"a": "rejected", "b": "proven", "c": "failed"}


def test_fingerprint_sees_content_and_copies_but_not_order(spark):
    df = spark.range(300).select((F.col("id") % 90).alias("a"), F.lit("x").alias("b"))
    one = D.set_fingerprint(df).first()
    assert one == D.set_fingerprint(df.repartition(13).orderBy(F.desc("a"))).first() and one.n_rows == 300
    assert one.fingerprint != D.set_fingerprint(df.unionByName(df.limit(1))).first().fingerprint
    nulls = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert D.record_duplicates(nulls).count() == 0


def test_replay_restore_and_append(spark):
    a, b = spark.range(10).withColumn("v", F.lit(1)), spark.range(1, 11).withColumn("v", F.lit(1))
    got = G.replay_equal(a, b, ["id", "v"]).first()
    assert (got.only_first, got.only_second, got.replay_status) == (1, 1, "different")
    assert G.replay_equal(a, a, ["id", "v"]).first().replay_status == "equal"
    assert G.append_only(a, a.unionByName(b), ["id", "v"]).first().append_status == "append_only"
    assert G.append_only(a.unionByName(a), a, ["id", "v"]).first().lost == 10
    manifest = spark.createDataFrame([("p", "1"), ("q", "2"), ("r", "3")], "path string, h string")
    restored = spark.createDataFrame([("p", "1"), ("q", "x"), ("s", "4")], "path string, h string")
    assert {r.path: r.restore_status for r in G.verify_restore(manifest, restored, ["path"], "h").collect()} == {
        "p": "restored", "q": "hash_mismatch", "r": "missing", "s": "undeclared"}


def test_population_overlap_and_gap(spark):
    base = spark.range(4).withColumnRenamed("id", "k")
    got = {(r.parts, r.population_status): r.n_keys for r in G.population(
        base, {"a": base.filter("k < 2"), "b": base.filter("k IN (1, 2)").unionByName(spark.createDataFrame([(9,)], "k long"))}, ["k"]).collect()}
    assert got == {("a", "assigned"): 1, ("a+b", "overlap"): 1, ("b", "assigned"): 1, ("", "unassigned"): 1, ("b", "not_a_candidate"): 1}


def test_conflicting_fields_become_unknown(spark):
    df = spark.createDataFrame([("a", "x", "1"), ("a", "x", "2"), ("b", "y", None), ("b", "y", "3"), ("c", None, "z")], "k string, f string, g string")
    got = {r.k: (r.f, r.g, r.conflicts) for r in D.merge_conflicts(df, ["k"], ["f", "g"]).collect()}
    assert got == {"a": ("x", None, "g"), "b": ("y", None, "g"), "c": (None, "z", "")}


def test_alias_table(spark):
    columns = spark.createDataFrame([("t", c) for c in ("member_id", "symbol", "market", "market_type", "采集时间")], "table string, column string")
    got = {r.field: (r.alias_status, r.resolved_column) for r in C.resolve_aliases(columns, DECLARATION_ALIASES).collect()}
    assert len(got) == 20 and got["member_no"] == ("resolved", "member_id") and got["market_type"] == ("multiple", None)
    assert got["collected_at"] == ("resolved", "采集时间") and got["venue"] == ("missing", None)
    with pytest.raises(ValueError, match="alias used twice"):
        C.resolve_aliases(columns, {"a": ["x"], "b": ["x"]})


def test_schema_comparison(spark):
    facts = "table string, column string, type string, position int"
    declared = spark.createDataFrame([("m", "a", "int", 0), ("d", "a", "int", 0), ("g", "a", "int", 0), ("u", "a", None, 0)], facts)
    observed = spark.createDataFrame([("m", "a", "int", 0), ("d", "a", "long", 0), ("u", "a", "int", 0), ("x", "a", "int", 0)], facts)
    assert {r.table: r.schema_status for r in C.compare_schema(declared, observed).collect()} == {
        "m": "match", "d": "drift", "g": "not_found", "u": "undetermined", "x": "undeclared"}


def test_structure_comparison(spark):
    column_rows = "table string, column string, type string, position int, nullable boolean, key_position int"
    index_rows = "table string, index string, seq int, column string, non_unique boolean, index_type string"

    def facts(columns, indexes):
        return structure.column_facts(spark.createDataFrame(columns, column_rows)).unionByName(structure.index_facts(spark.createDataFrame(indexes, index_rows)))

    tables = ["same", "order", "unique", "gone", "unknown", "failed", "denied", "unread", "twice", None]
    declared = facts([(t, "Id", "bigint", 0, False, 0) for t in tables] + [(t, "ts", "int", 1, True, None) for t in tables],
                     [(t, "PK", 1, "Id", False, "btree") for t in tables] + [(t, "by_ts", i + 1, c, True, "BTREE") for t in tables for i, c in enumerate(("ts", "id"))])
    seen = [t for t in tables if t != "gone"]
    columns = [(t, "ID", "bigint", 0, False, 0) for t in seen] + [(t, "ts", None if t == "unknown" else "int", 1, True, None) for t in seen]
    indexes = [(t, "pk", 1, "id", t == "unique", "BTREE") for t in seen]
    indexes += [(t, "BY_TS", i + 1, c, True, "btree") for t in seen for i, c in enumerate(("id", "ts") if t == "order" else ("ts", "id"))]
    observed = facts([*columns, ("twice", "id", "bigint", 0, False, 0), ("extra", "a", "int", 0, True, None)], indexes)
    outcomes = {"failed": "timeout", "denied": "denied", "unread": None}
    reads = spark.createDataFrame([(t, outcomes.get(t, "read")) for t in [*tables, "extra", "listed"] if t != "unread"] + [("failed", "read")], "table string, outcome string")
    got = {r.table: (r.structure_state, r.columns_differing, r.indexes_differing) for r in structure.compare_structure(declared, observed, reads).collect()}
    assert got == {
        "same": ("match", 0, 0), "order": ("drift", 0, 2), "unique": ("drift", 0, 1), "gone": ("not_found", 2, 3), "unknown": ("undetermined", 1, 0),
        "failed": ("failed", 0, 0), "denied": ("undetermined", 0, 0), "unread": ("undetermined", 0, 0), "twice": ("match", 0, 0),
        None: ("match", 0, 0), "extra": ("undeclared", 1, 0), "listed": ("undeclared", 0, 0)}
    shas = [{(r.table, r.kind): r.fingerprint for r in structure.structure_sha(f).collect()} for f in (declared, observed.repartition(5))]
    assert {t for t in seen for k in ("column", "index") if shas[0][t, k] != shas[1][t, k]} == {"order", "unique", "unknown", "twice"}
    assert structure.compare_structure(declared.limit(0), observed.limit(0), reads.limit(0)).collect() == []


def test_audit_reads_each_unit_once(spark):
    rules = RuleSet.freeze([Rule("r1", "v > 1", "large"), Rule("r2", "`a.b` = ''", "empty")])
    shape = "`a.b` string, v double, d date"
    unit = spark.sql("SELECT * FROM VALUES ('x', 2D, DATE'2026-01-01'), ('x', 2D, DATE'2026-01-01'), (' ', double('NaN'), DATE'2026-01-04'), (NULL, NULL, NULL), ('', 1D, DATE'2026-01-04') AS t(`a.b`, v, d)")
    frames = {"full": unit, "empty": spark.createDataFrame([], shape), "bare": unit.select(F.lit(1).alias("one"))}
    contracts = {"full": jobs.UnitContract(rules, day="d", critical_rule="large"), "empty": jobs.UnitContract(rules, day="d"), "bare": jobs.UnitContract(RuleSet.freeze([]))}
    units = spark.createDataFrame([(u,) for u in ("full", "empty", "bare", "lost", "full")], "asset_id string")
    for name, df in frames.items():
        plan = jobs._unit_facts(name, df, contracts[name])._jdf.queryExecution().analyzed()
        assert plan.collectLeaves().size() == 1, name
    audit = jobs.audit_inventory(spark, units, frames, contracts)
    got = {r.asset_id: (r.scan_status, r.n_rows, r.n_null, r.n_blank, r.n_non_finite, r.n_duplicate, r.time_candidates, r.availability) for r in audit.quality.collect()}
    assert got == {"full": ("scanned", 5, 3, 2, 1, 1, 1, "unavailable"), "empty": ("scanned", 0, 0, 0, 0, 0, 1, "undetermined"),
                   "bare": ("scanned", 5, 0, 0, 0, 4, 0, "undetermined"), "lost": ("not_executed", None, None, None, None, None, 0, "undetermined")}
    assert {r.asset_id: (r.gap_status, r.n_missing_days) for r in audit.gaps.collect()} == {
        "full": ("measured", 2), "empty": ("measured", 0), "bare": ("undetermined", None), "lost": ("not_executed", None)}
    # NaN is larger than any number, and a rule that cannot be decided counts as broken
    assert {(r.anomaly, r.n) for r in audit.anomalies.collect() if r.asset_id == "full"} == {("blank_field", 2), ("non_finite", 1), ("large", 4), ("empty", 2)}


def test_window_guard_and_warm_up(spark):
    days = spark.sql("SELECT 's' AS k, explode(sequence(DATE'2026-01-01', DATE'2026-01-31')) AS day").filter("day <> DATE'2026-01-15'")
    seg = E.segments(days, ["k"], "day")
    inside = {str(r.day): r.inside for r in B.inside_segment(days, seg, ["k"], "day", 3).collect()}
    assert inside["2026-01-04"] and not inside["2026-01-03"] and not inside["2026-01-18"] and inside["2026-01-19"]
    assert [str(r.day) for r in C.missing_days(days, ["k"], "day").collect()] == ["2026-01-15"]


def test_permission_asks_in_order_and_closes_on_missing(spark):
    ok, no = F.lit(True), F.lit(False)
    gates = {"data": ok, "sample": ok, "edge": no, "cost": no}
    got = spark.range(1).select(V.permission(gates).alias("p"), V.permission({}).alias("q")).first()
    assert (got.p.allowed, got.p.reason, got.q.reason) == (False, "edge", "data")
    layers = spark.range(1).select(V.admission_layers(F.lit("open"), F.lit(None), F.lit("conflict"), F.lit("open")).alias("a")).first().a
    assert tuple(layers) == ("open", "closed", "closed", "open")


def test_availability_order(spark):
    yes, no, nul = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    cases = [((yes, yes, no, no, yes), "unavailable"), ((no, yes, no, no, yes), "undetermined"), ((no, nul, no, no, yes), "undetermined"),
             ((no, no, yes, yes, yes), "limited"), ((no, no, yes, no, yes), "undetermined"), ((no, no, no, no, yes), "available"), ((no, no, no, no, no), "undetermined")]
    got = spark.range(1).select(*[V.availability(*c).alias(f"v{i}") for i, (c, _) in enumerate(cases)]).first()
    assert list(got) == [w for _, w in cases]


def test_session_edges(spark):
    rows = [("2026-07-01 00:00:00", "asia"), ("2026-07-01 06:59:59", "asia"), ("2026-07-01 07:00:00", "europe"), ("2026-07-01 13:29:59", "europe"),
            ("2026-07-01 13:30:00", "us"), ("2026-07-01 23:59:59", "us")]
    winter = [("2026-01-15 07:00:00", "europe"), ("2026-01-15 14:29:59", "europe"), ("2026-01-15 14:30:00", "us")]
    cold = spark.createDataFrame(winter, "t string, want string").withColumn("ts", F.col("t").cast("timestamp"))
    assert cold.filter(S.session_label("ts") != F.col("want")).count() == 0
    df = spark.createDataFrame(rows, "t string, want string").withColumn("ts", F.col("t").cast("timestamp"))
    assert df.filter(S.session_label("ts") != F.col("want")).count() == 0
    assert {str(r[0]) for r in df.select(S.session_date("ts")).collect()} == {"2026-07-01"}
    assert df.filter(S.session_label("ts", us_open="22:30") == "europe").count() == 3


def test_ema_over_many_blocks(spark):
    n = 9
    values = [float((i * 37) % 101) for i in range(1500)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "symbol string, i long, v double").repartition(4)
    got = {r.i: r.e for r in X.ema(df, {"e": ("v", n)}, row="i").collect()}
    e = values[0]
    for i, v in enumerate(values):
        e = v if i == 0 else e + (v - e) * 2 / (n + 1)
        assert abs(got[i] - e) < 1e-9


def test_event_windows_agree(split):
    rows = split.range(0, 400).select((F.col("id") % 2).cast("string").alias("symbol"), F.col("id").alias("n"), F.timestamp_seconds(F.col("id") * 61).alias("ts"))
    events = rows.filter("n % 9 = 0").select("symbol", F.col("n").alias("e"), F.col("ts").alias("at"))
    totals = {r.e: (r.rows_in_window, r.sum_in_window) for r in C.event_window_totals(
        events, rows, ["symbol"], "at", "e", "ts", F.col("n"), 10, 5).collect()}
    pairs = C.event_window_join(events, rows, ["symbol"], "at", "ts", 10, 5).groupBy("e").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    assert totals == {r.e: (r.c, r.s) for r in pairs.collect()}


def test_declarations_do_not_look_ahead(spark):
    facts = spark.createDataFrame([("a", 1, "x", 10), ("a", 2, "y", 20), ("b", 1, "z", 15), ("b", 2, "w", None)], "k string, v int, p string, seen int")
    revoked = spark.createDataFrame([("a", 2, 30), ("a", 2, 25), ("b", 1, None)], "k string, v int, at int")
    cutoffs = [F.lit(c) for c in (9, 12, 20, 24, 25, 40)]
    got = {(r.k, r.cutoff): (r.v, r.p, r.n_versions) for r in E.declarations_as_of(facts, ["k"], "v", ["p"], "seen", revoked, "at", cutoffs).collect()}
    b = {("b", c): (1, "z", 1) for c in (20, 24, 25, 40)}
    assert got == {("a", 12): (1, "x", 1), ("a", 20): (2, "y", 2), ("a", 24): (2, "y", 2), ("a", 25): (1, "x", 1), ("a", 40): (1, "x", 1), **b}


def test_current_declaration_skips_revoked_versions(spark):
    facts = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, p string")
    revoked = spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int")
    assert [(r.k, r.v, r.p) for r in E.current_declaration(facts, ["k"], "v", ["p"], revoked).collect()] == [("a", 1, "x")]


def test_reconciliation(spark):
    board = spark.createDataFrame([("t1", "done"), ("t2", "open"), ("t3", "open"), ("t4", "open")], "task string, status string")
    sections = spark.createDataFrame([("t1", "done"), ("t2", "done"), ("t3", "open"), ("t3", "open"), ("t5", "open")], "task string, section string")
    assert {r.task: r.reconciled for r in C.reconcile_one_to_one(board, sections, ["task"], "status", "section").collect()} == {
        "t1": "ok", "t2": "wrong_section", "t3": "duplicate", "t4": "missing_right", "t5": "missing_left"}


def test_components_never_stand_in_for_one_another(spark):
    df = spark.createDataFrame([("s", 1.0, None), ("s", 1.0, 2.0)], "k string, fee double, funding double")
    grid = spark.createDataFrame([("s",), ("t",)], "k string")
    got = {(r.k, r.component): r.cost_state for r in D.cost_coverage(df, grid, ["k"], ["fee", "funding"]).collect()}
    assert got == {("s", "fee"): "covered", ("s", "funding"): "missing", ("t", "fee"): "missing", ("t", "funding"): "missing"}


def test_latest_n_counts_an_identity_that_the_cut_splits(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 1, 7), ("a", 0, 1)], "k string, ts long, id long")
    assert [(r["rank"], r["identity_status"]) for r in R.latest_n(df, ["k"], "ts", "id", 1).collect()] == [(1, "duplicate_identity")]


def test_canonical_order_over_text_and_fractions(spark):
    rows = [("b", 0.2), ("a", 0.9), ("a", 0.5), (None, 1.5), ("b", 0.1)]
    df = spark.createDataFrame(rows, "s string, x double")
    got = sorted(R.canonical_order(df, [F.col("s"), F.col("x")]).collect(), key=lambda r: r["ordinal"])
    assert [(r["s"], r["x"], r["ordinal"]) for r in got] == [(None, 1.5, 1), ("a", 0.5, 2), ("a", 0.9, 3), ("b", 0.1, 4), ("b", 0.2, 5)]


def test_inventory_rows_without_id_or_batch_are_named(spark):
    df = spark.createDataFrame([("1", "x", "CSV", "/d/a"), (None, None, "CSV", "/d/b")], "id string, batch string, fmt string, path string")
    got = {r["path"]: r["reasons"] for r in B.check_inventory(df, ["id"], "id", "batch", ["CSV"], "fmt", "path", ["/d"]).collect()}
    assert got == {"/d/a": [], "/d/b": ["missing_id", "second_batch"]}


def test_lines_are_grouped_in_partitions_of_bounded_size(spark, tmp_path):
    """Groups of about one line each: every task gets a bounded number of lines, and orders are not held whole by each."""
    from plumbline.session import dealt
    from registry import QUERIES

    rows = spark.range(1000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 300).alias("k"), "id")
    parts = dealt(rows, "k", rows=100)
    at = parts.withColumn("p", F.spark_partition_id()).collect()
    assert parts.rdd.getNumPartitions() == 10 and sorted(r.id for r in at) == list(range(1000))
    assert len({(r.k, r.p) for r in at}) == len({r.k for r in at})
    assert dealt(rows.where("false"), "k").count() == 0

    day = "timestamp_ntz'1995-03-01 00:00:00' + make_dt_interval(cast({} as int))"
    orders = spark.range(40).selectExpr("nullif(id, 7) as o_orderkey", day.format("id % 5") + " as o_orderdate")
    lines = spark.range(120).selectExpr("id % 45 as l_orderkey", "cast(id % 3 as int) as l_linenumber", "'R' as l_returnflag", f"if(id % 11 = 0, null, {day.format('id % 4')}) as l_shipdate")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.union(lines.where("l_orderkey = 3")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["h09_date_matches"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Broadcast" not in plan
    want = {}
    for i in [*range(120), *(i for i in range(120) if i % 45 == 3)]:
        k = i % 45
        if k < 40 and k != 7:
            n = want.setdefault((k, i % 3), [0, 0])
            n[0] += i % 11 != 0 and i % 4 >= k % 5
            n[1] += 1
    assert {(r.l_orderkey, r.l_linenumber): [r.n_match, r.n] for r in got.collect()} == want
