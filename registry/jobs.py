"""Queries for the composite jobs (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.functions import verdicts as V
from plumbline.operators import joins as C
from plumbline.plans import jobs
from plumbline.rules import Rule, RuleSet
from plumbline.session import fresh_folder, materialise
from plumbline.sources import archives, files, sinks
from registry.audits import CUTOFF, GATE_VIEW, GATES, SUMS_SQL, cutoff, daily_archives, gate_rows, tick_archives
from registry.base import bars, load, members, oi, query, session_sql, ticks, visibility
from registry.series import BODY_SQL, BREAK_SQL, OI_SQL, RECURSIVE, VOL_SQL, VOLUME_SQL, books

ORDER_RULES = RuleSet.freeze([Rule("o1", "o_totalprice <= 1000", "price_low"), Rule("o2", "o_orderstatus NOT IN ('F', 'O', 'P')", "status_unknown")])
DOC_RULES = RuleSet.freeze([Rule("d1", "n_chars < 200", "short_text"), Rule("d2", "n_chars <> length(text)", "length_wrong")])


def audit(spark, sf):
    name = F.regexp_extract("path", r"([^/]+)\.parquet(/|$)", 1)
    units = files.file_inventory(spark, [sf]).select(name.alias("asset_id")).filter(F.col("asset_id").isin("orders", "documents", "labels"))
    frames = {"orders": load(spark, sf, "orders"), "documents": load(spark, sf, "documents")}
    contracts = {"orders": jobs.UnitContract(ORDER_RULES, day="o_orderdate"), "documents": jobs.UnitContract(DOC_RULES, critical_rule="short_text")}
    return jobs.audit_inventory(spark, units, frames, contracts)


@query("k01_audit_quality", f"""
WITH o AS (SELECT count(*) AS n, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)))::BIGINT AS d FROM orders),
x AS (SELECT count(*) AS n, sum(CASE WHEN trim(text) = '' THEN 1 ELSE 0 END)::BIGINT AS b, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents)))::BIGINT AS d, count(*) FILTER (n_chars < 200) AS short FROM documents)
SELECT 'orders' AS asset_id, 'scanned' AS scan_status, n AS n_rows, 0::BIGINT AS n_null, 0::BIGINT AS n_blank, 0::BIGINT AS n_non_finite, d AS n_duplicate,
 CASE WHEN d > 0 THEN 'duplicates' ELSE 'unique' END AS duplicate_verdict, 1::BIGINT AS time_candidates, '{ORDER_RULES.sha}' AS rule_sha, 'undetermined' AS availability FROM o
UNION ALL SELECT 'documents', 'scanned', n, 0, b, 0, d, CASE WHEN d > 0 THEN 'duplicates' ELSE 'unique' END, 0, '{DOC_RULES.sha}', CASE WHEN short > 0 THEN 'unavailable' ELSE 'undetermined' END FROM x
UNION ALL SELECT 'labels', 'not_executed', NULL, NULL, NULL, NULL, NULL, NULL, 0, NULL, 'undetermined'""")
def k01(spark, sf):
    return audit(spark, sf).quality


@query("k01_audit_gaps", """
SELECT 'orders' AS asset_id, 'measured' AS gap_status, (max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) + 1 - count(DISTINCT o_orderdate))::BIGINT AS n_missing_days FROM orders
UNION ALL SELECT 'documents', 'undetermined', NULL UNION ALL SELECT 'labels', 'not_executed', NULL""")
def k01g(spark, sf):
    return audit(spark, sf).gaps


@query("k01_audit_anomalies", """
SELECT * FROM (SELECT 'orders' AS asset_id, 'price_low' AS anomaly, count(*) AS n FROM orders WHERE o_totalprice <= 1000 UNION ALL SELECT 'documents', 'short_text', count(*) FROM documents WHERE n_chars < 200
 UNION ALL SELECT 'documents', 'length_wrong', count(*) FROM documents WHERE n_chars <> length(text)) WHERE n > 0
UNION ALL SELECT 'orders', 'blank_field', 0 UNION ALL SELECT 'orders', 'non_finite', 0 UNION ALL SELECT 'documents', 'non_finite', 0 UNION ALL SELECT 'labels', 'not_executed', NULL
UNION ALL SELECT 'documents', 'blank_field', count(*) FILTER (trim(text) = '') FROM documents""")
def k01a(spark, sf):
    return audit(spark, sf).anomalies


# Every given table as a unit, with its columns (text columns, double columns, others), its day and its rules.
UNITS = {
    "region": ("r_name", "", "r_regionkey"), "nation": ("n_name", "", "n_nationkey n_regionkey"),
    "customer": ("c_name c_mktsegment", "c_acctbal", "c_custkey c_nationkey"), "supplier": ("s_name", "s_acctbal", "s_suppkey s_nationkey"),
    "part": ("p_name p_brand p_type", "p_retailprice", "p_partkey p_size"),
    "orders": ("o_orderstatus o_orderpriority", "o_totalprice", "o_orderkey o_custkey o_orderdate"),
    "lineitem": ("l_returnflag l_linestatus", "l_quantity l_extendedprice l_discount l_tax", "l_orderkey l_partkey l_suppkey l_linenumber l_shipdate"),
    "events": ("event_type props", "value", "event_id ts user_id"), "documents": ("text lang source", "", "doc_id n_chars"),
    "embeddings": ("", "", "vec_id embedding label"), "pages": ("url html", "", "page_id"), "benchmark": ("text", "", "item_id"),
    "labels": ("", "", "doc_id quality toxic"), "conversations": ("role text", "", "conv_id turn"),
}
UNIT_DAYS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
UNIT_RULES = {
    "orders": ORDER_RULES, "documents": DOC_RULES,
    "customer": RuleSet.freeze([Rule("c1", "c_acctbal < 0", "overdrawn")]), "supplier": RuleSet.freeze([Rule("s1", "s_acctbal < 0", "overdrawn")]),
    "lineitem": RuleSet.freeze([Rule("l1", "l_discount > l_tax", "discount_above_tax"), Rule("l2", "l_quantity < 1", "no_quantity")]),
    "events": RuleSet.freeze([Rule("e1", "value >= 100", "value_high")]), "labels": RuleSet.freeze([Rule("t1", "quality = 1 AND toxic = 1", "good_and_toxic")]),
    "conversations": RuleSet.freeze([Rule("v1", "role NOT IN ('system', 'user', 'assistant')", "role_unknown")]),
}
NO_RULES = RuleSet.freeze([])
TIME_COLUMNS = {"orders": 1, "lineitem": 1, "events": 1}


def _unit_sql(name: str) -> str:
    texts, reals, others = (part.split() for part in UNITS[name])
    total = lambda parts: " + ".join(["0", *parts])
    nulls = total(f"count(*) - count({c})" for c in (*texts, *reals, *others))
    blanks, odd = total(f"count(*) FILTER (trim({c}) = '')" for c in texts), total(f"count(*) FILTER (isnan({c}) OR isinf({c}))" for c in reals)
    day = UNIT_DAYS.get(name)
    gap = f"datediff('day', CAST(min({day}) AS DATE), CAST(max({day}) AS DATE)) + 1 - count(DISTINCT CAST({day} AS DATE))" if day else "NULL"
    rules = UNIT_RULES.get(name, NO_RULES)
    broken = ", ".join(f"{{'anomaly': '{r.reason}', 'n': count(*) FILTER (coalesce({r.violation}, true))}}" for r in rules.rules)
    return (f"SELECT '{name}' AS asset_id, count(*) AS n_rows, CAST({nulls} AS BIGINT) AS n_null, CAST({blanks} AS BIGINT) AS n_blank, CAST({odd} AS BIGINT) AS n_non_finite, "
            f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS BIGINT) AS n_duplicate, CAST({TIME_COLUMNS.get(name, 0)} AS BIGINT) AS time_candidates, "
            f"'{rules.sha}' AS rule_sha, CAST({gap} AS BIGINT) AS n_missing_days, CAST([{broken}] AS STRUCT(anomaly VARCHAR, n BIGINT)[]) AS broken FROM {name}")


UNITS_SQL = " UNION ALL ".join(_unit_sql(name) for name in UNITS)


def audit_whole(spark, sf):
    name = F.regexp_extract("path", r"([^/]+)\.parquet(/|$)", 1)
    units = files.file_inventory(spark, [sf]).select(name.alias("asset_id"))
    contracts = {u: jobs.UnitContract(UNIT_RULES.get(u, NO_RULES), day=UNIT_DAYS.get(u), critical_rule="good_and_toxic" if u == "labels" else None) for u in UNITS}
    return jobs.audit_inventory(spark, units, {u: load(spark, sf, u) for u in UNITS}, contracts)


@query("k01_whole_quality", f"""
SELECT asset_id, 'scanned' AS scan_status, n_rows, n_null, n_blank, n_non_finite, n_duplicate, CASE WHEN n_duplicate > 0 THEN 'duplicates' ELSE 'unique' END AS duplicate_verdict,
 time_candidates, rule_sha, CASE WHEN len(list_filter(broken, lambda b: b.anomaly = 'good_and_toxic' AND b.n > 0)) > 0 THEN 'unavailable' ELSE 'undetermined' END AS availability FROM ({UNITS_SQL})""")
def k01_whole(spark, sf):
    return audit_whole(spark, sf).quality


@query("k01_whole_gaps", f"SELECT asset_id, CASE WHEN n_missing_days IS NULL THEN 'undetermined' ELSE 'measured' END AS gap_status, n_missing_days FROM ({UNITS_SQL})")
def k01_whole_gaps(spark, sf):
    return audit_whole(spark, sf).gaps


@query("k01_whole_anomalies", f"""
WITH u AS ({UNITS_SQL}) SELECT asset_id, 'blank_field' AS anomaly, n_blank AS n FROM u UNION ALL SELECT asset_id, 'non_finite', n_non_finite FROM u
UNION ALL SELECT asset_id, b.anomaly, b.n FROM (SELECT asset_id, unnest(broken) AS b FROM u) WHERE b.n > 0""")
def k01_whole_anomalies(spark, sf):
    return audit_whole(spark, sf).anomalies


@query("k02_prove_members", """
WITH a AS (SELECT 'd-' || doc_id AS name, length(text) AS size, sha256(text) AS sha, CASE WHEN source = (SELECT min(source) FROM documents) THEN 'undetermined' ELSE 'proven' END AS identity, doc_id FROM documents),
c AS (SELECT 'd-' || d.doc_id AS name, CASE WHEN d.doc_id % 11 = 0 THEN 'broken' ELSE sha256(CASE WHEN d.doc_id % 7 = 0 THEN text || 'x' ELSE text END) END AS sha, 'd-' || (CASE WHEN d.doc_id % 13 = 0 THEN 0 ELSE d.doc_id END) AS cname FROM documents d WHERE d.doc_id % 5 <> 0),
l AS (SELECT 'd-' || doc_id AS name, n_chars + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS ls FROM documents WHERE doc_id % 19 <> 0),
r AS (SELECT a.name, CASE WHEN c.name IS NULL THEN 'checksum_missing' WHEN c.sha = 'broken' THEN 'checksum_malformed' WHEN cname <> a.name THEN 'checksum_name_mismatch' WHEN c.sha <> a.sha THEN 'digest_mismatch'
 WHEN l.name IS NULL THEN 'not_listed' WHEN ls <> size THEN 'size_mismatch' WHEN identity <> 'proven' THEN 'identity_open' END AS reason FROM a LEFT JOIN c ON a.name = c.name LEFT JOIN l ON a.name = l.name)
SELECT name, reason, CASE WHEN reason IS NULL THEN 'proven' WHEN reason IN ('checksum_missing', 'archive_missing', 'not_listed', 'identity_open') THEN 'undetermined' ELSE 'rejected' END AS status FROM r""")
def k02(spark, sf):
    docs = load(spark, sf, "documents")
    i, name = F.col("doc_id"), F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    archives = docs.select(
        name.alias("name"), F.length("text").alias("size"), S.sha256("text").alias("sha256"),
        (F.col("source") == docs.agg(F.min("source")).scalar()).alias("open"))
    line = F.concat(S.sha256(F.when(i % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))), F.lit("  d-"),
                    F.when(i % 13 == 0, 0).otherwise(i).cast("string"))
    checksums = docs.filter("doc_id % 5 <> 0").select(name.alias("name"), F.when(i % 11 == 0, "broken").otherwise(line).alias("line"))
    listing = docs.filter("doc_id % 19 <> 0").select(name.alias("name"), (F.col("n_chars") + F.when(i % 17 == 0, 1).otherwise(0)).alias("listed_size"))
    return jobs.prove_members(archives, checksums, listing, F.when(F.col("open"), "undetermined").otherwise("proven"))


MEMBER_COUNTS = ["n_rows", "first_key", "last_key", "key_repeat", "key_regression", "time_regression", "date_mismatch", "rule_violation"]
TICK_RULES = RuleSet.freeze([Rule("t1", "price <= 0.2", "price_too_low"), Rule("t2", "qty <= 0", "quantity_not_positive")])
SCAN_SQL = """, s AS (SELECT symbol, CAST(ts AS DATE) AS event_date, trade_id, ts, price, qty, lag(trade_id) OVER w AS pk, lag(ts) OVER w AS pt FROM ticks WINDOW w AS (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY trade_id)),
p AS (SELECT symbol, event_date, count(*) AS n_rows, min(trade_id) AS first_key, max(trade_id) AS last_key, count(*) FILTER (trade_id = pk) AS key_repeat, count(*) FILTER (trade_id < pk) AS key_regression,
 count(*) FILTER (ts < pt) AS time_regression, count(*) FILTER (CAST(ts AS DATE) <> event_date) AS date_mismatch, count(*) FILTER (price <= 0.2 OR qty <= 0) AS rule_violation FROM s GROUP BY ALL),
b AS (SELECT *, CASE WHEN first_key <= max(last_key) OVER (PARTITION BY symbol ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'conflict' ELSE 'ok' END AS boundary_status FROM p),
m AS (SELECT *, CASE WHEN key_repeat + key_regression + time_regression + date_mismatch + rule_violation > 0 OR boundary_status = 'conflict' THEN 'rejected' ELSE 'proven' END AS status FROM b)"""


def scan(spark, sf):
    rows = ticks(spark, sf).withColumn("event_date", F.to_date("ts"))
    return jobs.scan_rows(rows, ["symbol"], "event_date", "trade_id", "trade_id", "ts", TICK_RULES)


@query("k03_scan_members", SCAN_SQL + " SELECT * FROM m", ("ticks",), event_date="VARCHAR")
def k03(spark, sf):
    return scan(spark, sf).members


@query("k03_scan_segments", SCAN_SQL + """ SELECT symbol, min(event_date) AS seg_start, max(event_date) AS seg_end, count(*) AS days FROM
 (SELECT symbol, event_date, event_date - CAST(row_number() OVER (PARTITION BY symbol ORDER BY event_date) AS INTEGER) AS run FROM m WHERE status = 'proven') GROUP BY symbol, run""", ("ticks",), seg_start="VARCHAR", seg_end="VARCHAR")
def k03s(spark, sf):
    return scan(spark, sf).segments


@query("k03_scan_missing", SCAN_SQL + """, g AS (SELECT symbol, event_date FROM m WHERE status = 'proven')
SELECT symbol, day FROM (SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT symbol, min(event_date) AS lo, max(event_date) AS hi FROM g GROUP BY 1)) EXCEPT SELECT symbol, event_date FROM g""", ("ticks",), day="VARCHAR")
def k03m(spark, sf):
    return scan(spark, sf).missing


@query("k03_scan_archives", """
SELECT count(*) AS n_rows, 0::BIGINT AS n_order, count(*) FILTER (price <= 0) AS n_rules FROM ticks""", ("ticks",))
def k03z(spark, sf):
    root, _ = tick_archives(spark, sf)
    rows = archives.parse_trades(archives.read_archive_members(spark, root)).withColumn("day", F.to_date("ts"))
    rules = RuleSet.freeze([Rule("z", "size(reasons) > 0", "bad_row")])
    members = jobs.scan_rows(rows, ["member"], "day", "row_no", "id", "ts", rules, before="before",
                             failed=F.col("archive_reason").isNotNull()).members
    return members.agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("key_repeat") + F.col("key_regression") + F.col("time_regression")).alias("n_order"),
                       F.sum("rule_violation").alias("n_rules"))


@query("k03_archive_members", f"""
, d AS (SELECT symbol, CAST(ts AS DATE) AS day, day(ts) % 7 AS kind, trade_id, epoch_us(ts) // 1000 AS ms, price, min(trade_id) OVER w AS lo, max(trade_id) OVER w AS hi FROM ticks WINDOW w AS (PARTITION BY symbol, CAST(ts AS DATE))),
r AS (SELECT symbol, day, kind, trade_id, copy, ms - CASE WHEN kind = 5 AND trade_id = hi THEN 86400000 ELSE 0 END AS ms, CAST(price AS DECIMAL(18,2)) AS price, CASE WHEN kind = 1 THEN -trade_id ELSE trade_id END AS pos
 FROM d, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR (kind = 2 AND trade_id = lo)),
s AS (SELECT *, lag(trade_id) OVER w AS pk, lag(ms) OVER w AS pt FROM r WINDOW w AS (PARTITION BY symbol, day ORDER BY pos, copy)),
p AS (SELECT symbol, day, kind IN (3, 4) AS broken, count(*) AS n_rows, min(trade_id) AS first_key, max(trade_id) AS last_key, count(*) FILTER (trade_id = pk) AS key_repeat, count(*) FILTER (trade_id < pk) AS key_regression,
 count(*) FILTER (ms < pt) AS time_regression, count(*) FILTER (CAST(make_timestamp(ms * 1000) AS DATE) <> day) AS date_mismatch, count(*) FILTER (price <= 0) AS rule_violation FROM s GROUP BY ALL),
b AS (SELECT *, CASE WHEN NOT broken AND first_key <= max(last_key) FILTER (NOT broken) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'conflict' ELSE 'ok' END AS boundary_status FROM p)
SELECT symbol, 'trades' AS object, day AS member_date, boundary_status, CASE WHEN broken THEN 'failed' WHEN key_repeat + key_regression + time_regression + date_mismatch + rule_violation > 0 OR boundary_status = 'conflict' THEN 'rejected' ELSE 'proven' END AS status,
 {", ".join(f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in MEMBER_COUNTS)} FROM b""", ("ticks",), member_date="VARCHAR")
def k03m_archives(spark, sf):
    root = daily_archives(spark, sf)
    rows = archives.with_identity(archives.parse_trades(archives.read_archive_members(spark, root)))
    rules = RuleSet.freeze([Rule("z", "size(reasons) > 0", "bad_row")])
    group = ["symbol", "object"]
    members = jobs.scan_rows(rows, group, "member_date", "row_no", "id", "ts", rules, before="before",
                             failed=F.col("archive_reason").isNotNull(), unit=[*group, "member_date"]).members
    known = F.col("status") != "failed"
    return members.select(*group, "member_date", "boundary_status", "status", *[F.when(known, F.col(c)).alias(c) for c in MEMBER_COUNTS])


@query("k04_freeze_decide_replay", f""", v AS (SELECT *, source_visible_at > TIMESTAMP '{CUTOFF}' OR collected_at > TIMESTAMP '{CUTOFF}' AS late FROM visibility),
f AS (SELECT l_returnflag, {SUMS_SQL} AS fp FROM (SELECT l_returnflag, sha256('{{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_returnflag":"' || l_returnflag || '"}}') AS s
  FROM v WHERE NOT late) GROUP BY ALL)
SELECT v.l_returnflag, count(*) AS total, count(*) FILTER (NOT late) AS formal, count(*) FILTER (late) AS rejected, 0::BIGINT AS undetermined, fp AS decision_sha, fp AS replay_sha, 'equal' AS replay_status,
 sha256('{CUTOFF}' || chr(10) || 'rules-1') AS intent_sha, 0::BIGINT AS difference FROM v LEFT JOIN f ON v.l_returnflag = f.l_returnflag GROUP BY v.l_returnflag, fp""", ("visibility",))
def k04(spark, sf):
    return jobs.freeze_decide_replay(visibility(spark, sf), visibility(spark, sf), cutoff(), ["l_returnflag"], ["l_orderkey", "l_linenumber"], "rules-1")


@query("k04_replay_differs", f""", v AS (SELECT *, source_visible_at > TIMESTAMP '{CUTOFF}' OR collected_at > TIMESTAMP '{CUTOFF}' AS late FROM visibility)
SELECT l_returnflag, CASE WHEN l_returnflag = 'N' OR count(*) FILTER (NOT late AND l_returnflag = 'R' AND l_linenumber = 7) > 0 THEN 'different' ELSE 'equal' END AS replay_status
FROM v GROUP BY l_returnflag""", ("visibility",))
def k04d(spark, sf):
    first = visibility(spark, sf)
    second = first.filter("l_returnflag <> 'N' AND NOT (l_returnflag = 'R' AND l_linenumber = 7)")
    return jobs.freeze_decide_replay(first, second, cutoff(), ["l_returnflag"], ["l_orderkey", "l_linenumber"], "rules-1").select("l_returnflag", "replay_status")


def frozen(spark, sf, name):
    """The visibility rows as an intent below a new root, and the decision on it."""
    root = fresh_folder(spark, name)
    intent = jobs.freeze(visibility(spark, sf), root, CUTOFF, ["l_returnflag"], ["l_orderkey", "l_linenumber"], "rules-1")
    return root, intent, jobs.decide_frozen(spark, root, intent)


@query("k04_frozen_replay", f""", v AS (SELECT *, source_visible_at > TIMESTAMP '{CUTOFF}' OR collected_at > TIMESTAMP '{CUTOFF}' AS late FROM visibility),
f AS (SELECT l_returnflag, {SUMS_SQL} AS fp FROM (SELECT l_returnflag, sha256('{{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_returnflag":"' || l_returnflag || '"}}') AS s
  FROM v WHERE NOT late) GROUP BY ALL)
SELECT attempt, v.l_returnflag, count(*) AS total, count(*) FILTER (NOT late) AS formal, count(*) FILTER (late) AS rejected, 0::BIGINT AS undetermined, fp AS decision_sha, fp AS replay_sha, 'equal' AS replay_status
FROM v LEFT JOIN f ON v.l_returnflag = f.l_returnflag CROSS JOIN (SELECT unnest([1, 2]) AS attempt) GROUP BY v.l_returnflag, fp, attempt""", ("visibility",))
def k04f(spark, sf):
    """Two proofs, each from the published intent alone."""
    root, _, decided = frozen(spark, sf, "k04f")
    proofs = [sinks.read_batch(spark, root, jobs.prove_frozen(spark, root, decided, n)).select(F.lit(n).alias("attempt"), "*") for n in (1, 2)]
    return proofs[0].unionByName(proofs[1])


@query("k04_altered_batch", """
SELECT 'intent' AS kind, count(*) AS n_stated, count(*) + count(*) FILTER (l_linenumber = 7) AS n_held, CASE WHEN count(*) FILTER (l_linenumber = 7) > 0 THEN 'altered' ELSE 'intact' END AS batch_state, true AS replay_refused FROM visibility
UNION ALL SELECT 'decision', count(DISTINCT l_returnflag), count(DISTINCT l_returnflag), 'intact', true FROM visibility""", ("visibility",))
def k04a(spark, sf):
    """Rows are added to a published intent: it is found altered, its decision is not, and a replay is refused."""
    root, intent, decided = frozen(spark, sf, "k04a")
    folder = sinks.read_manifest(spark, root, intent)["data"]
    sinks.read_batch(spark, root, intent).where("l_linenumber = 7").write.mode("append").parquet(f"{root}/batch_id={intent}/{folder}")
    try:
        jobs.prove_frozen(spark, root, decided, 1)
        refused = False
    except sinks.BatchAltered:
        refused = True
    states = jobs.batch_state(spark, root, intent).unionByName(jobs.batch_state(spark, root, decided))
    return states.withColumn("replay_refused", F.lit(refused))


LEAF_SQL = f""", {GATE_VIEW},
w AS (SELECT symbol, scale_h, gate, i FROM (SELECT DISTINCT symbol FROM members) CROSS JOIN (SELECT unnest([4, 8, 24, 48]) AS scale_h) CROSS JOIN (SELECT unnest(['identity', 'time', 'quality', 'coverage']) AS gate, unnest([0, 1, 2, 3]) AS i)),
lv AS (SELECT w.symbol, w.scale_h, count(*) FILTER (ok) AS gates_passed, CASE WHEN bool_and(ok) THEN 'pass' ELSE 'blocked' END AS verdict, arg_min(w.gate, w.i) FILTER (NOT ok) AS first_gate
 FROM (SELECT w.*, coalesce(g.state = 'pass' OR (w.gate = 'quality' AND w.scale_h = 4), w.gate = 'quality' AND w.scale_h = 4) AS ok FROM w LEFT JOIN g ON w.symbol = g.symbol AND w.gate = g.gate) w GROUP BY 1, 2)"""


def gate(spark, sf):
    scales = [4, 8, 24, 48]
    leaves = C.leaf_grid(members(spark, sf).select("symbol"), scales)
    gates = C.with_grid(gate_rows(spark, sf), scale_h=scales).withColumn(
        "state", F.when((F.col("gate") == "quality") & (F.col("scale_h") == 4), "pass").otherwise(F.col("state")))
    return jobs.final_gate(leaves, gates, "symbol", ["symbol", "scale_h"], GATES)


@query("k05_final_gate", LEAF_SQL + " SELECT * FROM lv", ("members",))
def k05(spark, sf):
    return gate(spark, sf).leaves


@query("k05_symbol_floor", LEAF_SQL + " SELECT symbol, CASE WHEN bool_and(verdict = 'pass') THEN 'pass' ELSE 'blocked' END AS verdict, count(*) AS n_units FROM lv GROUP BY 1", ("members",))
def k05f(spark, sf):
    return gate(spark, sf).floors


@query("k05_next_gap", LEAF_SQL + """ SELECT first_gate AS reason, 'prove_' || first_gate AS "release", count(*) AS n_gates, count(*) AS n_leaves FROM lv WHERE verdict <> 'pass' GROUP BY 1 ORDER BY n_gates DESC, reason LIMIT 1""", ("members",))
def k05g(spark, sf):
    return gate(spark, sf).gap


@query("k06_lifecycle_evidence", """
WITH s AS (SELECT l_returnflag AS symbol, l_discount > 0 AND l_tax > 0 AND l_quantity >= 4 AS valid, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey DESC) AS rn
 FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-15 00:00:00'),
g AS (SELECT symbol, kind, clock, CASE WHEN kind LIKE 'passive%' THEN 'canceled' WHEN valid THEN 'filled' ELSE 'unknown' END AS t FROM s CROSS JOIN (SELECT unnest(['buy', 'sell']) AS side)
 CROSS JOIN (SELECT unnest(['aggressive_market', 'aggressive_limit', 'passive_limit_cancel']) AS kind) CROSS JOIN (SELECT unnest(['baseline', 'stress']) AS clock) WHERE rn <= 256)
SELECT symbol, kind, clock, count(*) FILTER (t = 'filled') AS n_filled, count(*) FILTER (t = 'canceled') AS n_canceled, count(*) FILTER (t = 'unknown') AS n_unknown, count(*) AS n_all, 0::BIGINT AS illegal_steps FROM g GROUP BY ALL""")
def k06(spark, sf):
    book_rows = books(spark, sf).select(
        F.col("l_returnflag").alias("symbol"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10_000_000 + F.col("l_partkey")).alias("snapshot_id"),
        F.col("l_shipdate").alias("capture_ts"), F.col("l_shipdate").alias("event_ts"), "bids", "asks")
    return jobs.lifecycle_evidence(book_rows, 256, cutoff())


@query("k07_missing_data_audit", """
, c AS (SELECT grp, CAST(sum(days) AS BIGINT) AS days_covered, CAST(max(seg_end) - min(seg_start) + 1 - sum(days) AS BIGINT) AS days_missing, count(*) AS n_segments, max(days) AS longest_segment, max(seg_end) - min(seg_start) + 1 = sum(days) AS research_ready FROM segs GROUP BY 1),
o AS (SELECT o_orderpriority AS grp, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS n_rows, count(*) AS population, count(*) FILTER (o_orderstatus IN ('F', 'O', 'P')) AS in_states,
 count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) AS difference FROM orders GROUP BY 1)
SELECT c.*, '1' AS version, first_ts, last_ts, n_rows, population, in_states, difference, CASE WHEN difference = 0 AND days_missing = 0 THEN 'complete' ELSE 'gaps' END AS audit_status FROM c JOIN o ON c.grp = o.grp""", ("segs",))
def k07(spark, sf):
    rows = load(spark, sf, "orders").select(F.col("o_orderpriority").alias("grp"), "o_orderdate", "o_orderstatus")
    return jobs.missing_data_audit(rows, ["grp"], "o_orderdate", "o_orderstatus", ["F", "O", "P"])


@query("k08_cost_evidence", """
WITH b AS (SELECT l_returnflag AS symbol, CASE WHEN l_linenumber <= 3 THEN 4 ELSE 8 END AS scale_h, l_tax AS fee, CASE WHEN l_returnflag <> 'N' OR l_linenumber <= 3 THEN l_discount END AS funding,
 CASE WHEN (l_extendedprice + l_tax) * (l_quantity + 1) + (l_extendedprice + 2 * l_tax) * (l_quantity + 2) + (l_extendedprice + 3 * l_tax) * (l_quantity + 3) >= 5000 THEN 1 END AS depth FROM lineitem),
k AS (SELECT symbol, scale_h, count(*) AS n, count(fee) AS fee, count(funding) AS funding, count(*) AS spread, count(depth) AS depth FROM b GROUP BY ALL),
g AS (SELECT symbol, scale_h FROM (SELECT DISTINCT l_returnflag AS symbol FROM lineitem) CROSS JOIN (SELECT unnest([4, 8, 24]) AS scale_h)),
j AS (SELECT g.symbol, g.scale_h, coalesce(n > 0 AND fee = n, false) AS a, coalesce(n > 0 AND funding = n, false) AS b, coalesce(n > 0 AND spread = n, false) AS c, coalesce(n > 0 AND depth = n, false) AS d FROM g LEFT JOIN k ON g.symbol = k.symbol AND g.scale_h = k.scale_h)
SELECT symbol, scale_h, CAST(a AS BIGINT) + CAST(b AS BIGINT) + CAST(c AS BIGINT) + 2 * CAST(d AS BIGINT) AS gates_passed, CASE WHEN a AND b AND c AND d THEN 'pass' ELSE 'blocked' END AS verdict,
 CASE WHEN NOT a THEN 'fee' WHEN NOT b THEN 'funding' WHEN NOT c THEN 'spread' WHEN NOT d THEN 'depth' END AS first_gate FROM j""")
def k08(spark, sf):
    from plumbline.contracts import COST_COMPONENTS
    lines = load(spark, sf, "lineitem")
    small = F.col("l_linenumber") <= 3
    rows = books(spark, sf).select(
        F.col("l_returnflag").alias("symbol"), F.when(small, 4).otherwise(8).alias("scale_h"), F.col("l_tax").alias("fee"),
        F.when((F.col("l_returnflag") != "N") | small, F.col("l_discount")).alias("funding"), "bids", "asks")
    grid = C.leaf_grid(lines.select(F.col("l_returnflag").alias("symbol")), [4, 8, 24])
    return jobs.cost_evidence(rows, grid, ["symbol", "scale_h"], 5000.0, COST_COMPONENTS)


@query("k09_session_study", BREAK_SQL + f""", o AS (SELECT a.*, n.close AS outcome FROM (SELECT *, bar_ts + INTERVAL 4 HOUR AS target FROM k) a ASOF LEFT JOIN bars_1h n ON a.symbol = n.symbol AND a.target <= n.bar_ts),
z AS (SELECT *, {session_sql('bar_ts')} AS session, CASE break_side WHEN 'up' THEN next_min <= range_high WHEN 'down' THEN next_max >= range_low END AS false_break FROM o)
SELECT symbol, session, count(*) AS n_bars, count(outcome) AS n_known,
 round(avg(CAST(outcome > close AS DOUBLE)), 6) AS hit_rate, round(stddev_samp(ln(CAST(outcome AS DOUBLE) / CAST(close AS DOUBLE))), 6) AS volatility, count(break_side) AS n_breaks, count(*) FILTER (false_break) AS n_false_breaks FROM z GROUP BY ALL""", ("bars_1h",))
def k09(spark, sf):
    out = jobs.session_study(bars(spark, sf), 240)
    return out.withColumn("hit_rate", F.round("hit_rate", 6)).withColumn("volatility", F.round("volatility", 6))


STUDY_SQL = RECURSIVE + VOL_SQL + VOLUME_SQL + BODY_SQL + OI_SQL + BREAK_SQL + """,
x AS (SELECT k.symbol, k.bar_ts, k.close, k.taker_buy, k.taker_sell, k.break_side, CASE WHEN break_side = 'up' AND next_n = 3 THEN next_low > range_high END AS retest_held, volume_ratio, oi_turned_up, oi_step,
 CAST(coalesce(volume_ratio < 1, false) AS INT) + CAST(coalesce(volatility_falling, false) AS INT) + CAST(coalesce(br < bm, false) AS INT) + CAST(coalesce(abs(macd) <= atr * 0.25, false) AS INT) + CAST(coalesce(oi_change <= 0, false) AS INT) AS met
 FROM k JOIN vol ON vol.symbol = k.symbol AND vol.bar_ts = k.bar_ts JOIN vr ON vr.symbol = k.symbol AND vr.bar_ts = k.bar_ts JOIN body ON body.symbol = k.symbol AND body.bar_ts = k.bar_ts
 JOIN g ON g.symbol = k.symbol AND g.bar_ts = k.bar_ts JOIN oc ON oc.symbol = k.symbol AND oc.bar_ts = k.bar_ts),
y AS (SELECT *, met >= 3 AS compressed, coalesce(volume_ratio > 1, false) AS qualified, coalesce(break_side = 'up' AND volume_ratio > 1 AND taker_buy > taker_sell AND oi_turned_up AND retest_held, false) AS l,
 coalesce(break_side = 'down' AND volume_ratio > 1 AND taker_sell > taker_buy AND oi_step > 0, false) AS s FROM x),
y2 AS (SELECT *, sum(CASE WHEN compressed AND NOT pc THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY bar_ts) AS run FROM (SELECT *, coalesce(lag(compressed) OVER (PARTITION BY symbol ORDER BY bar_ts), false) AS pc FROM y)),
y3 AS (SELECT *, NOT compressed AND qualified AND run > 0 AS cand FROM y2),
y4 AS (SELECT *, cand AND bar_ts = min(bar_ts) FILTER (cand) OVER (PARTITION BY symbol, run) AS is_first_release, CASE WHEN l AND NOT s THEN 'long' WHEN s AND NOT l THEN 'short' ELSE 'none' END AS direction FROM y3)"""


@query("k10_compression_features", STUDY_SQL + " SELECT symbol, bar_ts, met, compressed, direction, is_first_release FROM y4", ("bars_1h", "oi"))
def k10(spark, sf):
    rows = materialise(bars(spark, sf), "bars")
    return jobs.compression_features(rows, oi(rows), needed=3).select("symbol", "bar_ts", "met", "compressed", "direction", "is_first_release")


@query("k10_compression_study", STUDY_SQL + """ SELECT a.symbol, compressed, is_first_release, count(*) AS n, count(n.close) AS denominator, count(*) - count(n.close) AS n_unknown, count(*) FILTER (n.close > a.close) AS n_hit,
 round(avg(CAST(n.close > a.close AS DOUBLE)), 6) AS rate FROM (SELECT *, bar_ts + INTERVAL 4 HOUR AS target FROM y4) a ASOF LEFT JOIN bars_1h n ON a.symbol = n.symbol AND a.target <= n.bar_ts GROUP BY ALL""", ("bars_1h", "oi"))
def k10s(spark, sf):
    rows = materialise(bars(spark, sf), "bars")
    return jobs.compression_study(rows, oi(rows), 240, needed=3).withColumn("rate", F.round("rate", 6))


@query("k10_run_length_outcomes", STUDY_SQL + """,
len_runs AS (SELECT symbol, run, count(*) FILTER (compressed) AS run_length, max(bar_ts) = max(bar_ts) FILTER (compressed) AS censored, min(bar_ts) FILTER (is_first_release) AS released FROM y4 WHERE run > 0 GROUP BY symbol, run),
len_rel AS (SELECT lr.*, b.open, b.close, released + INTERVAL 4 HOUR AS target FROM len_runs lr LEFT JOIN bars_1h b ON b.symbol = lr.symbol AND b.bar_ts = lr.released),
len_out AS (SELECT q.*, n.close AS later FROM len_rel q ASOF LEFT JOIN bars_1h n ON q.symbol = n.symbol AND q.target <= n.bar_ts)
SELECT symbol, run_length, censored, count(*) AS n_runs, count(released) AS n_released, count(later) AS n_known,
 count(*) FILTER ((later > close AND close > open) OR (later < close AND close < open)) AS n_continued,
 round(avg(CASE WHEN later IS NOT NULL THEN CAST((later > close AND close > open) OR (later < close AND close < open) AS DOUBLE) END), 6) AS rate FROM len_out GROUP BY ALL""", ("bars_1h", "oi"))
def k10r(spark, sf):
    rows = materialise(bars(spark, sf), "bars")
    marked = materialise(jobs.compression_features(rows, oi(rows), needed=3), "features")
    return jobs.run_length_outcomes(marked, 240).withColumn("rate", F.round("rate", 6))


@query("k11_decision_card", """
, j AS (SELECT symbol, event_date, n_rows, CASE WHEN NOT n_rows > 40 THEN 'data' WHEN NOT n_rows > 50 THEN 'sample' WHEN NOT first_id % 2 = 0 THEN 'edge' WHEN NOT last_id % 3 <> 0 THEN 'cost' END AS reason FROM members),
p AS (SELECT symbol, event_date, CAST(row_number() OVER (PARTITION BY event_date ORDER BY n_rows DESC, symbol) AS INTEGER) AS rank FROM j WHERE reason IS NULL)
SELECT j.event_date, j.symbol, j.n_rows, reason IS NULL AS allowed, reason, CASE WHEN rank <= 2 THEN rank END AS rank, CASE WHEN rank <= 2 THEN 1 ELSE 0 END AS size FROM j LEFT JOIN p ON j.symbol = p.symbol AND j.event_date = p.event_date""", ("members",), event_date="VARCHAR")
def k11(spark, sf):
    c, yes = F.col, F.lit(True)
    gates = {"data": c("n_rows") > 40, "sample": c("n_rows") > 50, "edge": c("first_id") % 2 == 0, "cost": c("last_id") % 3 != 0,
             "risk": yes, "execution": yes, "discipline": yes}
    cand = members(spark, sf).select("symbol", "event_date", "n_rows", "first_id", "last_id")
    return jobs.decision_card(cand, gates, "event_date", "n_rows", "symbol").drop("first_id", "last_id")
