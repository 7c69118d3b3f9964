"""Queries for selections, joins and aggregates (groups A to D)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scalars as S
from plumbline.operators import aggregates as D
from plumbline.operators import filters as B
from plumbline.operators import joins as C
from plumbline.operators import structure
from plumbline.operators import windows as E
from plumbline.rules import Rule, RuleSet
from plumbline.session import fresh_folder, materialise
from plumbline.sources import archives, catalog, files, sinks
from registry.base import bars, load, members, oi, order_days, query, session_sql, ticks, visibility

CUTOFF = "1998-06-15 00:00:00"


def cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


# ---- A ----
@query("a01_file_inventory")
def a01(spark, sf):
    return files.file_inventory(spark, [sf]).select("format", "bytes").groupBy("format").agg(
        F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"))


def order_lines(spark, sf):
    """The orders as delimited text with blank, short and unparsable lines, written by Spark."""
    k = F.col("o_orderkey")
    good = F.concat_ws(",", k.cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    line = F.when(k % 50 == 0, "").when(k % 51 == 0, k.cast("string")).when(k % 52 == 0, F.concat(F.lit("x"), good)).otherwise(good)
    path = fresh_folder(spark, "order-lines")
    load(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return path


LINE_CASE = "CASE WHEN o_orderkey % 50 = 0 THEN 'blank' WHEN o_orderkey % 51 = 0 THEN 'short' WHEN o_orderkey % 52 = 0 THEN 'text' ELSE 'good' END"


@query("a02_delimited_strict", f"""
SELECT line_class, count(*) AS n, count(o_custkey) AS n_cust, CAST(sum(o_custkey) AS BIGINT) AS sum_cust FROM
 (SELECT CASE {LINE_CASE} WHEN 'good' THEN 'ok' WHEN 'blank' THEN 'blank' ELSE 'malformed' END AS line_class, CASE WHEN {LINE_CASE} IN ('good', 'text') THEN o_custkey END AS o_custkey
  FROM orders) GROUP BY 1""")
def a02(spark, sf):
    fields = T.StructType([T.StructField("k", T.LongType()), T.StructField("c", T.LongType()), T.StructField("s", T.StringType())])
    rows = files.read_delimited_strict(spark, order_lines(spark, sf), fields)
    return rows.groupBy("line_class").agg(F.count("*").alias("n"), F.count("c").alias("n_cust"), F.sum("c").alias("sum_cust"))


@query("a02_delimited_counts", f"""
SELECT count(*) AS n_lines, count(*) FILTER ({LINE_CASE} = 'blank') AS n_blank_lines, count(*) FILTER ({LINE_CASE} = 'short') AS n_wrong_width, 0::BIGINT AS n_blank_fields FROM orders""")
def a02c(spark, sf):
    fields = T.StructType([T.StructField(c, T.StringType()) for c in "kcs"])
    counts = files.delimited_counts(spark, order_lines(spark, sf), fields)  # one row per file
    return counts.agg(*[F.sum(c).alias(c) for c in ("n_lines", "n_blank_lines", "n_wrong_width", "n_blank_fields")])


def event_text():
    m, k = F.col("user_id") % 5, F.col("event_id").cast("string")
    return F.when(m == 0, " ").when(m == 1, F.concat(F.lit("["), k, F.lit("]"))).when(m == 2, F.concat(F.lit('{"k": '), k)).otherwise(F.col("props"))


@query("a03_json_classes", """
SELECT CASE user_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'non_object' WHEN 2 THEN 'illegal' ELSE 'object' END AS json_class, count(*) AS n FROM events GROUP BY 1""")
def a03(spark, sf):
    return load(spark, sf, "events").groupBy(files.json_class(event_text()).alias("json_class")).agg(F.count("*").alias("n"))


@query("a03_jsonl_counts", """
SELECT event_type, count(*) AS n_lines, count(*) FILTER (user_id % 5 > 2) AS n_object, count(*) FILTER (user_id % 5 = 0) AS n_blank, count(*) FILTER (user_id % 5 = 2) AS n_illegal, count(*) FILTER (user_id % 5 = 1) AS n_non_object,
 count(*) FILTER (user_id % 5 > 2) - count(DISTINCT props) FILTER (user_id % 5 > 2) AS n_duplicate FROM events GROUP BY 1""")
def a03c(spark, sf):
    path = fresh_folder(spark, "event-lines")
    load(spark, sf, "events").select("event_type", event_text().alias("value")).write.partitionBy("event_type").text(path)
    counts = files.jsonl_counts(spark, path, unit=F.regexp_extract("file", "event_type=([^/]+)/", 1))
    return counts.withColumnRenamed("file", "event_type")


def tick_archives(spark, sf):
    """The ticks as ZIP archives of bounded size, written by the tasks that hold the rows."""
    root = fresh_folder(spark, "tick-archives")
    k = F.get_json_object("props", "$.k").cast("bigint")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("value").cast("decimal(18,2)").cast("string"), (k + 1).cast("string"), F.lit("1"),
                       F.floor(us / 1000).cast("string"), F.when(k % 2 == 0, "true").otherwise("false"))
    lines = load(spark, sf, "events").select(line.alias("line"))
    written = lines.mapInPandas(archives.line_archives(root), archives.WRITTEN_SCHEMA)
    return root, materialise(written, "archive-list")


def _one_archive_a_name(root):
    """Writer for `mapInPandas` over rows sorted by (name, position): a member is streamed into its archive while its rows last."""
    def write(batches):
        system, place = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        system.create_dir(place, recursive=True)
        name, packed, archive, member = None, None, None, None

        def close(damage):
            member.close()
            archive.close()
            content = bytearray(packed.getvalue())
            if damage == 3:  # the middle of the packed rows, which follow a head of 30 bytes and the file name
                content[30 + len(f"{name}.csv") + archive.infolist()[0].compress_size // 2] ^= 255
            with system.open_output_stream(f"{place}/{name}.zip") as out:
                out.write(bytes(content[: len(content) // 2] if damage == 4 else content))

        damage = 0
        for batch in batches:
            for key, rows in batch.groupby("name", sort=False):
                if key != name:
                    if name is not None:
                        close(damage)
                        yield pd.DataFrame({"name": [name]})
                    name, damage, packed = key, rows["kind"].iloc[0], io.BytesIO()
                    archive = zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED)
                    member = archive.open(f"{name}.csv", "w")
                member.write(("\n".join(rows["line"]) + "\n").encode())
        if name is not None:
            close(damage)
            yield pd.DataFrame({"name": [name]})

    return write


def daily_archives(spark, sf):
    """The ticks as one archive per symbol and day, named after both. By day of the month modulo 7: 1 the rows run backwards,
    2 the first row comes twice, 3 a byte is damaged, 4 the file is cut short, 5 the last row is of the day before."""
    root = fresh_folder(spark, "daily-archives")
    rows = ticks(spark, sf).select("symbol", "trade_id", "ts", "qty", F.col("price").cast("decimal(18,2)").alias("price"), "buyer_maker",
                                   F.to_date("ts").alias("day"), (F.dayofmonth("ts") % 7).alias("kind"))
    ends = rows.groupBy("symbol", "day").agg(F.min("trade_id").alias("lo"), F.max("trade_id").alias("hi"))
    copies = F.when((F.col("kind") == 2) & (F.col("trade_id") == F.col("lo")), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000) - F.when((F.col("kind") == 5) & (F.col("trade_id") == F.col("hi")), 86_400_000).otherwise(0)
    line = F.concat_ws(",", F.col("trade_id").cast("string"), F.col("price").cast("string"), F.col("qty").cast("string"), F.lit("1"),
                       ms.cast("bigint").cast("string"), F.when(F.col("buyer_maker"), "true").otherwise("false"))
    lines = rows.join(ends, ["symbol", "day"]).withColumn("copy", F.explode(copies)).select(
        F.concat_ws("-", "symbol", F.lit("trades"), F.col("day").cast("string")).alias("name"), "kind", "copy", line.alias("line"),
        F.when(F.col("kind") == 1, -F.col("trade_id")).otherwise(F.col("trade_id")).alias("pos"))
    written = lines.repartition("name").sortWithinPartitions("name", "pos", "copy").mapInPandas(_one_archive_a_name(root), "name string")
    materialise(written, "archive-list")
    return root


@query("a04_archive_members", """
SELECT symbol_free AS is_buyer_maker, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(price) AS DOUBLE) AS price, min(make_timestamp((epoch_us(ts) // 1000) * 1000)) AS first_ts, count(*) FILTER (price <= 0) AS n_bad
FROM (SELECT *, buyer_maker AS symbol_free FROM ticks) GROUP BY 1""", ("ticks",))
def a04(spark, sf):
    root, _ = tick_archives(spark, sf)
    rows = archives.parse_trades(archives.read_archive_members(spark, root))
    return rows.groupBy("is_buyer_maker").agg(
        F.count("*").alias("n"), F.sum("qty").cast("bigint").alias("qty"), F.sum(F.col("price").cast("decimal(18,6)")).cast("double").alias("price"),
        F.min("ts").cast("timestamp_ntz").alias("first_ts"), F.count_if(F.size("reasons") > 0).alias("n_bad"))


@query("a04_aggregate_trades", """
SELECT CASE WHEN qty = 51 THEN 'id_syntax' WHEN qty = 52 THEN 'field_count,boolean_syntax,trade_id_order' WHEN (qty - 1) % 3 = 0 THEN 'trade_id_order' ELSE '' END AS reasons,
 count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty, min(trade_id) AS first_id, count(*) FILTER (buyer_maker AND qty <> 52) AS n_maker FROM ticks GROUP BY 1""", ("ticks",))
def a04a(spark, sf):
    root = fresh_folder(spark, "aggregate-archives")
    k, first = F.col("qty") - 1, F.col("trade_id") * 2
    last = F.when(k == 50, "x").otherwise((first + k % 3 - 1).cast("string"))  # reversed in every third row
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("string")
    cells = [*[F.col(c).cast("string") for c in ("trade_id", "price", "qty")], first.cast("string"), last, ms]
    line = F.concat_ws(",", *cells, F.when(k != 51, F.col("buyer_maker").cast("string")))  # one field is missing where it is null
    materialise(ticks(spark, sf).select(line.alias("line")).mapInPandas(archives.line_archives(root), archives.WRITTEN_SCHEMA), "archive-list")
    rows = archives.parse_trades(archives.read_archive_members(spark, root, archives.AGG_TRADE_FIELDS), archives.AGG_TRADE_FIELDS)
    return rows.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(
        F.count("*").alias("n"), F.sum("qty").cast("bigint").alias("qty"), F.min("id").alias("first_id"), F.count_if("is_buyer_maker").alias("n_maker"))


@query("j02_member_rows", "SELECT count(*) AS n_rows, 0::BIGINT AS n_uneven FROM events")
def j02(spark, sf):
    root, written = tick_archives(spark, sf)
    seen = archives.read_archive_members(spark, root).groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(
        F.count("row_no").alias("n"), F.max("row_no").alias("last"))
    both = written.join(seen, "name", "full_outer")
    ok = (F.col("n") == F.col("n_lines")) & (F.col("last") == F.col("n_lines") - 1)
    return both.agg(F.sum("n").alias("n_rows"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_uneven"))


@query("a05_catalog_metadata", """
SELECT 'orders' AS "table", 'o_orderkey' AS "column", 'bigint' AS type, 0 AS position, count(*) AS n_rows FROM orders
UNION ALL SELECT 'orders', 'o_custkey', 'bigint', 1, count(*) FROM orders
UNION ALL SELECT 'orders', 'o_orderstatus', 'string', 2, count(*) FROM orders
UNION ALL SELECT 'orders', 'o_totalprice', 'double', 3, count(*) FROM orders
UNION ALL SELECT 'orders', 'o_orderdate', 'timestamp_ntz', 4, count(*) FROM orders
UNION ALL SELECT 'orders', 'o_orderpriority', 'string', 5, count(*) FROM orders
UNION ALL SELECT 'labels', 'doc_id', 'bigint', 0, count(*) FROM labels
UNION ALL SELECT 'labels', 'quality', 'int', 1, count(*) FROM labels
UNION ALL SELECT 'labels', 'toxic', 'int', 2, count(*) FROM labels""")
def a05(spark, sf):
    frames = {t: load(spark, sf, t) for t in ("orders", "labels")}
    return catalog.catalog_metadata(spark, frames).select("table", "column", "type", "position", "n_rows")


@query("a06_scan_bounded", """
SELECT event_id, ts, user_id FROM events WHERE event_type = 'view'
AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'""")
def a06(spark, sf):
    return catalog.scan_bounded(load(spark, sf, "events"), ("event_type", "view"), "ts",
                                "2024-01-05 00:00:00", "2024-01-06 00:00:00", ["event_id", "ts", "user_id"])


@query("a07_publish_batch", "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1")
def a07(spark, sf):
    root = fresh_folder(spark, "batches")
    sinks.publish_batch(load(spark, sf, "events").select("event_id", "event_type"), root, "b1", {"rule_version": "1"})
    return sinks.read_batch(spark, root, "b1").groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query("a08_safe_text", """
SELECT doc_id, sha256(CASE WHEN regexp_matches(text, '^[=+\\-@\\t\\r]') THEN '''' || text ELSE text END) AS safe_sha FROM documents""")
def a08(spark, sf):
    return sinks.safe_projection(load(spark, sf, "documents"), ["doc_id", "text"]).select(
        "doc_id", S.sha256("text").alias("safe_sha"))


@query("a09_missing_objects", """
SELECT p.p_partkey AS partkey, m.ship_month FROM part p CROSS JOIN
 (SELECT CAST(y AS VARCHAR) || '-' || lpad(CAST(i AS VARCHAR), 2, '0') AS ship_month FROM generate_series(1992, 1998) AS t(y), generate_series(1, 12) AS s(i)) m
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND strftime(l.l_shipdate, '%Y-%m') = m.ship_month)""")
def a09(spark, sf):
    have = load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("partkey"), F.date_format("l_shipdate", "yyyy-MM").alias("ship_month")).distinct()
    listing = C.with_grid(load(spark, sf, "part").select(F.col("p_partkey").alias("partkey")), ship_month=[f"{y}-{m:02d}" for y in range(1992, 1999) for m in range(1, 13)])
    return catalog.missing_objects(listing, have, ["partkey", "ship_month"])


# ---- B ----
@query("b01_select_units", """
SELECT o_orderstatus AS kind, o_orderpriority AS format, count(*) AS n FROM orders
WHERE NOT (o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')) GROUP BY ALL
UNION ALL SELECT 'unit', 'unit', count(*) FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')""")
def b01(spark, sf):
    units, rest = B.select_units(
        load(spark, sf, "orders").select(F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("format")),
        ["F", "O"], ["1-URGENT", "2-HIGH", "5-LOW"], "kind", "format")
    one = units.agg(F.lit("unit").alias("kind"), F.lit("unit").alias("format"), F.count("*").alias("n"))
    return rest.unionByName(one)


@query("b02_check_inventory", """
WITH inv AS (SELECT l_orderkey * 10 + l_linenumber AS asset_id, l_returnflag AS batch, l_linestatus AS format,
  CASE WHEN l_linenumber = 1 THEN 'data/x' WHEN l_linenumber = 2 THEN '/srv/a/../b' WHEN l_linenumber = 3 THEN '/etc/x' ELSE '/srv/a/x' END AS location FROM lineitem),
c AS (SELECT *, count(*) OVER (PARTITION BY asset_id) AS n, min(batch) OVER () AS b0 FROM inv)
SELECT asset_id, batch, format, location, concat_ws(',', CASE WHEN n > 1 THEN 'duplicate_id' END, CASE WHEN batch <> b0 THEN 'second_batch' END,
  CASE WHEN format <> 'F' THEN 'bad_format' END, CASE WHEN location NOT LIKE '/%' THEN 'relative_path' END,
  CASE WHEN location LIKE '%/../%' THEN 'path_escape' END, CASE WHEN location NOT LIKE '/srv/%' THEN 'outside_roots' END) AS reasons FROM c""")
def b02(spark, sf):
    n = F.col("l_linenumber")
    path = F.when(n == 1, "data/x").when(n == 2, "/srv/a/../b").when(n == 3, "/etc/x").otherwise("/srv/a/x")
    inv = load(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + n).alias("asset_id"), F.col("l_returnflag").alias("batch"),
        F.col("l_linestatus").alias("format"), path.alias("location"))
    checked = B.check_inventory(inv, ["asset_id", "format"], "asset_id", "batch", ["F"], "format", "location", ["/srv"])
    return checked.withColumn("reasons", F.concat_ws(",", "reasons"))


CUSTOMER_RULES = RuleSet.freeze([
    Rule("r1", "c_acctbal <= 0", "balance_not_positive"),
    Rule("r2", "c_nationkey < 0 OR c_nationkey > 20", "nation_out_of_range"),
])


@query("b03_domain_rules", """
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal <= 0 THEN 'balance_not_positive' END,
 CASE WHEN c_nationkey < 0 OR c_nationkey > 20 THEN 'nation_out_of_range' END) AS reasons FROM customer""")
def b03(spark, sf):
    return B.domain_rules(load(spark, sf, "customer"), CUSTOMER_RULES).select(
        "c_custkey", F.concat_ws(",", "reasons").alias("reasons"))


@query("b04_visible_at", f"""
SELECT l_orderkey, l_linenumber, source_visible_at FROM visibility
WHERE source_visible_at <= TIMESTAMP '{CUTOFF}' AND collected_at <= TIMESTAMP '{CUTOFF}'""", ("visibility",))
def b04(spark, sf):
    return B.visible_at(visibility(spark, sf), cutoff()).select("l_orderkey", "l_linenumber", "source_visible_at")


@query("b05_label_visibility", f"""
SELECT l_returnflag, CASE WHEN source_visible_at > TIMESTAMP '{CUTOFF}' OR collected_at > TIMESTAMP '{CUTOFF}'
 THEN 'time_boundary_rejected' ELSE 'visible' END AS visibility, count(*) AS n FROM visibility GROUP BY ALL""", ("visibility",))
def b05(spark, sf):
    return B.label_visibility(visibility(spark, sf), cutoff()).groupBy("l_returnflag", "visibility").agg(F.count("*").alias("n"))


@query("b06_scope_filter", """
SELECT symbol, symbol IN ('purchase', 'view') AS in_scope, count(*) AS n FROM ticks GROUP BY ALL""", ("ticks",))
def b06(spark, sf):
    return B.label_scope(ticks(spark, sf), ["purchase", "view"]).groupBy("symbol", "in_scope").agg(F.count("*").alias("n"))


@query("b07_is_fresh", """
SELECT event_id, coalesce(p <= ts AND ts - p <= INTERVAL 1 HOUR, false) AS fresh FROM
 (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)""")
def b07(spark, sf):
    from plumbline.ordering import prior
    seen = prior(load(spark, sf, "events").select("event_id", "ts", "user_id"), ["user_id"], [F.col("event_id")], ["ts"])
    return seen.select("event_id", B.is_fresh(F.col("prior")["ts"], F.col("ts")).alias("fresh"))


@query("b08_inside_segment", """
SELECT o_orderkey, grp, o.day, coalesce(o.day - 30 >= seg_start, false) AS inside FROM
 (SELECT o_orderkey, o_orderpriority AS grp, CAST(o_orderdate AS DATE) AS day FROM orders) o
 JOIN segs USING (grp) WHERE o.day BETWEEN seg_start AND seg_end""", ("segs",), day="VARCHAR")
def b08(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("grp"), F.to_date("o_orderdate").alias("day"))
    return B.inside_segment(rows, E.segments(order_days(spark, sf), ["grp"], "day"), ["grp"], "day", 30).select(
        "o_orderkey", "grp", "day", "inside")


@query("b09_project_allowed", "SELECT c_custkey, c_mktsegment FROM customer")
def b09(spark, sf):
    return B.project_allowed(load(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])


@query("b10_check_scale", """
SELECT role, minutes, CASE WHEN role = 'user' THEN (CASE WHEN minutes IN (15, 60) THEN 'reject_observation_window'
  WHEN minutes IN (240, 480, 1440, 2880) THEN 'accept' ELSE 'reject_unknown_scale' END)
  WHEN role = 'assistant' AND minutes IN (15, 60, 240, 480, 1440, 2880) THEN 'accept' ELSE 'reject_unknown_scale' END AS scale_verdict, count(*) AS n
FROM (SELECT role, CAST(15 * (1 + turn % 4) * (CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 16 END) AS BIGINT) AS minutes FROM conversations) GROUP BY ALL""")
def b10(spark, sf):
    minutes = 15 * (1 + F.col("turn") % 4) * F.when(F.col("conv_id") % 2 == 0, 1).otherwise(16)
    use = F.when(F.col("role") == "user", "state").when(F.col("role") == "assistant", "outcome")
    rows = load(spark, sf, "conversations").select("role", minutes.alias("minutes"), use.alias("use"))
    return B.check_scale(rows, "use", "minutes").groupBy("role", "minutes", "scale_verdict").agg(F.count("*").alias("n"))


# ---- C ----
@query("c01_pair_files", """
SELECT k AS name, coalesce(a, 0) AS left_n, coalesce(b, 0) AS right_n, CASE WHEN b IS NULL THEN 'right_missing' WHEN a IS NULL THEN 'left_missing'
 WHEN a > 1 OR b > 1 THEN 'not_unique' ELSE 'paired' END AS pair_status FROM
 (SELECT coalesce(o.k, l.k) AS k, a, b FROM (SELECT o_orderkey AS k, count(*) AS a FROM orders GROUP BY 1) o
  FULL JOIN (SELECT l_orderkey AS k, count(*) AS b FROM lineitem GROUP BY 1) l ON o.k = l.k)""")
def c01(spark, sf):
    return C.pair_files(load(spark, sf, "orders").select(F.col("o_orderkey").alias("name")),
                        load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("name")), ["name"])


@query("c02_match_listing", """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'not_listed' WHEN length(d.text) = l.n THEN 'match' ELSE 'size_mismatch' END AS listing_status
FROM documents d LEFT JOIN (SELECT doc_id, n_chars + quality AS n FROM documents JOIN labels USING (doc_id)) l ON d.doc_id = l.doc_id""")
def c02(spark, sf):
    docs = load(spark, sf, "documents")
    listing = docs.select("doc_id", "n_chars").join(load(spark, sf, "labels"), "doc_id").select(
        "doc_id", (F.col("n_chars") + F.col("quality")).alias("n"))
    return C.match_listing(docs.select("doc_id", F.length("text").cast("bigint").alias("size")), listing, ["doc_id"], "size", "n").select(
        "doc_id", "listing_status")


@query("c03_match_digest", """
SELECT d.doc_id, CASE WHEN s.s IS NULL THEN 'undeclared' WHEN sha256(d.text) = s.s THEN 'match' ELSE 'digest_mismatch' END AS digest_status, md5(d.text) AS etag
FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN sha256(text || ' ') ELSE sha256(text) END AS s FROM documents JOIN labels USING (doc_id)) s
ON d.doc_id = s.doc_id""")
def c03(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    declared = docs.join(load(spark, sf, "labels"), "doc_id").select("doc_id", S.sha256(
        F.when(F.col("toxic") == 1, F.concat("text", F.lit(" "))).otherwise(F.col("text"))).alias("declared"))
    return C.match_digest(docs, declared, ["doc_id"], S.sha256("text"), "declared").select(
        "doc_id", "digest_status", S.md5("text").alias("etag"))


@query("c03_match_etag", """
SELECT d.doc_id, CASE WHEN s.doc_id IS NULL THEN 'undeclared' WHEN toxic = 1 THEN 'etag_mismatch' WHEN quality = 0 THEN 'undetermined' ELSE 'match' END AS etag_status
FROM documents d LEFT JOIN labels s ON d.doc_id = s.doc_id""")
def c03e(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    md5 = F.md5("text")
    etag = F.when(F.col("toxic") == 1, F.md5(F.concat("text", F.lit(" ")))).when(F.col("quality") == 0, F.concat(md5, F.lit("-2"))).otherwise(
        F.concat(F.lit('"'), F.upper(md5), F.lit('"')))
    listing = docs.join(load(spark, sf, "labels"), "doc_id").select("doc_id", etag.alias("listed"))
    return C.match_etag(docs, listing, ["doc_id"], F.col("text"), "listed").select("doc_id", "etag_status")


@query("c04_classify_drift", """
WITH d AS (SELECT CASE WHEN doc_id < 20 THEN 1 ELSE doc_id END AS k, text, doc_id FROM documents),
a AS (SELECT k, min(text) AS t, min(trim(text)) AS n, count(*) AS c FROM d WHERE doc_id % 3 <> 0 GROUP BY k),
b AS (SELECT k, min(u) AS t, min(trim(u)) AS n, count(*) AS c FROM
 (SELECT k, CASE WHEN doc_id % 2 = 0 THEN text || '  ' WHEN doc_id % 4 = 1 THEN text || '!' ELSE text END AS u FROM d WHERE doc_id % 5 <> 0) GROUP BY k)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN coalesce(a.k, b.k) % 7 = 0 THEN 'out_of_scope' WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'new'
 WHEN a.c > 1 OR b.c > 1 THEN 'not_unique' WHEN a.t = b.t THEN 'same' WHEN a.n = b.n THEN 'normalised_equal' ELSE 'changed' END AS drift
FROM a FULL JOIN b ON a.k = b.k""")
def c04(spark, sf):
    i = F.col("doc_id")
    docs = load(spark, sf, "documents").withColumn("k", F.when(i < 20, 1).otherwise(i).cast("bigint"))
    frozen = docs.filter("doc_id % 3 <> 0")
    text = F.when(i % 2 == 0, F.concat("text", F.lit("  "))).when(i % 4 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    current = docs.filter("doc_id % 5 <> 0").withColumn("text", text)

    def hashed(df):
        return df.select("k", S.sha256("text").alias("raw"), S.sha256(F.trim("text")).alias("norm"))

    return C.classify_drift(hashed(frozen), hashed(current), ["k"], "raw", "norm", in_scope=F.col("k") % 7 != 0)


@query("c05_compare_schema", """
SELECT o_orderpriority AS "table", count(*) FILTER (o_orderstatus <> 'P') AS declared_n, count(*) AS observed_n,
 count(*) FILTER (o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_custkey % 3 = 0)) AS differing,
 CASE WHEN count(*) FILTER (o_orderstatus <> 'P') = 0 THEN 'undeclared'
  WHEN count(*) FILTER (o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_custkey % 3 = 0)) > 0 THEN 'drift' ELSE 'match' END AS schema_status
FROM orders GROUP BY 1""")
def c05(spark, sf):
    orders = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table"), F.col("o_orderkey").alias("column"), "o_orderstatus", "o_custkey")
    observed = orders.select("table", "column", F.lit("bigint").alias("type"), F.lit(1).alias("position"))
    kind = F.when((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 3 == 0), "int").otherwise("bigint")
    declared = orders.filter("o_orderstatus <> 'P'").select("table", "column", kind.alias("type"), F.lit(1).alias("position"))
    return C.compare_schema(declared, observed)


@query("c06_cover_all", """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'not_executed') AS result FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def c06(spark, sf):
    results = load(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("result"))
    return C.cover_all(load(spark, sf, "documents").select("doc_id"), results, ["doc_id"], "result")


@query("c07_bind_evidence", """
WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_custkey % 2 AS p FROM orders),
b AS (SELECT l_orderkey AS k, min(l_linestatus) AS s, l_suppkey % 2 AS p FROM lineitem GROUP BY l_orderkey, l_suppkey % 2),
b1 AS (SELECT k, count(*) AS n, min(s) AS s, min(p) AS p FROM b GROUP BY k)
SELECT coalesce(r.k, b1.k) AS k, CASE WHEN r.k IS NULL THEN 'record_missing' WHEN b1.k IS NULL THEN 'binding_missing' WHEN n > 1 THEN 'not_unique'
 WHEN r.s = b1.s AND r.p = b1.p THEN 'bound' ELSE 'field_conflict' END AS binding_status FROM r FULL JOIN b1 ON r.k = b1.k""")
def c07(spark, sf):
    records = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), (F.col("o_custkey") % 2).alias("p"))
    bindings = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 2).alias("p")).agg(
        F.min("l_linestatus").alias("s"))
    return C.bind_evidence(records, bindings, "k", ["s", "p"])


@query("c08_asof_join", """
SELECT p.trade_id, p.user_id, p.ts, v.trade_id AS matched_id, v.ts AS matched_ts, v.price AS matched_price
FROM (SELECT * FROM ticks WHERE symbol = 'purchase') p ASOF LEFT JOIN (SELECT * FROM ticks WHERE symbol = 'view') v
ON p.user_id = v.user_id AND p.ts >= v.ts""", ("ticks",), matched_price="DOUBLE")
def c08(spark, sf):
    rows = ticks(spark, sf)
    left = rows.filter("symbol = 'purchase'").select("trade_id", "user_id", "ts")
    right = rows.filter("symbol = 'view'").select("trade_id", "user_id", "ts", "price")
    m = F.col("matched")
    return C.asof_join(left, right, ["user_id"], "ts", "ts", "trade_id", ["price"]).select(
        "trade_id", "user_id", "ts", m["id"].alias("matched_id"), m["event"].alias("matched_ts"), m["price"].alias("matched_price"))


@query("c08_asof_two_clocks", """
SELECT p.trade_id, max(v.trade_id) FILTER (v.ts = best) AS matched_id, CASE WHEN any_value(p.ts) - best <= INTERVAL 2 DAY THEN best END AS matched_ts FROM
 (SELECT p.trade_id, p.ts, p.side, max(v.ts) AS best FROM (SELECT trade_id, ts, buyer_maker AS side FROM ticks WHERE symbol = 'purchase') p
  LEFT JOIN (SELECT ts, buyer_maker AS side, qty FROM ticks WHERE symbol = 'view') v
  ON p.side = v.side AND v.ts + to_hours(qty) <= p.ts GROUP BY ALL) p
LEFT JOIN (SELECT trade_id, ts, buyer_maker AS side, qty FROM ticks WHERE symbol = 'view') v ON v.ts = p.best AND v.side = p.side AND p.ts - best <= INTERVAL 2 DAY
GROUP BY p.trade_id, best""", ("ticks",))
def c08b(spark, sf):
    rows = ticks(spark, sf).withColumnRenamed("buyer_maker", "side")
    left = rows.filter("symbol = 'purchase'").select("trade_id", "side", "ts")
    visible = F.col("ts") + F.make_interval(hours=F.col("qty").cast("int"))
    right = rows.filter("symbol = 'view'").select("trade_id", "side", "ts", visible.alias("visible"))
    m = F.col("matched")
    return C.asof_join(left, right, ["side"], "ts", "ts", "trade_id", [], visible_ts="visible", tolerance="2 DAYS").select(
        "trade_id", m["id"].alias("matched_id"), m["event"].alias("matched_ts"))


@query("c09_phase_conflict", """
SELECT l.l_orderkey, l.l_linenumber, CASE WHEN o_orderstatus = l_linestatus AND o_custkey % 3 = l_suppkey % 3 THEN 'usable' ELSE 'version_conflict' END AS phase_status
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""")
def c09(spark, sf):
    frozen = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("s"), (F.col("o_custkey") % 3).alias("v"))
    content = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("s"), (F.col("l_suppkey") % 3).alias("v"))
    return C.phase_conflict(frozen, content, ["l_orderkey"], ["s", "v"]).select("l_orderkey", "l_linenumber", "phase_status")


@query("c10_reconcile_one_to_one", """
SELECT coalesce(o.k, l.k) AS k, coalesce(a, 0) AS left_n, coalesce(b, 0) AS right_n, CASE WHEN b IS NULL THEN 'missing_right' WHEN a IS NULL THEN 'missing_left'
 WHEN a > 1 OR b > 1 THEN 'duplicate' WHEN s = t THEN 'ok' ELSE 'wrong_section' END AS reconciled FROM
 (SELECT o_orderkey AS k, count(*) AS a, min(o_orderstatus) AS s FROM orders GROUP BY 1) o
 FULL JOIN (SELECT l_orderkey AS k, count(*) AS b, min(l_linestatus) AS t FROM lineitem GROUP BY 1) l ON o.k = l.k""")
def c10(spark, sf):
    return C.reconcile_one_to_one(
        load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")),
        load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("t")), ["k"], "s", "t")


@query("c11_adopt", """
SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS adopted FROM customer""")
def c11(spark, sf):
    proven = load(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return C.adopt(load(spark, sf, "customer").select("c_custkey"), proven, ["c_custkey"])


@query("c12_leaf_grid", """
SELECT symbol, scale_h FROM (SELECT DISTINCT event_type AS symbol FROM events) CROSS JOIN (SELECT unnest([4, 8, 24, 48]) AS scale_h)""")
def c12(spark, sf):
    return C.leaf_grid(load(spark, sf, "events").select(F.col("event_type").alias("symbol")), [4, 8, 24, 48])


@query("c12_scenario_grid", """
SELECT symbol, event_date, side, kind, clock FROM members CROSS JOIN (SELECT unnest(['buy', 'sell']) AS side)
CROSS JOIN (SELECT unnest(['aggressive_market', 'aggressive_limit', 'passive_limit_cancel']) AS kind) CROSS JOIN (SELECT unnest(['baseline', 'stress']) AS clock)""", ("members",), event_date="VARCHAR")
def c12b(spark, sf):
    from plumbline.contracts import CLOCKS, ORDER_KINDS, SIDES
    return C.scenario_grid(members(spark, sf).select("symbol", "event_date"), SIDES, ORDER_KINDS, CLOCKS)


@query("c13_missing_days", """
SELECT grp, day FROM (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT grp, min(day) AS lo, max(day) AS hi FROM days GROUP BY grp))
EXCEPT SELECT grp, day FROM days""", ("days",), day="VARCHAR")
def c13(spark, sf):
    return C.missing_days(order_days(spark, sf), ["grp"], "day")


@query("c14_event_window_join", """
SELECT e.trade_id, b.symbol, b.bar_ts, b.volume FROM ticks e JOIN bars_1h b ON e.buyer_maker = (b.symbol = 'view')
AND b.bar_ts BETWEEN e.ts - INTERVAL 120 MINUTE AND e.ts + INTERVAL 60 MINUTE""", ("bars_1h",))
def c14(spark, sf):
    events = ticks(spark, sf).select("trade_id", F.col("buyer_maker").alias("k"), "ts")
    right = bars(spark, sf).select((F.col("symbol") == "view").alias("k"), "symbol", "bar_ts", "volume")
    return C.event_window_join(events, right, ["k"], "ts", "bar_ts", 120, 60).select("trade_id", "symbol", "bar_ts", "volume")


@query("c14_event_window_totals", """
SELECT e.trade_id, count(t.trade_id) AS rows_in_window, CAST(coalesce(sum(t.qty), 0) AS BIGINT) AS sum_in_window
FROM ticks e LEFT JOIN ticks t ON t.symbol = e.symbol
AND t.ts BETWEEN e.ts - INTERVAL 60 MINUTE AND e.ts + INTERVAL 60 MINUTE GROUP BY 1""", ("ticks",))
def c14b(spark, sf):
    rows = ticks(spark, sf)
    return C.event_window_totals(rows, rows, ["symbol"], "ts", "trade_id", "ts", F.col("qty"), 60, 60).select(
        "trade_id", "rows_in_window", "sum_in_window")


@query("c15_forward_outcome", """
SELECT a.symbol, a.trade_id, a.ts, a.price AS base, a.horizon_min, b.ts AS outcome_ts, b.price AS outcome FROM
 (SELECT *, ts + to_minutes(horizon_min) AS target FROM ticks, (SELECT unnest([15, 60, 240, 480, 1440, 2880]) AS horizon_min)) a
ASOF LEFT JOIN ticks b ON a.symbol = b.symbol AND a.target <= b.ts""", ("ticks",), base="DOUBLE", outcome="DOUBLE")
def c15(spark, sf):
    from plumbline.contracts import OUTCOME_HORIZONS_M
    return C.forward_outcome(ticks(spark, sf), ["symbol"], "ts", "trade_id", "price", OUTCOME_HORIZONS_M)


ALIASES = {"member_no": ["o_orderkey", "doc_id"], "status": ["o_orderstatus", "quality", "toxic"], "venue": ["o_custkey"]}


@query("c16_resolve_aliases", """
WITH cols AS (SELECT 'orders' AS "table", unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS c WHERE EXISTS (SELECT 1 FROM orders)
 UNION ALL SELECT 'labels', unnest(['doc_id', 'quality', 'toxic']) WHERE EXISTS (SELECT 1 FROM labels)),
al AS (SELECT unnest(['member_no', 'member_no', 'status', 'status', 'status', 'venue']) AS field, unnest(['o_orderkey', 'doc_id', 'o_orderstatus', 'quality', 'toxic', 'o_custkey']) AS c),
f AS (SELECT "table", field, count(*) AS n, min(c) AS first_c FROM cols JOIN al USING (c) GROUP BY ALL)
SELECT t."table", a.field, CASE WHEN n = 1 THEN first_c END AS resolved_column, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'multiple' ELSE 'resolved' END AS alias_status
FROM (SELECT DISTINCT "table" FROM cols) t CROSS JOIN (SELECT DISTINCT field FROM al) a LEFT JOIN f ON f."table" = t."table" AND f.field = a.field""")
def c16(spark, sf):
    columns = catalog.catalog_metadata(spark, {t: load(spark, sf, t) for t in ("orders", "labels")}).filter("n_rows > 0")
    return C.resolve_aliases(columns, ALIASES)


# ---- D ----
@query("d01_profile", """
SELECT 'c_custkey' AS "column", 'bigint' AS type, count(*) AS n_rows, count(*) - count(c_custkey) AS n_null, 0::BIGINT AS n_blank, 0::BIGINT AS n_non_finite FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', count(*), count(*) - count(c_mktsegment), count(*) FILTER (trim(c_mktsegment) = ''), 0 FROM customer
UNION ALL SELECT 'c_acctbal', 'double', count(*), count(*) - count(c_acctbal), 0, count(*) FILTER (isnan(c_acctbal) OR isinf(c_acctbal)) FROM customer
UNION ALL SELECT 'c_nationkey', 'int', count(*), count(*) - count(c_nationkey), 0, 0 FROM customer
UNION ALL SELECT 'c_name', 'string', count(*), count(*) - count(c_name), count(*) FILTER (trim(c_name) = ''), 0 FROM customer""")
def d01(spark, sf):
    return D.profile(load(spark, sf, "customer"))


@query("d02_record_duplicates", """
SELECT sha256('{"n_chars":' || n_chars || ',"sha":"' || sha256(text) || '"}') AS record_sha, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1""")
def d02(spark, sf):
    return D.record_duplicates(load(spark, sf, "documents").select("n_chars", S.sha256("text").alias("sha")))


@query("d03_duplicate_verdict", """
SELECT l_returnflag, l_linestatus, sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS n_duplicate, CASE WHEN sum(n - 1) > 0 THEN 'duplicates' ELSE 'unique' END AS duplicate_verdict
FROM (SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def d03(spark, sf):
    return D.duplicate_verdict(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                               F.struct("l_orderkey", "l_linenumber"))


@query("d04_key_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def d04(spark, sf):
    return D.key_duplicates(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("d05_reason_counts", """
SELECT c_mktsegment, reason, count(*) AS n FROM (SELECT c_mktsegment, 'balance_not_positive' AS reason FROM customer WHERE c_acctbal <= 0
 UNION ALL SELECT c_mktsegment, 'nation_out_of_range' FROM customer WHERE c_nationkey < 0 OR c_nationkey > 20) GROUP BY ALL""")
def d05(spark, sf):
    return D.reason_counts(B.domain_rules(load(spark, sf, "customer"), CUSTOMER_RULES), ["c_mktsegment"])


STATUS_OF = {"F": "proven", "O": "undetermined", "P": "rejected"}
STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'proven' WHEN 'O' THEN 'undetermined' WHEN 'P' THEN 'rejected' ELSE 'failed' END"


def statuses():
    c = F.col("o_orderstatus")
    return F.when(c == "F", "proven").when(c == "O", "undetermined").when(c == "P", "rejected").otherwise("failed")


@query("d06_member_status", f"""
SELECT o_custkey, ['failed', 'rejected', 'undetermined', 'proven'][min(CASE {STATUS_SQL} WHEN 'failed' THEN 1 WHEN 'rejected' THEN 2 WHEN 'undetermined' THEN 3 ELSE 4 END)] AS status, count(*) AS n_units
FROM orders GROUP BY 1""")
def d06(spark, sf):
    return D.member_status(load(spark, sf, "orders").select("o_custkey", statuses().alias("status")), ["o_custkey"], "status")


@query("d07_conservation", """
SELECT o_orderpriority, count(*) AS population, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS in_states,
 count(*) - count(*) FILTER (o_orderstatus IN ('F', 'O')) AS difference FROM orders GROUP BY 1 HAVING count(*) <> count(*) FILTER (o_orderstatus IN ('F', 'O'))""")
def d07(spark, sf):
    return D.assert_conserved(load(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O"])


@query("d08_denominators", """
SELECT o_orderpriority, o_orderstatus, CAST(grouping(o_orderpriority, o_orderstatus) AS INTEGER) AS level, count(*) AS total,
 count(*) FILTER (o_totalprice >= 100000) AS formal, count(*) FILTER (o_totalprice < 100000) AS rejected FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def d08(spark, sf):
    return D.denominators(load(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"],
                          F.col("o_totalprice") >= 100000, F.col("o_totalprice") < 100000)


@query("d09_coverage_record", """
SELECT s.grp, '1' AS version, first_ts, last_ts, n_rows, CAST(sum(days) AS BIGINT) AS days_covered,
 CAST(max(seg_end) - min(seg_start) + 1 - sum(days) AS BIGINT) AS days_missing, count(*) AS n_segments, max(days) AS longest_segment,
 max(seg_end) - min(seg_start) + 1 = sum(days) AS research_ready
FROM segs s JOIN (SELECT o_orderpriority AS grp, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS n_rows FROM orders GROUP BY 1) o ON s.grp = o.grp
GROUP BY s.grp, first_ts, last_ts, n_rows""", ("segs",))
def d09(spark, sf):
    return D.coverage_record(load(spark, sf, "orders").select(F.col("o_orderpriority").alias("grp"), "o_orderdate"), ["grp"], "o_orderdate")


GATES = ["identity", "time", "quality", "coverage"]
GATE_VIEW = """g AS (SELECT symbol, 'identity' AS gate, CASE WHEN sum(n_rows) > 0 THEN 'pass' ELSE 'reject' END AS state FROM members GROUP BY 1
 UNION ALL SELECT symbol, 'time', CASE WHEN max(last_ts) > TIMESTAMP '2024-01-30 12:00:00' THEN 'pass' ELSE 'unknown' END FROM members GROUP BY 1
 UNION ALL SELECT symbol, 'quality', CASE WHEN min(n_rows) >= 50 THEN 'pass' ELSE 'reject' END FROM members GROUP BY 1
 UNION ALL SELECT symbol, 'coverage', CASE WHEN count(*) >= 30 THEN 'pass' ELSE 'reject' END FROM members WHERE symbol <> 'error' GROUP BY 1)"""


def gate_rows(spark, sf):
    facts = members(spark, sf).groupBy("symbol").agg(
        F.sum("n_rows").alias("rows"), F.max("last_ts").alias("last"), F.min("n_rows").alias("thin"), F.count("*").alias("days"))

    def one(gate, ok, otherwise, keep=F.lit(True)):
        return F.when(keep, F.struct(F.lit(gate).alias("gate"), F.when(ok, "pass").otherwise(otherwise).alias("state")))

    cells = F.array_compact(F.array(
        one("identity", F.col("rows") > 0, "reject"),
        one("time", F.col("last") > F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"), "unknown"),
        one("quality", F.col("thin") >= 50, "reject"),
        one("coverage", F.col("days") >= 30, "reject", F.col("symbol") != "error")))
    return facts.select("symbol", F.inline(cells))


@query("d10_leaf_verdict", f""", {GATE_VIEW},
w AS (SELECT symbol, gate, i FROM (SELECT DISTINCT symbol FROM members) CROSS JOIN (SELECT unnest(['identity', 'time', 'quality', 'coverage']) AS gate, unnest([0, 1, 2, 3]) AS i))
SELECT w.symbol, count(*) FILTER (g.state = 'pass') AS gates_passed, CASE WHEN bool_and(coalesce(g.state = 'pass', false)) THEN 'pass' ELSE 'blocked' END AS verdict,
 arg_min(w.gate, w.i) FILTER (coalesce(g.state <> 'pass', true)) AS first_gate
FROM w LEFT JOIN g ON w.symbol = g.symbol AND w.gate = g.gate GROUP BY 1""", ("members",))
def d10(spark, sf):
    return D.leaf_verdict(gate_rows(spark, sf), members(spark, sf).select("symbol"), ["symbol"], GATES)


@query("d11_rollup_floor", """
WITH u AS (SELECT n_regionkey, n_nationkey, CASE WHEN c_acctbal <= 0 THEN 0 WHEN c_acctbal < 200 THEN 1 WHEN c_acctbal < 1000 THEN 2 ELSE 3 END AS r
 FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_regionkey, n_nationkey, CAST(grouping(n_regionkey, n_nationkey) AS INTEGER) AS level,
 ['unavailable', 'undetermined', 'limited', 'available'][min(r) + 1] AS floor_status FROM u GROUP BY ROLLUP (n_regionkey, n_nationkey)""")
def d11(spark, sf):
    from plumbline.contracts import AVAILABILITY
    nation = load(spark, sf, "nation").select(F.col("n_nationkey"), "n_regionkey")
    b = F.col("c_acctbal")
    status = F.when(b <= 0, "unavailable").when(b < 200, "undetermined").when(b < 1000, "limited").otherwise("available")
    units = load(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), status.alias("status")).join(nation, "n_nationkey")
    return D.rollup_floor(units, ["n_regionkey", "n_nationkey"], "status", AVAILABILITY)


@query("d12_remaining_gap", """
SELECT o_orderpriority AS reason, 'recollect' AS "release", count(*) AS n_gates, count(DISTINCT o_custkey) AS n_leaves FROM orders
WHERE o_orderstatus <> 'F' GROUP BY 1 ORDER BY n_gates DESC, reason LIMIT 1""")
def d12(spark, sf):
    gates = load(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderpriority").alias("reason"), F.lit("recollect").alias("release"),
        F.when(F.col("o_orderstatus") == "F", "pass").otherwise("reject").alias("state"))
    return D.remaining_gap(gates, ["o_custkey"])


# count(s) and the sums of nine 20-bit words of the digests s, hashed once.
SUMS_SQL = "sha256(concat_ws(':', count(s), " + ", ".join(
    f"coalesce(sum((CAST('0x' || substr(s, {at}, 15) AS BIGINT) >> {down}) & 1048575), 0)" for at in (1, 16, 31) for down in (0, 20, 40)) + "))"
EVENT_SHA = """sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id || '}') AS s"""


@query("d13_set_fingerprint", f"SELECT count(*) AS n_rows, {SUMS_SQL} AS fingerprint FROM (SELECT {EVENT_SHA} FROM events)")
def d13(spark, sf):
    return D.set_fingerprint(load(spark, sf, "events"), ["event_id", "ts", "user_id", "event_type"])


# Order lines read as the metadata of one table per order: a column and an index entry a line, in two spellings.
DECLARED_SQL = """
SELECT 't' || l_orderkey AS tbl, 'column' AS kind, 'c' || l_partkey AS name, l_linenumber AS seq, 'type_' || l_returnflag AS what,
 l_linestatus = 'F' AS flag, CASE WHEN l_linenumber = 1 THEN '0' ELSE '-' END AS more, l_orderkey AS k, l_partkey AS p, l_suppkey AS s FROM lineitem
UNION ALL SELECT 't' || l_orderkey, 'index', 'ix_' || l_suppkey, l_linenumber, 'c' || l_partkey, l_linestatus = 'O', 'BTREE', l_orderkey, l_partkey, l_suppkey FROM lineitem"""
OBSERVED_SQL = """
SELECT * REPLACE (CASE WHEN kind = 'column' AND p % 61 = 0 THEN NULL ELSE what END AS what, CASE WHEN kind = 'index' AND s % 37 = 0 THEN NOT flag ELSE flag END AS flag)
FROM facts WHERE k % 13 <> 0 AND NOT (kind = 'column' AND p % 50 = 7) AND NOT (kind = 'index' AND s % 41 = 3)"""


def order_metadata(spark, sf, observed=False):
    """Facts of one table per order, as they are declared or as they are observed."""
    lines = load(spark, sf, "lineitem").withColumn("table", F.concat(F.lit("t"), "l_orderkey"))
    columns = indexes = lines.filter("l_orderkey % 13 <> 0" if observed else "l_orderkey % 17 <> 0")
    kind, unique = F.concat(F.lit("type_"), "l_returnflag"), F.col("l_linestatus") == "O"
    if observed:
        columns, indexes = columns.filter("l_partkey % 50 <> 7"), indexes.filter("l_suppkey % 41 <> 3")
        kind, unique = F.when(F.col("l_partkey") % 61 != 0, kind), unique != (F.col("l_suppkey") % 37 == 0)
    named = structure.column_facts(columns.select(
        "table", F.concat(F.lit("C" if observed else "c"), "l_partkey").alias("column"), kind.alias("type"), F.col("l_linenumber").alias("position"),
        (F.col("l_linestatus") == "F").alias("nullable"), F.when(F.col("l_linenumber") == 1, 0).alias("key_position")))
    return named.unionByName(structure.index_facts(indexes.select(
        "table", F.concat(F.lit("ix_" if observed else "IX_"), "l_suppkey").alias("index"), F.col("l_linenumber").alias("seq"),
        F.concat(F.lit("C"), "l_partkey").alias("column"), unique.alias("non_unique"), F.lit("btree").alias("index_type"))))


@query("a05_structure_facts", f"SELECT tbl AS \"table\", kind, name, seq, what, flag, more FROM (WITH facts AS ({DECLARED_SQL}) {OBSERVED_SQL})")
def a05_structure(spark, sf):
    return order_metadata(spark, sf, observed=True)


@query("h18_structure_sha", f"""
SELECT tbl AS "table", kind, count(*) AS n_facts, {SUMS_SQL} AS fingerprint FROM (SELECT tbl, kind, sha256('{{"flag":' || flag || ',"kind":"' || kind
 || '","more":"' || more || '","name":"' || name || '","seq":' || seq || ',"what":"' || what || '"}}') AS s FROM ({DECLARED_SQL}) WHERE k % 17 <> 0) GROUP BY ALL""")
def h18_structure(spark, sf):
    return structure.structure_sha(order_metadata(spark, sf))


@query("c05_compare_structure", f"""
WITH facts AS ({DECLARED_SQL}), sides AS (SELECT *, 'd' AS side FROM facts WHERE k % 17 <> 0 UNION ALL SELECT *, 'o' FROM ({OBSERVED_SQL})),
per AS (SELECT tbl, kind, name, count(*) FILTER (side = 'd') AS d, count(*) FILTER (side = 'o') AS o, count(*) FILTER (what IS NULL) AS u,
 count(DISTINCT (seq, coalesce(what, ''), flag, more)) AS v FROM sides GROUP BY tbl, kind, name, CASE WHEN kind = 'index' THEN seq ELSE 0 END),
t AS (SELECT tbl, count(*) FILTER (d > 0) AS dn, count(*) FILTER (o > 0) AS obs, count(*) FILTER (u > 0) AS un, count(*) FILTER (kind = 'column' AND (d = 0 OR o = 0 OR v > 1)) AS cd,
 count(*) FILTER (kind = 'index' AND (d = 0 OR o = 0 OR v > 1)) AS xd FROM per GROUP BY 1),
r AS (SELECT 't' || o_orderkey AS tbl, CASE WHEN o_custkey % 29 = 0 THEN 'over_limit' WHEN o_custkey % 23 = 0 THEN 'denied' ELSE 'read' END AS outcome FROM orders WHERE o_orderkey % 19 <> 0)
SELECT coalesce(t.tbl, r.tbl) AS "table", coalesce(dn, 0) AS declared_n, coalesce(obs, 0) AS observed_n, coalesce(un, 0) AS unknown_n, coalesce(cd, 0) AS columns_differing,
 coalesce(xd, 0) AS indexes_differing, CASE WHEN coalesce(dn, 0) = 0 THEN 'undeclared' WHEN outcome = 'over_limit' THEN 'failed' WHEN outcome IS NULL OR outcome = 'denied' THEN 'undetermined'
 WHEN obs = 0 THEN 'not_found' WHEN un > 0 THEN 'undetermined' WHEN cd + xd > 0 THEN 'drift' ELSE 'match' END AS structure_state FROM t FULL JOIN r ON t.tbl = r.tbl""")
def c05_structure(spark, sf):
    reads = load(spark, sf, "orders").filter("o_orderkey % 19 <> 0").select(
        F.concat(F.lit("t"), "o_orderkey").alias("table"),
        F.when(F.col("o_custkey") % 29 == 0, "over_limit").when(F.col("o_custkey") % 23 == 0, "denied").otherwise("read").alias("outcome"))
    return structure.compare_structure(order_metadata(spark, sf), order_metadata(spark, sf, observed=True), reads)


@query("d14_table_coverage", "SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM events GROUP BY 1")
def d14(spark, sf):
    return D.table_coverage(load(spark, sf, "events"), ["event_type"], "ts")


@query("d15_terminal_counts", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "n_F", count(*) FILTER (o_orderstatus = 'O') AS "n_O",
 count(*) FILTER (o_orderstatus = 'P') AS "n_P", count(*) AS n_all FROM orders GROUP BY 1""")
def d15(spark, sf):
    return D.terminal_counts(load(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@query("d16_session_stats", f"""
SELECT symbol, session, count(*) AS n_bars, count(close > open) AS n_known, round(avg(CAST(close > open AS DOUBLE)), 6) AS hit_rate, round(stddev_samp(ln(CAST(close AS DOUBLE) / CAST(open AS DOUBLE))), 6) AS volatility FROM
 (SELECT *, {session_sql('bar_ts')} AS session FROM bars_1h) GROUP BY ALL""", ("bars_1h",))
def d16(spark, sf):
    rows = bars(spark, sf).withColumn("session", S.session_label("bar_ts"))
    ret = F.ln(F.col("close").cast("double") / F.col("open").cast("double"))
    out = D.session_stats(rows, ["symbol", "session"], F.col("close") > F.col("open"), ret)
    return out.withColumn("hit_rate", F.round("hit_rate", 6)).withColumn("volatility", F.round("volatility", 6))


@query("d17_merge_conflicts", """
SELECT l_orderkey, l_linenumber, count(*) AS n_merged, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS l_returnflag,
 CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS l_linestatus,
 concat_ws(',', CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END) AS conflicts,
 CASE WHEN count(DISTINCT l_returnflag) > 1 OR count(DISTINCT l_linestatus) > 1 THEN 'metadata_conflict' ELSE 'merged' END AS merge_status
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def d17(spark, sf):
    return D.merge_conflicts(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus"])


@query("d18_assert_unique", "SELECT text AS key_text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) <> 1")
def d18(spark, sf):
    return D.assert_unique(load(spark, sf, "documents").select(F.col("text").alias("key_text")), ["key_text"])


@query("d19_ohlcv", "SELECT * FROM bars_1h", ("bars_1h",), open="DOUBLE", high="DOUBLE", low="DOUBLE", close="DOUBLE")
def d19(spark, sf):
    return bars(spark, sf)


@query("d20_hit_rate", """
SELECT symbol, bucket, count(*) AS n, count(hit) AS denominator, count(*) - count(hit) AS n_unknown, count(*) FILTER (hit) AS n_hit, round(avg(CAST(hit AS DOUBLE)), 6) AS rate FROM
 (SELECT symbol, CASE WHEN volume < 300 THEN 'thin' ELSE 'thick' END AS bucket, lead(close) OVER (PARTITION BY symbol ORDER BY bar_ts) > close AS hit FROM bars_1h) GROUP BY ALL""", ("bars_1h",))
def d20(spark, sf):
    from pyspark.sql import Window as W
    nxt = F.lead("close").over(W.partitionBy("symbol").orderBy("bar_ts"))
    rows = bars(spark, sf).withColumn("bucket", F.when(F.col("volume") < 300, "thin").otherwise("thick")).withColumn("hit", nxt > F.col("close"))
    return D.hit_rate(rows, ["symbol", "bucket"], F.col("hit")).withColumn("rate", F.round("rate", 6))


@query("d21_cost_coverage", """
WITH c AS (SELECT l_returnflag AS symbol, CASE WHEN l_linenumber <= 3 THEN 4 ELSE 8 END AS scale_h, l_tax AS fee, CASE WHEN l_discount > 0 THEN l_discount END AS funding, l_quantity AS spread FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linenumber > 3)),
g AS (SELECT symbol, scale_h FROM (SELECT DISTINCT l_returnflag AS symbol FROM lineitem) CROSS JOIN (SELECT unnest([4, 8]) AS scale_h)),
k AS (SELECT symbol, scale_h, count(*) AS n_rows, count(fee) AS fee, count(funding) AS funding, count(spread) AS spread FROM c GROUP BY ALL),
u AS (SELECT g.symbol, g.scale_h, coalesce(n_rows, 0) AS n_rows, unnest(['fee', 'funding', 'spread']) AS component, unnest([coalesce(fee, 0), coalesce(funding, 0), coalesce(spread, 0)]) AS n_covered FROM g LEFT JOIN k ON g.symbol = k.symbol AND g.scale_h = k.scale_h)
SELECT *, CASE WHEN n_rows > 0 AND n_covered = n_rows THEN 'covered' ELSE 'missing' END AS cost_state FROM u""")
def d21(spark, sf):
    lines = load(spark, sf, "lineitem")
    grid = C.leaf_grid(lines.select(F.col("l_returnflag").alias("symbol")), [4, 8])
    costs = lines.filter("NOT (l_returnflag = 'A' AND l_linenumber > 3)").select(
        F.col("l_returnflag").alias("symbol"), F.when(F.col("l_linenumber") <= 3, 4).otherwise(8).alias("scale_h"),
        F.col("l_tax").alias("fee"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("funding"), F.col("l_quantity").alias("spread"))
    return D.cost_coverage(costs, grid, ["symbol", "scale_h"], ["fee", "funding", "spread"])
