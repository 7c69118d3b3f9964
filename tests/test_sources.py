"""Readers and sinks on small files, with the broken variants."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import aggregates as D
from plumbline.operators import sets as G
from plumbline.plans import jobs
from plumbline.rules import Rule, RuleSet
from plumbline.sources import archives, catalog, files, sinks

PAIR = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])


def test_inventory_lists_candidates_without_content(spark, tmp_path):
    for name in ("x.csv", "y.JSONL", "z.txt", ".hidden/h.csv", "cache/c.csv", "deep/er/p.parquet"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1")
    found = files.file_inventory(spark, [str(tmp_path)])
    assert sorted(r.format for r in found.collect()) == ["CSV", "JSONL", "Parquet"]
    assert "content" not in found._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_delimited_lines_are_all_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text('1,x,y\n1,x,y\n2,,z\n3,only\n\n4,"a,b",q\nbad,x,y\n')
    got = files.delimited_counts(spark, str(tmp_path / "t.csv"), PAIR).first()
    assert (got.n_lines, got.n_blank_lines, got.n_wrong_width, got.n_blank_fields) == (7, 1, 1, 1)
    rows = files.read_delimited_strict(spark, str(tmp_path / "t.csv"), PAIR).collect()
    assert sorted(r.line_class for r in rows) == ["blank"] + ["malformed"] * 2 + ["ok"] * 4
    pruned = files.read_delimited_strict(spark, str(tmp_path / "t.csv"), PAIR).groupBy("line_class").agg(F.count("c").alias("n"))
    assert {r.line_class: r.n for r in pruned.collect()} == {"blank": 0, "malformed": 1, "ok": 4}
    assert {r.raw_line for r in rows if r.line_class == "malformed"} == {"3,only", "bad,x,y"}
    text = spark.read.text(str(tmp_path / "t.csv"))
    assert D.record_duplicates(text.filter("value <> ''")).first().copies == 2


def test_json_lines_are_all_classed(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"a":1,"b":2}\n{"a":1,"b":2}\n\n{bad\n[1]\n3\nnull\n{"c":{"a":1}}\n')
    rows = files.read_jsonl_strict(spark, str(tmp_path / "t.jsonl"))
    assert {r.line_class: r["count"] for r in rows.groupBy("line_class").count().collect()} == {
        "object": 3, "blank": 1, "illegal": 1, "non_object": 3}
    counts = files.jsonl_counts(spark, str(tmp_path / "t.jsonl")).first()
    assert counts[1:] == (8, 3, 1, 1, 3, 1)
    fields = G.field_union(rows.filter("line_class = 'object'"), "line")
    assert {r.field: r.n_records for r in fields.collect()} == {"a": 2, "b": 2, "c": 1}


def make_zip(path, members, corrupt=False):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    if corrupt:
        raw = bytearray(path.read_bytes())
        raw[raw.index(b"1,10.5")] = ord("7")
        path.write_bytes(raw)


GOOD = "1,10.5,2,21.0,1704067200000,true\n2,10.6,1,10.6,1704067201000,False\n"


@pytest.fixture
def zips(tmp_path):
    root = tmp_path / "zips"
    root.mkdir()
    make_zip(root / "good.zip", {"good.csv": GOOD})
    make_zip(root / "two.zip", {"two.csv": GOOD, "more.csv": GOOD})
    make_zip(root / "name.zip", {"other.csv": GOOD})
    make_zip(root / "up.zip", {"../up.csv": GOOD})
    make_zip(root / "empty.zip", {"empty.csv": ""})
    make_zip(root / "crc.zip", {"crc.csv": GOOD}, corrupt=True)
    make_zip(root / "fields.zip", {"fields.csv": "1,2,3\n1,1e3,2,2,x,maybe\n-5,-1,0,NaN,1704067200000,true\n"})
    (root / "junk.zip").write_bytes(b"no zip at all")
    return root


def test_archives_give_rows_or_a_reason(spark, zips):
    lines = archives.read_archive_members(spark, str(zips)).cache()
    reasons = {r.path.rsplit("/", 1)[-1]: r.reason for r in lines.filter("reason IS NOT NULL").collect()}
    assert reasons == {"two.zip": "not_one_member", "name.zip": "member_name", "up.zip": "member_name", "empty.zip": "empty_member",
                       "crc.zip": "crc_mismatch", "junk.zip": "unreadable"}
    good = lines.filter("path LIKE '%good.zip' AND line IS NOT NULL").orderBy("row_no").collect()
    assert [r.row_no for r in good] == [0, 1] and "\n".join(r.line for r in good) + "\n" == GOOD
    parsed = archives.parse_trades(lines)
    bad = {r.row_no: set(r.reasons) for r in parsed.filter("path LIKE '%fields.zip'").collect()}
    assert bad[0] == {"field_count", "number_syntax", "time_syntax", "boolean_syntax"}
    assert bad[1] == {"number_syntax", "time_syntax", "boolean_syntax"}
    assert bad[2] == {"number_syntax", "price_not_positive", "quantity_not_positive"}
    assert all(not r.reasons for r in parsed.filter("path LIKE '%good.zip'").collect())


def test_long_member_is_read_in_batches(spark, tmp_path, monkeypatch):
    (tmp_path / "z").mkdir()
    make_zip(tmp_path / "z" / "long.zip", {"long.csv": "".join(f"{i},1,1,1,1704067200000,true\n" for i in range(120_001))})
    lines = archives.read_archive_members(spark, str(tmp_path / "z"))
    assert lines.agg(F.count("*"), F.max("row_no"), F.count_distinct("row_no")).first()[:] == (120_001, 120_000, 120_001)


def test_blocks_of_any_size_give_the_same_rows(monkeypatch):
    text = "1,a,é\n\n,,\r\n2\n3,b,c,d\nlast, no end "
    want = [["1", "a", "é"], [""], ["", "", ""], ["2"], ["3", "b", "c", "d"], ["last", " no end "]]
    third = [cells[2] if len(cells) > 2 else None for cells in want]
    for size in (1, 2, 3, 5, 8, 1 << 20):
        monkeypatch.setattr(archives, "BLOCK_BYTES", size)
        got = [r for batch in archives._lines("p", "m", io.BytesIO(text.encode()), [0, 2]) for r in batch.to_pylist()]
        assert [r["cells"] for r in got] == want and [r["row_no"] for r in got] == list(range(6))
        assert [r["before"] for r in got] == [None, *({"id": c[0], "time_ms": t} for c, t in zip(want[:-1], third))]
    with pytest.raises(archives.ArrowInvalid):
        list(archives._lines("p", "m", io.BytesIO(b"ok\n\xff\n"), [0, 1]))


def test_archives_are_planned_by_size(tmp_path, monkeypatch):
    for i, size in enumerate([10, 900, 40, 40, 40]):
        (tmp_path / f"{i}.zip").write_bytes(b"x" * size)
    (tmp_path / "other.txt").write_text("x")
    monkeypatch.setattr(archives, "PARTITION_BYTES", 100)
    for root in (str(tmp_path), f"file://{tmp_path}"):
        parts = archives._ArchiveReader({"path": root, "id": "0", "time": "4"}).partitions()
        assert [[p.rsplit("/", 1)[-1] for p in part.paths] for part in parts] == [["1.zip"], ["4.zip", "3.zip"], ["2.zip", "0.zip"]]
        assert all(p.startswith(root) for part in parts for p in part.paths)


def test_folder_without_archives(spark, tmp_path):
    assert archives.read_archive_members(spark, str(tmp_path)).count() == 0


def test_scan_of_an_archive_rejects_its_member(spark, zips):
    rows = archives.parse_trades(archives.read_archive_members(spark, str(zips)).filter("path LIKE '%good.zip'"))
    rows = rows.withColumn("day", F.to_date(F.lit("2024-01-01"))).withColumn("symbol", F.lit("s"))
    rules = RuleSet.freeze([Rule("r", "size(reasons) > 0", "bad_row")])
    assert jobs.scan_rows(rows, ["symbol"], "day", "row_no", "id", "ts", rules).members.first().status == "proven"
    late = rows.withColumn("ts", F.when(F.col("id") == 2, F.col("ts") - F.expr("INTERVAL 10 SECONDS")).otherwise(F.col("ts")))
    member = jobs.scan_rows(late, ["symbol"], "day", "row_no", "id", "ts", rules).members.first()
    assert (member.status, member.time_regression, member.date_mismatch) == ("rejected", 1, 1)


def test_scan_in_reading_order_equals_the_sorted_scan(spark, tmp_path):
    (tmp_path / "z").mkdir()
    for m, rows in {"a": [(1, 10), (2, 5), (2, 7), (1, 7)], "b": [(5, 1), (6, 2), (7, 2)], "c": [(8, 3)]}.items():
        text = "".join(f"{i},1,1,1,{1704067200000 + t},true\n" for i, t in rows)
        make_zip(tmp_path / "z" / f"{m}.zip", {f"{m}.csv": text})
    rows = archives.parse_trades(archives.read_archive_members(spark, str(tmp_path / "z"))).withColumn("day", F.to_date(F.lit("2024-01-01")))
    rules = RuleSet.freeze([Rule("r", "size(reasons) > 0", "bad_row")])
    by_reader = jobs.scan_rows(rows, ["member"], "day", "row_no", "id", "ts", rules, before="before").members
    by_sort = jobs.scan_rows(rows, ["member"], "day", "row_no", "id", "ts", rules).members
    assert sorted(map(tuple, by_reader.collect())) == sorted(map(tuple, by_sort.collect()))
    a = by_reader.filter("member = 'a.csv'").first()
    assert (a.key_repeat, a.key_regression, a.time_regression, a.status) == (1, 1, 1, "rejected")


def test_provenance_reasons(spark):
    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    archive_rows = [(n, 3, sha(n), "proven") for n in ("ok", "nosum", "hash", "size", "form", "who", "wrongname")] + [("twice", 3, sha("twice"), "proven")] * 2
    archive_rows[5] = ("who", 3, sha("who"), "undetermined")
    lines = {"ok": f"{sha('ok')}  ok", "hash": f"{sha('x')}  hash", "size": f"{sha('size')}  size", "form": "nothing", "who": f"{sha('who')}  who",
             "twice": f"{sha('twice')}  twice", "alone": f"{sha('alone')}  alone", "wrongname": f"{sha('wrongname')}  ok"}
    got = jobs.prove_members(
        spark.createDataFrame(archive_rows, "name string, size long, sha256 string, identity string"),
        spark.createDataFrame(list(lines.items()), "name string, line string"),
        spark.createDataFrame([(n, 4 if n == "size" else 3) for n in lines], "name string, listed_size long"), F.col("identity"))
    assert {r.name: (r.reason, r.status) for r in got.collect()} == {
        "ok": (None, "proven"), "nosum": ("checksum_missing", "undetermined"), "hash": ("digest_mismatch", "rejected"),
        "size": ("size_mismatch", "rejected"), "form": ("checksum_malformed", "rejected"), "who": ("identity_open", "undetermined"),
        "twice": ("not_unique", "rejected"), "alone": ("archive_missing", "undetermined"), "wrongname": ("checksum_name_mismatch", "rejected")}


def test_batches_are_never_overwritten(spark, tmp_path):
    df = spark.range(5)
    sinks.publish_batch(df, str(tmp_path), "b1", {"rule_sha": "x"})
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.publish_batch(df, str(tmp_path), "b1", {})
    assert sinks.read_batch(spark, str(tmp_path), "b1").count() == 5
    assert sinks.read_manifest(spark, str(tmp_path), "b1")["n_rows"] == 5
    df.write.parquet(str(tmp_path / "batch_id=b2" / "data"))  # a batch that broke before its manifest
    with pytest.raises(AnalysisException):
        sinks.read_batch(spark, str(tmp_path), "b2")
    sinks.publish_batch(spark.range(3), str(tmp_path), "b2", {})  # is made again, and holds only its own rows
    assert sinks.read_batch(spark, str(tmp_path), "b2").count() == 3


def test_safe_csv_escapes_sorts_and_refuses_secrets(spark, tmp_path):
    df = spark.createDataFrame([(2, "=SUM(A1)"), (1, "plain"), (3, "-x")], "id int, t string")
    sinks.write_safe_csv(df, str(tmp_path / "ok"), ["id", "t"], ["id"])
    rows = spark.read.option("header", "true").csv(str(tmp_path / "ok")).collect()
    assert [(r.id, r.t) for r in sorted(rows, key=lambda r: r.id)] == [("1", "plain"), ("2", "'=SUM(A1)"), ("3", "'-x")]
    with pytest.raises(ValueError, match="sensitive"):
        sinks.write_safe_csv(spark.createDataFrame([(1, "token=smoke-only-value")], "id int, t string"), str(tmp_path / "no"), ["id", "t"], ["id"])
    assert not (tmp_path / "no").exists()


def test_catalog_and_time_candidates(spark):
    df = spark.createDataFrame([], "event_time string, arrival_time string, collected_at timestamp, note string")
    columns = catalog.catalog_metadata(spark, {"t": df}, keys={"t": ["note"]})
    assert [r.column for r in columns.filter("key_position = 0").collect()] == ["note"]
    assert [r.position for r in columns.orderBy("position").collect()] == [0, 1, 2, 3]
    found = {r.column: r.time_contract for r in catalog.time_candidates(columns).collect()}
    assert found == dict.fromkeys(["event_time", "arrival_time", "collected_at"], "undetermined")


def test_a_damaged_member_fails_on_every_day(spark, tmp_path):
    import zipfile

    from plumbline.plans import jobs
    from plumbline.rules import Rule, RuleSet

    lines = "".join(f"{i},1.5,2,3,{1704067200000 + i * 1000},true\n" for i in range(200_000))  # two days and more
    for name in ("good", "bad"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_STORED) as z:
            z.writestr(f"{name}.csv", lines)
    raw = bytearray((tmp_path / "bad.zip").read_bytes())
    raw[len(lines) - 500] ^= 1  # near the end, so that whole batches come before the check sum is known
    (tmp_path / "bad.zip").write_bytes(raw)
    rows = archives.parse_trades(archives.read_archive_members(spark, str(tmp_path))).withColumn("day", F.to_date("ts"))
    rules = RuleSet.freeze([Rule("z", "size(reasons) > 0", "bad_row")])
    members = jobs.scan_rows(rows, ["member"], "day", "row_no", "id", "ts", rules, before="before", failed=F.col("archive_reason").isNotNull()).members
    got = {(r["member"][:3], r["status"]) for r in members.collect()}
    assert got == {("goo", "proven"), ("bad", "failed")}
    assert members.where("member like 'good%'").agg(F.sum("n_rows")).first()[0] == 200_000


def test_the_archive_name_says_what_a_member_is(spark):
    paths = ["file:/x/BTCUSDT-trades-2024-01-02.zip", "s/ETHUSDT-aggTrades-2024-02-30.zip", "y/notes.zip", "BTCUSDT-trades-2024-01.zip"]
    got = archives.with_identity(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r.symbol, r.object, r.member_date and str(r.member_date)) for r in got] == [
        ("BTCUSDT", "trades", "2024-01-02"), ("ETHUSDT", "aggTrades", None), (None, None, None), (None, None, None)]


def test_a_broken_member_fails_alone_and_bounds_no_other(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01", i, i, None) for i in range(5)] + [("a", "2024-01-02", 0, 900, None), ("a", "2024-01-02", None, None, "crc_mismatch"),
         ("a", "2024-01-03", 0, 10, None)], "symbol string, day string, row_no long, id long, fault string").selectExpr(
        "symbol", "CAST(day AS date) AS day", "row_no", "id", "CAST(day AS timestamp) AS ts", "fault")
    rules = RuleSet.freeze([Rule("r", "id < 0", "negative")])
    scan = jobs.scan_rows(rows, ["symbol"], "day", "row_no", "id", "ts", rules, failed=F.col("fault").isNotNull(), unit=["symbol", "day"])
    got = {str(r.day)[-1]: (r.status, r.boundary_status, r.first_key) for r in scan.members.collect()}
    assert got == {"1": ("proven", "ok", 0), "2": ("failed", "ok", None), "3": ("proven", "ok", 10)}
    assert [str(r.day) for r in scan.missing.collect()] == ["2024-01-02"]


def test_aggregate_trades(spark):
    lines = ["7,1.5,2,10,12,1704067200000,true", "8,1.5,2,13,12,1704067200000,false", "9,1.5,2,a,12,1704067200000,false", "10,1.5,2,3,1704067200000,true"]
    rows = spark.createDataFrame([("p", "m", i, v.split(","), None, None) for i, v in enumerate(lines)], archives.LINE_SCHEMA)
    got = {r.id: r for r in archives.parse_trades(rows.withColumn("line", F.array_join("cells", ",")), archives.AGG_TRADE_FIELDS).collect()}
    assert (got[7].first_trade_id, got[7].last_trade_id, got[7].reasons) == (10, 12, [])
    assert (got[8].reasons, got[9].reasons) == (["trade_id_order"], ["id_syntax"])
    assert got[10].reasons[0] == "field_count"


def test_frozen_evidence_replays_from_its_batch_only(spark, tmp_path):
    rows = [("a", 1, "2024-01-01", "2024-01-02"), ("a", 2, "2024-03-01", "2024-01-02"), (None, 3, None, "2024-01-01"), ("b", 4, "2024-01-01", "2024-01-01")]
    df = spark.createDataFrame(rows, "g string, k long, v string, c string").selectExpr("g", "k", "CAST(v AS timestamp) AS source_visible_at", "CAST(c AS timestamp) AS collected_at")
    root = str(tmp_path)
    intent = jobs.freeze(df, root, "2024-02-01 00:00:00", ["g"], ["k"], "1")
    assert jobs.freeze(df.repartition(3), root, "2024-02-01 00:00:00", ["g"], ["k"], "1") == intent  # content, not partitioning
    assert jobs.freeze(df, root, "2024-02-01 00:00:00", ["g"], ["k"], "2") != intent and jobs.freeze(df.where("k < 4"), root, "2024-02-01 00:00:00", ["g"], ["k"], "1") != intent
    decided = jobs.decide_frozen(spark, root, intent)
    assert jobs.decide_frozen(spark, root, intent) == decided
    proof = jobs.prove_frozen(spark, root, decided, 1)
    got = {r.g: (r.total, r.formal, r.rejected, r.undetermined, r.replay_status) for r in sinks.read_batch(spark, root, proof).collect()}
    assert got == {"a": (2, 1, 1, 0, "equal"), "b": (1, 1, 0, 0, "equal"), None: (1, 0, 0, 1, "equal")}
    # a decision that was published with other counts is told apart, group by group
    forged = sinks.read_batch(spark, root, decided).withColumn("formal", F.when(F.col("g") == "b", 9).otherwise(F.col("formal")).cast("bigint"))
    sinks.publish_batch(forged, root, "decision-forged", {k: sinks.read_manifest(spark, root, decided)[k] for k in ("kind", "intent", "intent_fingerprint")})
    got = {r.g: r.replay_status for r in sinks.read_batch(spark, root, jobs.prove_frozen(spark, root, "decision-forged", 1)).collect()}
    assert got == {"a": "equal", "b": "different", None: "equal"}
    data = sinks.read_manifest(spark, root, intent)["data"]
    df.where("k = 1").write.mode("append").parquet(f"{root}/batch_id={intent}/{data}")
    with pytest.raises(sinks.BatchAltered):
        jobs.prove_frozen(spark, root, decided, 2)
    assert [tuple(jobs.batch_state(spark, root, b).first())[1:] for b in (intent, decided)] == [(4, 5, "altered"), (3, 3, "intact")]
