"""Removal of repeated strings by distributed prefix doubling over sampled suffixes.

A string of `length` bytes that starts in two documents is found by doubling: positions are named by their first half
(the names of 1, 2, 4, ... bytes paired at growing offsets), Spark brings equal names together and sorts them with their positions,
positions whose name is theirs alone drop out, and those that are left are named again by the pair (name here, name one
half further on), which reaches the threshold. Names are 64-bit digests instead of dense ranks: equal for equal strings, so
no round has to renumber.

The first round does not send all positions. In each string of `length` bytes the smallest of its half-length names stands for all; a string
and its copy have the same one. Neighbouring strings mostly share it, and such a run travels as one entry: the name, a digest
of the whole run, its place. A run whose digest is also in an earlier document is repeated as a whole. A run of which only the
name is shared goes to the second round, position by position. All others are unique and gone.

Entries travel as packed arrays, one row per task and range of names. Before that each task keeps, of equal entries, only those of the
smallest document and settles the others itself, so a passage that a third of all documents hold comes once from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import paired_names, sliding_min, span_names, store

LENGTH = 50
#: Windows worked on at once, and entries a task gathers before it sends them.
SEGMENT, FLUSH = 1 << 18, 300_000
ENTRIES = "bucket int, settled boolean, rids binary, docs binary, `row` binary, name binary, whole binary, lo binary, n binary"
SPANS = "rid long, round int, lo array<int>, n array<int>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.int64(-(2**63))  # null ids come before all others


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], out[1:] = 1, np.uint64(base)
    return np.cumprod(out)


class Runs:
    """Runs of windows with the same smallest name, for one `length`."""

    def __init__(self, length: int) -> None:
        self.length, self.half = length, -(-length // 2)
        self.width = length - self.half + 1
        size = SEGMENT + self.width
        self.up, self.down = powers(int(_ODD), size), powers(pow(int(_ODD), -1, 2**64), size)

    def of(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """(name, digest of the run, first window, number of windows), for parts of the text."""
        codes = np.frombuffer(text, np.uint8)
        for at in range(0, len(codes) - self.length + 1, SEGMENT):
            h = span_names(codes[at : at + SEGMENT + self.length - 1], self.half)
            m = sliding_min(h, self.width)
            lo = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
            hi = np.append(lo[1:], len(m))
            total = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * self.up[: len(h)], out=total[1:])
            whole = (total[hi + self.width - 1] - total[lo]) * self.down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            yield m[lo], whole ^ whole >> np.uint64(32), at + lo, hi - lo


class Sender:
    """Gathers entries of a task and packs them into one row per bucket."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.rids, self.docs = buckets, [], []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rid: int, doc: int, name: np.ndarray, whole: np.ndarray, lo: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((np.full(len(lo), len(self.rids), np.uint32), name, whole, lo.astype(np.uint32), n.astype(np.uint32)))
        self.rids.append(rid)
        self.docs.append(doc)
        self.size += len(lo)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        row, name, whole, lo, n = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        rids, docs = np.array(self.rids, np.int64), np.array(self.docs, np.int64)
        self.__init__(self.buckets)
        order = np.lexsort((docs[row], whole))
        doc, head = docs[row][order], np.concatenate(([True], whole[order][1:] != whole[order][:-1]))
        least = doc[head][np.cumsum(head) - 1]
        later = np.zeros(len(row), bool)
        later[order] = doc > least  # an equal entry of a smaller document is in this very task
        bucket = (name * _ODD >> np.uint64(32)) % np.uint64(self.buckets)
        bucket[later] = rids[row[later]].astype(np.uint64) % np.uint64(self.buckets)
        order = np.lexsort((row, later, bucket))
        edge = np.flatnonzero(np.concatenate(([True], (bucket[order][1:] != bucket[order][:-1]) | (later[order][1:] != later[order][:-1]))))
        out: list[list] = [[] for _ in range(9)]
        for a, b in zip(edge, np.append(edge[1:], len(order)), strict=True):
            at = order[a:b]
            used, local = np.unique(row[at], return_inverse=True)
            done = bool(later[at[0]])
            packed = (rids[used], docs[used], local.astype(np.uint32), (name[at] if not done else name[:0]).astype("<u8"), whole[at] if not done else whole[:0], lo[at], n[at])
            for column, value in zip(out, (int(bucket[at[0]]), done, *(p.tobytes() for p in packed)), strict=True):
                column.append(value)
        kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 7)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["bucket", "settled", "rids", "docs", "row", "name", "whole", "lo", "n"])


def spans_by_row(rid: np.ndarray, round_: int, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row per rid with its places as lists."""
    order = np.lexsort((lo, rid))
    rid = rid[order]
    head = np.flatnonzero(np.concatenate(([True], rid[1:] != rid[:-1]))) if len(rid) else np.empty(0, np.int64)
    ends = pa.array(np.append(head, len(rid)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order].astype(np.int32))) for x in (lo, n)]
    return pa.RecordBatch.from_arrays([pa.array(rid[head]), pa.array(np.full(len(head), round_, np.int32)), *lists], ["rid", "round", "lo", "n"])


def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """All entries of one bucket: those of an equal run in an earlier document are repeated (round 0); of names that
    several documents share otherwise, the entries go on to the next round (round 1)."""
    parts = []
    for _, settled, *packed in rows:
        rids, docs, row, name, whole, lo, n = (np.frombuffer(p, t) for p, t in zip(packed, ("<i8", "<i8", "<u4", "<u8", "<u8", "<u4", "<u4"), strict=True))
        if settled:
            yield spans_by_row(rids[row], 0, lo, n)
        else:
            parts.append((rids[row], docs[row], name, whole, lo, n))
    if not parts:
        return
    rid, doc, name, whole, lo, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((doc, whole, name))
    rid, doc, name, whole, lo, n = (x[order] for x in (rid, doc, name, whole, lo, n))
    new_name = np.concatenate(([True], name[1:] != name[:-1]))
    new_run = new_name | np.concatenate(([True], whole[1:] != whole[:-1]))
    repeated = doc > doc[new_run][np.cumsum(new_run) - 1]
    if repeated.any():
        yield spans_by_row(rid[repeated], 0, lo[repeated], n[repeated])
    starts = np.flatnonzero(new_name)
    group = np.cumsum(new_name) - 1
    several = (np.add.reduceat(new_run.astype(np.int64), starts) > 1) & (np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts))
    open_ = several[group] & ~repeated
    if open_.any():
        yield spans_by_row(rid[open_], 1, lo[open_], n[open_])


def settled(entries: DataFrame) -> DataFrame:
    """Bring the entries of a bucket together and settle them; a task holds one bucket at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for bucket, done, *packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:], strict=True):
                if held and held[0][0] != bucket:
                    yield from settle(held)
                    held = []
                held.append((bucket, done, *[p.as_buffer() for p in packed]))  # views of the batch, no copies
        if held:
            yield from settle(held)

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(scan, SPANS)


def bucket_count(spark) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def first_round(keyed: DataFrame, length: int) -> DataFrame:
    buckets = bucket_count(keyed.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, sender = Runs(length), Sender(buckets)
        for batch in batches:
            for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for name, whole, lo, n in runs.of(text.as_py().encode("utf-8", "surrogatepass")):
                    sender.add(rid, _FIRST if doc is None else doc, name, whole, lo, n)
                    if sender.size >= FLUSH:
                        yield from sender.flush()
        yield from sender.flush()

    return settled(keyed.mapInArrow(scan, ENTRIES))


def second_round(keyed: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """Name every position of the open runs by its pair of halves, and settle these."""
    buckets = bucket_count(keyed.sparkSession)
    half = -(-length // 2)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets)
        for batch in batches:
            for rid, doc, text, lows, many in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:], strict=True):
                codes = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                lo, n = (x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lows, many))
                for at in range(0, len(codes) - length + 1, SEGMENT):
                    a, b = np.maximum(lo, at), np.minimum(lo + n, at + SEGMENT)
                    a, m = a[b > a], (b - a)[b > a]
                    if not len(a):
                        continue
                    h = span_names(codes[at : at + SEGMENT + length - 1], half)
                    place = np.repeat(a - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())
                    pair = paired_names(h[place - at], h[place - at + length - half])
                    sender.add(rid, _FIRST if doc is None else doc, pair, pair, place, np.ones(len(place)))
                    if sender.size >= FLUSH:
                        yield from sender.flush()
        yield from sender.flush()

    open_ = spans.where("round = 1").groupBy("rid").agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("n")).alias("n"))
    return settled(keyed.join(open_, "rid").select("rid", "doc_id", "text", "lo", "n").mapInArrow(scan, ENTRIES))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` (doc_id, text) with the repeated strings of each row: first places `lo` and numbers `n` of runs of them, in no order; null where there are none."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    first = store(first_round(keyed, length), "repeats")
    second = second_round(keyed, first, length)
    found = first.where("round = 0").unionByName(second).groupBy("rid").agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("n")).alias("n"))
    return keyed.join(found, "rid", "left").select("doc_id", "text", "lo", "n")


def merged(lows: pa.ListScalar, many: pa.ListScalar, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes (starts, lengths) that the repeated strings cover."""
    if lows.values is None or not len(lows.values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lo = lows.values.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], (lo + many.values.to_numpy(zero_copy_only=False) + length - 1)[order]
    reach = np.maximum.accumulate(hi)
    head = np.concatenate(([True], lo[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(head)[1:], len(lo)) - 1
    return lo[head], reach[last] - lo[head]


def removed_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of `docs` (doc_id, text): the text as bytes, and the maximal runs of bytes that lie in a string of `length` bytes
    which also starts in a document with a smaller doc_id. Strings are judged on the input; overlaps count.

    Null texts are empty, null ids are the smallest, rows with equal ids do not remove from each other. Returns doc_id, text,
    `starts` and `lengths` of the runs (array<long>). Texts shorter than `length` lose nothing; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [merged(lo, n, length) for lo, n in zip(batch.column(2), batch.column(3), strict=True)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([x[i] for x in both], kind) for i in (0, 1)]], ["doc_id", "text", "starts", "lengths"])

    return repeats(docs, length).mapInArrow(scan, "doc_id long, text string, starts array<long>, lengths array<long>")


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What `removed_spans` removes, as counts and the SHA-256 of the bytes that are left."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, lo, n in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                starts, sizes = merged(lo, n, length)
                kept, at = hashlib.sha256(), 0
                for a, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                    kept.update(raw[at:a])
                    at = a + size
                kept.update(raw[at:])
                rows.append((doc_id, len(raw), int(sizes.sum()), len(starts), kept.hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (*[pa.int64()] * 4, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return repeats(docs, length).mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_query(spark, sf_dir):
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substring(h, CAST(2 * i + 1 AS BIGINT), 100)) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM s) WHERE least < doc_id),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER w <= 50 THEN 0 ELSE 1 END AS head FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM c GROUP BY doc_id, run),
kept AS (SELECT doc_id, substring(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)) AS piece, a FROM (
    SELECT d.doc_id, d.h, coalesce(lag(b) OVER w, 0) AS a, s.a AS b FROM d JOIN spans s USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY s.a)
    UNION ALL SELECT d.doc_id, d.h, coalesce(e.b, 0) AS a, length(d.h) // 2 AS b FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM spans GROUP BY doc_id) e USING (doc_id))),
k AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS piece FROM kept GROUP BY doc_id),
t AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(t.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(t.n, 0) AS BIGINT) AS n_spans, sha256(unhex(k.piece)) AS kept_sha256
FROM d JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""
