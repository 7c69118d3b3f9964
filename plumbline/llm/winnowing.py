"""Document fingerprints by winnowing: hashes of all k-grams, the smallest of every window, the rightmost of equal ones.

Any passage of at least k + w - 1 characters that two texts share leaves a common hash in both; positions are kept, so
the shared place can be found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from plumbline.llm.shared import sliding_min, span_names, store

#: Any 12 shared characters leave a common hash, so a text of 16 on has one with a version that keeps three quarters of it.
GRAM, WINDOW = 5, 8
_STEP = 1 << 20


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text. A text shorter than k is one gram; the empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, len(codes))
    chosen = []
    for at in range(0, max(1, len(codes) - k + 1 - w + 1), _STEP):  # long texts in overlapping parts, so memory stays bounded
        h = (span_names(codes[at : at + _STEP + w - 1 + k - 1], k) >> np.uint64(32)).astype(np.uint32)
        n = len(h)
        width = min(w, n)
        # The low half makes the rightmost of equal hashes the smallest.
        m = sliding_min(h.astype(np.uint64) << np.uint64(32) | np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64), width)
        keep = m[np.concatenate(([True], m[1:] != m[:-1]))]
        chosen.append(np.stack(((keep >> np.uint64(32)).astype(np.int64), at + (np.uint64(0xFFFFFFFF) - (keep & np.uint64(0xFFFFFFFF))).astype(np.int64))))
    both = np.concatenate(chosen, axis=1)
    both = both[:, np.concatenate(([True], both[1, 1:] != both[1, :-1]))]
    return both[0].astype(np.uint32), both[1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the hashes of both that both have; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def printed(hashes: np.ndarray) -> str:
    """A fingerprint as text: eight hex digits a hash, in text order."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(doc_id, text) to (doc_id, hashes array<long>, positions array<long>). Null texts are empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [winnow(t.as_py() or "", k, w) for t in batch.column(1)]
            ends = np.cumsum([0, *[len(h) for h, _ in both]], dtype=np.int32)
            flat = [np.concatenate([np.empty(0, np.int64), *[x[i].astype(np.int64) for x in both]]) for i in (0, 1)]
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(f)) for f in flat]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "hashes", "positions"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, hashes array<long>, positions array<long>")


def in_ranges(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id long, text) cut into ranges of doc_id, each with a copy (`extra`) of the row that follows its last.

    The cut comes from the ids alone; one row per range, four times as many as there are shuffle partitions, passes the driver. Texts are
    shuffled once. The last range is followed by the very first row. Null ids come first, as the smallest number.
    """
    spark = docs.sparkSession
    id_ = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(id_.alias("id")).repartitionByRange(4 * parts, "id").withColumn("part", F.spark_partition_id())
    starts = np.array(sorted(r["a"] for r in store(ids.groupBy("part").agg(F.min("id").alias("a")), "ranges").collect()), dtype=np.int64)

    @F.pandas_udf(LongType())
    def place(ids):
        import pandas as pd

        return pd.Series(np.maximum(np.searchsorted(starts, ids.to_numpy(), side="right") - 1, 0))

    @F.pandas_udf("boolean")
    def leads(ids):
        import pandas as pd

        return pd.Series(np.isin(ids.to_numpy(), starts))

    last = max(len(starts) - 1, 0)
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), id_.alias("id")).withColumn("range", place("id")).withColumn("leads", leads("id"))
    before = F.when(F.col("range") == 0, F.lit(last).cast("long")).otherwise(F.col("range") - 1)
    copies = F.when(F.col("leads"), F.array(F.struct(F.col("range"), F.lit(False).alias("extra")), F.struct(before.alias("range"), F.lit(True).alias("extra")))).otherwise(
        F.array(F.struct(F.col("range"), F.lit(False).alias("extra"))))
    dealt = placed.select("doc_id", "text", "id", F.explode(copies).alias("c")).select("doc_id", "text", "id", "c.range", "c.extra")
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "extra", "id", "text")


def against_next(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Per row of `docs`: its fingerprint, that of its edited text (the last quarter replaced by the beginning of the next
    document), and the likeness to both. The next document is the next row by (doc_id, text); after the last comes the first."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for the next one: range, doc_id, text, hashes
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, _, part, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = winnow(text, k, w)[0]
                if held and held[0] == part:
                    _, own_id, own, own_hashes = held
                    cut = len(own) // 4
                    edited = own[: len(own) - cut] + text[:cut]
                    new = winnow(edited, k, w)[0]
                    out.append((own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), printed(own_hashes), printed(new), likeness(own_hashes, new), likeness(own_hashes, hashes)))
                held = None if extra else (part, doc_id, text, hashes)
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = in_ranges(docs.select(F.col("doc_id").cast("long"), "text"))
    return rows.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def winnowing_query(spark, sf_dir):
    return against_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
