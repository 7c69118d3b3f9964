"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. Two blocks of 23 of them are covered by the binary Golay code, a perfect code: every block
lies within 3 bits of exactly one of its 4,096 words. A pair of code words is an anchor. Each fingerprint has one home anchor
(the nearest) and visits every anchor that some fingerprint within the threshold may have as its home: a block visits the
words within 3 + f bits, f being the bits by which the two may differ in that block, all f together at most the threshold.
Two linked fingerprints therefore always meet at each other's home, where homes are compared with visitors on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import store

#: Length, radius and generator polynomial of the binary Golay code.
BLOCK, RADIUS, GENERATOR = 23, 3, 0b101011100011
BLOCKS = 2
SEED = 42


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fingerprint(text: str | None, n: int = 3) -> int:
    """SimHash of the text's n-word shingles, repeats counted: a bit is 1 if it is set in over half of the hashes."""
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < n:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    votes, total = np.zeros(64, np.int64), len(words) - n + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    while True:
        part = np.fromiter((digest(s, SEED) for s in islice(shingles, 65_536)), "<u8")
        if len(part):
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        if len(part) < 65_536:
            break
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, text) to (doc_id, text_hash, fp): the fingerprint as a signed long. Null and blank texts have fingerprint zero."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), n) for t in batch.column(2)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "text_hash", "fp"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(scan, f"doc_id {kind}, text_hash long, fp long")


def remainders(blocks: np.ndarray) -> np.ndarray:
    """Remainder of each block's polynomial by the generator: 0 for code words, the same for what lies equally off them."""
    left = blocks.astype(np.int64)
    for bit in range(BLOCK - 1, 10, -1):
        left = np.where(left >> bit & 1, left ^ GENERATOR << (bit - 11), left)
    return left


@lru_cache(maxsize=4)
def offsets(threshold: int) -> tuple[np.ndarray, ...]:
    """By remainder: the differences that lead to code words within RADIUS + threshold, and how far beyond RADIUS each is.
    A flat pair of arrays sorted by remainder, and where each remainder starts."""
    flips = [sum(1 << b for b in bits) for w in range(RADIUS + threshold + 1) for bits in combinations(range(BLOCK), w)]
    diff = np.array(flips, dtype=np.int64)
    over = np.maximum(np.bitwise_count(diff).astype(np.int64) - RADIUS, 0)
    key = remainders(diff)
    order = np.lexsort((over, key))
    starts = np.searchsorted(key[order], np.arange(2**11 + 1))
    return diff[order], over[order], starts


def visits(values: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each fingerprint (uint64): its row, every anchor it visits, and whether that is its home."""
    diff, over, starts = offsets(threshold)
    row, anchor, spent = np.arange(len(values)), np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    for b in range(BLOCKS):
        block = (values >> np.uint64(b * BLOCK) & np.uint64(2**BLOCK - 1)).astype(np.int64)
        first = starts[remainders(block)]
        n = starts[remainders(block) + 1] - first
        many = n[row]
        at = np.repeat(first[row] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        row, anchor, spent = np.repeat(row, many), np.repeat(anchor, many), np.repeat(spent, many) + over[at]
        anchor = anchor << BLOCK | block[row] ^ diff[at]
        keep = spent <= threshold
        row, anchor, spent = row[keep], anchor[keep], spent[keep]
    return row, anchor, spent == 0


def links(prints: DataFrame, threshold: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints in `prints` (fp, distinct) that differ in at most `threshold` bits.

    A fingerprint has few possible neighbours (2,080 at two bits), so the pairs grow with the fingerprints, not with
    the square of a group: equal fingerprints of many documents are one row here.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(values), 4096):
                part = values[i : i + 4096]
                row, anchor, home = visits(part.view(np.uint64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row]), pa.array(home)], ["anchor", "fp", "home"])

    placed = prints.mapInArrow(spread, "anchor long, fp long, home boolean")
    home = placed.where("home").select("anchor", F.col("fp").alias("b"))
    visitor = placed.select("anchor", F.col("fp").alias("a"))
    met = home.hint("merge").join(visitor, "anchor").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold))
    return met.select("a", "b")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): of every node of `edges` (a, b), the smallest node that it can reach.

    Alternating steps: every node links its larger neighbours to its smallest one, then its smaller neighbours and itself
    to the smallest. Each step is one shuffle of the edges, at most as many as there were; a few rounds, logarithmic
    in the longest chain, suffice. Each round is a stored table, so the plan stays short and lost work is re-read.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now, before = store(both.groupBy("a").agg(F.min("b").alias("b")).where("b < a").select("a", "b").union(edges.where("a > b").select("a", "b")).union(
        edges.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"), None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        now = store(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.countDistinct("a")).first()
        if state == before and state[0] == state[2]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError("components did not settle")


def near_groups(docs: DataFrame, threshold: int = 2, n: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of `docs` (doc_id, text); root is the component's smallest fingerprint.

    component_id is the smallest doc_id reachable over links of at most `threshold` differing bits, the row's own included.
    Blank and null texts share fingerprint zero, which links like any other. Repeated rows come out repeated;
    a null doc_id is never a component's id unless nothing else is in it. An empty table gives no rows.
    """
    prints = store(fingerprints(docs, n), "prints")
    least = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(store(links(least.select("fp"), threshold), "links"))
    named = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = named.select("fp", "root").join(groups, "root").select("fp", "root", "component_id")
    return prints.join(members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, threshold: int = 2, n: int = 3) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of `docs`: the smallest doc_id (null last), among its rows any one."""
    return smallest(docs, near_groups(docs.select("doc_id", "text"), threshold, n))


def smallest(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of `docs` for each root of `groups` (doc_id, text_hash, root): the smallest doc_id (null last), among its rows any one."""
    best = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("b")).select(F.col("b.doc_id").alias("i"), F.col("b.text_hash").alias("h"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col("doc_id"), F.xxhash64("text").alias("h"))
    kept = rows.alias("k").join(best.alias("b"), F.col("k.doc_id").eqNullSafe(F.col("b.i")) & (F.col("k.h") == F.col("b.h")), "left_semi").dropDuplicates(["doc_id", "h"])
    return kept.select(*[F.col("r")[c].alias(c) for c in docs.columns])


def near_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
