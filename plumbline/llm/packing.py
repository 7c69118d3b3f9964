"""Best-fit packing of token sequences in bulk-synchronous steps.

Lengths and gaps are whole numbers up to the capacity, so documents and gaps of one size are alike. A step takes
all pieces of one length, longest first, and matches them with gaps by successor (the smallest gap that holds them,
then the next), k-th piece to k-th gap by rank, opens new sequences for what is left, and moves the used gaps down.
What a step decides depends only on how many pieces and gaps there are of each size; the sweep over sizes therefore runs on counts
(at most `capacity` of them, whatever the input), and its result, runs of equal pieces matched with runs of equal gaps, is
applied to the rows in parallel by their distributed rank. The outcome equals best-fit-decreasing done one piece at a time.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.shared import store

CAPACITY = 1024
END_ID = 2
#: Pieces of one length are ranked in cells of about so many.
CELL = 4_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """The byte-level BPE of a rank file, with special tokens (string, id). `encode_ordinary` takes their strings as text."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def default_vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the vocabulary byte_bpe_50k (the same ids as its tokenizers file gives)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: The added token of the tokenizers file of byte_bpe_50k, found inside texts whatever add_special_tokens says.
ADDED = (("<|endoftext|>", 50256),)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Tokenize (doc_id, text) and cut: a row per piece. Null texts are empty; an empty text is the end id alone.
    A document longer than the capacity gives pieces of exactly the capacity, the first one being shorter if need be."""
    known, added = vocabulary, ADDED if vocabulary is None else ()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, special = encoding(*(known or default_vocabulary()), added), {text for text, _ in added}
        encode = lambda text: bpe.encode(text, allowed_special=special, disallowed_special=())
        tail = [end_id]
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(encode(text.as_py() or "") + tail, dtype="<u4")
                lead = len(ids) % capacity
                bounds = [0, *([lead] if lead else []), *range(lead + capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    for column, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def plan_steps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The sweep over sizes. Returns runs (length, first rank, first sequence, pieces a sequence, offset): the pieces of that
    length from that rank on go, so many to each, into the sequences from that one on, at that offset."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> runs of sequences (first, how many)
    sizes: list[int] = []  # sizes with a gap, ascending
    runs, opened = [], 0

    def put(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(sizes, size)
            gaps[size].append((first, n))

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank = counts[length], 0
        at = bisect.bisect_left(sizes, length)
        while left and at < len(sizes):  # successors: the smallest gap that holds it, then larger ones
            size = sizes[at]
            first, n = gaps[size].pop()
            each = size // length
            whole = min(n, -(-left // each))
            runs.append((length, rank, first, each, capacity - size))
            placed = min(left, whole * each)
            full, rest = divmod(placed, each)
            if whole < n:
                gaps[size].append((first + whole, n - whole))
            if not gaps[size]:
                del gaps[size]
                sizes.pop(at)
            put(size - each * length, first, full)
            put(size - rest * length, first + full, 1 if rest else 0)
            left, rank = left - placed, rank + placed
            at = bisect.bisect_left(sizes, length)
        if left:
            each = capacity // length
            runs.append((length, rank, opened, each, 0))
            full, rest = divmod(left, each)
            put(capacity - each * length, opened, full)
            put(capacity - rest * length, opened + full, 1 if rest else 0)
            opened += full + (1 if rest else 0)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: each piece lies whole in one sequence, without gaps from offset 0.

    Pieces of one length may be any share of all: their ranks come from (length, hash of the id) cells that
    grow in number with the input. Equal rows are told apart by rank alone. An empty table gives no rows.
    """
    counted = pieces.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in counted.collect()}  # at most `capacity` rows
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("a piece must have between 1 and capacity tokens")
    runs = plan_steps(counts, capacity)
    lengths = sorted(counts)
    base = dict(zip(lengths, np.cumsum([0, *[counts[n] for n in lengths]])[:-1].tolist(), strict=True))
    runs.sort(key=lambda r: base[r[0]] + r[1])
    starts = np.array([base[r[0]] + r[1] for r in runs], dtype=np.int64)
    firsts, each, offsets, long = (np.array([r[i] for r in runs], dtype=np.int64) for i in (2, 3, 4, 0))

    spark = pieces.sparkSession
    cells = spark.createDataFrame([(n, -(-counts[n] // CELL)) for n in lengths], "length long, __cells long")
    celled = pieces.join(F.broadcast(cells), "length").withColumn("__cell", F.pmod(F.xxhash64("doc_id"), F.col("__cells"))).drop("__cells")
    totals = celled.groupBy("length", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("length").orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    placed = totals.select("length", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = W.partitionBy("length", "__cell").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = celled.withColumn("__rank", F.row_number().over(inside) - 1).join(placed, ["length", "__cell"])
    rows = ranked.withColumn("__rank", F.col("__rank") + F.col("__before")).drop("__cell", "__before")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            place = np.array([base[int(n)] for n in size], dtype=np.int64) + batch.column("__rank").to_numpy(zero_copy_only=False)
            run = np.searchsorted(starts, place, side="right") - 1
            inside = place - starts[run]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "__rank"}
            columns["sequence_id"] = pa.array(firsts[run] + inside // each[run])
            columns["offset"] = pa.array(offsets[run] + inside % each[run] * long[run])
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__rank")
    return rows.mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Tokenize, cut and pack (doc_id, text) documents."""
    return pack(store(token_pieces(docs.select("doc_id", "text"), capacity, END_ID, vocabulary), "pieces"), capacity)


def packing_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
