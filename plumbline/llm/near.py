"""Near-duplicates by SimHash and exact Jaccard similarity of five-word shingles, every pair of 0.8 or more found.

The groups of `simhash.near_groups` (fingerprints of five-word shingles, anchors of Golay code words, components) come first. Each
set of a group is compared in full with one of them, drawn anew for each group, and joins it if it is near.

At a similarity of 0.8 fingerprints of 64 bits differ in about ten bits, with a spread of three, and no number of blocks bounds
that, so the pairs that lie further apart than a group reaches are found by prefixes, exactly. Shingles are put in one order for
all texts, the rarer first. Two sets of a similarity of 0.8 share one of the first floor(n / 5) + 1 shingles of each (its prefix),
so texts meet where prefixes do. Rarity only decides how many meet; it is counted in a fixed number of cells.

Where many meet, each is first compared with one of them, drawn anew for each shingle, so a crowd of near copies joins in
linear work (what the fingerprints have joined is not compared again); then only those that are still apart are compared with each other. Most of these share a passage and are not near. Every set has a
sketch for them: shingles are dealt over a few hundred bits, and a bit says whether their number is odd. A shingle in one of two sets only
changes one bit, so sketches differ in no more bits than the sets have shingles apart, and where they differ in more than a near pair can, the pair is none.
Sketches are compared inside the join, so that only what may be near leaves it, and only that is read and compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import span_names, store
from plumbline.llm.simhash import SEED, components, near_groups, smallest, words_of

#: Similarity from which texts are near: NEAR / OF.
NEAR, OF = 4, 5
SHINGLE = 5
CELLS = 1 << 18
#: 64-bit words of a sketch.
SKETCH = 8
_ROWS = 512


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Names (64 bits, ascending) of the different n-word shingles; all words are one if there are fewer. Blank texts have none."""
    import xxhash

    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.unique(span_names(np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words)), min(n, len(words))))


def set_name(names: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(names.tobytes(), SEED)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    return (NEAR + OF) * len(np.intersect1d(a, b, assume_unique=True)) >= NEAR * (len(a) + len(b))


def sketch(names: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of the 64 * SKETCH bits."""
    odd = np.bincount((names >> np.uint64(40)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, sid, w0, w1, ...): the name of each row's set of shingles, and its sketch."""
    words = [f"w{i}" for i in range(SKETCH)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, bits = np.empty(len(batch), np.uint64), np.empty((SKETCH, len(batch)), np.int64)
            for i, t in enumerate(batch.column(2)):
                names = shingles(t.as_py())
                sid[i], bits[:, i] = set_name(names), sketch(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sid.view(np.int64)), *map(pa.array, bits)], ["doc_id", "text_hash", "sid", *words])

    kinds = ", ".join(f"{w} long" for w in words)
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, sid long, {kinds}")


def rarity(docs: DataFrame) -> np.ndarray:
    """How many shingles fall into each of CELLS cells; so many numbers come to the driver, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(total, (shingles(t.as_py()) & np.uint64(CELLS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    got = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def prefixes(docs: DataFrame) -> DataFrame:
    """(token, sid, at, n): the prefix of each row, `at` being the place in it and n the number of shingles of the set."""
    weight = rarity(docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), _ROWS):
                out = []
                for t in batch.column(0).slice(i, _ROWS):
                    names = shingles(t.as_py())
                    if len(names):
                        cut = len(names) * (OF - NEAR) // OF + 1
                        first = names[np.lexsort((names, weight[(names & np.uint64(CELLS - 1)).astype(np.int64)]))[:cut]]
                        sid = np.full(len(first), set_name(names), np.uint64)
                        out.append((first.view(np.int64), sid.view(np.int64), np.arange(len(first), dtype=np.int32), np.full(len(first), len(names), np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["token", "sid", "at", "n"])

    return docs.select("text").mapInArrow(scan, "token long, sid long, at int, n int")


def may_be_near(a: str, b: str) -> Column:
    """Whether enough shingles are left from the shared one on: a pair passes at the first that it shares, or is not near."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at")).cast("long")
    return left * (NEAR + OF) >= (F.col(f"{a}.n").cast("long") + F.col(f"{b}.n")) * NEAR


def sketches_near(a: str, b: str) -> Column:
    """Whether the sketches differ in no more bits than near sets have shingles that only one of them has: a ninth of both together."""
    apart = sum((F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}"))) for i in range(SKETCH)), F.lit(0)).cast("long")
    return apart * (NEAR + OF) <= (F.col(f"{a}.n").cast("long") + F.col(f"{b}.n")) * (OF - NEAR)


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose sets are near. Only texts in some pair are read."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), _ROWS):
                part = batch.slice(i, _ROWS)
                names = [shingles(t.as_py()).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.list_(pa.int64()))], ["sid", "names"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([x.values.to_numpy() for x in batch.column(c)] for c in (2, 3))
            keep = pa.array([near(x, y) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    texts = sets.join(nodes, "sid").groupBy("sid").agg(F.min("text_hash").alias("h"))
    rows = docs.select("text", F.xxhash64("text").alias("h")).join(texts, "h").dropDuplicates(["sid"])
    names = store(rows.select("sid", "text").mapInArrow(name, "sid long, names array<long>"), "shingles")
    both = pairs.join(names.select(F.col("sid").alias("a"), F.col("names").alias("x")), "a").join(names.select(F.col("sid").alias("b"), F.col("names").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def fingerprint_pairs(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of each set with the drawn one of its SimHash group: as many as there are sets, however large a group is."""
    groups = near_groups(docs, n=SHINGLE).select("text_hash", "root").distinct()
    members = store(groups.join(sets.select("text_hash", "sid").distinct(), "text_hash").select("root", "sid").distinct(), "groups")
    lead = members.groupBy("root").agg(F.min(F.struct(F.xxhash64("sid", "root").alias("draw"), "sid")).alias("l")).select("root", F.col("l.sid").alias("lead"))
    return members.join(lead, "root").where("sid <> lead").select(*ordered("sid", "lead")).distinct()


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) that `roots` (sid, root) does not lead to one root."""
    of = lambda c: roots.select(F.col("sid").alias(c), F.col("root").alias(f"{c}_root"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def near_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, root) per row of `docs` (doc_id, text): root is the smallest set that a chain of near ones leads to."""
    sets = store(named(docs), "sets")
    alike = store(verified(store(fingerprint_pairs(docs, sets), "pairs"), docs, sets), "links")
    joined = components(alike).withColumnRenamed("node", "sid")
    entries = store(prefixes(docs), "prefixes")
    met = entries.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi").select("token")
    shared = store(entries.join(store(met, "tokens"), "token").distinct(), "shared")
    lead = shared.groupBy("token").agg(F.min(F.struct(F.xxhash64("sid", "token").alias("draw"), "sid", "at", "n")).alias("l")).select("token", "l.sid", "l.at", "l.n")
    pair = lambda df: store(df.select(*ordered("x.sid", "y.sid")).distinct(), "pairs")
    star = pair(shared.alias("x").join(lead.alias("y"), "token").where((F.col("x.sid") != F.col("y.sid")) & may_be_near("x", "y")))
    links = store(alike.union(verified(store(still_apart(star, joined), "pairs"), docs, sets)), "links")
    roots = components(links).withColumnRenamed("node", "sid")
    apart = shared.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    still = apart.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    drawn = sets.dropDuplicates(["sid"]).select("sid", *[f"w{i}" for i in range(SKETCH)])
    apart = store(apart.join(still, "token").join(drawn, "sid"), "apart")
    rest = pair(apart.alias("x").join(apart.alias("y"), "token").where(
        (F.col("x.sid") < F.col("y.sid")) & (F.col("x.root") != F.col("y.root")) & may_be_near("x", "y") & sketches_near("x", "y"))).join(star, ["a", "b"], "left_anti")
    more = store(verified(store(rest, "pairs"), docs, sets), "links")
    final = components(store(links.union(more), "links")).withColumnRenamed("node", "sid")
    return sets.join(final, "sid", "left").select("doc_id", "text_hash", F.coalesce("root", "sid").alias("root"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near texts, with the columns of `docs`: the smallest doc_id (null last), among its rows any one. Blank and null texts are one group."""
    return smallest(docs, near_sets(docs.select("doc_id", "text")))
