"""Document quality from a linear-chain conditional random field over lines.

Each line of a text is good or bad. Its features are measures of the line itself and of its neighbours; the chain's transition
weights tie adjacent lines together. The field is trained by maximum conditional likelihood on labelled documents whose lines
carry their document's label. A document's quality is the length-weighted mean of its lines' marginal probabilities from
forward-backward, mapped to a probability by a logistic curve fitted on the same training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.shared import quoted

THRESHOLD = 0.7
#: Bounds of the training sample: so many labelled documents at most, none longer than so many characters, and so many lines in all.
MAX_DOCS, MAX_CHARS, MAX_LINES = 4000, 20_000, 400_000

SYMBOLS, UPPER, DIGITS, ENDS = b"#*$%&<>@^~=_{}\\", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?:;\"')"
OWN = 12  # measures of a line
WIDTH = 3 * OWN  # with those of the line before and the line after


def line_measures(line: bytes, seen: set[bytes]) -> tuple[float, ...]:
    words = line.split()
    n, size = len(words), len(line)
    if not n:
        return (1.0, *[0.0] * (OWN - 1))
    count = lambda chars: size - len(line.translate(None, chars))
    again = line in seen
    seen.add(line)
    letters = max(1, count(UPPER + UPPER.lower()))
    pairs = n - 1
    return (
        1.0, min(count(SYMBOLS) / n, 4.0) / 2, count(UPPER) / letters, min(line.count(b"!") / n, 3.0), min(line.count(b"|") / n, 2.0),
        count(DIGITS) / size * 4, 1 - len(set(words)) / n, 1 - len(set(zip(words, words[1:], strict=False))) / pairs if pairs else 0.0,
        min(np.log1p(n) / 5, 1.5), min((size - n) / n / 10, 3.0), float(line.rstrip()[-1:] not in ENDS), float(again))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, line lengths in bytes plus 1). Null is empty; an empty text is one empty line."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    seen: set[bytes] = set()
    own = np.array([line_measures(line, seen) for line in lines])
    out = np.zeros((len(lines), WIDTH))
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN :] = own[1:]
    return out, np.array([len(line) + 1 for line in lines], np.float64)


def marginals(scores: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once. scores: lines x 2, chains one after the other, beginning at `starts`.

    Returns the marginals, the pair marginals summed over all adjacent lines (2 x 2), and each chain's log partition.
    Chains advance together, the longest first, so a step works on all chains that still have a line there.
    """
    ends = np.append(starts[1:], len(scores))
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    length = ends - starts
    at_least = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), side="right")  # chains with that many lines
    forward, backward = np.array(scores), np.zeros_like(scores)
    both = lambda a: np.logaddexp(a[..., 0], a[..., 1])
    for t in range(1, len(at_least)):
        here = starts[: at_least[t]] + t
        forward[here] += both((forward[here - 1][:, :, None] + moves).transpose(0, 2, 1))
    for t in range(len(at_least) - 1, 0, -1):
        here = starts[: at_least[t]] + t
        backward[here - 1] = both(moves + (scores[here] + backward[here])[:, None, :])
    partition = np.empty(len(starts))
    partition[order] = both(forward[ends - 1]) if len(ends) else 0
    total = np.repeat(partition, np.diff(np.append(np.sort(starts), len(scores))))
    single = np.exp(forward + backward - total[:, None])
    inner = np.ones(len(scores), bool)
    inner[starts] = False
    later = np.flatnonzero(inner)
    pairs = np.exp(forward[later - 1][:, :, None] + moves + (scores[later] + backward[later])[:, None, :] - total[later][:, None, None]).sum(axis=0)
    return single, pairs, partition


def by_length(single: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' probability of being good, per chain."""
    return np.add.reduceat(single[:, 1] * sizes, starts) / np.add.reduceat(sizes, starts)


@dataclass(frozen=True)
class LineField:
    """Weights of a trained field: emission (WIDTH x 2), transition (2 x 2), and the logistic curve (slope, shift)."""

    emit: np.ndarray
    moves: np.ndarray
    curve: tuple[float, float]

    def raw(self, x: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return by_length(marginals(x @ self.emit, self.moves, starts)[0], sizes, starts)

    def score(self, x: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * self.raw(x, sizes, starts) + self.curve[1])))


def adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for k in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return w


def train(x: np.ndarray, sizes: np.ndarray, starts: np.ndarray, good: np.ndarray, steps: int = 150, l2: float = 1e-3) -> LineField:
    """Fit on documents (chains) with label `good`. Without documents of both labels the score is their share, for any text."""
    if not len(good) or good.min() == good.max():
        return LineField(np.zeros((WIDTH, 2)), np.zeros((2, 2)), (0.0, 20.0 if not len(good) or good[0] else -20.0))
    lengths = np.diff(np.append(starts, len(x)))
    label = np.repeat(good, lengths)
    weight = np.repeat(1 / lengths, lengths)[:, None] / len(good)  # documents count alike, however many lines they have
    seen = x.T @ (np.eye(2)[label] * weight)
    inner = np.ones(len(x), bool)
    inner[starts] = False
    stay = np.bincount(label[inner] * 3, minlength=4).reshape(2, 2) / max(1, inner.sum())

    def gradient(w: np.ndarray) -> np.ndarray:
        emit, moves = w[: 2 * WIDTH].reshape(WIDTH, 2), w[2 * WIDTH :].reshape(2, 2)
        single, pairs, _ = marginals(x @ emit, moves, starts)
        up = x.T @ (single * weight) - seen + l2 * emit
        return np.concatenate((up.ravel(), (pairs / max(1, inner.sum()) - stay + 0.05 * moves).ravel()))

    w = adam(gradient, np.zeros(2 * WIDTH + 4), steps, 0.1)
    field = LineField(w[: 2 * WIDTH].reshape(WIDTH, 2), w[2 * WIDTH :].reshape(2, 2), (1.0, 0.0))
    raw = field.raw(x, sizes, starts)

    def slope(c: np.ndarray) -> np.ndarray:
        miss = 1 / (1 + np.exp(-np.clip(c[0] * raw + c[1], -30, 30))) - good
        return np.array([(miss * raw).mean() + 1e-4 * c[0], miss.mean() + 1e-4 * c[1]])

    a, b = adam(slope, np.array([4.0, -2.0]), 400, 0.1)
    return LineField(field.emit, field.moves, (float(a), float(b)))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def featurize(docs: DataFrame, extra: dict[str, str]) -> DataFrame:
    """(text, extra columns) to (lines array<double> row by row, sizes array<double>, extra columns)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(0)]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x.ravel() for x, _ in rows], kind), pa.array([s for _, s in rows], kind), *batch.columns[1:]], ["lines", "sizes", *extra])

    return docs.select("text", *extra).mapInArrow(scan, "lines array<double>, sizes array<double>, " + ", ".join(f"{k} {v}" for k, v in extra.items()))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, max_lines: int = MAX_LINES) -> LineField:
    """Train on labelled documents outside the held-out fold: those of the `max_docs` smallest MD5 of their ids, one row an id
    (the smallest text of repeated ids), in that order as long as they have at most `max_lines` lines together.

    The sample is cut before it is collected, so no more than that comes to the driver. Conflicting labels of one id
    count as bad; null labels are left out.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_docs)
    text = F.coalesce("text", F.lit(""))
    short = docs.where(F.length(text) <= max_chars).select("doc_id", text.alias("text"))
    single = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    drawn = W.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").rowsBetween(W.unboundedPreceding, 0)  # over max_docs rows at most
    within = single.withColumn("n", F.sum(lines).over(drawn)).where(F.col("n") <= max_lines)
    rows = featurize(within, {"doc_id": dict(docs.dtypes)["doc_id"], "good": "int"})
    got = sorted(rows.collect(), key=lambda r: r["doc_id"])
    xs = [np.array(r["lines"]).reshape(-1, WIDTH) for r in got]
    sizes = [np.array(r["sizes"]) for r in got]
    good = [int(r["good"] > 0) for r in got]
    if not xs:
        return train(np.zeros((0, WIDTH)), np.zeros(0), np.zeros(0, int), np.zeros(0, int))
    return train(np.concatenate(xs), np.concatenate(sizes), np.cumsum([0, *[len(s) for s in sizes[:-1]]]), np.array(good))


def score(docs: DataFrame, field: LineField, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from THRESHOLD on); columns of these names in `docs` are replaced.
    Row by row: no shuffle, whole texts, any length. Null texts are empty."""
    names = [f.name for f in docs.schema]
    kept = [i for i, name in enumerate(names) if name.lower() not in ("score", "predicted")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, values = batch.column(names.index(text)), []
            for i in range(0, len(texts), 256):  # a few hundred texts at a time: their features stay small
                rows = [features(t.as_py()) for t in texts[i : i + 256]]
                starts = np.cumsum([0, *[len(s) for _, s in rows[:-1]]])
                values.append(field.score(np.concatenate([x for x, _ in rows]), np.concatenate([s for _, s in rows]), starts))
            got = np.concatenate(values) if values else np.empty(0)
            columns = [*[batch.column(i) for i in kept], pa.array(got), pa.array((got >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*[names[i] for i in kept], "score", "predicted"])

    schema = T.StructType([*[docs.schema[i] for i in kept], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(scan, schema)  # by place: names may hold dots


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with its columns, that the classifier accepts."""
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("r"), F.col("text").alias("t"))
    kept = score(packed, fit(docs, labels), "t").where("predicted = 1")
    return kept.select(*[F.col("r")[c].alias(c) for c in docs.columns])


def quality_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score(docs, fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
