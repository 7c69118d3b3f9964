"""Quality rules judged by host: rule failures are summed per host, their rates shrunk with an empirical beta prior,
and the host's verdict joined back to its documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import WORD, store

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Number of words that lie in a window of three found at least twice; every occurrence of the window counts."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1] if len(number) > 1_000_000 else pairs
    _, inverse, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The five base measures of a text, in the order of MEASURES; null is empty."""
    raw = (text or "").encode()
    words = raw.split()
    joined = b"".join(words)
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += bool(line.strip(b" \t\n\x0b\x0c\r"))
        else:
            seen.add(line)
    return len(words), len(joined.decode()), len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated_words(words)


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, host, text) to (doc_id, host, *MEASURES)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t.as_py()) for t in batch.column(2)], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, rows.T)], ["doc_id", "host", *MEASURES])

    kinds = dict(docs.dtypes)
    return docs.select("doc_id", "host", "text").mapInArrow(scan, f"doc_id {kinds['doc_id']}, host {kinds['host']}, " + ", ".join(f"{m} long" for m in MEASURES))


def judge(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """`measured` (doc_id, host, *MEASURES) with `base_failed`, `host_rate` and `kept`.

    A document fails by itself under 50 words, or if over half of its words are repeated. A host's failure rate is
    shrunk to the beta prior fitted to all hosts by moments (between-host variance beyond what counting alone gives);
    its documents go if the shrunken rate exceeds `max_rate`. So a host of few documents is judged mostly by the prior.
    Null is a host like any other. Hosts that hold any share of the rows are summed before the shuffle.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = measured.withColumn("base_failed", failed)
    hosts = store(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("bad")), "hosts")
    rate = F.col("bad") / F.col("n")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    n, bad = total["n"] or 0, total["bad"] or 0
    mean = bad / n if n else 0.0
    spread = hosts.agg(F.sum(F.col("n") * F.pow(rate - F.lit(mean), 2)).alias("s")).first()["s"] or 0.0
    # Moments: E[s] = mean (1 - mean) (hosts - 1) + between (n - nn / n).
    free = n - total["nn"] / n if n else 0.0
    between = max(0.0, (spread - mean * (1 - mean) * (total["hosts"] - 1)) / free) if free > 0 else 0.0
    weight = mean * (1 - mean) / between - 1 if between > 0 else 1e6
    weight = min(max(weight, 1.0), 1e6)
    verdicts = hosts.select(F.col("host").alias("__host"), ((F.col("bad") + mean * weight) / (F.col("n") + weight)).alias("host_rate"))
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("__host"))).drop("__host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_rate))


def rules_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("source").alias("host"), "text")
    return judge(store(measures(docs), "measures")).select("doc_id", *MEASURES, "base_failed", "kept")


RULES_SQL = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY ALL) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS bad FROM f GROUP BY source),
t AS (SELECT sum(n) AS n, sum(bad) / sum(n) AS mean, count(*) AS hosts, sum(n * n) AS nn FROM h),
s AS (SELECT sum(h.n * pow(h.bad / h.n - t.mean, 2)) AS s FROM h, t),
b AS (SELECT t.mean, greatest(0, (s - mean * (1 - mean) * (hosts - 1)) / nullif(n - nn / n, 0)) AS between_hosts FROM t, s),
p AS (SELECT mean, least(greatest(CASE WHEN between_hosts > 0 THEN mean * (1 - mean) / between_hosts - 1 ELSE 1e6 END, 1), 1e6) AS weight FROM b),
v AS (SELECT source, (bad + mean * weight) / (n + weight) <= 0.5 AS good FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
