"""Periodic runs of words in every document, by a suffix automaton with link-cut access.

The words of a text are appended to a suffix automaton one by one. Its suffix links form a tree; the strings that end at
word i are the nodes from the state of prefix i up to the root. A link-cut tree holds the links, and each of its solid paths
has one colour: where its strings ended last. `access` of prefix i meets the solid paths from the bottom up and recolours
them with i. A path met with colour e, entered at a node of length m, says that the longest equal stretches ending at e and at i have m words.
With d = i - e <= m that is a square: the d + m words up to i have period d, no smaller one, and cannot grow to the left.
All squares with one start and period belong to one run, which ends at the last of them.

A run of at least four periods and six words repeats five words in a row at its own period everywhere. So the automaton
is only built over stretches of positions whose five words occur again within a quarter of the stretch: a run never
leaves its stretch, and in running prose there are none. Stretches met before in the same task are not worked out again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import BLANK, table

SHORTEST, EXPONENT = 6, 4
#: Adjacent words that any run must repeat: the shortest run has SHORTEST words and period 1.
GRAM = 5
_ROWS = 64
RUN = "struct<start:long,length:long,period:long>"


def automaton(values: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states of the suffix automaton of `values`, and the state of every prefix."""
    moves: list[dict[int, int]] = [{}]
    link, length, prefixes, last = [0], [0], [], 0
    for value in values:
        now = len(link)
        link.append(0)
        length.append(length[last] + 1)
        moves.append({})
        at, top = last, False
        while value not in moves[at]:
            moves[at][value] = now
            if at == 0:
                top = True
                break
            at = link[at]
        if not top:
            target = moves[at][value]
            if length[target] == length[at] + 1:
                link[now] = target
            else:
                clone = len(link)
                link.append(link[target])
                length.append(length[at] + 1)
                moves.append(moves[target].copy())
                while moves[at].get(value) == target:
                    moves[at][value] = clone
                    if at == 0:
                        break
                    at = link[at]
                link[target] = link[now] = clone
        last = now
        prefixes.append(now)
    return link, length, prefixes


def squares(values: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) of every maximal repetition of at least two periods, with the last word in it.

    Memory is linear in `values`; time is linear but for a logarithm (amortised cost of link-cut access).
    """
    link, length, prefixes = automaton(values)
    # One splay tree per solid path, ordered by depth. State 0, the root, has no length and stands for "none".
    left, right, up, colour = [0] * len(link), [0] * len(link), link, [-1] * len(link)

    def splay(x: int) -> int:
        """Bring x to the root of its splay tree; the colour of the path lies at the root and moves with it."""
        p = up[x]
        while p and (left[p] == x or right[p] == x):
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner and (left[p] == x) == (left[g] == p):  # zig-zig: the parent goes first
                turn(p, g)
                p = up[x]
                turn(x, p)
            else:
                turn(x, p)
            p = up[x]
        return x

    def turn(x: int, p: int) -> None:
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            colour[x] = colour[p]

    found: dict[tuple[int, int], int] = {}
    for i, x in enumerate(prefixes):
        below = 0
        while x:
            splay(x)
            ended, cut = colour[x], right[x]
            if cut:
                colour[cut] = ended  # deeper nodes keep their last end
            if ended >= 0 and i - ended <= length[x]:
                found[(ended - length[x] + 1, i - ended)] = i
            right[x] = below
            below, x = x, up[x]
        colour[below] = i
    return found


def stretches(values: np.ndarray) -> list[tuple[int, int]]:
    """Parts (start, stop) of the word numbers `values` outside of which no run can have a word."""
    count = len(values) - GRAM + 1
    if count < 2:
        return []
    names = values[:count].astype(np.uint64)
    for k in range(1, GRAM):
        names = names * np.uint64(0x9E3779B97F4A7C15) + values[k : count + k].astype(np.uint64)
    order = np.argsort(names, kind="stable")
    again = np.flatnonzero(names[order[1:]] == names[order[:-1]])
    if not len(again):
        return []
    far = len(values)
    nearest = np.full(count, far, np.int64)
    one, other = order[again], order[again + 1]
    np.minimum.at(nearest, one, other - one)
    np.minimum.at(nearest, other, other - one)
    hot, before = nearest <= far // EXPONENT, -1
    while hot.any() and hot.sum() != before:  # a shorter stretch allows shorter periods only
        before = hot.sum()
        edges = np.flatnonzero(np.diff(hot, prepend=False, append=False))
        sizes = edges[1::2] - edges[::2] + GRAM - 1
        room = np.where(sizes >= SHORTEST, sizes // EXPONENT, 0)
        hot[hot] = nearest[hot] <= np.repeat(room, edges[1::2] - edges[::2])
    edges = np.flatnonzero(np.diff(hot, prepend=False, append=False))
    return [(int(a), int(b) + GRAM - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


@lru_cache(maxsize=2_000)
def _runs_of(raw: bytes) -> tuple[tuple[int, int, int], ...]:
    found = squares(np.frombuffer(raw, np.int64).tolist())
    return tuple((start, stop - start + 1, period) for (start, period), stop in found.items() if stop - start + 1 >= max(SHORTEST, EXPONENT * period))


def runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period: at least SHORTEST words and EXPONENT periods."""
    seen: dict[bytes, int] = {}
    values = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return []
    out = []
    for a, b in stretches(values):
        part, first = np.unique(values[a:b], return_index=True)
        named = np.argsort(np.argsort(first))[np.searchsorted(part, values[a:b])]  # numbered by first occurrence: equal stretches are equal bytes
        # Long stretches are not kept in memory for others.
        of = _runs_of if b - a <= 4_096 else _runs_of.__wrapped__
        out += [(a + start, size, period) for start, size, period in of(named.astype(np.int64).tobytes())]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that are not in some run after its first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, size, period in found:
        keep[start + period : start + size] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep))


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, n_words, runs, collapsed): all runs as structs, by start, then period, and the text without their repetitions.

    One row out per row in, in no order. Null, empty and blank texts have no words, no runs and an empty text. Ids may be null or repeated and
    only the two columns are read, whatever others there are. A text is worked on by itself, with memory linear in its length;
    rows need no shuffle, so neither frequent words nor groups of copies make a task larger.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                counts, listed, texts = [], [], []
                for text in part.column(1):
                    words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    found = runs(words)
                    counts.append(len(words))
                    listed.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    texts.append(collapsed(words, found).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(listed, kind), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by the hash of its id goes on periodically from some word on; null ids never."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", rf"[{BLANK}]+", -1), lambda w: w != "")
    n = F.size("words")
    a = F.pmod(F.col("g"), n)
    p = 1 + F.floor((n - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8))))

    def periodic(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))

    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    new = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), periodic), " ")
    return chosen.select("doc_id", F.when(n > 0, new).otherwise(F.col("text")).alias("text"))


def runs_query(spark, sf_dir):
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")

    def better(best: Column, r: Column) -> Column:
        """Exact comparison of length / period; of equal ones the earlier in the list stays: smaller start, then period."""
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast(RUN), better)
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "collapsed",
                       F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
