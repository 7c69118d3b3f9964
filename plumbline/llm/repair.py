"""Repair of conversation structure by a rank-convergence parallel Viterbi search.

The turns of a conversation are edited (keep, change the role, delete, insert an empty turn) so that their role initials
read `(s?(ua)+)?`. Four states say what has been written: nothing, s, u, a. The cost from a turn to the end is a vector
over these states, and going back over one turn maps vectors to vectors in (min, +). Such maps soon lose rank: whatever
vector they start from, the results differ by a constant only.

Conversations are therefore cut into chunks. Every chunk runs backwards from a speculative vector, that of the end of a
conversation. Fix-up passes compare what a chunk started from with what the chunk after it came to, and rerun those chunks where
the two differ by more than a constant, until none do. With the constants the costs are stitched together; with the vectors each
conversation is traced forwards, taking at every turn the ASCII-least edit that still is cheapest.

Blank and repeated turns must go, whatever the state: they change no vector but by a constant and are in no chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.llm.shared import BLANK, running, store, table

#: Costs of the edits; TRUNCATED is added for a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Places of the whole ordered table that one chunk covers.
CHUNK = 4_096
INITIALS = "sua"
#: By state (0 nothing, 1 s, 2 u, 3 a): the role to go on with, the state after it, and the state after a kept turn of an initial.
WANTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Cost of ending in each state: s alone and u need turns inserted.
END = (0, 2 * INSERT, INSERT, 0)
LAST = 2**63 - 1

_STEPS: dict[tuple[str, tuple[int, ...]], tuple[tuple[int, ...], int]] = {}


def back(kind: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs before a turn of `kind` from those after it, less their least, which comes apart. There are few such vectors."""
    known = _STEPS.get((kind, after))
    if known is None:
        initial, extra = kind.lower(), TRUNCATED * kind.isupper()
        cost = [min(DELETE + after[s], REROLE + extra + after[AFTER[s]], extra + after[KEPT[s][initial]] if initial in KEPT[s] else LAST) for s in range(4)]
        for s in (2, 3, 2, 0, 1):
            cost[s] = min(cost[s], INSERT + cost[AFTER[s]])
        known = _STEPS[kind, after] = tuple(c - min(cost) for c in cost), min(cost)
    return known


def run_back(kinds: str, after: tuple[int, ...]) -> list[tuple[tuple[int, ...], int]]:
    """(vector, constant) before every turn and, last, at the end."""
    least = min(after)
    out = [(tuple(c - least for c in after), least)]
    for kind in reversed(kinds):
        vector, more = back(kind, out[-1][0])
        out.append((vector, out[-1][1] + more))
    return out[::-1]


def trace(kinds: str, after: tuple[int, ...], state: int) -> tuple[list[str], int]:
    """Edits of every turn (insertions before it, then its own) and the state after the last."""
    costs, out = run_back(kinds, after), []
    for i, kind in enumerate(kinds):
        here, there = ([c + costs[j][1] for c in costs[j][0]] for j in (i, i + 1))
        initial, extra, edits = kind.lower(), TRUNCATED * kind.isupper(), ""
        while True:
            if DELETE + there[state] == here[state]:
                edits += "D"
                break
            if INSERT + here[AFTER[state]] == here[state]:
                edits, state = edits + "I", AFTER[state]
                continue
            keeps = initial in KEPT[state] and extra + there[KEPT[state][initial]] == here[state]
            edits, state = edits + ("K" if keeps else "R"), KEPT[state][initial] if keeps else AFTER[state]
            break
        out.append(edits)
    return out, state


def faults(rows: DataFrame) -> DataFrame:
    """Turns in order with `place` (over the whole table), `fault` (first of blank, duplicate, truncated) and `kind`: the role's initial
    (`x` if not s, u or a), upper case if truncated."""
    space = F.lit(" ")
    clean = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    placed = store(running(clean, order, "turns"), "placed")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = placed.groupBy("conv_id", same.alias("same")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    bare = F.regexp_replace("text", rf"[{BLANK}]+\z", "")
    fault = F.when(bare == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin(*INITIALS), initial).otherwise("x")
    return placed.join(first, "place", "left").withColumn("fault", fault).withColumn("kind", F.when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind))


def chunked(turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, id, next, places, kinds): the turns that may stay, in chunks of at most `size`; `id` is the first place, `next` that of the chunk after it."""
    listed = turns.groupBy("conv_id", F.floor(F.col("place") / size).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("place", "kind"))).alias("t"))
    named = listed.select("conv_id", F.col("t")[0]["place"].alias("id"), F.col("t.place").alias("places"), F.array_join("t.kind", "").alias("kinds"))
    chain = named.select("id", F.lead("id").over(W.partitionBy("conv_id").orderBy("id")).alias("next"))  # ids only
    return store(named.join(chain, "id"), "chunks")


def _vectors(chunks: DataFrame) -> DataFrame:
    """Run every chunk (id, kinds, start) backwards: `came`, the vector before its first turn, with its constant."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            came = []
            for kinds, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                vector, least = run_back(kinds, tuple(start))[0]
                came.append([c + least for c in vector])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(came, pa.list_(pa.int64()))], ["id", "start", "came"])

    return chunks.select("id", "kinds", "start").mapInArrow(scan, "id long, start array<long>, came array<long>")


def _flat(vector: str) -> Column:
    return F.transform(vector, lambda c: c - F.array_min(vector))


def converged(chunks: DataFrame) -> DataFrame:
    """`chunks` with `start`: costs after their last turn, exact but for a constant.

    Each pass reruns only chunks whose start was wrong. There are as many passes as a wrong vector crosses chunks without being lost:
    one or two as a rule, at most the number of chunks in the longest conversation.
    """
    known = store(_vectors(chunks.withColumn("start", F.array(*[F.lit(c).cast("long") for c in END]))), "vectors")
    links = chunks.select("id", "next", "kinds")
    while True:
        after = known.select(F.col("id").alias("next"), _flat("came").alias("true"))
        wrong = store(known.select("id", "start").join(links, "id").join(after, "next").where(_flat("start") != F.col("true")).select("id", "kinds", F.col("true").alias("start")), "wrong")
        if wrong.isEmpty():
            return chunks.join(known, "id")
        known = store(known.join(wrong.select("id"), "id", "left_anti").unionByName(_vectors(wrong)), "vectors")


def edits(chunks: DataFrame) -> DataFrame:
    """(conv_id, place, edits) of all turns in chunks, and per conversation one row of the last place with the insertions at its end.

    A conversation is walked once from its start, chunk by chunk; one chunk is in memory at a time.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = 0
        for batch in batches:
            for row in batch.to_pylist():
                found, state = trace(row["kinds"], tuple(row["start"]), state)
                places = row["places"]
                if row["next"] is None:
                    tail = ""
                    while state not in (0, 3):
                        tail, state = tail + "I", AFTER[state]
                    found, places, state = [*found, tail], [*places, LAST], 0
                yield pa.RecordBatch.from_pydict({"conv_id": pa.array([row["conv_id"]] * len(found), batch.schema.field("conv_id").type),
                                                  "place": pa.array(places, pa.int64()), "edits": pa.array(found, pa.string())})

    kind = dict(chunks.dtypes)["conv_id"]
    ordered = chunks.select("conv_id", "id", "next", "places", "kinds", "start").repartition("conv_id").sortWithinPartitions("conv_id", "id")
    return ordered.mapInArrow(walk, f"conv_id {kind}, place long, edits string")


class _Conversation:
    """What is told of a conversation, turn by turn."""

    def __init__(self) -> None:
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = self.before = self.initial = None
        self.turns = self.lines = self.state = 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def add(self, turn: int | None, role: str | None, text: str, fault: str | None, letters: str) -> None:
        """One turn; one without a role stands for the end and holds insertions only."""
        if role is not None:
            if self.initial is not None:
                self.counts["illegal"] += self.initial + role[:1] not in ("su", "ua", "au")
            self.initial = role[:1]
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            if fault:
                self.counts[fault] += 1
        self.audit.append(letters)
        for letter in letters:
            if letter == "D":
                self.counts["cost"] += DELETE
                continue
            self.counts["cost"] += {"I": INSERT, "R": REROLE, "K": 0}[letter] + (TRUNCATED if letter != "I" and fault == "truncated" else 0)
            self.write(role if letter == "K" else WANTED[self.state], "" if letter == "I" else text)
            self.state = KEPT[self.state][role[:1]] if letter == "K" else AFTER[self.state]

    def told(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.counts, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def edited(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Turns (conv_id, place, turn, role, text, fault, edits) with their edits, insertions before the turn first; plus one row without a role per
    conversation, at the last place, with the insertions at its end. Null roles and texts are one space; turns are taken by turn (nulls first), ties
    by role, then text. `place` orders the turns of a conversation."""
    turns = store(faults(rows), "faults")
    stays = turns.where("fault is null or fault = 'truncated'")
    done = store(edits(converged(chunked(stays.select("conv_id", "place", "kind"), chunk))), "edits")
    kept = turns.drop("kind", "first").join(done.where(F.col("place") < LAST).select("place", "edits"), "place", "left").withColumn("edits", F.coalesce("edits", F.lit("D")))
    return kept.unionByName(done.where(F.col("place") == LAST), allowMissingColumns=True)


def repair(rows: DataFrame, ids: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text), and of `ids` (conv_id): its faults, the least cost, the edits and a digest of the result.

    Null ids are one conversation. One without turns has zeros, no edits and the digest of the empty text. Other columns are not read. The search
    cuts long conversations into chunks; the audit is one value and the digest one pass over all text of a conversation, so at the end its turns go in
    order through one task, as a stream of which only the audit is kept. An audit has one letter per edit: a conversation may have 2^31.
    """
    told = edited(rows, chunk).select("conv_id", "place", "turn", "role", "text", "fault", "edits")
    ids = rows.select("conv_id") if ids is None else ids.select("conv_id")
    heads = ids.distinct().select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit("").alias("edits"))
    ordered = told.unionByName(heads, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    kind = dict(rows.dtypes)["conv_id"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of, type_of = None, None, None

        def close() -> pa.RecordBatch:
            row = {"conv_id": pa.array([of], type_of), **{k: pa.array([v]) for k, v in now.told().items()}}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            type_of = batch.schema.field("conv_id").type
            for conv, place, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place == -1:  # every conversation begins with its head
                    if now is not None:
                        yield close()
                    now, of = _Conversation(), conv
                else:
                    now.add(*turn)
        if now is not None:
            yield close()

    return ordered.mapInArrow(stream, f"conv_id {kind}, {REPORT}")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by the hash of conversation and turn: dropped, emptied, without end marks, repeated, of another role."""
    filled = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = filled.withColumn("hit", F.crc32(name.cast("binary")) % 20).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_query(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair(damaged(rows), rows)


def _option(letter: str, cost: str, of: str, line: str | None = None) -> str:
    lines = f"list_prepend({line}, {of}.t)" if line else f"{of}.t"
    return f"{{'c': {of}.c + {cost}, 'a': '{letter}' || {of}.a, 't': {lines}}}"


def _base(state: int) -> str:
    """Cheapest of the edits that use up a turn, from a state: v1 to v4 are the best ways on from the states after it."""
    after, kept = f"v{AFTER[state] + 1}", [f"WHEN '{i}' THEN {_option('K', 'extra', f'v{s + 1}', chr(39) + chr(39) + ' || line')}" for i, s in KEPT[state].items()]
    rerole = _option("R", f"extra + {REROLE}", after, f"'{WANTED[state]}:' || text")
    return (f"list_min([{_option('D', str(DELETE), f'v{state + 1}')}, CASE WHEN stays THEN {rerole} END, "
            f"CASE WHEN stays THEN CASE initial {' '.join(kept)} END END])")


def _insert(state: int, of: str) -> str:
    return f"list_min([b{state + 1}, {_option('I', str(INSERT), of, chr(39) + WANTED[state] + ':' + chr(39))}])"


_NONE, _ONE, _TWO = ("{'c': 0, 'a': '', 't': []::VARCHAR[]}", f"{{'c': {INSERT}, 'a': 'I', 't': ['assistant:']}}",
                     f"{{'c': {2 * INSERT}, 'a': 'II', 't': ['user:', 'assistant:']}}")
REPAIR_SQL = rf"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(name) + 1),
    lambda i: list_prepend(ord(name[i])::BIGINT, list_transform(range(8), lambda k: 256::BIGINT))))),
    lambda c, x: CASE WHEN x < 256 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT) % 20 AS hit FROM named),
hurt AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE hit <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[{BLANK}]+$', '') AS bare FROM hurt),
judged AS (SELECT *, substr(role, 1, 1) AS initial, role || ':' || text AS line, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed),
rows AS (SELECT *, fault IS NULL OR fault = 'truncated' AS stays, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
search AS (SELECT conv_id, count(*) + 1 AS i, {_NONE} AS v1, {_TWO} AS v2, {_ONE} AS v3, {_NONE} AS v4 FROM rows GROUP BY conv_id
    UNION ALL SELECT conv_id, i, {_insert(0, 'w3')}, {_insert(1, 'w3')}, w3, w4 FROM (SELECT *, {_insert(2, 'b4')} AS w3, {_insert(3, 'b3')} AS w4 FROM (
        SELECT s.conv_id, r.i, {_base(0)} AS b1, {_base(1)} AS b2, {_base(2)} AS b3, {_base(3)} AS b4
        FROM search s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i - 1))),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM rows GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v1.c, 0)::BIGINT AS cost, coalesce(v1.a, '') AS audit,
    sha256(coalesce(array_to_string(v1.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN search s ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND s.i = 1
"""
