"""Edit-aware token counts: a segment tree of pre-token runs per document, of which an edit re-encodes only what it touches.

A leaf is a run of pre-tokens, cut where a space stands between two other visible characters: there the tokens on either side do
not depend on each other. Each tree keeps characters and tokens per node, children summed in their parents. An edit descends
by characters to the leaves it touches, takes the neighbours whose cut it may move, re-encodes these alone, puts the new counts into
the first of their places, empties the others, and adds the difference on the way to the root.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.packing import ADDED, default_vocabulary, encoding
from plumbline.llm.shared import store

#: Characters a leaf has at least (but for the last one), and the context a cut depends on.
LEAF, CONTEXT = 256, 2
CUT = re.compile(r"(?<=\S)(?= [^\s])")


def leaves(text: str, least: int = LEAF) -> list[str]:
    """The text in runs that can be encoded on their own."""
    out, start = [], 0
    while start < len(text):
        found = CUT.search(text, start + least)
        end = found.start() if found else len(text)
        out.append(text[start:end])
        start = end
    return out


class SumTree:
    """Characters and tokens of leaves in an implicit binary tree: node i has the children 2 i and 2 i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.chars, self.tokens = chars, tokens
        self.base = len(chars) // 2

    @classmethod
    def build(cls, chars: list[int], tokens: list[int]) -> SumTree:
        base = 1 << max(0, len(chars) - 1).bit_length()
        nodes = []
        for level in (chars, tokens):
            whole = [0] * base + level + [0] * (base - len(level))
            for i in range(base - 1, 0, -1):
                whole[i] = whole[2 * i] + whole[2 * i + 1]
            nodes.append(whole)
        return cls(*nodes)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts; the end of the text belongs to its last character's leaf."""
        at, node, start = max(0, min(at, self.chars[1] - 1)), 1, 0
        while node < self.base:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.base
        more = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def apply_edit(tree: SumTree, text: str, start: int, removed: int, inserted: str, count) -> tuple[str, int]:
    """The edited text and how many characters had to be encoded for it. The tree is brought up to date."""
    start = max(0, min(start, len(text)))
    end = min(len(text), start + max(0, removed))
    first, low = tree.find(start - CONTEXT)
    last, high = tree.find(end + CONTEXT - 1)
    high += tree.chars[last + tree.base]
    region = text[low:start] + inserted + text[end:high]
    for leaf in range(first, last + 1):
        if tree.chars[leaf + tree.base]:
            tree.put(leaf, 0, 0)
    tree.put(first, len(region), count(region))
    return text[:start] + inserted + text[end:], len(region)


def counter(vocabulary: tuple[str, str] | None):
    """Number of ids as the tokenizers file gives them: its added token counts as one wherever it stands; another vocabulary has none."""
    added = ADDED if vocabulary is None else ()
    bpe, special = encoding(*(vocabulary or default_vocabulary()), added), {text for text, _ in added}
    return lambda text: len(bpe.encode(text, allowed_special=special, disallowed_special=()))


def build_trees(docs: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, text) to (doc_id, text_hash, chars array<int>, tokens array<int>): one tree per different document. Null texts are empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            chars, tokens = [], []
            for text in batch.column(2):
                runs = leaves(text.as_py() or "")
                tree = SumTree.build([len(r) for r in runs], [count(r) for r in runs])
                chars.append(tree.chars)
                tokens.append(tree.tokens)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(chars, kind), pa.array(tokens, kind)], ["doc_id", "text_hash", "chars", "tokens"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(scan, "doc_id long, text_hash long, chars array<int>, tokens array<int>")


def count_after_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Token counts of `docs` (doc_id, text) before and after `edits` (doc_id, text_hash, seq, start, removed, inserted).

    An edit is for the text with that id and that xxhash64, as in `trees` (those of `build_trees`); a null id is an id like others.
    Edits are made in order of seq (ties by start, removed, inserted), each on the text that the ones before left; places
    beyond the text are moved to its end, nulls are 0 and empty. A document without edits keeps its count. Repeated rows come
    out repeated. The token `<|endoftext|>` inside a text is one token, as in the packing; texts of one id, however many,
    are keyed apart, so the work is linear in them.
    """
    pair = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), "text_hash"]
    e = F.struct("seq", F.coalesce("start", F.lit(0)).cast("long").alias("start"), F.coalesce("removed", F.lit(0)).cast("long").alias("removed"), F.coalesce("inserted", F.lit("")).alias("inserted"))
    listed = edits.groupBy(*pair).agg(F.array_sort(F.collect_list(e)).alias("edits"))
    # One key for all three, so that each is shuffled once; equal texts of one id have equal trees.
    known = trees.groupBy(*pair).agg(F.any_value(F.struct("chars", "tokens")).alias("tree"))
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text")).select(*pair, "doc_id", "text")
    joined = keyed.join(known.join(listed, ["k", "text_hash"], "left"), ["k", "text_hash"]).select("doc_id", "text", "tree.chars", "tree.tokens", "edits")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text, chars, tokens, todo in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                tree = SumTree(chars, tokens)
                before, n_leaves, spent = tree.tokens[1], sum(c > 0 for c in tree.chars[tree.base :]), 0
                for edit in todo or ():
                    text, encoded = apply_edit(tree, text, edit["start"], edit["removed"], edit["inserted"], count)
                    spent += encoded
                rows.append((doc_id, before, tree.tokens[1], tree.chars[1], spent, n_leaves))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded", "n_leaves"]
    return joined.mapInArrow(scan, ", ".join(f"{n} long" for n in names))


def own_edits(docs: DataFrame) -> DataFrame:
    """Three edits for each document, made of its own text: a passage in the first third is replaced by the document's first 40
    characters, its source is put in at two thirds, and its last 10 characters come again at the end. Rows of the same id and
    text get one set of edits, with the smallest of their sources."""
    n = F.length("text")
    edits = F.array(
        F.struct(F.lit(0).alias("seq"), F.floor(n / 3).alias("start"), (F.floor(n / 50) + 1).alias("removed"), F.substring("text", 1, 40).alias("inserted")),
        F.struct(F.lit(1).alias("seq"), F.floor(n * 2 / 3).alias("start"), F.lit(0).cast("long").alias("removed"), F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" ")).alias("inserted")),
        F.struct(F.lit(2).alias("seq"), (n * 2 + 100).cast("long").alias("start"), F.lit(0).cast("long").alias("removed"), F.substring("text", -10, 10).alias("inserted")))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"), "source")
    listed = hashed.select("doc_id", "text_hash", "source", F.explode(edits).alias("e"))
    once = listed.groupBy("doc_id", "text_hash", "e.seq").agg(F.min(F.struct("source", "e")).alias("m"))
    return once.select("doc_id", "text_hash", "m.e.*")


def tokens_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return count_after_edits(docs, store(build_trees(docs), "trees"), own_edits(docs))
