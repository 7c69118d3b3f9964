"""Near-duplicates in crowds that share lines: few pairs are compared in full, and none is lost."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import near, simhash


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = rng.integers(0, 2**63, rng.integers(1, 3_000), dtype=np.uint64)
        a, b = (np.unique(pool[rng.random(len(pool)) < rng.random()]) for _ in "ab")
        bits = sum(int(x).bit_count() for x in (near.sketch(a) ^ near.sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))
        if len(a) and near.near(a, b):
            assert bits * (near.NEAR + near.OF) <= (len(a) + len(b)) * (near.OF - near.NEAR)


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(2)
    return [" ".join(f"w{rng.randrange(500)}" for _ in range(12)) for _ in range(40)]


@pytest.mark.parametrize("size", [200, 400, 800])
def test_mixed_boilerplate(spark, lines, monkeypatch, size):
    """Texts of four of forty lines share lines with a third of all others, and are near to hardly any."""
    rng = random.Random(size)
    docs = [(i, "\n".join(rng.sample(lines, 4))) for i in range(size)]
    pairs, plain = [], near.verified

    def counted(found, *rest):
        pairs.append(found.count())
        return plain(found, *rest)

    monkeypatch.setattr(near, "verified", counted)
    got = {r["doc_id"]: r["root"] for r in near.near_sets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(pairs) <= 1.2 * size  # in proportion, not with the square
    names, root = [near.shingles(t) for _, t in docs], list(range(size))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(size):
        for k in range(i):
            if near.near(names[i], names[k]):
                root[find(i)] = find(k)
    groups = [{frozenset(i for i in range(size) if of[i] == r) for r in set(of.values())} for of in ({i: find(i) for i in range(size)}, got)]
    assert groups[0] == groups[1] and Counter(map(len, groups[0])) == Counter(map(len, groups[1]))


def test_near_copies_are_joined_by_their_fingerprints(spark, monkeypatch):
    """SimHash groups link near copies without the prefixes, and what only shares a group is told apart by the exact check."""
    base = " ".join(f"v{i}" for i in range(400))
    texts = {0: base, 1: base + " end", 2: "start " + base, 3: base, 4: " ".join(f"u{i}" for i in range(90)), 5: None, 6: " "}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = {i: simhash.fingerprint(t, near.SHINGLE) for i, t in texts.items()}
    assert all((prints[0] ^ prints[i]).bit_count() <= 2 for i in (1, 2))
    sets = near.store(near.named(docs), "sets")
    name = {r["doc_id"]: r["sid"] for r in sets.collect()}
    found = {frozenset(r) for r in near.fingerprint_pairs(docs, sets).collect()}
    assert len(found) == 2 and set().union(*found) == {name[i] for i in (0, 1, 2)}

    group = near.near_groups
    monkeypatch.setattr(near, "near_groups", lambda rows, **k: group(rows, **k).withColumn("root", near.F.lit(7).cast("long")))  # all texts in one group
    wide = near.fingerprint_pairs(docs, sets)
    assert wide.count() == len(set(name.values())) - 1
    linked = {frozenset(r) for r in near.verified(near.store(wide, "pairs"), docs, sets).collect()}
    assert linked <= {frozenset((name[i], name[k])) for i in (0, 1, 2) for k in (0, 1, 2) if i != k}
    monkeypatch.setattr(near, "near_groups", group)

    plain = near.prefixes
    monkeypatch.setattr(near, "prefixes", lambda rows: plain(rows).where("false"))
    root = {r["doc_id"]: r["root"] for r in near.near_sets(docs).collect()}
    assert root[0] == root[1] == root[2] == root[3] and root[5] == root[6] and len(set(root.values())) == 3
