"""Each operator against a brute-force version, and all of them on empty, null, repeated, odd and very long rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import chat, host_rules, mixing, packing, pii, quality, simhash, suffix, token_counts, winnowing
from plumbline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, r string, taken long, `range` long, m string, h string, score double, predicted string, target string, source_size string, `a.b` string, k string, text_hash string"
LONG = "word " * 30_000 + "x" * 60_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, columns with names the operators use inside."""
    texts = [None, "", " \t\n", "a", "a b", "A b c!", LONG, LONG, "mail me.1@mail.example.com at 10.0.0.1 or 4111 1111 1111 1111",
             "é" * 70 + " ünï 😀 \U0001f600 end", "same text " * 12, "same text " * 12, "\n\n\n" * 40, "<s>[INST] x [/INST]</s>"]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (10, "another text with id ten", None, None, None), (None, "no id at all", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, 7, "r", 9, 1, "m", "h", 0.5, "p", "t", "z", "a.b", "k", "x") for r in rows], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours = QUERIES[name](spark, SF).toPandas()
    theirs = con.sql(ORACLES[name]).df()[list(ours.columns)]
    by = list(ours.columns)
    pd.testing.assert_frame_equal(ours.sort_values(by).reset_index(drop=True), theirs.sort_values(by).reset_index(drop=True))


# --- 1: suffix dedup


def brute_removed(docs, length):
    raw = [((-(2**63) if i is None else i), (t or "").encode()) for i, t in docs]
    least = {}
    for i, b in raw:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, b in raw:
        mark = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                mark[p : p + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if mark[k] and (not k or not mark[k - 1]))
        out.append((len(b), sum(mark), spans, hashlib.sha256(bytes(c for c, m in zip(b, mark) if not m)).hexdigest()))
    return sorted(out)


def test_suffix_dedup_on_random_texts(spark):
    rng = random.Random(5)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(3, 70))) for _ in range(12)]
    docs = [(rng.choice([None, *range(30)]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for _ in range(60)]
    docs += [(40, "ab" * 300), (41, "ba" * 300), (42, "ab" * 300), (42, "ab" * 300), (43, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for length in (9, 50):
        assert sorted(r[1:] for r in rows_of(suffix.removal_digests(df, length))) == brute_removed(docs, length)


def test_suffix_dedup_on_odd_rows(odd):
    got = rows_of(suffix.removal_digests(odd.select("doc_id", "text")))
    assert sorted(r[1:] for r in got) == brute_removed([(r["doc_id"], r["text"]) for r in odd.collect()], 50)
    assert rows_of(suffix.removal_digests(odd.where("false"))) == []
    spans = suffix.removed_spans(odd).where("doc_id = 7").first()
    assert spans["starts"] == [0] and spans["lengths"] == [len(LONG)]


# --- 2: mixing


def test_mix_reaches_its_targets(odd, spark):
    docs = odd.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), "taken")
    got = mixing.mix(docs.drop("taken")).toPandas()
    assert len(got) == odd.count() and (got.taken <= 2 * got["size"]).all()
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1
    assert rows_of(mixing.mix(docs.drop("taken").where("false"))) == []
    zero = mixing.mix(docs.drop("taken").withColumn("size", F.lit(0).cast("long"))).agg(F.sum("taken"), F.sum("target")).first()
    assert tuple(zero) == (0, 0.0)


def test_mix_keeps_columns_of_any_name(odd):
    got = mixing.mix(odd)
    assert got.columns == [*[c for c in odd.columns if c not in ("source_size", "target", "taken")], "source_size", "target", "taken"]
    assert got.where("`a.b` = 'a.b' and m = 'm' and k = 'k' and target >= 0").count() == odd.count()
    plain = mixing.mix(odd.select("doc_id", "source", "size"))
    by = ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert Counter(rows_of(got.select(*by))) == Counter(rows_of(plain.select(*by)))


def test_mix_cuts_large_sources_into_ranges(spark, small, monkeypatch):
    sized = small.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    whole = sorted(rows_of(mixing.mix(sized).select("doc_id", "taken")))
    monkeypatch.setattr(mixing, "RANGE", 2)
    assert sorted(rows_of(mixing.mix(sized).select("doc_id", "taken"))) == whole


def test_mixed_texts_hold_the_words_taken(odd):
    out = mixing.mixed_texts(odd)
    assert out.columns == odd.columns
    words = sum(len(simhash.words_of(r["text"])) for r in out.collect())
    docs = odd.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    assert words == mixing.mix(docs).agg(F.sum("taken")).first()[0]


# --- 3: quality


def test_field_inference_against_enumeration():
    rng = np.random.default_rng(3)
    scores, moves = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    starts = np.array([0, 4])
    single, pairs, partition = quality.marginals(scores, moves, starts)
    want_pairs = np.zeros((2, 2))
    for c, (a, b) in enumerate(((0, 4), (4, 6))):
        paths = list(np.ndindex(*[2] * (b - a)))
        w = np.array([np.exp(sum(scores[a + i, y] for i, y in enumerate(p)) + sum(moves[p[i], p[i + 1]] for i in range(len(p) - 1))) for p in paths])
        assert np.isclose(partition[c], np.log(w.sum()))
        for i in range(b - a):
            assert np.isclose(single[a + i, 1], sum(x for x, p in zip(w, paths) if p[i]) / w.sum())
        for p, x in zip(paths, w / w.sum()):
            for i in range(len(p) - 1):
                want_pairs[p[i], p[i + 1]] += x
    assert np.allclose(pairs, want_pairs)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.quality_query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    unseen = got[got.held_out]
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id])
    assert (unseen.predicted == unseen.quality).mean() > 0.97 and got.score.between(0, 1).all()


def test_quality_sample_is_cut_before_it_is_collected(spark, monkeypatch):
    docs = [(i, "\n".join(f"{'Fine words here.' if i % 2 else '### || !!'} {i} {k}" for k in range(5))) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    order = sorted((i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    seen, whole = [], quality.featurize
    monkeypatch.setattr(quality, "featurize", lambda rows, extra: seen.append(rows) or whole(rows, extra))
    hot = [(order[0], "zz\nlater text")] * 300  # copies of one id
    quality.fit(spark.createDataFrame(docs + hot, "doc_id long, text string").repartition(3), labels, max_lines=52)
    assert sorted(tuple(r) for r in seen[0].select("doc_id", "text").collect()) == sorted(docs[i] for i in order[:10])


def test_quality_on_odd_rows(odd, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    field = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    scored = quality.score(odd, field)
    assert scored.columns == [*[c for c in odd.columns if c not in ("score", "predicted")], "score", "predicted"]
    assert {r[0] for r in scored.select("`a.b`").collect()} == {"a.b"}
    assert scored.count() == odd.count() and scored.where("not score between 0 and 1 or score is null").count() == 0
    assert rows_of(quality.score(odd.where("false"), field)) == []
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.keep_good(odd, labels.where("false")).count() == odd.count()  # nothing learnt, nothing rejected


# --- 4: token counts


def file_counter():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(whole.encode(text, add_special_tokens=False).ids)


def check_edits(docs):
    """Counts of every row, null and repeated ids too, against the tokenizers file on the whole edited text."""
    count, rows = file_counter(), docs.collect()
    sources = {}
    for r in rows:
        sources.setdefault((r["doc_id"], r["text"]), set()).add(r["source"])
    want = Counter()
    for r in rows:
        text = r["text"] or ""
        n, source = len(text), min(sources[r["doc_id"], r["text"]], key=lambda s: (s is not None, s or ""))
        edits = [(n // 3, n // 50 + 1, text[:40]), (n * 2 // 3, 0, f" {source or ''} "), (2 * n + 100, 0, text[-10:])]
        before = count(text)
        for start, removed, inserted in edits:
            start = min(start, len(text))
            text = text[:start] + inserted + text[start + removed :]
        want[r["doc_id"], before, count(text), len(text)] += 1
    got = token_counts.count_after_edits(docs, token_counts.build_trees(docs), token_counts.own_edits(docs))
    assert Counter(rows_of(got.select("doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited"))) == want


def test_edited_counts_equal_whole_encoding(odd, small, spark):
    check_edits(small.select("doc_id", "text", "source"))
    check_edits(odd)
    check_edits(odd.where("false"))
    mark = "<|endoftext|>"
    crowd = [(None, f"number {i} {mark} here" + f" and {mark}" * i, f"s{i % 2}") for i in range(60)]  # one id, many texts
    crowd += [(5, f"{mark}{' word' * 80} {mark}" * 3, s) for s in ("b", "a", None)] + [(6, f"x <|endof text|> {mark}{mark}", "<|")]
    check_edits(spark.createDataFrame(crowd, "doc_id long, text string, source string"))


def test_added_token_is_made_and_broken_by_edits():
    count, whole = token_counts.counter(None), file_counter()
    text = "long words " * 40 + "<|endof text|> " + "more words " * 40 + "<|endoftext|> end"
    runs = token_counts.leaves(text, 12)
    tree = token_counts.SumTree.build([len(r) for r in runs], [count(r) for r in runs])
    for start, removed, new in ((text.index("f text|>") + 1, 1, ""), (text.rindex("oftext"), 0, " "), (0, 0, "<|endoftext|>"), (5, 4, "")):
        text, _ = token_counts.apply_edit(tree, text, start, removed, new, count)
        assert (tree.tokens[1], tree.chars[1]) == (whole(text), len(text))


def test_trees_of_one_id_stay_apart(spark):
    """Texts that share an id meet one tree each: no row holds the trees or edits of others."""
    docs = spark.createDataFrame([(None, f"text {i} of many", "s") for i in range(200)], "doc_id long, text string, source string")
    edits = token_counts.own_edits(docs)
    assert edits.groupBy("doc_id", "text_hash").count().agg(F.max("count"), F.count("*")).first() == (3, 200)


def test_random_edits(spark):
    rng, count = random.Random(1), token_counts.counter(None)
    for _ in range(60):
        text = "".join(rng.choice(["the ", "it's ", " ", "\n", "12", "é", "end. ", "  x"]) for _ in range(rng.randint(0, 90)))
        runs = token_counts.leaves(text, 12)
        assert "".join(runs) == text
        tree = token_counts.SumTree.build([len(r) for r in runs], [count(r) for r in runs])
        for _ in range(6):
            start, removed, new = rng.randint(0, len(text) + 2), rng.randint(0, 9), rng.choice(["", " ", "s", "'ll go", "\n\n ", " word"])
            text, _ = token_counts.apply_edit(tree, text, start, removed, new, count)
            assert (tree.tokens[1], tree.chars[1]) == (count(text), len(text))


# --- 5: packing


def check_packing(got, capacity=1024):
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= capacity


def test_packing(small, odd):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    for docs in (small, odd.where("doc_id is null or doc_id <> 10")):
        got = packing.pack_documents(docs).toPandas()
        check_packing(got)
        assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 1024) + 2
        want = []
        for r in docs.collect():
            ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
            lead = len(ids) % 1024
            cuts = [0, *([lead] if lead else []), *range(lead + 1024, len(ids) + 1, 1024)]
            want += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert Counter(want) == Counter(map(tuple, got[["piece", "start", "length", "ids_crc32"]].astype(int).values.tolist()))
    assert rows_of(packing.pack_documents(odd.where("false"))) == []


def test_pieces_with_added_tokens(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["see <|endoftext|> here", "<|endoftext|><|endoftext|>", " <|endoftext|>\n\nx <|endoftext", "a  <|endoftext|>  b", "<|startoftext|> none", "\U00031fff\U000323af <|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.token_pieces(df).collect()}
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_steps_equal_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([7, 16, 50])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        gaps = []
        for n in sorted(lengths, reverse=True):
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is None:
                gaps.append(capacity - n)
            else:
                gaps[gaps.index(fit)] -= n
        used = {first + (i // each) for length, rank, first, each, _, n in spread(packing.plan_steps(Counter(lengths), capacity), Counter(lengths)) for i in range(n)}
        assert len(used) == len(gaps)


def spread(runs, counts):
    """Runs with the number of pieces in each."""
    for i, run in enumerate(runs):
        later = [r[1] for r in runs if r[0] == run[0] and r[1] > run[1]]
        yield (*run, min(later, default=counts[run[0]]) - run[1])


# --- 6: SimHash


def groups_by_force(prints, threshold=2):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= threshold:
                root[find(b)] = find(a)
    return {n: find(n) for n in nodes}


def test_links_and_components_against_all_pairs(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints):  # chains and balls of near fingerprints
        for _ in range(rng.randint(0, 6)):
            p ^= 1 << rng.randint(0, 63) | 1 << rng.randint(0, 63)
            prints.append(p)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in set(signed)], "fp long")
    want = groups_by_force(signed)
    edges = {tuple(r) for r in simhash.links(df).collect()}
    assert edges == {(a, b) for a in set(signed) for b in set(signed) if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    for a in set(signed):
        for b in set(signed):
            assert (got.get(a, a) == got.get(b, b)) == (want[a] == want[b])


def test_near_groups(odd, small, spark):
    for docs in (small, odd):
        got = simhash.near_groups(docs)
        assert got.count() == docs.count()
        rows = got.collect()
        want = groups_by_force([r["fp"] for r in rows])
        least = {}
        for r in rows:
            if r["doc_id"] is not None:
                least[want[r["fp"]]] = min(r["doc_id"], least.get(want[r["fp"]], r["doc_id"]))
        assert all(r["component_id"] == least.get(want[r["fp"]]) for r in rows)
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len(set(want.values()))
    assert rows_of(simhash.near_groups(odd.where("false"))) == []


def test_fingerprint_votes():
    import xxhash

    text = "One two\tTHREE four  two three FOUR"
    words = text.lower().encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want and simhash.fingerprint(" \n") == simhash.fingerprint(None) == 0


def test_fingerprint_votes_of_long_texts():
    import xxhash

    words = [b"2w%d" % i for i in range(131_080)]  # its fingerprint changes if shingle 65,537 and 131,074 go missing
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)), np.uint64)
    votes = [int((hashes >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
    want = sum(1 << b for b in range(64) if 2 * votes[b] > len(hashes))
    assert simhash.fingerprint(b" ".join(words).decode()) == want


# --- 7: pseudonyms


def one(spark, text, key="k"):
    return pii.pseudonymize(spark.createDataFrame([(text,)], "text string"), key).first()["text"]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_their_form(spark):
    values = ["4111 1111 1111 1111", "4111111111111112", "10.0.0.1", "+1 (743) 555-3824", "2024-02-29", "29.02.2024", "123-45-6789"]
    out = one(spark, " and ".join(values)).split(" and ")
    shape = lambda v: "".join("9" if c.isdigit() else c for c in v)
    assert [shape(v) for i, v in enumerate(out) if i != 2] == [shape(v) for i, v in enumerate(values) if i != 2]
    assert not set(values) & set(out)
    assert luhn(out[0]) and not luhn(out[1]) | (out[1] == values[1])
    assert all(0 <= int(p) < 256 for p in out[2].split("."))
    assert pd.Timestamp(out[4]) and pd.to_datetime(out[5], format="%d.%m.%Y")


def test_pseudonyms_link_equal_values_and_only_these(spark):
    df = spark.range(100_000, 101_000).selectExpr("concat('4111111', id, ' and 10.1.', id % 256, '.', (id div 7) % 256, ' x') AS text", "id")
    out = pii.pseudonymize(df).select(F.split("text", " ").alias("p"), F.split(df["text"], " ").alias("q") if False else F.col("id")).collect()
    numbers = [r["p"][0] for r in out]
    assert len(set(numbers)) == len(numbers) and all(len(n) == 13 for n in numbers)
    assert one(spark, "call 4111 1111 1111 1111") == one(spark, "call 4111 1111 1111 1111") != one(spark, "call 4111 1111 1111 1111", "other")


def test_long_values_leave_nothing(spark):
    rng = random.Random(7)
    for n in (201, 1_000, 10_000):
        value = "".join(rng.choice("abcdefXYZ0123456789_-") for _ in range(n))
        outs = [one(spark, f"token={v} end") for v in (value, value, value[:-1] + ("a" if value[-1] != "a" else "b"))]
        assert outs[0] == outs[1] != outs[2] and len(outs[0]) == len("token= end") + 64
        mail = one(spark, f"to {value}@mail.example.com, {'a@b' + '.c' * n}.")
        assert mail.startswith("to user.") and mail.endswith("@example.invalid.") and len(mail) < 100
        digits = "".join(rng.choice("0123456789") for _ in range(n))
        new, again, other = (one(spark, f"DE{d} end")[2:-4] for d in (digits, digits, digits[:-1] + str((int(digits[-1]) + 1) % 10)))
        assert new == again != other and new != digits and new.isdigit() and len(new) == n
    for n in (19, 20, 36, 37):
        new = one(spark, f"DE{'7' * n} end")[2:-4]
        assert new != "7" * n and new.isdigit() and len(new) == n


def test_feistel_is_a_permutation(spark):
    df = spark.range(1000).select(pii.permuted_digits("k", F.lpad(F.col("id").cast("string"), 3, "0")).alias("v"))
    assert sorted(r["v"] for r in df.collect()) == [f"{i:03d}" for i in range(1000)]


def test_pseudonyms_on_odd_rows(odd):
    out = pii.pseudonymize(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    before, after = (Counter((r["doc_id"], r["text"]) for r in d.collect()) for d in (odd, out))
    assert [k[0] for k in before - after] == [8]
    assert rows_of(pii.pseudonymize(odd.where("false"))) == []


# --- 8: winnowing


def brute_winnow(text, k, w):
    grams = [text[i : i + k] for i in range(max(1, len(text) - k + 1))]
    h = [int(winnowing.winnow(g, k, w)[0][0]) for g in grams]
    chosen = []
    for i in range(max(1, len(h) - w + 1)):
        window = h[i : i + w]
        at = i + max(j for j, x in enumerate(window) if x == min(window))
        if not chosen or chosen[-1] != at:
            chosen.append(at)
    return [h[i] for i in chosen], chosen


def test_winnowing_chooses_rightmost_minima(monkeypatch):
    rng = random.Random(9)
    for step in (1 << 20, 16):
        monkeypatch.setattr(winnowing, "_STEP", step)
        for n in (1, 3, 4, 9, 40, 150):
            text = "".join(rng.choice("abé") for _ in range(n))
            hashes, at = winnowing.winnow(text, 4, 6)
            want = brute_winnow(text, 4, 6)
            assert hashes.tolist() == want[0] and at.tolist() == want[1]


def test_winnowing_keeps_short_texts_near_their_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) between 16 and 127").select("doc_id", "text")
    follow = "QWZXJKVYUGPB" * 20  # shares nothing with the texts
    texts = [r["text"] for r in docs.collect()] + ["short text of 22 signs", "sixteen letters!"]
    for text in texts:
        cut = len(text) // 4
        prints = [winnowing.winnow(t)[0] for t in (text, text[: len(text) - cut] + follow[:cut], follow)]
        assert winnowing.likeness(prints[0], prints[1]) > winnowing.likeness(prints[0], prints[2])


def test_winnowing_against_next(odd, small):
    for docs in (small, odd):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
        want = []
        for (i, text), (_, follow) in zip(rows, [*rows[1:], rows[0]]):
            cut = len(text) // 4
            new = text[: len(text) - cut] + follow[:cut]
            prints = [winnowing.winnow(t)[0] for t in (text, new, follow)]
            want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), winnowing.printed(prints[0]), winnowing.printed(prints[1]),
                         winnowing.likeness(prints[0], prints[1]), winnowing.likeness(prints[0], prints[2])))
        assert Counter(rows_of(winnowing.against_next(docs))) == Counter(want)
    assert rows_of(winnowing.against_next(odd.where("false"))) == []
    assert winnowing.fingerprints(odd).count() == odd.count()


# --- 9: host rules


def test_measures_by_hand(odd):
    assert host_rules.measure("a b c\nx #|\na b c\n\n\nd") == (9, 10, 2, 1, 6)
    assert host_rules.measure(None) == (0, 0, 0, 0, 0)
    judged = host_rules.judge(host_rules.measures(odd.withColumn("host", F.col("source"))))
    assert judged.count() == odd.count() and judged.where("kept and base_failed").count() == 0
    assert rows_of(host_rules.judge(host_rules.measures(odd.withColumn("host", F.col("source")).where("false")))) == []


def test_bad_hosts_lose_their_good_documents(spark):
    rows = [(i, f"h{i % 20}", 100, 1, 0, 0, 80 if i % 20 == 3 and i % 200 != 3 else 0) for i in range(2000)]
    judged = host_rules.judge(spark.createDataFrame(rows, "doc_id long, host string, " + ", ".join(f"{m} long" for m in host_rules.MEASURES)))
    lost = judged.where("not kept and not base_failed").select("host").distinct().collect()
    assert [r["host"] for r in lost] == ["h3"]


# --- 10: chat


def test_chats_round_trip(spark):
    rng = random.Random(6)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\/s>", "<\\\\s>", "[\\INST]", "\n", "</s>\n<s>[INST] user [/INST]\n", " hi", "$1", "</s", "<", "é😀", ""]
    rows = [(c, t, rng.choice(["user", "assistant", None, "odd [/INST]\nrole", ""]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 7)))])) for c in range(150) for t in range(rng.randint(1, 6))]
    rows += [(7, 2, "user", "tie"), (7, 2, "user", "tie"), (None, None, None, None)]
    chats = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    done = chat.format_chats(chats)
    assert done.where("not identical").count() == 0 and done.where("rounds > 0").count() > 0
    for r in done.collect():
        assert r["formatted"].count("<s>") == r["formatted"].count("</s>") == r["formatted"].count("[/INST]") == len(r["turns"])
    assert chat.format_chats(chats.where("false")).count() == 0


# --- pipeline


def test_near_duplicate_stage_against_all_pairs(spark, small):
    rng = random.Random(8)
    docs = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").limit(120).collect()]
    for base in [t for _, t in docs if len((t or "").split()) > 60][:15]:  # near copies, some on either side of 0.8
        for share in (0.005, 0.01, 0.02, 0.04):
            words = [f"new{rng.random()}" if rng.random() < share else w for w in base.split(" ")]
            docs.append((10**6 + len(docs), " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(60))  # a crowd of near copies, and one of texts that only share a passage
    docs += [(2 * 10**6 + i, f"{passage} {i}") for i in range(40)] + [(3 * 10**6 + i, passage + " " + " ".join(f"q{i}.{k}" for k in range(rng.randint(5, 30)))) for i in range(40)]
    docs += [(5, None), (6, " "), (7, "a b"), (8, "A  b"), (9, "a b c"), (docs[3][0], docs[3][1]), (None, docs[4][1])]

    def shingles(text):
        words = (text or "").lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if sets[i] == sets[k] or (both and 5 * both >= 4 * (len(sets[i]) + len(sets[k]) - both)):
                root[find(i)] = find(k)
    want = {}
    for i, (doc_id, _) in enumerate(docs):
        key = (doc_id is None, doc_id or 0)
        want[find(i)] = min(key, want.get(find(i), key))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, SF).collect()
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == Counter(want.values())


def test_pipeline_stages(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas())


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got)
    check_packing(got)
