"""Periodic runs, conversation repair and HTML extraction against brute force, hand-written cases and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from html import unescape

import pytest

from plumbline.llm import html_text, periodic, repair

SF = "/root/testdata/sf0.001"


# --- 11: periodic runs


def brute_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            part = words[i : i + size]
            if j > i and size >= max(6, 4 * q) and not any(part[d:] == part[: size - d] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = [b"%d" % rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
    if len(words) > 8 and rng.random() < 0.6:
        a, p = rng.randrange(len(words) - 6), rng.randint(1, 7)
        for i in range(a, min(len(words), a + rng.randint(6, 40))):
            words[i] = words[a + (i - a) % p]
    return words


def test_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(1_500):
        words = random_words(rng)
        assert periodic.runs(words) == brute_runs(words), words


def test_squares_against_brute_force():
    """All maximal repetitions of two periods or more, not only those that are long enough for a run."""
    rng = random.Random(12)
    for _ in range(600):
        values = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(0, 40))]
        want = {}
        for q in range(1, len(values) // 2 + 1):
            for i in range(len(values) - 2 * q + 1):
                if values[i : i + q] != values[i + q : i + 2 * q] or (i and values[i - 1] == values[i + q - 1]):
                    continue
                j = i + 2 * q
                while j < len(values) and values[j] == values[j - q]:
                    j += 1
                part = values[i:j]
                if not any(part[d:] == part[: len(part) - d] for d in range(1, q)):
                    want[i, q] = j - 1
        assert periodic.squares(values) == want, values


def test_stretches_hold_every_run_and_little_else():
    rng = random.Random(13)
    prose = [b"%d" % rng.randrange(10**6) for _ in range(5_000)]
    passage = prose[100:160]
    far_apart = prose + passage  # repeated, but never four times in a row
    assert periodic.runs(far_apart) == [] and periodic.stretches(periodic.np.array([hash(w) for w in far_apart])) == []
    assert periodic.runs(prose + passage * 4) == [(5_000, 240, 60)]


def expected_runs(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    digests = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{s},{size},{q}\n" for s, size, q in found).encode(), b" ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *digests)


def by_text(rows):
    return sorted(rows, key=repr)


def test_runs_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(14)
    texts = [None, "", " \t\n\x0b", "a", "a a a a a a", "x " * 700, "é ü é " * 9, "  a b " * 5, "one line of text\n" * 20]
    texts += [b" ".join(random_words(rng)).decode() for _ in range(150)]
    rows = [(i, t, i, "clash", 1.5) for i, t in enumerate(texts)] + [(8, texts[8], 0, "", 0.0), (None, "b a " * 6, 0, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, g long, words string, a double")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.runs_query(spark, str(tmp_path)).collect()]
    assert by_text(got) == by_text(expected_runs(r[0], r[1]) for r in rows)
    assert periodic.find_runs(docs.where("false")).count() == 0


def test_runs_query_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 4000").collect()
    got = {r["doc_id"]: tuple(r) for r in periodic.runs_query(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for doc_id, text in docs:
        assert got[doc_id] == expected_runs(doc_id, text)


# --- 12: conversation repair


def brute_repair(kinds):
    """Least cost, then least audit, of all edits of turns that may stay, by exhaustive dynamic programming over strings."""
    ways = [(0, ""), (10, "II"), (5, "I"), (0, "")]
    for kind in reversed(kinds):
        extra, initial, now = 5 * kind.isupper(), kind.lower(), []
        for s in range(4):
            to = repair.AFTER[s]
            options = [(2 + ways[s][0], "D" + ways[s][1]), (1 + extra + ways[to][0], "R" + ways[to][1])]
            if initial in repair.KEPT[s]:
                kept = ways[repair.KEPT[s][initial]]
                options.append((extra + kept[0], "K" + kept[1]))
            now.append(min(options))
        for _ in range(3):
            now = [min(now[s], (5 + now[repair.AFTER[s]][0], "I" + now[repair.AFTER[s]][1])) for s in range(4)]
        ways = now
    return ways[0]


def test_trace_against_brute_force():
    rng = random.Random(21)
    for _ in range(4_000):
        kinds = "".join(rng.choice("suaxSUAX") for _ in range(rng.randint(0, 14)))
        letters, state = repair.trace(kinds, repair.END, 0)
        audit = "".join(letters) + {0: "", 1: "II", 2: "I", 3: ""}[state]
        vector, least = repair.run_back(kinds, repair.END)[0]
        assert (vector[0] + least, audit) == brute_repair(kinds)


def expected_repair(rows):
    """All that is told of one conversation, from its rows (turn, role, text) as they are."""
    rows = sorted(((turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds, faults = set(), [], []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        kinds.append(initial.upper() if fault == "truncated" else initial)
    stays = [f in (None, "truncated") for f in faults]
    cost, letters = brute_repair([k for k, s in zip(kinds, stays) if s])
    letters, audit, state, lines = list(letters), "", 0, []

    def write(letter, role="", text=""):
        nonlocal state
        lines.append(f"{role if letter == 'K' else repair.WANTED[state]}:{text}")
        state = repair.KEPT[state][role[0]] if letter == "K" else repair.AFTER[state]

    for (_, role, text), stay in zip(rows, stays):
        if not stay:
            audit, cost = audit + "D", cost + 2
            continue
        while (letter := letters.pop(0)) == "I":
            audit += "I"
            write("I")
        audit += letter
        if letter != "D":
            write(letter, role, text)
    for letter in letters:
        audit += letter
        write(letter)
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_turns(rng, n, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    return [(rng.choice([None, t, t, t, t]), rng.choice(roles), rng.choice([None, "", " \n", "same.", "no end", f"text {t}.", f"text {t}?\n", f"cut {t}"])) for t in range(n)]


@pytest.mark.parametrize("size", [3, 4_096])
def test_repair_against_brute_force(spark, size):
    rng = random.Random(22)
    convs = {c: random_turns(rng, rng.randint(1, 25)) for c in [None, *range(-2, 60)]}
    convs[100] = [(1, "user", "a."), (1, "user", "a."), (1, "user", "b."), (1, None, None)]
    rows = [(c, *r, "clash", 7) for c, rs in convs.items() for r in rs]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, fault int")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(df, chunk=size).collect()}
    assert got == {c: expected_repair(rs) for c, rs in convs.items()}


def test_long_conversation_needs_fix_up_passes(spark):
    """Stretches of truncated turns pass a vector on unchanged, so that a wrong start has to cross chunks."""
    rng = random.Random(23)
    turns = [(t, rng.choice(["user", "assistant"]), f"cut {t}" if t % 100 < 90 else f"whole {t}.") for t in range(800)] + [(900, "user", "last.")]
    df = spark.createDataFrame([(1, *r) for r in turns] + [(2, 0, "user", "hello.")], "conv_id long, turn long, role string, text string")
    stays = repair.faults(df).select("conv_id", "place", "kind")
    chunks = repair.converged(repair.chunked(stays, 16)).where("conv_id = 1").orderBy("id").collect()
    after = repair.END
    for row in reversed(chunks):  # every start is exact but for a constant
        assert {a - b for a, b in zip(row["start"], after)} == {row["start"][0] - after[0]}
        vector, least = repair.run_back(row["kinds"], after)[0]
        after = tuple(c + least for c in vector)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(df, chunk=16).collect()}
    assert got == {1: expected_repair(turns), 2: expected_repair([(0, "user", "hello.")])}


def test_repair_keeps_conversations_without_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi.")], "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(1,), (2,), (None,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(df, ids).collect()}
    assert got == {1: (0, 0, 0, 0, 0, 2, "D", empty[-1]), 2: empty, None: empty}
    assert repair.repair(df.where("false")).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", f"a. b! {c}") for c in range(40) for t in range(5)] + [(None, None, None, None), (3, None, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        want += [(c, t, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    assert by_text(tuple(r) for r in repair.damaged(df).collect()) == by_text(want)


# --- 13: HTML extraction

LONG = "A sentence of a paragraph that goes on, and on, with many words. " * 5


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), (" \n ", ""), ("plain", "plain"), ("<p><p><p>", ""), ("<script>never closed", ""), ("<!-- never closed", ""),
    ("<nav><a href=x>menu</a></nav>", ""), ('<p title="a>b">q</p', "q"), ("a &lt;b&gt; &amp;amp; &#233; &nosuch; &copy", "a <b> &amp; é &nosuch; ©"),
    (f"<article><h1>T</h1><p>{LONG}<p>two<br>lines<ul><li>one<li>two</ul><pre>x\n   y</pre></article><footer>f</footer>", f"T\n\n{LONG.strip()}\n\ntwo lines\n\none\n\ntwo\n\nx y"),
    (f"<article><header><h1>T</h1></header><p>x < y & z <b>bo<i>ld</b></i> on<script>if(a<b){{'</p>'}}</script><!-- </p> -->.</p>"
     f"<div class='reader-comments'><p>{LONG}</p></div><aside>s</aside></article>", "T\n\nx < y & z bold on."),
    (f"<div id=wrap><div class='top-menu'><a href=/>Home</a></div><div class=post><h1>Title</h1><div class=content><p>{LONG}</p><p>Short.</p></div></div>"
     f"<section id=comments><p>{LONG * 3}</p></section><div id=cookieNotice>We use cookies</div></div>", f"Title\n\n{LONG.strip()}\n\nShort."),
    (f"<div><a href=a>one</a> <a href=b>two</a> <a href=c>three</a></div><div><h1>H</h1><p>{LONG}</p><p>{LONG}</p></div><div>plain footer</div>", f"H\n\n{LONG.strip()}\n\n{LONG.strip()}"),
    (f"<form action=search><input name=q>find</form><p>{LONG}</p><div hidden>secret</div><p style='display: none'>no</p>", LONG.strip()),
    (f"<body><div>{'word ' * 4}</div><main><h1>M</h1><p>{LONG}</p></main></body>", f"M\n\n{LONG.strip()}"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_density_by_hand():
    tree = html_text.Tree("<div><a>menu</a><a>more</a></div><p>" + "x" * 200 + "</p>")
    gone = html_text.not_text(tree)
    of, total = html_text.densities(tree, gone)
    chars, linked, tags, links = {"body": 208, "div": 8, "a": 4, "p": 200}, {"body": 8, "div": 8, "a": 4, "p": 0}, {"body": 4, "div": 2, "a": 0, "p": 0}, {"body": 2, "div": 2, "a": 1, "p": 0}
    for i, tag in enumerate(tree.tag):
        c, lc, t, lt = (d[tag] for d in (chars, linked, tags, links))
        base = html_text.np.log(html_text.np.log(c / max(c - lc, 1) * lc + 8 / 208 * c + html_text.np.e))
        assert of[i] == pytest.approx(c / max(t, 1) * html_text.np.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / base)
    assert total[0] == pytest.approx(of[1] + of[4]) and of[1] == 0 and html_text._densest(tree, total, 0, 5) == 4


def test_deep_and_broken_pages_stay_linear():
    for html in ("<div>" * 20_000 + "x", "<h1>a</h1><div><p>x</p></div>" * 5_000, "</section>" * 20_000 + "<ul><li>" * 5_000, "<p '" + "'" * 50_000, "<a b=\"" * 20_000, "<" * 20_000):
        assert isinstance(html_text.main_text(html), str)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html_text.html_query(spark, SF).collect()}
    for page_id, url, html in pages:  # these pages are plain enough for a rule of their own
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in blocks if b)
        assert got[page_id] == (url, text, len(text))


def test_extract_on_odd_rows(spark):
    rows = [(1, "u", "<p>a</p>", "clash"), (1, None, "<p>a</p>", ""), (None, None, None, None), (2, "v", "", "x"), (3, "w", "<p>" + "long " * 200_000, "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = by_text(tuple(r) for r in html_text.extract(df).collect())
    assert got == by_text([(1, "u", "a"), (1, None, "a"), (None, None, ""), (2, "v", ""), (3, "w", ("long " * 200_000).strip())])
    assert html_text.extract(df.where("false")).collect() == []
