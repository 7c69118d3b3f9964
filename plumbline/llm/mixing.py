"""Mixing sources to target weights: hash-random order inside each source, distributed prefix sums, an exact cut.

DataFrame operations only. A source may hold any share of the rows: its rows are cut into ranges of their
random key before they are summed, so no task ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.shared import BLANK, WORD, order_first, quoted, running, store

#: The random key has so many bits; one range of it holds about RANGE documents.
KEY_BITS = 60
RANGE = 4_000


def word_count(text: Column) -> Column:
    """Number of words; null and blank texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    """A 60-bit number from MD5 of seed and id: the same in every run and on every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """One row per source with `docs`, `source_size` and `target`.

    Sources in code point order (null last) take the weights in turn. All targets together are `share` times
    all sizes; no target exceeds `cap` times its source, what is cut off goes to the others by weight. With
    sources sorted by ceiling over weight, a source is full exactly if filling everything to its level costs
    no more than the budget, so one pass of running totals replaces repeated resharing.
    """
    per = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    placed = running(per, order_first("source"), "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighed = placed.select("source", "docs", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * cap).alias("ceiling"))
    level = F.col("ceiling") / F.col("weight")
    summed = running(weighed.withColumn("level", level), [F.col("level").asc(), *order_first("source")], "levels",
                     full_before=F.col("ceiling"), weight_before=F.col("weight")).drop("place")
    whole = summed.agg(F.sum("weight"), F.sum("source_size")).first()
    all_weight, budget = whole[0] or 0, float((whole[1] or 0) * share)
    known = summed.withColumn("full", F.col("full_before") + F.col("level") * (F.lit(all_weight) - F.col("weight_before")) <= F.lit(budget))
    rest = known.agg(F.sum(F.when(F.col("full"), F.col("ceiling"))), F.sum(F.when(~F.col("full"), F.col("weight")))).first()
    full_sum, open_weight = rest[0] or 0, rest[1] or 1
    water = F.col("weight") * F.lit(budget - full_sum) / F.lit(open_weight)
    target = F.when(F.col("full"), F.col("ceiling").cast("double")).otherwise(F.least(F.col("ceiling").cast("double"), water))
    return known.select("source", "docs", "source_size", target.alias("target"))


def mix(rows: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "mix") -> DataFrame:
    """`rows` (doc_id, source, size, anything else) with `source_size`, `target` and `taken`.

    Whole epochs of a source are taken as often as they fit its target; of the last epoch the documents are
    taken in random order until the target, rounded down to a whole word, is reached, the last one in part.
    Null ids, null sources and repeated rows count like others; documents of size 0 take 0; an empty table gives none.
    Other columns come along under any name; those named like a result are replaced by it.
    `rows` is evaluated three times: pass a stored table if it is dear.
    """
    base, results = ("doc_id", "source", "size"), ("source_size", "target", "taken")
    kept = [c for c in rows.columns if c.lower() not in results]
    extra = [c for c in kept if c.lower() not in base]  # packed, so that no name meets one used here
    packed = [F.struct(*[quoted(c) for c in extra]).alias("__extra")] if extra else []
    keyed = rows.select(*base, *packed).withColumn("__key", random_key(F.col("doc_id"), seed))
    sources = store(source_targets(rows, weights, share, cap), "targets")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / RANGE))).cast("int")
    cuts = sources.select("source", F.col("source_size"), "target", F.least(bits, F.lit(30)).alias("__bits"))
    known = keyed.join(cuts, keyed["source"].eqNullSafe(cuts["source"])).drop(cuts["source"])
    ranged = known.withColumn("__range", F.expr(f"shiftright(__key, {KEY_BITS} - __bits)"))
    totals = ranged.groupBy("source", "__range").agg(F.sum("size").alias("__sum"))
    earlier = W.partitionBy("source").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("__s"), F.col("__range").alias("__r"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = W.partitionBy("source", "__range").orderBy("__key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, -1)
    summed = ranged.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(offsets, summed["source"].eqNullSafe(offsets["__s"]) & (summed["__range"] == offsets["__r"]))
    goal = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = goal - epochs * F.col("source_size") - F.col("__offset") - F.col("__inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    columns = [F.col("__extra")[c].alias(c) if c in extra else F.col(c) for c in kept]
    return joined.select(*columns, "source_size", "target", taken.cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"[{BLANK}]*{WORD}"), F.lit(0)), F.lit(1), n), "")


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of `docs`: a row per copy that the mix takes; the last copy of a
    document is cut to the words that are still taken, with `n_chars` to match. Documents of no words are not taken."""
    plain = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*[quoted(c) for c in docs.columns]).alias("__row"))
    mixed = mix(plain, **options).where("taken > 0")
    left = F.when(F.col("__copy") * F.col("size") > F.col("taken"), (F.col("taken") % F.col("size")).cast("int"))
    copies = mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    text = F.when(left.isNull(), F.col("__row.text")).otherwise(first_words(F.col("__row.text"), F.coalesce(left, F.lit(1))))
    cut = copies.select("__row", text.alias("__text"))
    out = {"text": F.col("__text"), "n_chars": F.length("__text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return cut.select(*[out[c].alias(c) if c in out else F.col("__row")[c].alias(c) for c in docs.columns])


def mix_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
MIX_SQL = f"""
WITH docs AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
    CAST(('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS k FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight
    FROM docs GROUP BY source),
levels AS (SELECT *, source_size * 2 AS ceiling, source_size * 2 / weight AS level FROM per),
summed AS (SELECT *, coalesce(sum(ceiling) OVER b, 0) AS full_before, coalesce(sum(weight) OVER b, 0) AS weight_before,
    sum(weight) OVER () AS all_weight, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget
    FROM levels WINDOW b AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
known AS (SELECT *, full_before + level * (all_weight - weight_before) <= budget AS filled FROM summed),
rest AS (SELECT coalesce(sum(ceiling) FILTER (filled), 0) AS full_sum, sum(weight) FILTER (NOT filled) AS open_weight FROM known),
targets AS (SELECT source, source_size, CASE WHEN filled THEN CAST(ceiling AS DOUBLE)
    ELSE coalesce(least(CAST(ceiling AS DOUBLE), weight * (budget - full_sum) / open_weight), 0) END AS target FROM known, rest),
placed AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS goal,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id NULLS LAST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, goal - epochs * source_size - before)) AS BIGINT) AS taken FROM placed
"""
