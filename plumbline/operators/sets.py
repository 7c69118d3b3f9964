"""Set proofs: partitions of a population, replay equality, restore and append-only checks.

Multiset comparison adds +1 and -1 per distinct row in one aggregation, so both
directions cost one shuffle and copies combine before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import record_sha
from plumbline.operators.aggregates import fingerprint_sums
from plumbline.operators.joins import _per_key, _present


def multiset_balance(a: DataFrame, b: DataFrame, cols: list[str], digest: bool = False) -> DataFrame:
    """Per distinct row: copies in `a` minus copies in `b`, zero rows left out.

    Rows are grouped by their values; `digest=True` groups wide rows by fingerprint instead,
    so that 32 bytes per distinct row are shuffled.
    """
    keys = [F.unhex(record_sha(cols)).alias("record_sha")] if digest else [F.col(c) for c in cols]
    signed = a.select(*keys, F.lit(1).alias("__s")).unionByName(b.select(*keys, F.lit(-1).alias("__s")))
    return signed.groupBy(*signed.columns[:-1]).agg(F.sum("__s").alias("balance")).filter("balance <> 0")


def population(candidates: DataFrame, parts: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """Each candidate must lie in exactly one part; counts of candidates per number and names of parts."""
    marked = candidates.select(*key, F.lit("candidates").alias("part"))
    for name, part in parts.items():
        marked = marked.unionByName(part.select(*key, F.lit(name).alias("part")))
    counts = [F.count_if(F.col("part") == name).alias(name) for name in ("candidates", *parts)]
    per_key = marked.groupBy(*key).agg(*counts)
    inside = sum((F.col(name) for name in parts), F.lit(0))
    where = F.concat_ws("+", *[F.when(F.col(name) > 0, F.lit(name)) for name in parts])
    status = (
        F.when(F.col("candidates") == 0, "not_a_candidate").when(inside == 0, "unassigned")
        .when(inside > F.col("candidates"), "overlap").otherwise("assigned")
    )
    return per_key.groupBy(where.alias("parts"), status.alias("population_status")).agg(F.count("*").alias("n_keys"))


def replay_equal(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows only in `a`, rows only in `b`, and the verdict."""
    balance = multiset_balance(a, b, cols)
    only_a = F.coalesce(F.sum(F.greatest(F.col("balance"), F.lit(0))), F.lit(0))
    only_b = F.coalesce(F.sum(F.greatest(-F.col("balance"), F.lit(0))), F.lit(0))
    return balance.agg(only_a.alias("only_first"), only_b.alias("only_second")).withColumn(
        "replay_status", F.when((F.col("only_first") == 0) & (F.col("only_second") == 0), "equal").otherwise("different"))


def verify_restore(manifest: DataFrame, files: DataFrame, key: list[str], digest: str) -> DataFrame:
    """Restored files against the manifest by path and hash; an undeclared file fails."""
    joined = _per_key(manifest, key, [digest], "m").join(_per_key(files, key, [digest], "f"), key, "full_outer")
    equal = F.col(f"m_{digest}").eqNullSafe(F.col(f"f_{digest}"))
    status = (
        F.when(_present("f") == 0, "missing").when(_present("m") == 0, "undeclared")
        .when((_present("m") > 1) | (_present("f") > 1), "not_unique").when(equal, "restored").otherwise("hash_mismatch")
    )
    return joined.select(*key, status.alias("restore_status"))


def replicate(df: DataFrame, k: int, name: str = "copy") -> DataFrame:
    """The same rows k times, each copy numbered."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(k))))


def replicated_fingerprints(df: DataFrame, cols: list[str], k: int) -> DataFrame:
    """One fingerprint per copy; all must agree."""
    return fingerprint_sums(replicate(df, k), cols, ["copy"])


def field_union(df: DataFrame, json_col: str) -> DataFrame:
    """Every field found in any object, with the number of records that carry it."""
    return df.select(F.explode(F.json_object_keys(json_col)).alias("field")).groupBy("field").agg(F.count("*").alias("n_records"))


def append_only(old: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    """Counts of kept-or-added rows and lost rows; append-only means nothing is lost."""
    balance = multiset_balance(old, new, cols)
    lost = F.coalesce(F.sum(F.greatest(F.col("balance"), F.lit(0))), F.lit(0))
    added = F.coalesce(F.sum(F.greatest(-F.col("balance"), F.lit(0))), F.lit(0))
    return balance.agg(lost.alias("lost"), added.alias("added")).withColumn(
        "append_status", F.when(F.col("lost") == 0, "append_only").otherwise("rewritten"))


def appended_text(old: str | Column, new: str | Column) -> Column:
    """struct(append_status, suffix_sha): the old text is still the prefix, and the digest of what was added."""
    o = F.col(old) if isinstance(old, str) else old
    n = F.col(new) if isinstance(new, str) else new
    kept = F.coalesce(n.startswith(o), F.lit(False))
    return F.struct(
        F.when(kept, "append_only").otherwise("rewritten").alias("append_status"),
        F.when(kept, F.sha2(F.substring(n, F.length(o) + 1, F.length(n)), 256)).alias("suffix_sha"))
