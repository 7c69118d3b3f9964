"""Append-only batches and safe CSV."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import escape_formula, is_sensitive
from plumbline.operators.aggregates import set_fingerprint
from plumbline.operators.filters import project_allowed

MANIFEST = "manifest"


def publish_batch(df: DataFrame, root: str, batch_id: str, manifest: dict[str, str]) -> None:
    """Write a new `batch_id=` directory; a second publish of the same id fails and changes nothing.

    Rows go to a folder of their own first. The manifest is written last, names that folder and the fingerprint of what
    was written, and marks the batch as complete: `read_batch` never sees a half-written one, and a publish
    that broke before its manifest can simply be made again.
    """
    target, staged = f"{root}/batch_id={batch_id}", f"data-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{target}/{staged}")
    written = set_fingerprint(df.sparkSession.read.schema(df.schema).parquet(f"{target}/{staged}")).first()
    facts = {**manifest, "batch_id": batch_id, "data": staged, "n_rows": written["n_rows"], "fingerprint": written["fingerprint"]}
    row = json.dumps(facts, sort_keys=True, ensure_ascii=False)
    schema = T.StructType([T.StructField("value", T.StringType())])
    df.sparkSession.createDataFrame([(row,)], schema).coalesce(1).write.mode("errorifexists").text(f"{target}/{MANIFEST}")


class BatchAltered(ValueError):
    """A batch holds other rows than it was published with."""


def read_batch(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """Rows of a completed batch, whose fingerprint is computed again and must be the stated one; without a manifest the read fails."""
    facts = read_manifest(spark, root, batch_id)
    rows = spark.read.parquet(f"{root}/batch_id={batch_id}/{facts['data']}")
    found = set_fingerprint(rows).first()
    if (found["n_rows"], found["fingerprint"]) != (facts["n_rows"], facts["fingerprint"]):
        raise BatchAltered(f"batch {batch_id} states {facts['n_rows']} rows and holds {found['n_rows']}, or others")
    return rows


def is_published(spark: SparkSession, root: str, batch_id: str) -> bool:
    try:
        read_manifest(spark, root, batch_id)
        return True
    except AnalysisException:
        return False


def read_manifest(spark: SparkSession, root: str, batch_id: str) -> dict[str, str]:
    """What a completed batch says about itself; raises when it was never completed."""
    return json.loads(spark.read.text(f"{root}/batch_id={batch_id}/{MANIFEST}").first()["value"])


def safe_projection(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed columns, formula signs escaped in text."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return project_allowed(df, cols).select(*[escape_formula(c).alias(c) if c in text else F.col(c) for c in cols])


def write_safe_csv(df: DataFrame, path: str, cols: list[str], order_by: list[str]) -> None:
    """Sorted CSV with a header; fails before writing when any text is sensitive.

    The sort is a range sort over all tasks: part files in name order are the total order.
    """
    safe = safe_projection(df, cols)
    text = [f.name for f in safe.schema if isinstance(f.dataType, T.StringType)]
    if text and safe.filter(is_sensitive(F.concat_ws("\n", *text))).limit(1).count():
        raise ValueError("sensitive text in the output; nothing was written")
    safe.orderBy(*order_by).write.mode("errorifexists").option("header", "true").csv(path)
