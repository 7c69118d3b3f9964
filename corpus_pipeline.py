"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a DataFrame; all but the last
return the columns of `docs`. `run` writes each stage as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.mixing import mixed_texts
from plumbline.llm.near import keep_one
from plumbline.llm.packing import pack_documents
from plumbline.llm.pii import pseudonymize
from plumbline.llm.quality import keep_good
from plumbline.llm.shared import store, table


def recounted(docs: DataFrame) -> DataFrame:
    """`n_chars`, where there is one, brought up to date with the text."""
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of those documents."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 or more) stays: the one with the smallest id.

    SimHash groups come first, each compared exactly; prefixes find the near pairs whose fingerprints lie further apart.
    """
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms; every document stays."""
    return recounted(pseudonymize(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: documents come as often, and as far, as the mix takes them."""
    return mixed_texts(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_duplicates),
    ("PII pseudonyms", personal_data),
    ("mixing to target weights", mixture),
    ("best-fit packing", packing),
]

#: The classifier, the tokenizer and the pseudonyms have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
