"""A corpus pipeline: five stages from raw documents to a weighted training mix.

Each stage takes what the one before it kept, as a written table, and works on all of it. All
but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage
changes it. The last returns one row per document that is left, with its rate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotflow.llm import latent, mixing, ordinal, simhash, substrings
from depotflow.llm.common import shared_folder, table

#: Words of a passage that is removed where it repeats.
PASSAGE_WORDS = 50


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any toxic grade is a half or more go."""
    return ordinal.drop_toxic(docs, ordinal.fit_ordinal(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of five-word shingles, the smallest id stays."""
    return simhash.keep_first(docs, shingle=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that start more than once in what is left go; the document stays."""
    cleaned = substrings.remove_repeats(docs, PASSAGE_WORDS)
    changed = cleaned
    if "n_chars" in docs.columns:
        length = F.when(F.col("__removed__") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        changed = cleaned.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return latent.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the domains of the labels to their target weights."""
    return mixing.mixing_rates(docs, table(spark, sf_dir, "labels"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing_weights),
]

#: None: no SQL expresses the learned stages. tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/llm/{name.replace(' ', '-')}-{uuid.uuid4().hex[:12]}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
