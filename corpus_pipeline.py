"""The cleaning pipeline over ``documents``: toxicity, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import decontamination, linededup, nearcopies, packing, toxicity
from sieveline.storage import discard, mark, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold; the lexicon is learnt from the labelled rows that are not held out."""
    lexicon = toxicity.learn_from_tables(spark, sf_dir)
    return toxicity.score(docs, lexicon).filter(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document with a smaller doc_id holds; n_chars follows the text."""
    kept = linededup.deduplicate_lines(docs)
    kind = docs.schema["n_chars"].dataType
    return kept.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of texts whose five-word shingles are alike by 0.8 or more."""
    return nearcopies.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 4096: a row per piece, with its ids."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Tokenisation, fingerprints and the learnt lexicon are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written to the shared folder and read again.

    What a stage wrote on the way, and the result of the stage before, is deleted once its own result is written.
    """
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(spark, since, docs)
    return docs
