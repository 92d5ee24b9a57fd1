"""The corpus pipeline: documents are selected, thinned of near copies, decontaminated, cleaned of secrets and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm import decontamination, graded_quality, ngram_join, packing, secret_scan
from talkgrain.llm.queries import SELECT_CHANCE, SELECT_GRADE, graded
from talkgrain.llm.shared import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Well written and clean documents stay, by a classifier fitted on the rated ones."""
    model = graded_quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return graded_quality.scored(docs, model, select=SELECT_GRADE, least=SELECT_CHANCE).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the values of secrets in them go."""
    return secret_scan.without_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("pack", pack),
]

# Neither the fitted classifier nor similarity classes, tiles, lexed pairs and packing can be written in SQL; tests hold them
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
