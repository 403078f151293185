"""The cleaning of a document table, stage by stage; each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, classifier, decontam, lines, neardup
from gleaner.sources.files import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weak-label classifier, fitted to these rows, does not reject."""
    return classifier.filtered(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines, or single long lines, that occur earlier; rows that lose all
    their lines go. n_chars is that of the shortened text."""
    kept = lines.dedup(docs, long_words=lines.LONG_WORDS)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return neardup.dedup(docs, size=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them."""
    decoded = bpe.decode(bpe.encode(docs))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("benchmark", drop_benchmark_leaks),
    ("tokens", tokens),
]

#: The first stage decides by a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``. Each result is written as Parquet to the shared folder
    and read back, so a lost executor never costs more than one stage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
