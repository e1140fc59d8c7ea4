"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwright.llm.decontaminate import clean_rows
from spanwright.llm.line_dedup import line_dedup_rows
from spanwright.llm.mixing import mix_sources
from spanwright.llm.near_dedup import near_dedup_rows
from spanwright.llm.quality import quality_filter
from spanwright.llm.rounds import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules by themselves or whose host does."""
    return quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated runs of three lines, or of more than 50 words, out of the texts; n_chars follows the text."""
    return line_dedup_rows(docs, words=50).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8)."""
    return near_dedup_rows(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that all sources weigh the same, in one global order."""
    return mix_sources(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near), ("decontamination", benchmark), ("mixing", mix)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
