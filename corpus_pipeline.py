"""A corpus pipeline: documents to a deduplicated, decontaminated mix, in stages of the corpus operators.

Each stage takes (spark, docs, sf_dir); ``docs`` is what its predecessor kept, stored as Parquet
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import drop_contaminated
from tidemark.llm.langid import keep_identified
from tidemark.llm.mixing import mix_documents
from tidemark.llm.neardup import keep_representatives
from tidemark.llm.paragraphs import remove_repeats
from tidemark.llm.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is doubtful, go."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return keep_representatives(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; documents with nothing left go."""
    cut = remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words it takes of each."""
    return mix_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeats),
    ("decontamination", benchmark),
    ("mixing", mix),
]

#: SQL cannot express the learned language stage; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
