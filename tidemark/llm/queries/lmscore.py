"""op12: log probabilities of texts. SQL cannot express the filter; tests compare with exact counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lmscore import score_documents
from .registry import query, table


@query("op12_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scored = score_documents(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("trained")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
