"""op3: token counts. SQL cannot express a tokenizer; tests compare with the library on whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..tokencounts import token_counts
from .registry import query, table


@query("op3_token_counts")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
