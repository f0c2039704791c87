"""op8: main text of pages. SQL cannot express the tree; tests hold it against planted pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..htmltext import extract
from .registry import query, table


@query("op8_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
