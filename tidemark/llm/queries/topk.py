"""op2: exact top-k search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..topk import top_products, whole_vectors
from .registry import query, table

TOP_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM v),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op2_top_products", TOP_SQL)
def top_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_products(vectors, vectors.where("vec_id % 50 = 0"))
