"""op4: near duplicates on word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..neardup import near_duplicates
from .registry import query, table

NEAR_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s, least(len(w), 5) AS n
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.n = b.n AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n_shingles + y.n_shingles - c)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM dw
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a
),
roots AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT dw.doc_id, coalesce(n_shingles, 0)::BIGINT AS n_shingles, component_id,
       dw.doc_id = component_id AS kept
FROM dw LEFT JOIN sizes ON dw.doc_id = sizes.doc_id JOIN roots ON dw.doc_id = roots.doc_id
"""


@query("op4_near_duplicates", NEAR_SQL)
def near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
