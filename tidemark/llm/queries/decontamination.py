"""op9: documents that hold benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..decontamination import decontaminate
from .registry import query, table

LEAKS_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS row, doc_id, w
  FROM (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\x00', ' ', 'g'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
),
iw AS (
  SELECT item_id, w, least(10, len(w)) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM iw)
),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n)
),
found AS (SELECT s.row, s.i, s.n, x.item_id FROM spots s JOIN windows x ON s.n = x.n AND s.pattern = x.pattern),
hit AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM found) GROUP BY row),
items AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON dw.row = hit.row LEFT JOIN items ON dw.row = items.row
"""


@query("op9_decontamination", LEAKS_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
