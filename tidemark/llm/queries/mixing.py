"""op7: sources mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..mixing import mix_to_targets
from .registry import query, table

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
),
filled AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weights,
         sum(3 * source_size) OVER f AS caps, sum(weight) OVER f AS capped_weights
  FROM per_source
  WINDOW f AS (ORDER BY 3 * source_size / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
marked AS (
  SELECT *, cap * (all_weights - capped_weights) <= (budget - caps) * weight AS capped FROM filled
),
targets AS (
  SELECT source, source_size, budget,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE
                   / (all_weights - coalesce(sum(weight) FILTER (capped) OVER (), 0)) * weight END AS target
  FROM marked
),
queued AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.budget,
         ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS queued
  FROM queued WHERE size > 0
),
passes AS (
  SELECT *, turn * source_size + queued - size AS ahead
  FROM placed, (SELECT unnest([0, 1, 2]) AS turn)
),
packets AS (
  SELECT *, unnest(range(CASE WHEN ahead < target AND ahead + size > target
                              THEN (size + 63) // 64 ELSE 1 END)) AS packet,
         ahead < target AND ahead + size > target AS cut
  FROM passes
),
times AS (
  SELECT *, (ahead + packet * 64 + words)::DOUBLE / target AS finish
  FROM (SELECT *, CASE WHEN cut THEN least(64, size - packet * 64) ELSE size END AS words FROM packets)
),
served AS (
  SELECT *, sum(words) OVER (ORDER BY finish, source ASC NULLS LAST, turn, draw, doc_id, size, packet
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
  FROM times
),
shares AS (
  SELECT doc_id, source, sum(greatest(least(words, budget - (served - words)), 0))::BIGINT AS taken
  FROM served GROUP BY doc_id, source
)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(s.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN shares s ON q.doc_id IS NOT DISTINCT FROM s.doc_id AND q.source IS NOT DISTINCT FROM s.source
"""


@query("op7_fair_mix", MIX_SQL)
def fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(table(spark, sf_dir, "documents"))
