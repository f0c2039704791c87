"""op13: conversations damaged by a checksum of their turns, then repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dialogues import repair_conversations
from .registry import query, table

REPAIR_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1
         THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)
),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
),
sums AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::INT])), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT key FROM keyed), crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM keyed JOIN sums USING (key) WHERE kind <> 0)
),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END AS initial
  FROM damaged
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '.' END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
  FROM numbered
),
stats AS (
  SELECT conv, any_value(conv_id) AS conv_id, max(i) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv
),
moves(p, q, turn) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
inserts(p, q, cost, audit, lines) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 3, 'I', E'\nuser:'), (1, 2, 3, 'I', E'\nuser:'), (3, 2, 3, 'I', E'\nuser:'), (2, 3, 3, 'I', E'\nassistant:'),
  (0, 3, 6, 'II', E'\nuser:\nassistant:'), (1, 3, 6, 'II', E'\nuser:\nassistant:')),
edited AS (
  SELECT conv, i, p, q, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cost, 'K' AS audit, E'\n' || role || ':' || text AS lines
  FROM faulty JOIN moves ON initial = moves.turn WHERE fault IN ('.', 't')
  UNION ALL
  SELECT conv, i, p, q, 3 + CASE fault WHEN 't' THEN 3 ELSE 0 END, 'R',
         E'\n' || CASE moves.turn WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
  FROM faulty JOIN moves ON moves.turn <> 's' WHERE fault IN ('.', 't')
  UNION ALL
  SELECT conv, i, p, p, 4, 'D', '' FROM faulty, (SELECT unnest([0, 1, 2, 3]) AS p)
),
steps AS (
  SELECT conv, i, e.p, x.q, min({'cost': e.cost + x.cost, 'audit': e.audit || x.audit, 'lines': e.lines || x.lines}) AS c
  FROM edited e JOIN inserts x ON e.q = x.p GROUP BY ALL
),
chart AS (
  SELECT conv, 0::BIGINT AS i, x.q, {'cost': x.cost, 'audit': x.audit, 'lines': x.lines} AS c
  FROM stats, inserts x WHERE x.p = 0
  UNION ALL
  SELECT conv, i, q, min(c) FROM (
    SELECT chart.conv, s.i, s.q, {'cost': chart.c.cost + s.c.cost, 'audit': chart.c.audit || s.c.audit,
                                  'lines': chart.c.lines || s.c.lines} AS c
    FROM chart JOIN steps s ON s.conv = chart.conv AND s.i = chart.i + 1 AND s.p = chart.q
  ) GROUP BY conv, i, q
),
ended AS (SELECT conv, min(c) AS c FROM chart JOIN stats USING (conv) WHERE chart.i = stats.n AND q IN (0, 3) GROUP BY conv)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(c.cost, 0)::BIGINT AS cost,
       coalesce(c.audit, '') AS audit, sha256(coalesce(substr(c.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN (stats JOIN ended USING (conv)) ON o.conv_id IS NOT DISTINCT FROM stats.conv_id
"""


def damage(rows: DataFrame) -> DataFrame:
    """Rows with one fault in four of twenty turns, by a checksum; one in twenty is dropped."""
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20
    cut = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        cut.alias("text"),
        F.explode(copies).alias("copy"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The report on damaged ``rows``, with a digest of each repaired conversation."""
    report, fixed = repair_conversations(damage(rows))
    line = F.struct("place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"])
    digests = fixed.groupBy(F.col("conv_id").alias("c")).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        rows.select(F.col("conv_id").alias("own"))
        .distinct()
        .join(report, F.col("own").eqNullSafe(F.col("conv_id")), "left")
        .join(digests, F.col("own").eqNullSafe(F.col("c")), "left")
        .select(
            F.col("own").alias("conv_id"),
            *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


@query("op13_conversation_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))
