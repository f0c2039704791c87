"""Cleansing, casting, normalisation, de-duplication and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, dates, metrics, text
from ..operators.cleanse import stamp_run
from ..operators.dedup import dedup_keep_last, dedup_latest
from ..operators.flatten import flatten, flatten_all, infer_json_schemas, json_columns
from ..operators.normalize import INGEST_ORDER, explode_items, unify
from ..plans.silver import clean_statistics
from ..sources.catalog import query_table, read_table
from .registry import FACTS, facts, query, table

def tidy_sql(column: str) -> str:
    return rf"trim(regexp_replace({column}, '[\r\n]+', ' ', 'g'), '{text.WHITESPACE}')"


@query(
    "derived_metrics",
    f"""WITH {FACTS}, zeroed AS (
      SELECT l_orderkey, l_linenumber, likes, dislikes, comment_count,
        CASE WHEN l_returnflag = 'R' THEN 0 ELSE views END AS views FROM facts)
    SELECT l_orderkey, l_linenumber, views,
      CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0.0 END AS like_ratio,
      CASE WHEN views > 0 THEN round((likes + dislikes + comment_count) / views * 100, 4)
           ELSE 0.0 END AS engagement_rate
    FROM zeroed""",
)
def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    views, likes = F.col("views"), F.col("likes")
    zeroed = facts(spark, sf_dir, videos=False).withColumn(
        "views", F.when(F.col("l_returnflag") == "R", 0).otherwise(views).cast("bigint")
    )
    return zeroed.select(
        "l_orderkey",
        "l_linenumber",
        "views",
        metrics.like_ratio(likes, views).alias("like_ratio"),
        metrics.engagement_rate(
            likes, F.col("dislikes"), F.col("comment_count"), views
        ).alias("engagement_rate"),
    )


_STATS_ORDER = "l_orderkey DESC, l_linenumber DESC, views DESC, likes DESC, dislikes DESC, comment_count DESC"


@query(
    "dedup_latest",
    f"""WITH {FACTS} SELECT video_id, region, trending_date_parsed, l_orderkey,
      l_linenumber, views FROM (
        SELECT *, row_number() OVER (
          PARTITION BY video_id, region, trending_date_parsed
          ORDER BY {_STATS_ORDER}) AS rn FROM facts) WHERE rn = 1""",
)
def dedup_latest_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_latest(
        facts(spark, sf_dir, videos=False),
        latest=("l_orderkey", "l_linenumber"),
        tie_break=[
            F.col(c).desc() for c in ("views", "likes", "dislikes", "comment_count")
        ],
    )
    return kept.select(
        "video_id", "region", "trending_date_parsed", "l_orderkey", "l_linenumber", "views"
    )


@query(
    "dedup_latest_events",
    """SELECT user_id, event_type, day, event_id, value FROM (
      SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (
        PARTITION BY user_id, event_type, CAST(ts AS DATE)
        ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    kept = dedup_latest(
        events,
        ("user_id", "event_type", "day"),
        latest=("ts",),
        tie_break=[F.col("event_id").desc()],
    )
    return kept.select("user_id", "event_type", "day", "event_id", "value")


@query(
    "dedup_keep_last",
    """SELECT conv_id, role, turn, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn
      FROM conversations) WHERE rn = 1""",
)
def dedup_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return dedup_keep_last(turns, ["conv_id", "role"], "turn").select(
        "conv_id", "role", "turn", "text"
    )


_DATE_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN strftime(d, '%Y-%m-%d')
  WHEN '2-HIGH' THEN 'zzz' WHEN '3-MEDIUM' THEN '17.31.02' ELSE strftime(d, '%y.%d.%m') END"""


@query(
    "parse_trending_date",
    rf"""WITH dated AS (
      SELECT o_orderkey, o_orderpriority,
        CAST(o_orderdate AS DATE) + INTERVAL 20 YEAR AS d FROM orders),
    texts AS (SELECT o_orderkey, {_DATE_TEXT} AS trending_date FROM dated)
    SELECT o_orderkey, trending_date,
      CASE WHEN regexp_matches(trending_date, '^\d{{2}}\.\d{{2}}\.\d{{2}}$')
           THEN CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE)
           ELSE TRY_CAST(trending_date AS DATE) END AS trending_date_parsed
    FROM texts""",
)
def parse_trending_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 240)
    kind = F.col("o_orderpriority")
    written = (
        F.when(kind == "1-URGENT", dates.day_stamp(day))
        .when(kind == "2-HIGH", F.lit("zzz"))
        .when(kind == "3-MEDIUM", F.lit("17.31.02"))
        .otherwise(dates.trending_stamp(day))
    )
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", written.alias("trending_date")
    )
    return texts.withColumn(
        "trending_date_parsed", dates.parse_trending_date(F.col("trending_date"))
    )


@query(
    "safe_numeric_cast",
    """WITH texts AS (
      SELECT l_orderkey, l_linenumber,
        CASE l_linenumber WHEN 2 THEN 'x' || CAST(l_suppkey AS VARCHAR) WHEN 3 THEN ''
          WHEN 4 THEN NULL
          ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS views,
        CASE l_returnflag WHEN 'A' THEN 'TRUE' WHEN 'N' THEN 'false' ELSE '' END AS flag,
        CASE WHEN l_linenumber = 5 THEN 'Music' ELSE CAST(l_suppkey AS VARCHAR) END AS cat
      FROM lineitem)
    SELECT l_orderkey, l_linenumber,
      coalesce(CAST(trunc(TRY_CAST(views AS DOUBLE)) AS BIGINT), 0) AS views,
      CASE lower(flag) WHEN 'true' THEN true WHEN 'false' THEN false END AS flag,
      TRY_CAST(cat AS BIGINT) AS category_id
    FROM texts WHERE TRY_CAST(cat AS DOUBLE) IS NOT NULL""",
)
def safe_numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier = F.col("l_linenumber"), F.col("l_suppkey").cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    flag = F.col("l_returnflag")
    texts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 2, F.concat(F.lit("x"), supplier))
        .when(line == 3, F.lit(""))
        .when(line == 4, F.lit(None))
        .otherwise(price)
        .alias("views"),
        F.when(flag == "A", "TRUE").when(flag == "N", "false").otherwise("").alias("flag"),
        F.when(line == 5, F.lit("Music")).otherwise(supplier).alias("cat"),
    )
    numeric = texts.filter(casts.to_number(F.col("cat")).isNotNull())
    return numeric.select(
        "l_orderkey",
        "l_linenumber",
        casts.zero_if_null(casts.to_long(F.col("views"))).alias("views"),
        casts.to_flag(F.col("flag")).alias("flag"),
        casts.to_long(F.col("cat")).alias("category_id"),
    )


@query(
    "clean_text",
    f"""SELECT doc_id, {tidy_sql('text')} AS text, lower(trim(lang)) AS region
    FROM documents""",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.tidy_text(F.col("text")).alias("text"),
        text.normalize_region(F.upper(F.concat(F.lit(" "), "lang"))).alias("region"),
    )


@query("charset_fallback", "SELECT doc_id, text, n_chars FROM documents")
def charset_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    latin1 = F.col("text").rlike(r"^[\x00-\xff]*$")
    stored = F.when(latin1, F.encode("text", "ISO-8859-1")).otherwise(
        F.encode("text", "UTF-8")
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.decode_bytes(stored).alias("text"), "n_chars"
    )


@query(
    "region_filter",
    f"""WITH {FACTS} SELECT video_id, region, views FROM facts
    WHERE region IN ('asia', 'europe')""",
)
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts(spark, sf_dir, videos=False).createOrReplaceTempView("tidemark_statistics")
    return read_table(
        spark,
        "tidemark_statistics",
        columns=["video_id", "region", "views"],
        regions=["ASIA", "europe"],
    )


def _record(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("trending_date_parsed")
    return facts(spark, sf_dir).withColumns(
        {"date": dates.day_stamp(day), "stamp": dates.trending_stamp(day)}
    )


def _csv_shape(df: DataFrame) -> DataFrame:
    """Facts as the delivered CSV has them: everything is text."""
    s = {c: F.col(c).cast("string") for c in df.columns}
    return df.select(
        "video_id",
        F.col("stamp").alias("trending_date"),
        "title",
        "channel_title",
        s["category_id"].alias("category_id"),
        F.col("date").alias("publish_time"),
        F.concat_ws("|", "p_type", "p_brand").alias("tags"),
        *[s[c].alias(c) for c in ("views", "likes", "dislikes", "comment_count")],
        F.col("p_brand").alias("thumbnail_link"),
        F.lit("True").alias("comments_disabled"),
        F.lit("False").alias("ratings_disabled"),
        F.lit("").alias("video_error_or_removed"),
        F.col("p_type").alias("description"),
        "region",
    )


def _dotted_shape(df: DataFrame) -> DataFrame:
    s = {c: F.col(c).cast("string") for c in df.columns}
    return df.select(
        F.col("video_id").alias("id"),
        F.col("title").alias("snippet.title"),
        F.col("channel_title").alias("snippet.channelTitle"),
        s["category_id"].alias("snippet.categoryId"),
        F.col("date").alias("snippet.publishedAt"),
        F.array("p_type", "p_brand").alias("snippet.tags"),
        s["views"].alias("statistics.viewCount"),
        s["likes"].alias("statistics.likeCount"),
        s["dislikes"].alias("statistics.dislikeCount"),
        s["comment_count"].alias("statistics.commentCount"),
        F.col("p_brand").alias("snippet.thumbnails.default.url"),
        F.col("p_type").alias("snippet.description"),
        "region",
        "date",
    )


def _nested_shape(df: DataFrame) -> DataFrame:
    s = {c: F.col(c).cast("string") for c in df.columns}
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(
            F.col("title"),
            F.col("channel_title").alias("channelTitle"),
            s["category_id"].alias("categoryId"),
            F.col("date").alias("publishedAt"),
            F.col("p_type").alias("description"),
        ).alias("snippet"),
        F.struct(
            s["views"].alias("viewCount"),
            s["likes"].alias("likeCount"),
            s["comment_count"].alias("commentCount"),
        ).alias("statistics"),
    )
    return df.select(F.array(item).alias("items"), "region", "date")


@query(
    "normalize_shapes",
    f"""WITH {FACTS}, shaped AS (
      SELECT *, l_returnflag = 'A' AS csv, l_returnflag = 'R' AS nested FROM facts)
    SELECT video_id, strftime(trending_date_parsed, '%y.%d.%m') AS trending_date, title,
      channel_title, category_id,
      strftime(trending_date_parsed, '%Y-%m-%d') AS publish_time,
      CASE WHEN NOT nested THEN p_type || '|' || p_brand END AS tags, views, likes,
      CASE WHEN nested THEN 0 ELSE dislikes END AS dislikes, comment_count,
      CASE WHEN NOT nested THEN p_brand END AS thumbnail_link,
      csv AS comments_disabled, false AS ratings_disabled,
      CASE WHEN NOT csv THEN false END AS video_error_or_removed,
      p_type AS description, region
    FROM shaped""",
)
def normalize_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, flag = _record(spark, sf_dir), F.col("l_returnflag")
    return unify(
        _csv_shape(rows.filter(flag == "A")),
        _nested_shape(rows.filter(flag == "R")),
        _dotted_shape(rows.filter(~flag.isin("A", "R"))),
    ).drop(INGEST_ORDER)


@query(
    "bronze_to_silver",
    f"""WITH {FACTS}, cleaned AS (
      SELECT video_id, title, channel_title, category_id, region, l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE trending_date_parsed END AS day,
        CASE WHEN l_linenumber = 3 THEN 0 ELSE views END AS views,
        likes, dislikes, comment_count
      FROM facts WHERE l_linenumber <> 7),
    latest AS (
      SELECT *, row_number() OVER (PARTITION BY video_id, region, day
        ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn FROM cleaned)
    SELECT video_id, title, channel_title, category_id, region,
      day AS trending_date_parsed, views, likes, dislikes, comment_count,
      CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0.0 END AS like_ratio,
      CASE WHEN views > 0 THEN round((likes + dislikes + comment_count) / views * 100, 4)
           ELSE 0.0 END AS engagement_rate
    FROM latest WHERE rn = 1""",
)
def bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty CSV text in, Silver out: null keys, junk numbers and dates, duplicates."""
    rows = _record(spark, sf_dir)
    line = F.col("l_linenumber")
    order = F.concat(
        F.lpad(F.col("l_orderkey").cast("string"), 19, "0"), line.cast("string")
    )
    # Keeps the parsed year in the century that two-digit years are read in.
    stamp = F.when(F.col("l_returnflag") == "R", "17.31.02").otherwise(F.col("date"))
    dirty = rows.withColumns({"stamp": stamp, "order": order})
    csv = _csv_shape(dirty).columns
    bronze = dirty.withColumns(
        {
            "trending_date": F.col("stamp"),
            "publish_time": F.col("date"),
            "tags": F.col("p_type"),
            "thumbnail_link": F.col("p_brand"),
            "description": F.col("p_type"),
            "comments_disabled": F.lit("True"),
            "ratings_disabled": F.lit("False"),
            "video_error_or_removed": F.lit(""),
            "video_id": F.when(line != 7, F.col("video_id")),
            "views": F.when(line == 3, "n/a").otherwise(F.col("views").cast("string")),
            "region": F.concat(F.lit(" "), F.upper("region"), F.lit("\t")),
            "_ingestion_timestamp": F.col("order"),
        }
    ).select(*csv, "_ingestion_timestamp")
    return clean_statistics(bronze, job_name="registered").select(
        "video_id", "title", "channel_title", "category_id", "region",
        "trending_date_parsed", "views", "likes", "dislikes", "comment_count",
        "like_ratio", "engagement_rate",
    )


@query(
    "explode_items",
    """WITH parts AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS position,
        CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_items
      FROM documents)
    SELECT doc_id, CAST(position AS INTEGER) AS position, line, n_items FROM parts""",
)
def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a document as its items."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line")))
    documents = table(spark, sf_dir, "documents").select("doc_id", lines.alias("items"))
    counted = documents.withColumn(
        "n_items", text.item_count(F.col("items")).cast("bigint")
    )
    return explode_items(counted).select("doc_id", "position", "item.line", "n_items")


@query(
    "flatten_json",
    """SELECT event_id, event_type, user_id AS actor_user_id, value AS actor_value,
      CAST(props->>'k' AS BIGINT) AS props_k, CAST(NULL AS VARCHAR) AS props_unparsed
    FROM events""",
)
def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props", F.struct("user_id", "value").alias("actor")
    )
    found = json_columns(events, ["event_type", "props"])
    return flatten(events, infer_json_schemas(events, found))


@query(
    "path_region",
    """WITH keys AS (
      SELECT doc_id, source, CASE WHEN source = 'src0' THEN 'raw/' ELSE 'raw/region=' || lang || '/'
        END || source || '+file%20' || CAST(doc_id AS VARCHAR) || '.json' AS key
      FROM documents)
    SELECT doc_id, replace(replace(key, '+', ' '), '%20', ' ') AS source_file,
      CASE WHEN source = 'src0' THEN 'unknown'
           ELSE regexp_extract(key, 'region=([^/]*)', 1) END AS region
    FROM keys""",
)
def path_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.when(F.col("source") == "src0", F.lit("raw/")).otherwise(
        F.concat(F.lit("raw/region="), "lang", F.lit("/"))
    )
    key = F.concat(
        folder, "source", F.lit("+file%20"), F.col("doc_id").cast("string"), F.lit(".json")
    )
    named = table(spark, sf_dir, "documents").select(
        "doc_id", text.decode_key(key).alias("source_file")
    )
    return named.withColumn("region", text.region_from_path(F.col("source_file")))


@query(
    "stamped_sql_scan",
    """SELECT o_orderkey, timestamp '2024-05-06 07:08:09' AS processed_at, 'nightly' AS job_name,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ordered_at,
      CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS settled
    FROM orders""",
)
def stamped_sql_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an SQL scan with run stamps of a given clock, ISO times and strictly read flags."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_scan")
    scanned = query_table(
        spark,
        """SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'TRUE'
           WHEN 'O' THEN 'false' ELSE 'yes' END AS flag FROM orders_scan""",
    )
    stamped = stamp_run(scanned, "nightly", F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))
    return stamped.select(
        "o_orderkey",
        F.col("_processed_at").alias("processed_at"),
        F.col("_job_name").alias("job_name"),
        F.substring(dates.iso_stamp(F.col("o_orderdate")), 1, 19).alias("ordered_at"),
        casts.text_flag(F.col("flag")).alias("settled"),
    )


@query(
    "flatten_nested_json",
    """SELECT o_orderkey, o_orderstatus AS payload_status, o_totalprice AS payload_price,
      CASE WHEN o_custkey % 5 <> 0 THEN c_name END AS payload_customer_name,
      CASE WHEN o_custkey % 5 <> 0 THEN c_mktsegment END AS payload_customer_place_segment,
      CASE WHEN o_custkey % 5 <> 0 THEN n_name END AS payload_customer_place_nation,
      CASE WHEN o_custkey % 5 = 0 THEN 'unknown' END AS payload_customer_unparsed,
      o_custkey AS payload_by_key
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def flatten_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text in JSON text in JSON text, some of it none, and an object whose keys are data."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    place = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation")))
    buyer = F.to_json(F.struct(F.col("c_name").alias("name"), place.alias("place")))
    payload = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_custkey") % 5 == 0, "unknown").otherwise(buyer).alias("customer"),
        F.create_map(F.concat(F.lit("c"), "o_custkey"), F.col("o_custkey")).alias("by"),
    )
    flat = flatten_all(rows.select("o_orderkey", F.to_json(payload).alias("payload")), maps=["payload_by"])
    by_key = F.map_values(F.col("payload_by").cast("map<string,bigint>"))[0]
    return flat.withColumns(
        {"payload_price": F.col("payload_price").cast("double"), "payload_by_key": by_key}
    ).drop("payload_by", "payload_unparsed", "payload_customer_place_unparsed")
