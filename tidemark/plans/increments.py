"""Silver and Gold by what has arrived: bookmarked loads, and marts of the touched partitions only.

Gold keeps two things between runs. The daily grain (region, day, channel, category) has every measure as
a sum or a bound, so totals of any span of days come from it. Distinct videos of a channel cannot be
added up over days; they are kept as bitmaps of 64 dense video numbers each, by channel and Silver
partition, which an OR combines exactly. A run reads from Silver the partitions that were replaced since
its last time, and puts their grain and bitmaps in place of the old ones. Daily marts are then made for
these partitions; the channel mart for their regions, from grain and bitmaps.

Checks on Silver work alike: counters of each partition are kept, and added up for the whole.

Silver's ledger says what is new: runs that Gold has not used yet. They count as used when all Gold tables
are in place, and each of these is replaced by a run named after them, so a run that died is repeated
without harm.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import marts, quality
from ..operators.enrich import attach_category_names, category_lookup
from ..operators.reference import ReferenceLoad
from ..session import sized_shuffles, stage, staging
from ..sources import versions, writers
from ..sources.catalog import read_optional
from ..streaming import incremental
from ..streaming.incremental import PIECE, dealt_out, in_touched_partitions, ingest_into_table, pieces_of
from .medallion import Layers
from .silver import clean_statistics, run_reference_load

CONSUMER = "gold"
DAY = ["region", "trending_date_parsed"]
GRAIN, NUMBERS, BITMAPS, PROFILE = "daily_grain", "video_numbers", "channel_videos", "quality_profile"


def _same(df: DataFrame) -> DataFrame:
    return df


def _dealt_grain(
    changed: DataFrame, sizes: DataFrame, cols: Sequence[str], dealt: Callable[[DataFrame, Sequence[str]], DataFrame]
) -> DataFrame:
    """The daily grain, dealt out as it is written.

    Grain rows are about as many as rows of Silver, so these are shuffled once, to where their grain is written.
    A day of very many rows is aggregated before it is dealt out, as all of them can be of one channel and category.
    """
    others, at = [c for c in cols if c not in marts.DAILY_GRAIN], list(dict.fromkeys([*cols, *DAY]))
    large = sizes.filter(F.col("rows") > incremental.FREQUENT_ROWS).select(*at)
    if large.isEmpty():
        return marts.daily_grain(dealt(changed, marts.DAILY_GRAIN), *others, PIECE).drop(PIECE)
    rest = dealt(incremental.beside(changed, large, at, "left_anti"), marts.DAILY_GRAIN)
    before = marts.daily_grain(incremental.beside(changed, large, at, "left_semi"), *others)
    return marts.daily_grain(rest, *others, PIECE).unionByName(dealt(before, marts.DAILY_GRAIN)).drop(PIECE)


def refresh_gold(
    spark: SparkSession,
    silver: str,
    table_of: Callable[[str], str],
    reference: DataFrame | None,
    *,
    partitioned: Callable[[DataFrame], DataFrame] = _same,
    renamed: bool = False,
    as_of: Column | None = None,
) -> list[str]:
    """Bring Gold up to Silver's runs; returns those that were new.

    ``partitioned`` adds Silver's partition columns to rows of region and day, where Silver has others
    than these two. ``renamed`` makes the marts with category names anew for all that is stored.
    """
    runs = versions.open_runs(spark, silver, CONSUMER)
    if not runs and not renamed:
        return []
    run_id = sha256("\n".join([*runs, silver]).encode()).hexdigest()[:32]
    if renamed:
        run_id += uuid4().hex[:8]
    cols = versions.partition_columns(spark, silver)
    lookup = None if reference is None else category_lookup(reference)

    def put(name: str, rows: DataFrame, by: Sequence[str] = tuple(cols), spread: bool = True) -> DataFrame:
        versions.replace_partitions(spark, table_of(name), lambda: rows, rows.schema, by, run_id=run_id, spread=spread)
        return spark.table(table_of(name))

    with staging(spark), sized_shuffles(spark) as size:
        touched = stage(versions.partitions_of(spark, silver, runs, cols), "touched")
        changed = in_touched_partitions(spark.table(silver), touched, cols)
        sizes = stage(changed.groupBy(*dict.fromkeys([*cols, *DAY])).agg(F.count("*").alias("rows")), "sizes")
        pieces, total = pieces_of(sizes, cols)
        size(total)

        def dealt(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
            return dealt_out(rows, pieces, total, cols, keys)

        grain = put(GRAIN, partitioned(_dealt_grain(changed, sizes, cols, dealt)), spread=False)
        known = spark.table(table_of(NUMBERS)) if spark.catalog.tableExists(table_of(NUMBERS)) else None
        new = marts.new_videos(changed, known).withColumn("run", F.lit(run_id))
        numbers = put(NUMBERS, new, ("region", "run"))
        in_regions = in_touched_partitions(numbers, touched, ["region"])
        bitmaps = put(BITMAPS, marts.video_bitmaps(changed, in_regions, cols, dealt=dealt), spread=False)

        fresh = in_touched_partitions(grain, touched, cols)
        by_category = stage(marts.category_days(fresh), "category-days")
        days = marts.trending_from_categories(by_category, marts.daily_channels(fresh))
        put("trending_analytics", marts.stamp_aggregation(partitioned(days), as_of))
        if isinstance(fresh.schema["category_id"].dataType, T.IntegralType):
            rows = marts.category_days(grain) if renamed else by_category
            shares = marts.category_from_categories(rows, lookup)
        else:
            shares = marts.category_from_grain(attach_category_names(grain if renamed else fresh, lookup))
        put("category_analytics", marts.stamp_aggregation(partitioned(shares), as_of))

        def of_regions(df: DataFrame) -> DataFrame:
            return df if renamed else in_touched_partitions(df, touched.select("region").distinct(), ["region"])

        by_category = attach_category_names(marts.channel_categories(of_regions(grain)), lookup)
        totals = marts.channel_from_categories(by_category, marts.distinct_videos(of_regions(bitmaps)))
        put("channel_analytics", marts.stamp_aggregation(marts.ranked_channels(totals), as_of), ("region",))
    versions.mark_used(spark, silver, CONSUMER, runs)
    return runs


def refresh_profile(
    spark: SparkSession,
    silver: str,
    profile: str,
    *,
    thresholds: quality.Thresholds | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Check rows on all of Silver, from counters of its partitions that are kept in the table ``profile``.

    Only partitions that were replaced since the last time are read. Counters hold for the thresholds
    they were made with: use another table for others.
    """
    t = thresholds or quality.Thresholds()
    runs, cols = versions.open_runs(spark, silver, profile), versions.partition_columns(spark, silver)
    stats = spark.table(silver)
    measures = quality.profile_measures(stats, quality.STATISTICS, t)
    if runs:
        touched = versions.partitions_of(spark, silver, runs, cols)
        # Partition columns go by names of their own, as they can be among the columns that are counted.
        parts = {c: f"part_{c}" for c in cols}
        changed = in_touched_partitions(stats, touched, cols).withColumns({p: F.col(c) for c, p in parts.items()})
        counted = changed.groupBy(*parts.values()).agg(*measures)
        run_id = sha256("\n".join([*runs, silver]).encode()).hexdigest()[:32]
        versions.replace_partitions(spark, profile, lambda: counted, counted.schema, list(parts.values()), run_id=run_id)
        versions.mark_used(spark, silver, profile, runs)
    names = [c for c in spark.table(profile).columns if not c.startswith("part_")]
    merged = quality.merged_profile(spark.table(profile), names)
    return quality.checks_of_profile(merged, stats, quality.STATISTICS, thresholds=t, as_of=as_of)


def run_incremental(
    spark: SparkSession,
    streams: Sequence[DataFrame],
    reference: ReferenceLoad | None,
    layers: Layers,
    *,
    checkpoint: str,
    job_name: str,
    as_of: Column | None = None,
) -> tuple[list[str], bool, list[str]]:
    """Load what has arrived in the file streams of Bronze, check Silver, and bring Gold up to it.

    Returns the runs that went into Silver, whether all checks passed, and the runs that Gold took.
    ``checkpoint`` holds the bookmark of each stream, in the order given. Runs that a failing check
    keeps from Gold are taken by the next run that passes.
    """
    for db in (layers.silver_db, layers.gold_db):
        writers.create_database(spark, db)
    stats, ref = layers.silver(layers.statistics), layers.silver(layers.reference)

    def clean(batch: DataFrame) -> DataFrame:
        return clean_statistics(batch, job_name=job_name, as_of=as_of)

    loaded: list[str] = []
    for i, stream in enumerate(streams):
        loaded += ingest_into_table(
            stream, stats, f"{checkpoint}/statistics-{i}", clean,
            partition_cols=layers.partition_cols, path=layers.path("silver", layers.statistics),
        )
    how = {"thresholds": layers.thresholds, "as_of": as_of}
    if spark.catalog.tableExists(stats):
        results = refresh_profile(spark, stats, layers.silver(PROFILE), **how)
    else:
        results = quality.unreadable(spark, quality.STATISTICS, "no such table")
    if reference is not None:
        run_reference_load(reference, table=ref, path=layers.path("silver", layers.reference))
        results = results.unionByName(quality.check_tables(spark, {quality.REFERENCE: ref}, **how))
    stored = layers.silver(layers.results)
    writers.write_table(results, stored, path=layers.path("silver", layers.results), partition_cols=(), mode="overwrite")
    passed = quality.quality_passed(spark.table(stored))
    if not passed:
        return loaded, passed, []
    names = read_optional(spark, ref)
    built = refresh_gold(spark, stats, layers.gold, names, renamed=reference is not None, as_of=as_of)
    return loaded, passed, built
