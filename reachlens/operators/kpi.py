"""Creator- and platform-side KPIs.

All aggregates are ``groupBy`` with partial (map-side) aggregation; exact
medians go through the skew-safe ``exact_percentiles``; values pushed back to
rows are pre-aggregated and joined. One-row results are plain global
aggregates, never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.operators.gaps import with_gaps, with_group_mean
from reachlens.operators.quantiles import exact_percentiles
from reachlens.session import materialize

DEFAULT_RETENTION_DAYS = (30, 90, 180)


# A1 --------------------------------------------------------------------------
def uploads_by_category(channels: DataFrame, category: str = "category",
                        uploads: str = "avg_weekly_uploads", size: str = "subscribers") -> DataFrame:
    """Median uploads/week, creator count and total size per category,
    highest median first."""
    med = exact_percentiles(channels, [category], uploads, [0.5], ["median_uploads_per_week"])
    cnt = channels.groupBy(category).agg(F.count(F.lit(1)).alias("channel_count"),
                                         F.sum(size).alias("total_subscribers"))
    med = med.withColumnRenamed(category, "_category")
    return cnt.join(med, cnt[category].eqNullSafe(med["_category"]), "left") \
        .select(category, "median_uploads_per_week", "channel_count", "total_subscribers") \
        .orderBy(F.desc("median_uploads_per_week"), category)


# A2 --------------------------------------------------------------------------
def entity_stats(videos: DataFrame, entity: str = "channel_id", measure: str = "views",
                 event_id: str = "video_id") -> DataFrame:
    """Mean/std of views and engagement (0 on zero views), mean duration, count."""
    eng = C.engagement_rate_or_zero(views=measure)
    return videos.groupBy(entity).agg(
        F.avg(measure).alias("mean_views"),
        F.stddev_samp(measure).alias("std_views"),
        F.avg(eng).alias("mean_engagement"),
        F.stddev_samp(eng).alias("std_engagement"),
        F.avg("duration_seconds").alias("mean_duration"),
        F.count(event_id).alias("video_count"))


# A3 --------------------------------------------------------------------------
def consistency_score(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
                      event_id: str = "video_id") -> DataFrame:
    """Mean and sample std of fractional-day upload gaps; score = 1/std
    (NULL when the std is 0 or undefined)."""
    g = with_gaps(videos, entity, ts, event_id)
    s = g.groupBy(entity).agg(F.avg("gap_days").alias("avg_gap_days"),
                              F.stddev_samp("gap_days").alias("std_gap_days"))
    return s.withColumn("consistency_score", C.consistency_null_on_zero("std_gap_days"))


# A4 --------------------------------------------------------------------------
def breakout_ratio(videos: DataFrame, entity: str = "channel_id", measure: str = "views") -> DataFrame:
    """Share of an entity's uploads with more than twice its mean views."""
    j = with_group_mean(videos.select(entity, measure), entity, measure, "_mean")
    return j.groupBy(entity).agg(
        F.avg((F.col(measure) > 2 * F.col("_mean")).cast("int")).alias("breakout_ratio"))


# A5 --------------------------------------------------------------------------
def view_sub_ratio(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                   measure: str = "views", size: str = "subscribers") -> DataFrame:
    """Mean views per upload / size, over the union of keys of both sides
    (NULL where a side is missing or the size is 0)."""
    avg_v = videos.groupBy(entity).agg(F.avg(measure).alias("_avg"))
    subs = channels.select(entity, size)
    j = avg_v.join(subs, entity, "full")
    return j.select(entity, F.try_divide(F.col("_avg"), F.nullif(F.col(size).cast("double"), F.lit(0.0)))
                    .alias("view_sub_ratio"))


# A6 --------------------------------------------------------------------------
def creator_retention(videos: DataFrame, thresholds: Sequence[int] = DEFAULT_RETENTION_DAYS,
                      entity: str = "channel_id", ts: str = "publish_time") -> DataFrame:
    """First/last upload, whole active days and a retained_d<N> flag per threshold."""
    s = videos.groupBy(entity).agg(F.min(ts).alias("first_upload"), F.max(ts).alias("last_upload"))
    s = s.withColumn("active_days", C.whole_days("first_upload", "last_upload"))
    for t in thresholds:
        s = s.withColumn(f"retained_d{t}", F.col("active_days") >= t)
    return s


def retention_rates(retention: DataFrame, thresholds: Sequence[int] = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """One row: percentage of entities retained at each threshold."""
    return retention.agg(*[(F.avg(F.col(f"retained_d{t}").cast("double")) * 100)
                         .alias(f"d{t}_retention_pct") for t in thresholds])


# A7 --------------------------------------------------------------------------
def uploads_in_first_days(videos: DataFrame, window_days: int = 30, entity: str = "channel_id",
                          ts: str = "publish_time") -> DataFrame:
    """Per entity: first upload and the number of uploads within
    ``window_days`` of it (inclusive)."""
    first = videos.groupBy(entity).agg(F.min(ts).alias("first_upload")).checkpoint()  # stored: the join can split a hot entity
    j = videos.select(entity, ts).join(first, entity)
    return j.groupBy(entity, "first_upload").agg(
        F.count_if(F.col(ts) <= C.plus_days("first_upload", window_days)).alias("early_uploads"))


def activation_rate(videos: DataFrame, min_videos: int = 5, window_days: int = 30,
                    entity: str = "channel_id", ts: str = "publish_time") -> DataFrame:
    """One row: % of entities with at least ``min_videos`` uploads in their
    first ``window_days`` days."""
    e = uploads_in_first_days(videos, window_days, entity, ts)
    return e.agg((F.avg((F.col("early_uploads") >= min_videos).cast("double")) * 100)
                 .alias("activation_rate_pct"))


# A8 --------------------------------------------------------------------------
def hhi(channels: DataFrame, col: str = "category") -> DataFrame:
    """One row: Herfindahl-Hirschman index of the category shares (NULL
    categories excluded), on a 0-10 000 scale."""
    counts = channels.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    tot = counts.agg(F.sum(F.col("_n") * F.col("_n")).cast("double").alias("_sq"),
                     F.sum("_n").cast("double").alias("_t"))
    return tot.select((F.try_divide(F.col("_sq"), F.col("_t") * F.col("_t")) * 10_000).alias("hhi"))


# A9 --------------------------------------------------------------------------
def trending_accessibility(trending: DataFrame, channels: DataFrame, small_threshold: int = 100_000,
                           entity: str = "channel_id", size: str = "subscribers") -> DataFrame:
    """One row: % of trending rows whose creator is smaller than the
    threshold; rows with an unknown creator count in the denominator only."""
    j = trending.select(entity).join(channels.select(entity, size), entity, "left")
    return j.agg((F.try_divide(F.count_if(F.col(size) < small_threshold), F.count(F.lit(1))) * 100)
                 .alias("small_creator_trending_pct"))


# A13 / A14 -------------------------------------------------------------------
def tier_engagement(videos: DataFrame, channels: DataFrame, entity: str = "channel_id",
                    size: str = "subscribers", median: bool = True) -> DataFrame:
    """Upload-level engagement (NULL on zero views) by right-closed size tier:
    mean, median (unless left out), count of non-NULL rates; every tier is listed."""
    v = videos.select(entity, C.engagement_rate().alias("engagement_rate"))
    j = v.join(channels.select(entity, size), entity, "left") \
        .select(C.size_tier(size).alias("tier"), "engagement_rate").where(F.col("tier").isNotNull())
    if median:
        j = materialize(j, "tier-engagement")  # two columns, read by the mean and the median
    agg = j.groupBy("tier").agg(F.avg("engagement_rate").alias("mean_engagement"),
                                F.count("engagement_rate").alias("video_count"))
    spine = videos.sparkSession.createDataFrame(
        [(lab, i) for i, lab in enumerate(C.TIER_LABELS)], "tier string, tier_order int")
    out = spine.join(agg, "tier", "left")
    if median:
        out = out.join(exact_percentiles(j, ["tier"], "engagement_rate", [0.5], ["median_engagement"]), "tier", "left")
    return out.select("tier", "tier_order", "mean_engagement", *["median_engagement"][:median],
                      F.coalesce("video_count", F.lit(0).cast("long")).alias("video_count")) \
        .orderBy("tier_order")


def tier_engagement_by_creator(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                               size: str = "subscribers", digits: int | None = 4) -> DataFrame:
    """Creator-level engagement (ratio of sums, 0 without views) averaged per
    left-closed size tier; creators without uploads are dropped; ordered by the
    smallest creator in the tier."""
    per = videos.groupBy(entity).agg(F.sum("views").alias("_v"),
                                     F.sum(F.col("likes") + F.col("comment_count")).alias("_lc"))
    per = per.select(entity, F.when(F.col("_v") > 0, F.col("_lc").cast("double") / F.col("_v"))
                     .otherwise(F.lit(0.0)).alias("engagement_rate"))
    j = channels.select(entity, size).join(per, entity)
    avg = F.avg("engagement_rate")
    g = j.groupBy(C.size_tier_sql(size).alias("tier")).agg(
        F.count(F.lit(1)).alias("channel_count"),
        (F.round(avg, digits) if digits is not None else avg).alias("avg_engagement_rate"),
        F.min(size).alias("_min"))
    return g.orderBy("_min").select("tier", "channel_count", "avg_engagement_rate")


# A15 / A16 -------------------------------------------------------------------
def new_entry_rate(channels: DataFrame, as_of_year: int, lookback_years: int = 2,
                   min_channels: int = 10, category: str = "category",
                   created_year: str = "created_year") -> DataFrame:
    """Per category: creators created in the last ``lookback_years`` years, all
    creators and the percentage (1 decimal); categories under ``min_channels``
    are dropped."""
    new = F.count_if(F.col(created_year) >= as_of_year - lookback_years)
    g = channels.groupBy(category).agg(new.alias("new_channels"),
                                       F.count(F.lit(1)).alias("total_channels"))
    g = g.where(F.col("total_channels") >= min_channels)
    return g.withColumn("new_entry_pct",
                        F.round(F.try_divide(100.0 * F.col("new_channels"),
                                             F.nullif(F.col("total_channels"), F.lit(0))), 1)) \
        .orderBy(F.desc("new_entry_pct"), category)


def geo_distribution(channels: DataFrame, top: int = 20, country: str = "country",
                     size: str = "subscribers") -> DataFrame:
    """Top countries by total size: creator count, total and mean size."""
    g = channels.where(F.col(size).isNotNull()).groupBy(country).agg(
        F.count(F.lit(1)).alias("channel_count"), F.sum(size).alias("total_subscribers"),
        F.avg(size).alias("avg_subscribers"))
    return g.orderBy(F.desc("total_subscribers"), country).limit(top)


# A24 / W3 --------------------------------------------------------------------
def daily_rollup(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time") -> DataFrame:
    """channel_daily_metrics derived from uploads: per entity and day the
    views, uploads and mean engagement (0 on zero views)."""
    return videos.groupBy(entity, F.to_date(ts).alias("metric_date")).agg(
        F.sum("views").alias("views_day"),
        F.count(F.lit(1)).alias("videos_published"),
        F.avg(C.engagement_rate_or_zero()).alias("avg_engagement"))


def growth_velocity(daily: DataFrame, window_days: int = 30, value: str = "subs_day",
                    entity: str = "channel_id", date: str = "metric_date",
                    calendar: bool = False) -> DataFrame:
    """Rolling sum of ``value`` over the last ``window_days`` rows per entity
    (``calendar=True``: the last ``window_days`` calendar days).

    The input has one row per entity and day, so a window partition holds at
    most one row per day of history: its size is bounded by the time span,
    not by the data volume.
    """
    if calendar:
        day_no = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
        w = Window.partitionBy(entity).orderBy(day_no).rangeBetween(-(window_days - 1), 0)
    else:
        w = Window.partitionBy(entity).orderBy(date).rowsBetween(-(window_days - 1), 0)
    return daily.select(entity, date, F.sum(value).over(w).alias(f"growth_velocity_{window_days}d"))


# A12 -------------------------------------------------------------------------
def full_kpi_report(channels: DataFrame, videos: DataFrame, as_of_retention=DEFAULT_RETENTION_DAYS,
                    min_videos: int = 5, window_days: int = 30) -> DataFrame:
    """The KPI report as a long (metric, key, value) frame: counts, median
    engagement, Gini of total views, category HHI, activation, retention and
    mean engagement per size tier. Scalars are rounded like the report."""
    from reachlens.operators.concentration import gini

    def scalar(df: DataFrame, col: str, metric: str, digits: int | None = None) -> DataFrame:
        v = F.col(col).cast("double")
        if digits is not None:
            v = F.bround(v, digits)
        return df.select(F.lit(metric).alias("metric"), F.lit(None).cast("string").alias("key"),
                         v.alias("value"))

    n_ch = channels.agg(F.count(F.lit(1)).alias("n"))
    n_v = videos.agg(F.count(F.lit(1)).alias("n"))
    med = exact_percentiles(videos.select(C.engagement_rate().alias("er")), [], "er", [0.5], ["m"])
    g = gini(channels.select(F.coalesce(F.col("total_views"), F.lit(0)).alias("total_views")),
             "total_views")
    h = hhi(channels, "category")
    act = activation_rate(videos, min_videos, window_days)
    ret = retention_rates(creator_retention(videos, as_of_retention), as_of_retention)
    ret_long = ret.select(F.explode(F.array(*[
        F.struct(F.lit(f"d{t}_retention_pct").alias("key"), F.col(f"d{t}_retention_pct").alias("value"))
        for t in as_of_retention])).alias("kv")).select(
        F.lit("retention_rates").alias("metric"), F.col("kv.key").alias("key"), F.col("kv.value").alias("value"))
    tiers = tier_engagement(videos, channels, median=False).select(
        F.lit("tier_engagement").alias("metric"), F.col("tier").alias("key"),
        F.col("mean_engagement").alias("value"))
    parts = [scalar(n_ch, "n", "total_channels"), scalar(n_v, "n", "total_videos"),
             scalar(med, "m", "median_engagement_rate"), scalar(g, "gini", "gini_coefficient", 4),
             scalar(h, "hhi", "hhi_categories", 1), scalar(act, "activation_rate_pct", "activation_rate_pct", 2),
             ret_long, tiers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

