"""Per-creator feature tables.

Each builder runs the ordered part (gaps, first/last uploads) through the
skew-safe ``sequence`` primitive and then one ``groupBy(entity)`` with partial
aggregation, so a creator with a third of all uploads is still split over many
tasks. Dimension attributes are joined last, onto one row per creator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.operators.gaps import with_gaps, with_group_mean
from reachlens.operators.sequence import sequence, with_group_count
from reachlens.session import materialize


def creator_features(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                     ts: str = "publish_time", event_id: str = "video_id") -> DataFrame:
    """Creator feature view (A25): upload stats, gap consistency, breakout
    ratio and view/subscriber ratio, inner-joined onto the creators."""
    g = with_gaps(videos, entity, ts, event_id, keep=["views", "likes", "comment_count"])
    g = with_group_mean(g, entity, "views", "_mean_views")
    stats = g.groupBy(entity).agg(
        F.count(F.lit(1)).alias("total_videos"),
        F.avg("views").alias("avg_views"),
        F.avg(C.engagement_rate_positive_only()).alias("avg_engagement_rate"),
        F.stddev_samp("gap_days").alias("consistency_score_raw"),
        F.avg("gap_days").alias("avg_upload_gap_days"),
        (F.sum(F.when(F.col("views") > 2 * F.col("_mean_views"), 1).otherwise(0)).cast("double")
         / F.count(F.lit(1))).alias("breakout_ratio"),
    )
    ch = channels.select(entity, "channel_name", "category", "country", "subscribers",
                         "total_views", "avg_weekly_uploads", "created_year", "created_month")
    j = ch.join(stats, entity)
    return j.select(
        entity, "channel_name", "category", "country", "subscribers", "total_views",
        "avg_weekly_uploads", "total_videos", "avg_views", "avg_engagement_rate",
        "consistency_score_raw", "avg_upload_gap_days", "breakout_ratio",
        C.consistency_positive("consistency_score_raw").alias("consistency_score"),
        C.safe_ratio("avg_views", "subscribers").alias("view_sub_ratio"),
        "created_year", "created_month")


def one_hot_drop_first(df: DataFrame, col: str, prefix: str | None = None,
                       levels: list[str] | None = None) -> DataFrame:
    """Dummy columns ``<col>_<level>`` (1.0/0.0) for every level except the
    alphabetically first; NULL -> all zeros; the source column is dropped.
    Without ``levels`` they are those of the data; with them (a fitted model's),
    any other level is an error.

    The level list is the only thing brought to the driver (one value per
    distinct level, a small dimension). Rows whose levels are looked up are
    stored first, so that they are computed once."""
    prefix = prefix or col
    if levels is None:
        df = materialize(df, "levels")
        levels = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())
    else:
        unknown = F.raise_error(F.concat(F.lit(f"unknown level of {col}: "), F.col(col).cast("string"))).cast(df.schema[col].dataType)
        df = df.withColumn(col, F.when(F.col(col).isNull() | F.col(col).isin(levels), F.col(col)).otherwise(unknown))
    dummies = [F.when(F.col(col) == lv, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{prefix}_{lv}")
               for lv in levels[1:]]
    return df.select(*[c for c in df.columns if c != col], *dummies)


def regression_features(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                        ts: str = "publish_time", event_id: str = "video_id",
                        levels: list[str] | None = None) -> DataFrame:
    """Growth-regression features (M1): upload stats (engagement 0 on zero
    views), gap mean and the floored consistency score (std 0/NULL -> 0.01),
    growth_rate = log1p(avg_views / subscribers(0/NULL->1) * consistency(NULL->1)),
    category dummies. The declared and observed upload counts are kept apart."""
    v_stats = videos.groupBy(entity).agg(
        F.avg(C.engagement_rate_or_zero()).alias("avg_engagement"),
        F.avg("views").alias("avg_views"),
        F.count(event_id).alias("total_videos_observed"),
        F.avg("duration_seconds").alias("avg_duration"))
    g = with_gaps(videos, entity, ts, event_id)
    gap = g.groupBy(entity).agg(F.avg("gap_days").alias("avg_gap"),
                                F.stddev_samp("gap_days").alias("_std"))
    gap = gap.select(entity, "avg_gap", C.consistency_floor("_std").alias("consistency_score"))
    feat = channels.withColumnRenamed("total_videos", "total_videos_declared") \
        .join(v_stats, entity, "left").join(gap, entity, "left")
    subs = F.coalesce(F.nullif(F.col("subscribers").cast("double"), F.lit(0.0)), F.lit(1.0))
    growth = F.log1p(F.coalesce(F.col("avg_views"), F.lit(0.0)) / subs
                     * F.coalesce(F.col("consistency_score"), F.lit(1.0)))
    feat = feat.withColumn("growth_rate", growth).where(F.col("growth_rate").isNotNull())
    return one_hot_drop_first(feat, "category", levels=levels)


def cluster_features(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                     ts: str = "publish_time", event_id: str = "video_id") -> DataFrame:
    """Segmentation features (M6); every missing value becomes 0."""
    v_stats = videos.groupBy(entity).agg(
        F.avg(C.engagement_rate_or_zero()).alias("avg_engagement"),
        F.avg("views").alias("avg_views"),
        F.count(event_id).alias("total_videos"),
        F.stddev_samp("views").alias("std_views"))
    g = with_gaps(videos, entity, ts, event_id)
    gap = g.groupBy(entity).agg(F.stddev_samp("gap_days").alias("gap_std"))
    feat = channels.select(entity, "subscribers", "avg_weekly_uploads") \
        .join(v_stats, entity, "left").join(gap, entity, "left")
    feat = feat.withColumn("upload_x_engagement",
                           F.coalesce("avg_weekly_uploads", F.lit(0.0)) * F.coalesce("avg_engagement", F.lit(0.0)))
    feat = feat.withColumn("sub_growth_proxy", F.try_divide(
        F.log1p(F.coalesce(F.col("avg_views"), F.lit(0.0))),
        F.log1p(F.coalesce(F.col("subscribers").cast("double"), F.lit(1.0)))))
    return feat.select(entity, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in feat.columns if c != entity])


def video_features(channels: DataFrame, videos: DataFrame, entity: str = "channel_id",
                   ts: str = "publish_time", event_id: str = "video_id") -> DataFrame:
    """Pre-publish features per upload (M10): creator size and cadence, mean
    views of the creator's *earlier* uploads, whole days since the previous
    upload, hour, weekday (Monday=0), title length, duration; target
    log1p(views). Rows with any missing feature (every first upload) are
    dropped."""
    v = videos.select(entity, event_id, ts, "views", "title", "duration_seconds") \
        .withColumn("_t", C.epoch_micros(ts))
    s = sequence(v, entity, ["_t", event_id], lags=["_t"], cums=["views"])
    hist = F.when(F.col("seq") > 1, (F.col("cum_views") - F.col("views")) / (F.col("seq") - 1))
    days = F.floor((F.col("_t") - F.col("prev__t")) / F.lit(C.MICROS_PER_DAY)).cast("long")
    s = s.select(entity, event_id, ts, "views", "title", "duration_seconds",
                 hist.alias("hist_avg_views"), days.alias("days_since_last"))
    j = s.join(channels.select(entity, "subscribers", "avg_weekly_uploads"), entity)
    feats = ["subscribers", "avg_weekly_uploads", "hist_avg_views", "days_since_last",
             "publish_hour", "publish_dow", "title_len", "duration_seconds"]
    out = j.select(
        "subscribers", "avg_weekly_uploads", "hist_avg_views", "days_since_last",
        F.hour(ts).alias("publish_hour"), C.weekday_monday0(ts).alias("publish_dow"),
        C.text_length("title").alias("title_len"), "duration_seconds",
        F.log1p("views").alias("log_views"), entity, event_id)
    return out.dropna(subset=feats + ["log_views"])


def churn_features(channels: DataFrame, videos: DataFrame, inactivity_days: int = 90,
                   entity: str = "channel_id", ts: str = "publish_time", event_id: str = "video_id",
                   levels: list[str] | None = None, one_hot: bool = True) -> DataFrame:
    """Churn features per creator (M17): upload count, mean whole-day gap,
    gap_trend (mean of last 3 gaps - first 3, 0 with fewer than 6 gaps),
    engagement_trend and view_trend (last 5 vs first 5 uploads), whole days
    since the last upload relative to the latest upload overall, and
    churned = silent for >= ``inactivity_days``; creator attributes joined,
    category one-hot encoded."""
    g = with_gaps(videos, entity, ts, event_id, keep=["views", "likes", "comment_count"])
    g = with_group_count(g, entity, "_n")
    eng = C.engagement_rate_or_zero()
    gap_idx = F.col("seq") - 1          # 1-based index of the gap ending at this upload
    n_gaps = F.col("_n") - 1
    first5 = F.col("seq") <= 5
    last5 = F.col("seq") > F.col("_n") - 5
    per = g.groupBy(entity).agg(
        F.count(F.lit(1)).alias("total_videos"),
        F.avg("gap_whole_days").alias("avg_gap"),
        F.avg(F.when((gap_idx >= 1) & (gap_idx > n_gaps - 3), F.col("gap_whole_days"))).alias("_g_last"),
        F.avg(F.when((gap_idx >= 1) & (gap_idx <= 3), F.col("gap_whole_days"))).alias("_g_first"),
        F.max(n_gaps).alias("_ngaps"),
        F.avg(F.when(last5, eng)).alias("_e_last"), F.avg(F.when(first5, eng)).alias("_e_first"),
        F.avg(F.when(last5, F.col("views"))).alias("_v_last"),
        F.avg(F.when(first5, F.col("views"))).alias("_v_first"),
        F.max(ts).alias("_last"))
    now = videos.agg(F.max(ts).alias("_now"))
    per = per.crossJoin(F.broadcast(now))
    silent = C.whole_days("_last", "_now")
    per = per.select(
        entity, "total_videos", "avg_gap",
        F.when(F.col("_ngaps") >= 6, F.col("_g_last") - F.col("_g_first")).otherwise(F.lit(0.0)).alias("gap_trend"),
        (F.col("_e_last") - F.col("_e_first")).alias("engagement_trend"),
        ((F.col("_v_last") - F.col("_v_first")) / (F.col("_v_first") + 1)).alias("view_trend"),
        silent.alias("days_since_last"),
        (silent >= inactivity_days).cast("int").alias("churned"))
    feat = per.join(channels.select(entity, "subscribers", "avg_weekly_uploads", "category"), entity, "left")
    return one_hot_drop_first(feat, "category", levels=levels) if one_hot else feat
