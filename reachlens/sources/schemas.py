"""Table contracts (S10) and a validator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANNELS = T.StructType([
    T.StructField("channel_id", T.StringType(), False),
    T.StructField("channel_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("subscribers", T.LongType()),
    T.StructField("total_views", T.LongType()),
    T.StructField("total_videos", T.IntegerType()),
    T.StructField("avg_weekly_uploads", T.DoubleType()),
    T.StructField("created_year", T.IntegerType()),
    T.StructField("created_month", T.IntegerType()),
    T.StructField("earnings_min", T.DoubleType()),
    T.StructField("earnings_max", T.DoubleType()),
])

VIDEOS = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("channel_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publish_time", T.TimestampNTZType()),
    T.StructField("category", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("dislikes", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("tags", T.StringType()),
    T.StructField("description_len", T.IntegerType()),
])

TRENDING_SNAPSHOTS = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("trending_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("rank_on_day", T.IntegerType()),
])

VIDEO_ANALYTICS = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("channel_id", T.StringType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("ctr", T.DoubleType()),
    T.StructField("avg_view_duration", T.DoubleType()),
    T.StructField("subscribers_gained", T.IntegerType()),
    T.StructField("subscribers_lost", T.IntegerType()),
    T.StructField("snapshot_date", T.DateType()),
])

CHANNEL_DAILY_METRICS = T.StructType([
    T.StructField("channel_id", T.StringType(), False),
    T.StructField("metric_date", T.DateType(), False),
    T.StructField("views_day", T.LongType()),
    T.StructField("subs_day", T.IntegerType()),
    T.StructField("videos_published", T.IntegerType()),
    T.StructField("avg_engagement", T.DoubleType()),
])

CONTRACTS = {"channels": CHANNELS, "videos": VIDEOS, "trending_snapshots": TRENDING_SNAPSHOTS,
             "video_analytics": VIDEO_ANALYTICS, "channel_daily_metrics": CHANNEL_DAILY_METRICS}
PRIMARY_KEYS = {"channels": ["channel_id"], "videos": ["video_id"],
                "trending_snapshots": ["video_id", "trending_date", "country"],
                "video_analytics": ["video_id", "snapshot_date"],
                "channel_daily_metrics": ["channel_id", "metric_date"]}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto the contract: cast present columns, add missing ones as
    NULL, drop the rest."""
    present = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in present
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def validate(df: DataFrame, schema: T.StructType) -> list[str]:
    """Schema problems: missing columns and type mismatches (no data scan)."""
    problems = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in types:
            problems.append(f"missing column {f.name}")
        elif types[f.name] != f.dataType:
            problems.append(f"{f.name}: {types[f.name].simpleString()} != {f.dataType.simpleString()}")
    return problems


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of key values that are NULL or occur more than once (one
    aggregate; the result is usually empty)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | any_null)
