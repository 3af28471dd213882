"""Map the driver's TPC-H-style tables onto the creator/upload contract.

customers play creators, orders play uploads (see FIXTURES.md §2). Keys stay
BIGINT. The same definitions are repeated as SQL CTEs in
``reachlens.plans.oracle`` so DuckDB can check every registered query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contract (FIXTURES.md §2)
AS_OF_YEAR = 2024          # "current year" used for years_active
FIRST_CREATED_YEAR = 2008  # created_year = 2008 + custkey % 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per upload: orders left-joined to their line items, which are
    pre-aggregated to one row per order before the join."""
    o = table(spark, sf_dir, "orders")
    per_order = (table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.sum("l_quantity").alias("_qty"), F.count(F.lit(1)).alias("_lines")))
    j = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("video_id"),
        F.col("o_custkey").alias("channel_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("publish_time"),
        F.floor("o_totalprice").cast("long").alias("views"),
        F.coalesce(F.floor(F.col("_qty") * 10).cast("long"), F.lit(0).cast("long")).alias("likes"),
        F.coalesce(F.col("_lines") * 10, F.lit(0).cast("long")).alias("comment_count"),
        (F.lit(60) + F.col("o_orderkey") % 1740).cast("int").alias("duration_seconds"),
    )


def channels(spark: SparkSession, sf_dir: str, video_df: DataFrame | None = None) -> DataFrame:
    """One row per creator; total_views / total_videos come from the uploads
    (NULL views and 0 videos for creators without uploads)."""
    v = video_df if video_df is not None else videos(spark, sf_dir)
    per_ch = v.groupBy("channel_id").agg(F.sum("views").alias("_tv"), F.count(F.lit(1)).alias("_nv"))
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    created_year = (F.lit(FIRST_CREATED_YEAR) + F.col("c_custkey") % 16).cast("int")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]) \
        .join(per_ch, c["c_custkey"] == per_ch["channel_id"], "left")
    total_videos = F.coalesce(F.col("_nv"), F.lit(0).cast("long"))
    return j.select(
        F.col("c_custkey").alias("channel_id"),
        F.col("c_name").alias("channel_name"),
        F.col("c_mktsegment").alias("category"),
        F.col("n_name").alias("country"),
        F.floor(F.col("c_acctbal") * F.col("c_acctbal")).cast("long").alias("subscribers"),
        F.col("_tv").cast("long").alias("total_views"),
        total_videos.alias("total_videos"),
        (total_videos / (F.greatest(F.lit(AS_OF_YEAR) - created_year, F.lit(1)) * F.lit(52.0)))
        .alias("avg_weekly_uploads"),
        created_year.alias("created_year"),
        (F.lit(1) + F.col("c_custkey") % 12).cast("int").alias("created_month"),
    )


def channel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """channel_daily_metrics from the events stream: one row per user and day."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("channel_id"), F.to_date("ts").alias("metric_date"))
            .agg(F.count_if(F.col("event_type") == "view").alias("views_day"),
                 F.count_if(F.col("event_type") == "signup").alias("subs_day"),
                 F.count(F.lit(1)).alias("events_day")))


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trending slots: each order having a returned line item (one row per
    order), keyed by video and channel."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ret = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R") \
        .select("l_orderkey").distinct()
    return o.join(ret, o["o_orderkey"] == ret["l_orderkey"], "left_semi") \
        .select(F.col("o_orderkey").alias("video_id"), F.col("o_custkey").alias("channel_id"))
