"""Concentration of views across creators.

Everything that needs a global order (Gini's rank weights, NTILE, Lorenz
prefix sums) uses ``global_rank``: balanced range partitions plus
per-partition offsets, never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.operators.sequence import global_rank, ntile_expr, with_group_count


def _tie(df: DataFrame, tie: str | None) -> tuple[DataFrame, str]:
    if tie:
        return df, tie
    return df.withColumn("_tie", F.monotonically_increasing_id()), "_tie"


def gini(df: DataFrame, value: str, positive_only: bool = False, tie: str | None = None) -> DataFrame:
    """One row ``gini``: 2*sum(i*x_(i))/(n*sum x) - (n+1)/n over ascending
    order statistics. Values < 0 (or <= 0 with ``positive_only``) and NULLs are
    left out; no values -> 0, zero total -> NULL."""
    keep = F.col(value) > 0 if positive_only else F.col(value) >= 0
    d = df.select(F.col(value).cast("double").alias("_x"), *([tie] if tie else [])).where(keep)
    d, t = _tie(d, tie)
    r = global_rank(d, ["_x", t], rank_col="_i")
    s = r.agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_sx"),
              F.sum(F.col("_i") * F.col("_x")).alias("_six"))
    g = F.try_divide(2 * F.col("_six"), F.col("_n") * F.col("_sx")) - (F.col("_n") + 1) / F.col("_n")
    return s.select(F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(g).alias("gini"))


def ntile(df: DataFrame, order: list[str], k: int, bucket_col: str = "ntile") -> DataFrame:
    """NTILE(k) OVER (ORDER BY order) without a single partition."""
    r = global_rank(df, order, rank_col="_rank")
    r = with_group_count(r, [], "_n")
    return r.withColumn(bucket_col, ntile_expr(F.col("_rank"), F.col("_n"), k)).drop("_rank", "_n")


def rank_with_totals(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY ...), COUNT(*) OVER (), SUM(value) OVER ()."""
    r = global_rank(df, order, rank_col="i")
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return r.crossJoin(F.broadcast(tot))


def top_share_ntile(channels: DataFrame, value: str = "total_views", key: str = "channel_id",
                    buckets: int = 100, digits: int = 2) -> DataFrame:
    """One row: % of all views held by the top NTILE bucket of creators
    (NULL when there are fewer creators than buckets)."""
    d = channels.select(key, value).where(F.col(value).isNotNull())
    b = ntile(d, [value, key], buckets, "_b")
    top = b.agg(F.sum(F.when(F.col("_b") == buckets, F.col(value))).alias("_top"))
    tot = channels.agg(F.sum(value).alias("_all"))
    j = top.crossJoin(F.broadcast(tot))
    return j.select(F.round(100.0 * F.col("_top") / F.col("_all"), digits)
                    .alias("pct_views_captured_by_top1pct"))


def top_share_cumulative(channels: DataFrame, value: str = "total_views", key: str = "channel_id",
                         share: float = 0.01) -> DataFrame:
    """One row: % of views held by the top floor(n*share)+1 creators
    (cumulative-sum form)."""
    d = channels.select(key, value).where(F.col(value).isNotNull()) \
        .withColumn("_neg", -F.col(value).cast("double"))
    r = global_rank(d, ["_neg", key], rank_col="_rank")
    r = with_group_count(r, [], "_n")
    s = r.agg(F.sum(F.when(F.col("_rank") <= F.floor(F.col("_n") * share) + 1, F.col(value))).alias("_top"),
              F.sum(value).alias("_all"))
    return s.select((F.try_divide(F.col("_top").cast("double"), F.col("_all")) * 100)
                    .alias("top1_share_pct"))


def lorenz_curve(channels: DataFrame, value: str = "total_views", key: str = "channel_id",
                 descending: bool = True) -> DataFrame:
    """Per creator: rank, population share (rank-1)/(n-1) and cumulative
    share of the value, in descending (default) or ascending value order."""
    d = channels.select(key, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    d = d.withColumn("_o", -F.col("_x") if descending else F.col("_x"))
    r = global_rank(d, ["_o", key], cums=["_x"], rank_col="rank")
    tot = d.agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_t"))
    j = r.crossJoin(F.broadcast(tot))
    pop = F.when(F.col("_n") > 1, (F.col("rank") - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return j.select(key, "rank", pop.alias("population_share"),
                    F.try_divide(F.col("cum__x"), F.col("_t")).alias("cumulative_share"))
