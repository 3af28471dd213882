"""Creator cohorts, survival and early-milestone ("aha") analysis.

One ``groupBy(entity)`` gives first/last uploads; the first upload is joined
back to the uploads (AQE splits a hot creator's join partition) so early-window
sums are conditional aggregates of a single pass. Threshold scans stack the
windows to long form and compute exact quantiles per window without sending a
window's values to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.operators.quantiles import exact_percentiles

SURVIVAL_DAYS = (30, 60, 90, 180, 365)
AHA_DAY_WINDOWS = (7, 14, 30, 60, 90)
AHA_QUANTILES = (0.25, 0.5, 0.75)


def build_cohorts(videos: DataFrame, freq: str = "Q", entity: str = "channel_id",
                  ts: str = "publish_time") -> DataFrame:
    """Per entity: first upload and its cohort label ('2023Q1' or '2023')."""
    f = videos.groupBy(entity).agg(F.min(ts).alias("first_upload"))
    return f.withColumn("cohort", C.cohort_label("first_upload", freq))


def survival_curve(videos: DataFrame, cohorts: DataFrame, thresholds: Sequence[int] = SURVIVAL_DAYS,
                   entity: str = "channel_id", ts: str = "publish_time") -> DataFrame:
    """Per cohort: n and the share of entities active for >= t whole days."""
    last = videos.groupBy(entity).agg(F.max(ts).alias("last_upload"))
    j = cohorts.join(last, entity, "left")
    j = j.withColumn("active_days", F.greatest(C.whole_days("first_upload", "last_upload"), F.lit(0)))
    aggs = [F.count(F.lit(1)).alias("n")]
    for t in thresholds:
        aggs.append(F.avg((F.col("active_days") >= t).cast("double")).alias(f"survival_{t}d"))
    return j.groupBy("cohort").agg(*aggs).orderBy("cohort")


def early_volume(videos: DataFrame, windows: Sequence[int] = AHA_DAY_WINDOWS, entity: str = "channel_id",
                 ts: str = "publish_time", measure: str = "views") -> DataFrame:
    """Per entity: sum of ``measure`` within d days of the first upload
    (inclusive) for each window d, plus whole active days."""
    span = videos.groupBy(entity).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last")).checkpoint()  # stored: the join can split a hot entity
    j = videos.select(entity, ts, measure).join(span, entity)
    aggs = [F.sum(F.when(F.col(ts) <= C.plus_days("_first", d), F.col(measure)).otherwise(F.lit(0)))
            .alias(f"views_in_{d}d") for d in windows]
    g = j.groupBy(entity, "_first", "_last").agg(*aggs)
    return g.select(entity, *[f"views_in_{d}d" for d in windows],
                    C.whole_days("_first", "_last").alias("active_days"))


def aha_moment(videos: DataFrame, windows: Sequence[int] = AHA_DAY_WINDOWS,
               quantiles: Sequence[float] = AHA_QUANTILES, retained_days: int = 180,
               entity: str = "channel_id", ts: str = "publish_time", measure: str = "views",
               round_output: bool = True) -> DataFrame:
    """Threshold scan: for each early window d and quantile q of the early
    views, the retention (active >= ``retained_days``) of entities at or above
    the threshold vs below it, and the lift hit / (miss + 1e-9); highest lift
    first."""
    e = early_volume(videos, windows, entity, ts, measure)
    stacked = e.select(entity, (F.col("active_days") >= retained_days).cast("double").alias("_ret"),
                       F.explode(F.array(*[F.struct(F.lit(d).alias("days_window"),
                                                    F.col(f"views_in_{d}d").alias("_v"))
                                           for d in windows])).alias("_s")) \
        .select(entity, "_ret", "_s.days_window", "_s._v")
    names = [f"q{i}" for i in range(len(quantiles))]
    th = exact_percentiles(stacked, ["days_window"], "_v", quantiles, names)
    th_long = th.select("days_window", F.explode(F.array(*[
        F.struct(F.lit(int(round(q * 100))).alias("percentile"), F.col(n).alias("threshold"))
        for q, n in zip(quantiles, names)])).alias("_t")) \
        .select("days_window", "_t.percentile", "_t.threshold")
    # one row per (window, quantile): bounded by the parameter lists
    j = stacked.join(F.broadcast(th_long), "days_window")
    hit = F.col("_v") >= F.col("threshold")
    g = j.groupBy("days_window", "percentile").agg(
        F.first("threshold").alias("_th"),
        F.avg(F.when(hit, F.col("_ret"))).alias("retention_if_hit"),
        F.avg(F.when(~hit, F.col("_ret"))).alias("retention_if_miss"))
    lift = F.col("retention_if_hit") / (F.col("retention_if_miss") + F.lit(1e-9))
    out = g.select("days_window", "percentile", F.col("_th").cast("long").alias("view_threshold"),
                   "retention_if_hit", "retention_if_miss", lift.alias("lift"))
    if round_output:
        out = out.select("days_window", "percentile", "view_threshold",
                         F.round("retention_if_hit", 3).alias("retention_if_hit"),
                         F.round("retention_if_miss", 3).alias("retention_if_miss"),
                         F.round("lift", 2).alias("lift"))
    return out.orderBy(F.desc("lift"), "days_window", "percentile")


def creator_retention_view(videos: DataFrame, thresholds: Sequence[int] = (30, 90, 180),
                           first_window_days: int = 30, entity: str = "channel_id",
                           ts: str = "publish_time") -> DataFrame:
    """First/last upload, whole active days, retained flags and the number of
    uploads within ``first_window_days`` of the first (inclusive), in one
    pass over the uploads after the first-upload join."""
    span = videos.groupBy(entity).agg(F.min(ts).alias("first_video_date"),
                                      F.max(ts).alias("last_video_date")).checkpoint()  # as above
    j = videos.select(entity, ts).join(span, entity)
    g = j.groupBy(entity, "first_video_date", "last_video_date").agg(
        F.count_if(F.col(ts).between(F.col("first_video_date"),
                                     C.plus_days("first_video_date", first_window_days)))
        .alias(f"videos_in_first_{first_window_days}_days"))
    days = C.whole_days("first_video_date", "last_video_date")
    cols = [entity, "first_video_date", "last_video_date", days.alias("active_days")]
    cols += [(days >= t).alias(f"retained_d{t}") for t in thresholds]
    cols.append(f"videos_in_first_{first_window_days}_days")
    return g.select(*cols)
