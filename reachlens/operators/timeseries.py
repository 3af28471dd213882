"""Weekly per-creator series, future spines and a seasonal-naive hold-out
baseline (T1, T6, T7).

A series holds one row per creator and week between its first and last upload,
so its length is bounded by the time span, not by the number of uploads. All
creators are processed in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEASON = 4


def week_end(ts) -> F.Column:
    """The Sunday closing the Monday-Sunday week of ``ts`` (a DATE)."""
    return F.date_add(F.to_date(F.date_trunc("week", F.col(ts) if isinstance(ts, str) else ts)), 6)


def weekly_series(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
                  measure: str = "views") -> DataFrame:
    """(entity, week_end, views, week_idx): weekly sums with empty weeks
    between an entity's first and last week filled with 0."""
    w = videos.groupBy(entity, week_end(ts).alias("week_end")).agg(F.sum(measure).alias(measure)).where(F.col("week_end").isNotNull())
    # one row a week: bounded by the time span. A week is followed by the empty ones up to the next, so that the filled
    # series is never shuffled or joined
    own = Window.partitionBy(entity).orderBy("week_end")
    w = w.withColumns({"_a": F.min("week_end").over(Window.partitionBy(entity)), "_own": F.col("week_end"),
                       "_next": F.lead("week_end").over(own)})
    last = F.coalesce(F.date_sub("_next", 7), F.col("_own"))
    s = w.withColumn("week_end", F.explode(F.sequence("_own", last, F.expr("INTERVAL 7 DAYS"))))
    # rows without an entity have weeks but no values, as NULL equals no key
    seen = (F.col("week_end") == F.col("_own")) & F.col(entity).isNotNull()
    return s.select(entity, "week_end", F.coalesce(F.when(seen, F.col(measure)), F.lit(0).cast("long")).alias(measure),
                    (F.datediff("week_end", "_a") / 7).cast("int").alias("week_idx"))


def future_weeks(series: DataFrame, steps: int, entity: str = "channel_id") -> DataFrame:
    """The next ``steps`` weekly labels after each series' last week."""
    last = series.groupBy(entity).agg(F.max("week_end").alias("_b"))
    return last.select(entity, F.posexplode(F.sequence(F.date_add("_b", 7), F.date_add("_b", 7 * steps),
                                                       F.expr("INTERVAL 7 DAYS"))).alias("step", "week_end")) \
        .select(entity, (F.col("step") + 1).alias("step"), "week_end")


def holdout_split(series: DataFrame, entity: str = "channel_id", train_share: float = 0.8,
                  steps: int = 8) -> DataFrame:
    """Label each week 'train' (index < floor(n*share)) or 'test' (the next
    min(steps, n - split) weeks); later weeks are dropped."""
    n = series.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    s = series.join(n, entity)
    split = F.floor(F.col("_n") * train_share)
    return s.withColumn("_split", split.cast("int")) \
        .withColumn("part", F.when(F.col("week_idx") < F.col("_split"), "train").otherwise("test")) \
        .where(F.col("week_idx") < F.col("_split") + steps) \
        .drop("_n")


def seasonal_naive_eval(series: DataFrame, entity: str = "channel_id", measure: str = "views",
                        train_share: float = 0.8, steps: int = 8, season: int = SEASON) -> DataFrame:
    """Hold-out score of the seasonal-naive forecast (repeat the last
    training season): MAPE on value+1 and RMSE, per entity with at least one
    full training season."""
    s = holdout_split(series, entity, train_share, steps)
    test = s.where(F.col("part") == "test")
    src_idx = F.col("_split") - season + F.pmod(F.col("week_idx") - F.col("_split"), F.lit(season))
    test = test.select(entity, "week_idx", F.col(measure).alias("_a"), "_split", src_idx.alias("_src")) \
        .where(F.col("_split") >= season)
    train = s.where(F.col("part") == "train").select(entity, F.col("week_idx").alias("_src"),
                                                     F.col(measure).alias("_p"))
    j = test.join(train, [entity, "_src"])
    err = F.col("_a") - F.col("_p")
    return j.groupBy(entity).agg(
        F.lit("seasonal_naive").alias("model"),
        F.avg(F.abs(err) / (F.col("_a") + 1)).alias("mape"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.lit(1)).alias("n_test"))


def seasonal_naive_holdout(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
                           measure: str = "views", train_share: float = 0.8, steps: int = 8,
                           season: int = SEASON) -> DataFrame:
    """``seasonal_naive_eval`` computed from the uploads without building the
    dense weekly series: a series' length follows from its first and last
    week, so only the last training season and the test weeks (at most
    ``season + steps`` rows per entity) are generated and filled from the
    weekly sums."""
    w = videos.groupBy(entity, week_end(ts).alias("week_end")).agg(F.sum(measure).alias("_y"))
    span = w.groupBy(entity).agg(F.min("week_end").alias("_a"), F.max("week_end").alias("_b"))
    n = (F.datediff("_b", "_a") / 7).cast("int") + 1
    span = span.withColumn("_split", F.floor(n * train_share).cast("int")) \
        .withColumn("_k", F.least(F.lit(steps), n - F.col("_split"))) \
        .where((F.col("_split") >= season) & (F.col("_k") > 0))
    spine = span.select(entity, "_a", "_split",
                        F.explode(F.sequence(F.col("_split") - season, F.col("_split") + F.col("_k") - 1))
                        .alias("week_idx"))
    spine = spine.withColumn("week_end", F.date_add(F.col("_a"), F.col("week_idx") * 7))
    s = spine.join(w, [entity, "week_end"], "left") \
        .select(entity, "week_idx", "_split", F.coalesce(F.col("_y"), F.lit(0).cast("long")).alias("_v"))
    test = s.where(F.col("week_idx") >= F.col("_split")).select(
        entity, F.col("_v").alias("_a"),
        (F.col("_split") - season + F.pmod(F.col("week_idx") - F.col("_split"), F.lit(season))).alias("_src"))
    train = s.where(F.col("week_idx") < F.col("_split")).select(entity, F.col("week_idx").alias("_src"),
                                                                F.col("_v").alias("_p"))
    j = test.join(train, [entity, "_src"])
    err = F.col("_a") - F.col("_p")
    return j.groupBy(entity).agg(
        F.lit("seasonal_naive").alias("model"),
        F.avg(F.abs(err) / (F.col("_a") + 1)).alias("mape"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.lit(1)).alias("n_test"))
