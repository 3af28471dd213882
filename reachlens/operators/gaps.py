"""Upload gaps per entity (W1, W7) and per-entity means broadcast back to rows.

Gaps come from the skew-safe ``sequence`` primitive instead of a window
partitioned by entity; per-entity means come from a partial aggregate joined
back on the entity key (AQE splits the join partition of a hot entity).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions.columns import MICROS_PER_DAY, epoch_micros
from reachlens.operators.sequence import sequence


def with_gaps(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
              event_id: str = "video_id", keep=None) -> DataFrame:
    """Rows of ``videos`` (only ``keep`` columns plus keys) with

    * ``seq``          1-based upload number inside the entity (time order, id tie-break)
    * ``gap_days``     fractional days since the previous upload (NULL for the first)
    * ``gap_whole_days`` floor of the same (``Timedelta.days``)
    """
    keep = [c for c in (keep or []) if c not in (entity, ts, event_id)]
    v = videos.select(entity, event_id, ts, *keep).where(F.col(entity).isNotNull()) \
        .withColumn("_t", epoch_micros(ts))
    s = sequence(v, entity, ["_t", event_id], lags=["_t"])
    gap_us = F.col("_t") - F.col("prev__t")
    return s.select(
        entity, event_id, ts, *keep, "seq",
        (gap_us / F.lit(float(MICROS_PER_DAY))).alias("gap_days"),
        F.floor(gap_us / F.lit(MICROS_PER_DAY)).cast("long").alias("gap_whole_days"))


def with_group_mean(df: DataFrame, entity: str, value: str, name: str) -> DataFrame:
    """AVG(value) OVER (PARTITION BY entity) as a pre-aggregate + join. The
    aggregate is stored, so both sides of the join are plain shuffles and a
    hot entity's partition is split."""
    m = df.groupBy(entity).agg(F.avg(value).alias(name)).checkpoint()
    return df.join(m, entity)
