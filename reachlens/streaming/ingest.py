"""Structured Streaming forms of the ingest path.

* ``stream_append_new``: new upload files landing in a folder are appended to
  the upload table; keys already stored or repeated inside a micro-batch are
  skipped (the batch ingest S6 applied per micro-batch through
  ``foreachBatch``).
* ``stream_daily_rollup``: the per-creator daily roll-up (A24) maintained as
  an event-time aggregation with a watermark, so late uploads within the
  allowed lateness still land in their day and state for closed days is
  dropped.

Stream checkpoints live under the session's checkpoint folder (the cluster's
``spark.checkpoint.dir``) unless a location is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reachlens.functions import columns as C
from reachlens.session import ensure_checkpoint_dir
from reachlens.sources.files import append_new


def _location(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{ensure_checkpoint_dir(spark)}/streams/{name}"


def read_upload_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def stream_append_new(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                      keys: list[str], checkpoint_location: str | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Append-only, key-deduplicated ingest of files arriving in ``source_dir``."""
    stream = read_upload_stream(spark, source_dir, schema)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, target_dir, keys)

    w = stream.writeStream.foreachBatch(write_batch) \
        .option("checkpointLocation", _location(spark, "append_new", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_rollup_stream(uploads: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
                        lateness: str = "2 days") -> DataFrame:
    """Event-time daily roll-up of a stream of uploads (views, uploads, mean
    engagement with 0 on zero views)."""
    t = F.col(ts).cast("timestamp")
    return uploads.withColumn("_ts", t).withWatermark("_ts", lateness) \
        .groupBy(entity, F.window("_ts", "1 day").alias("_day")) \
        .agg(F.sum("views").alias("views_day"), F.count(F.lit(1)).alias("videos_published"),
             F.avg(C.engagement_rate_or_zero()).alias("avg_engagement")) \
        .select(entity, F.to_date(F.col("_day.start")).alias("metric_date"), "views_day", "videos_published",
                "avg_engagement")


def stream_daily_rollup(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                        checkpoint_location: str | None = None, lateness: str = "2 days",
                        available_now: bool = True) -> StreamingQuery:
    """Write closed days of the roll-up to Parquet (append mode emits a day
    once the watermark passes its end)."""
    out = daily_rollup_stream(read_upload_stream(spark, source_dir, schema), lateness=lateness)
    w = out.writeStream.outputMode("append").format("parquet").option("path", target_dir) \
        .option("checkpointLocation", _location(spark, "daily_rollup", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
