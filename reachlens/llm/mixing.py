"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow. Its shuffled documents get virtual finish times: the
source's cumulative words divided by its target. Sorting all documents by
finish time serves the flows in proportion to their weights, and the mix ends
where the total budget is used up. A source whose target exceeds its size goes
round again, up to ``max_epochs`` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import global_rank
from .common import packed, prepare, stored, unpacked, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Rows that share a prefix of the shuffle key, about: running sums are taken within prefixes, then shifted.
PREFIX_ROWS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """Targets of the sources: idx, source, source_size, target.

    ``sizes`` has source, size, rows by source (one row each). Sources in
    code-point order, null last, get ``weights`` in turn. No target exceeds
    ``max_epochs`` times its source's size; the excess goes to the others by
    weight until none is above. In order of size by weight the capped sources
    come first, so running sums over the table of sources give the share of a
    unit of weight at which the rest stays below its caps.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("idx") - 1, F.lit(len(weights))) + 1)
    s = sizes.withColumn("idx", F.row_number().over(every)).withColumn("w", w).withColumn("cap", F.col("size") * max_epochs)
    total = Window.partitionBy()
    s = s.withColumn("budget", F.sum("size").over(total) if budget is None else F.lit(budget).cast("long"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "idx")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("share", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
                     / (F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    s = s.withColumn("fits", F.col("share") * F.col("w") <= F.col("cap"))
    s = s.withColumn("k", F.row_number().over(order)).withColumn("level", F.min(F.when(F.col("fits"), F.struct("k", "share"))).over(total))
    target = F.when(F.col("level").isNull() | (F.col("k") < F.col("level.k")), F.col("cap").cast("double")).otherwise(F.col("level.share") * F.col("w"))
    return s.select("idx", "source", F.col("size").alias("source_size"), "rows", target.alias("target"))


def fair_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None, seed: str = SEED) -> DataFrame:
    """``sized`` (row, doc_id, source, size) with source_size, target and ``copies``, the times the mix takes the row.

    Reruns agree: the shuffle is the order of md5(doc_id + seed). Running sums
    are taken within prefixes of that key, so a hot source spreads over many
    tasks; only sums by prefix are ever put in order by source. Nulls: a null
    id is shuffled as the empty text, a null source is a source of its own.
    Rows of size 0 are never taken. Equal rows that meet the end of the budget
    are taken or left together.
    """
    prepare(sized.sparkSession)
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)))
    narrow = stored(sized.select("doc_id", "source", "size", key.alias("key")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    targets = stored(source_targets(sizes, weights, max_epochs, budget), "mix-targets")
    most = targets.agg(F.max("rows")).first()[0] or 0
    digits = 1
    while 16 ** digits * PREFIX_ROWS < most and digits < 8:
        digits += 1

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"]), "inner").drop(targets["source"])
        return rows.withColumn("slot", F.substring("key", 1, digits))

    slots = placed(narrow).groupBy("idx", "slot").agg(F.sum("size").alias("slot_size"))
    ahead = Window.partitionBy("idx").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = stored(slots.select("idx", "slot", F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)).alias("ahead")), "mix-slots")
    within = Window.partitionBy("idx", "slot").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)

    def timed(rows: DataFrame) -> DataFrame:
        """With ``done``, the source's words up to and with this row."""
        rows = placed(rows).withColumn("own", F.sum("size").over(within))
        return rows.join(slots, ["idx", "slot"]).withColumn("done", F.col("ahead") + F.col("own"))

    def finish(epoch):
        return (F.col("done") + epoch * F.col("source_size")).cast("double") / F.col("target")

    queue = timed(narrow).filter("size > 0 and target > 0").select("idx", "size", "done", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: F.struct(finish(e).alias("finish"), e.alias("epoch")))).alias("x"))
    queue = queue.select(F.col("x.finish").alias("finish"), "idx", F.col("x.epoch").alias("epoch"), "done", "size")
    order = ["finish", "idx", "epoch", "done"]
    limit = budget if budget is not None else (targets.agg(F.sum("source_size")).first()[0] or 0)
    # one ordered scan over balanced ranges, which gives every copy its running total: no part is summed in one place
    run = global_rank(queue, order, cums=["size"])
    end = run.filter(F.col("cum_size") <= limit).agg(F.max(F.struct(*order)).alias("e")).select("e.*").first()
    if end is None or end["finish"] is None:
        copies = F.lit(0)
    else:
        stop = F.struct(*[F.lit(end[c]).alias(c) for c in order])
        copies = sum((F.when((F.col("size") > 0) & (F.col("target") > 0) & (F.struct(finish(F.lit(e)).alias("finish"), F.col("idx"), F.lit(e).alias("epoch"), F.col("done")) <= stop), 1).otherwise(0)
                      for e in range(max_epochs)), F.lit(0))
    return timed(sized.withColumn("key", key)).withColumn("copies", copies).drop("key", "slot", "own", "ahead", "done", "rows")


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    sized = stored(sized, "mix-input")
    return fair_mix(sized, **options).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with all its columns."""
    sized = docs.select(packed(docs), "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    out = fair_mix(sized, **options).filter("copies > 0")
    return unpacked(out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns)
