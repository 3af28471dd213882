"""Skew-safe ordered operations: one two-level prefix scan.

``Window.partitionBy(entity).orderBy(ts)`` sends every row of an entity to one
task; a creator holding a third of all uploads would then be one task reading a
third of the data, and a global order would be one task reading everything. The
scan here gives the same answers on balanced partitions:

1. rows are range-partitioned on ``(entity, order…)``, sorted within partitions
   and stored by ``checkpoint()`` with their place (partition number and
   position), so retries never re-sample the range bounds;
2. window functions run over (partition, entity), which splits a hot entity
   over as many tasks as it has partitions (a plain rank needs no window: it
   is the position);
3. an entity that goes on from earlier partitions gets their totals from a
   table of one row a partition, which is all that is broadcast.

There is one path for every size, and values keep their types: nothing leaves
the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.session import ensure_checkpoint_dir

#: ``monotonically_increasing_id`` numbers rows within a partition in this many low bits.
_POSITION_BITS = 33


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _summable(df: DataFrame, col: str) -> Column:
    """The column as it is summed: NULL as 0, integers as long, floats as double."""
    kind = df.schema[col].dataType
    c = F.col(f"`{col}`")
    if isinstance(kind, T.IntegralType):
        c = c.cast("long")
    elif not isinstance(kind, T.DecimalType):
        c = c.cast("double")
    return F.coalesce(c, F.lit(0).cast(T.LongType() if isinstance(kind, T.IntegralType) else kind if isinstance(kind, T.DecimalType) else T.DoubleType()))


def _same(left: str, right: str, entity: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.`{e}`").eqNullSafe(F.col(f"{right}.`{e}`")) for e in entity], F.lit(True))


def sequence(df: DataFrame, entity, order, lags: Sequence[str] = (), cums: Sequence[str] = (), seq_col: str = "seq",
             num_partitions: int | None = None, ffills: Sequence[str] = ()) -> DataFrame:
    """Add ``seq_col`` (1-based rank inside ``entity`` by ``order``),
    ``prev_<c>`` for each column in ``lags`` (NULL on an entity's first row),
    ``cum_<c>`` (inclusive running sum inside the entity, NULL counted as 0)
    and ``last_<c>`` for each column in ``ffills`` (the last non-NULL value on
    an earlier row of the entity).

    ``order`` should end with a unique column so the order is total. NULL
    entity keys form an entity. Running sums of integers are long, of floats
    double; lags and fills take any type. Without ``num_partitions`` AQE sizes
    the range partitions from the data.
    """
    entity, order = _as_list(entity), _as_list(order)
    lags, cums, ffills = list(lags), list(cums), list(ffills)
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(f"`{c}`") for c in entity + order]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("_scan_at", F.monotonically_increasing_id()).checkpoint()
    pid = F.shiftright("_scan_at", _POSITION_BITS)
    placed = placed.withColumn("_scan_pid", pid)
    position = F.col("_scan_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    own = F.struct(*[F.col(f"`{e}`").alias(e) for e in entity]) if entity else F.struct(F.lit(0).alias("all"))

    # level 1: inside (partition, entity)
    local = placed.withColumn("_scan_own", own)
    if entity or lags or cums or ffills:
        w = Window.partitionBy("_scan_pid", *[F.col(f"`{e}`") for e in entity]).orderBy("_scan_at")
        upto, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
        local = local.select("*", F.row_number().over(w).cast("long").alias("_scan_seq"),
                             *[F.lag(F.col(f"`{c}`")).over(w).alias(f"_scan_lag_{c}") for c in lags],
                             *[F.sum(_summable(df, c)).over(upto).alias(f"_scan_cum_{c}") for c in cums],
                             *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(before).alias(f"_scan_ff_{c}") for c in ffills])
    else:
        local = local.withColumn("_scan_seq", position + 1)

    # level 2: one row a partition, with the totals of its last entity
    ends = placed.groupBy("_scan_pid").agg(F.max("_scan_at").alias("_scan_end"))
    last = placed.join(F.broadcast(ends.select(F.col("_scan_end").alias("_scan_at"))), "_scan_at") \
        .select(F.col("_scan_pid").alias("_scan_p"), own.alias("_scan_last"), *[F.col(f"`{c}`").alias(f"_v_{c}") for c in lags])
    tail = placed.withColumn("_scan_own", own)
    if entity:
        tail = tail.join(F.broadcast(last.select("_scan_p", "_scan_last")), F.col("_scan_pid") == F.col("_scan_p")).where(_same("_scan_own", "_scan_last", entity))
    tail = tail.groupBy("_scan_pid").agg(
        F.count(F.lit(1)).alias("_scan_n"), *[F.sum(_summable(df, c)).alias(f"_s_{c}") for c in cums],
        *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("_scan_at"))).alias(f"_f_{c}") for c in ffills])
    first = placed.where(position == 0).select("_scan_pid", own.alias("_scan_first"))
    parts = first.join(tail, "_scan_pid").join(last, F.col("_scan_pid") == F.col("_scan_p"))
    run = Window.partitionBy("_scan_last").orderBy("_scan_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select("_scan_pid", "_scan_first", F.struct(
        "_scan_last", F.sum("_scan_n").over(run).alias("n"), *[f"_v_{c}" for c in lags],
        *[F.sum(f"_s_{c}").over(run).alias(f"_s_{c}") for c in cums],
        *[F.last(f"_f_{c}", ignorenulls=True).over(run).alias(f"_f_{c}") for c in ffills]).alias("_scan_sum"))
    carry = parts.withColumn("_scan_sum", F.lag("_scan_sum").over(Window.orderBy("_scan_pid"))).where(F.col("_scan_sum").isNotNull())
    if entity:
        carry = carry.where(_same("_scan_first", "_scan_sum._scan_last", entity))
    carry = carry.select("_scan_pid", "_scan_first", F.col("_scan_sum").alias("_scan_c"))

    out = local.join(F.broadcast(carry), "_scan_pid", "left")
    goes_on = F.col("_scan_c").isNotNull() & _same("_scan_own", "_scan_first", entity)

    def added(name: str, more: str) -> Column:
        return F.col(f"`{name}`") + F.when(goes_on, F.col(f"_scan_c.`{more}`")).otherwise(F.lit(0))

    return out.select(
        *[F.col(f"`{c}`") for c in df.columns], added("_scan_seq", "n").alias(seq_col),
        *[F.when(goes_on & (F.col("_scan_seq") == 1), F.col(f"_scan_c.`_v_{c}`")).otherwise(F.col(f"`_scan_lag_{c}`")).alias("prev_" + c) for c in lags],
        *[added(f"_scan_cum_{c}", f"_s_{c}").alias("cum_" + c) for c in cums],
        *[F.coalesce(F.col(f"`_scan_ff_{c}`"), F.when(goes_on, F.col(f"_scan_c.`_f_{c}`"))).alias("last_" + c) for c in ffills])


def global_rank(df: DataFrame, order, cums: Sequence[str] = (), rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) and global running sums on balanced
    range partitions."""
    return sequence(df, [], order, cums=cums, seq_col=rank_col, num_partitions=num_partitions)


def with_group_count(df: DataFrame, group, count_col: str = "n") -> DataFrame:
    """Attach the row count of each group (pre-aggregated, stored, then joined
    back, so that a skewed join partition is split). No group -> one-row
    broadcast."""
    group = _as_list(group)
    if not group:
        n = df.agg(F.count(F.lit(1)).alias(count_col))
        return df.crossJoin(F.broadcast(n))
    n = df.groupBy(*group).agg(F.count(F.lit(1)).alias(count_col)).checkpoint()
    return df.join(n, group)


def ntile_expr(rank: Column, n: Column, k: int) -> Column:
    """NTILE(k) bucket of a 1-based rank among n rows (SQL semantics: the first
    n mod k buckets hold one extra row)."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
        .otherwise(r + F.floor((rank - 1 - big) / q) + 1).cast("long")
