"""Exact order statistics by counting.

A value's order-preserving integer image (the IEEE order of doubles) is cut into
three digits of 22, 21 and 21 bits. Each pass counts rows by group and digit,
finds with prefix sums the digit that holds a wanted rank, and the next pass
looks only at rows that share it. So there are always three aggregates with
map-side combining: no sort of the input, no sketch, no second attempt, and no
group's rows in one task. A window runs over at most 2^22 counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.session import ensure_checkpoint_dir, materialize

_MANTISSA = 1 << 52
#: Bits of the lower two digits; the highest has the other 22.
_DIGIT = 21
#: Up to so many wanted bins (a few numbers each) pass through the driver and are broadcast; more are stored and joined by shuffle.
BROADCAST_BINS = 100_000


def ordered_image(value: Column) -> Column:
    """Long with the order of the double ``value``: -0.0 equals 0.0, NaN is
    above all (as in Spark's sort order), NULL stays NULL.

    Exponent and mantissa are taken by exact arithmetic: the logarithm only
    proposes the exponent, comparisons with powers of two settle it.
    """
    v = value.cast("double")
    a = F.abs(v)
    least = F.lit(2.0 ** -1022)
    guess = F.floor(F.log2(a)).cast("double")
    guess = F.least(F.greatest(guess, F.lit(-1022.0)), F.lit(1023.0))
    # powers at the guess and around it; 2^1024 is infinite, which compares rightly
    e = guess - F.when(a < F.pow(F.lit(2.0), guess), 1.0).otherwise(0.0) + F.when(a >= F.pow(F.lit(2.0), guess + 1), 1.0).otherwise(0.0)
    normal = ((e + 1023).cast("long") * F.lit(_MANTISSA)) + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(float(_MANTISSA))).cast("long")
    # below 2^-1022 all numbers are multiples of 2^-1074; two factors, as 2^1074 is no double
    tiny = (a * F.lit(2.0 ** 1000) * F.lit(2.0 ** 74)).cast("long")
    size = F.when(F.isnan(v), F.lit(2047 * _MANTISSA + 1)).when(a == float("inf"), F.lit(2047 * _MANTISSA)) \
        .when(a < least, tiny).otherwise(normal)
    return F.when(v.isNull(), F.lit(None).cast("long")).when(v < 0, -size).otherwise(size)


def _held(wanted: DataFrame) -> tuple[DataFrame, bool]:
    """``wanted`` as a small local frame, or stored if it has over BROADCAST_BINS rows."""
    rows = wanted.limit(BROADCAST_BINS + 1).toArrow()
    if rows.num_rows > BROADCAST_BINS:
        return materialize(wanted, "bins"), False
    return wanted.sparkSession.createDataFrame(rows, wanted.schema), True


def order_statistics(df: DataFrame, group: Sequence[str], value: str, ranks: Column) -> DataFrame:
    """The values at given ranks of every group: columns ``group``, ``i``, ``n``, ``v``, ``tie``.

    ``ranks`` is an array of 0-based ranks, an expression over the group's row
    count ``n``; ``i`` is a rank's index in it, ``tie`` its place (from 0) among equal values. Ranks outside the group and
    NULL values are ignored; a NULL group key forms a group. Column names that
    start with ``_`` are taken for helpers. ``df`` is read once: values and images are stored.
    """
    group = list(group)
    ensure_checkpoint_dir(df.sparkSession)
    # keys travel in structs, which join and group NULL with NULL
    keys = [F.struct(F.col(f"`{g}`").alias("key")).alias(g) for g in group]
    d = df.select(*keys, F.col(f"`{value}`").cast("double").alias("_v")).where(F.col("_v").isNotNull())
    # stored: the input is computed once, and the passes read plain columns
    d = d.withColumn("_im", ordered_image(F.col("_v"))).checkpoint()
    low = F.lit((1 << _DIGIT) - 1)
    digits = [F.shiftright("_im", 2 * _DIGIT), F.shiftright("_im", _DIGIT).bitwiseAND(low), F.col("_im").bitwiseAND(low)]

    before = F.col("_upto") - F.col("_k")
    wanted = None
    for level, digit in enumerate(digits):
        # "_bin" is what the rows of a bin share so far
        rows = d.select(*group, "_v", digit.alias("_d"), (F.shiftright("_im", (3 - level) * _DIGIT) if level else F.lit(0).cast("long")).alias("_bin"))
        known = [*group, "_bin"]
        if wanted is not None:
            bins = wanted.select(*known).distinct()
            rows = rows.join(F.broadcast(bins) if small else bins, known)
        counts = rows.groupBy(*known, "_d").agg(F.count(F.lit(1)).alias("_k"), F.min("_v").alias("v"))
        w = Window.partitionBy(*known)
        counts = counts.withColumn("_upto", F.sum("_k").over(w.orderBy("_d")))
        if wanted is None:
            counts = counts.withColumn("n", F.sum("_k").over(w))
            asked = F.transform(ranks, lambda r, i: F.struct(i.alias("i"), r.cast("long").alias("rank")))
            hits = counts.select("*", F.explode(F.filter(asked, lambda r: (r["rank"] >= before) & (r["rank"] < F.col("_upto")))).alias("_r"))
            hits = hits.select("*", "_r.i", F.col("_r.rank").alias("_rank"))
        else:
            hits = counts.join(F.broadcast(wanted) if small else wanted, known).where((F.col("_rank") >= before) & (F.col("_rank") < F.col("_upto")))
        # one row a group and rank
        wanted, small = _held(hits.select(*group, F.shiftleft("_bin", _DIGIT).bitwiseOR(F.col("_d")).alias("_bin") if level else F.col("_d").alias("_bin"),
                                          "i", "n", (F.col("_rank") - before).alias("_rank"), "v"))
        if level < 2:
            wanted = wanted.drop("v")
    return wanted.select(*[F.col(f"`{g}`.key").alias(g) for g in group], "i", "n", "v", F.col("_rank").alias("tie"))


def exact_percentiles(df: DataFrame, group, value: str, qs: Sequence[float],
                      names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles (PERCENTILE_CONT / pandas ``quantile``)
    per group, always exact (``order_statistics``).

    NULL values are ignored; rows whose group key is NULL form a group. One
    output row per group that has a value; without groups one row always.
    """
    group = [group] if isinstance(group, str) else list(group or [])
    names = list(names) if names else [f"p{int(round(q * 100))}" for q in qs]
    at = [(F.col("n") - 1) * F.lit(float(q)) for q in qs]
    picked = order_statistics(df, group, value, F.array(*[f(h) for h in at for f in (F.floor, F.ceil)]))
    exprs = []
    for k, (h, name) in enumerate(zip(at, names)):
        lo, hi = F.max(F.when(F.col("i") == 2 * k, F.col("v"))), F.max(F.when(F.col("i") == 2 * k + 1, F.col("v")))
        exprs.append((lo + (hi - lo) * F.max(h - F.floor(h))).alias(name))
    return picked.groupBy(*group).agg(*exprs) if group else picked.agg(*exprs)
