"""1:1 nearest-neighbour matching on a score, without replacement.

A driver loop over rows (scan treated rows in order, take the closest unused
control) is sequential and touches every control per treated row. Here each
round is a small number of distributed jobs:

1. one ordered scan of the union of free rows (``sequence``: range
   partitions, no single-partition window) numbers the controls 1..C in score
   order and tells every treated row how many controls lie below it; treated
   rows with the same count form a *run* sitting between two neighbouring
   controls;
2. inside a run of m rows, the i-th row from the bottom claims the nearer of
   the i-th control below the run and the (m - i + 1)-th control above it
   (a missing side falls back to the other). Going up the run the distance
   down grows and the distance up shrinks, so the lower rows go down and the
   upper rows go up, no control is claimed twice within a run, and the split
   has the least total distance. Claims are equi-joins on the control number,
   so no pairs are enumerated;
3. every claimed control accepts its closest claimant (ties: smaller key);
4. accepted pairs are stored and leave; the rejected rows start over.

Rounds are at most log2(runs) + 2. A rejected row's control was claimed from
another run too, and both runs claimed all controls between themselves and it;
so nothing free is left between the two runs, which are one run in the next
round: the number of runs that still have rows at least halves. A dense
cluster, however large, is one run.

At the end no free control is closer to a treated row than its own. On the
side it went to, all nearer controls were claimed. If a control above stayed
free, the row of the run that could have claimed it went down and found that
no farther, and a row below it is farther from that control and nearer to its
own; the same holds the other way round. Controls only leave, so this stays
true. The result does not depend on row order, which is the documented
divergence from an order-dependent greedy scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.operators.sequence import sequence


def _claims(s: DataFrame) -> DataFrame:
    """Accepted pairs of a round. ``s``: free rows with their ranks among controls and treated rows."""
    ctl = s.where(F.col("_is_c") == 1).select(F.col("cum__is_c").alias("_rank"), F.col("_id").alias("_cid"),
                                              F.col("_p").alias("_cp"))
    tr = s.where(F.col("_is_t") == 1).select("_id", "_p", F.col("cum__is_c").alias("_run"),
                                             F.col("cum__is_t").alias("_ct"))
    # stored, so that the join can split a run that holds most of the rows
    runs = tr.groupBy("_run").agg(F.min("_ct").alias("_t0"), F.count(F.lit(1)).alias("_m")).checkpoint()
    tr = tr.join(runs, "_run")
    i = F.col("_ct") - F.col("_t0") + 1
    j = F.col("_m") - i + 1
    tr = tr.withColumn("_L", F.col("_run") - i + 1).withColumn("_R", F.col("_run") + j)
    tr = tr.join(ctl.select(F.col("_rank").alias("_L"), F.col("_cid").alias("lid"), F.col("_cp").alias("lp")),
                 "_L", "left") \
        .join(ctl.select(F.col("_rank").alias("_R"), F.col("_cid").alias("rid"), F.col("_cp").alias("rp")),
              "_R", "left")
    dl = F.col("_p") - F.col("lp")
    dr = F.col("rp") - F.col("_p")
    use_left = F.col("lid").isNotNull() & (F.col("rid").isNull() | (dl <= dr))
    claims = tr.select(F.col("_id").alias("t"), F.col("_p").alias("pt"),
                       F.when(use_left, F.col("lid")).otherwise(F.col("rid")).alias("c"),
                       F.when(use_left, F.col("lp")).otherwise(F.col("rp")).alias("pc")) \
        .where(F.col("c").isNotNull()).withColumn("d", F.abs(F.col("pt") - F.col("pc")))
    return claims.groupBy("c", "pc").agg(F.min_by(F.struct("t", "pt"), F.struct("d", "t")).alias("w")) \
        .select(F.col("w.t").alias("t"), "c", F.col("w.pt").alias("pt"), "pc")


def match_rounds(treated: DataFrame, controls: DataFrame, key: str = "channel_id",
                 score: str = "propensity") -> tuple[DataFrame, int]:
    """As ``match_nearest``, with the number of rounds it took."""
    def side(df: DataFrame, is_t: int) -> DataFrame:
        return df.select(F.col(key).alias("_id"), F.col(score).cast("double").alias("_p"), F.lit(is_t).alias("_is_t"),
                         F.lit(1 - is_t).alias("_is_c")).where(F.col("_p").isNotNull())

    free, won = side(treated, 1).unionByName(side(controls, 0)), []
    while True:
        s = sequence(free, [], ["_p", "_is_t", "_id"], cums=["_is_c", "_is_t"], seq_col="_r")
        left = s.agg(F.max("_is_t"), F.max("_is_c")).first()
        if not (left[0] and left[1]):
            break
        pairs = _claims(s).checkpoint()
        won.append(pairs)
        gone = pairs.select(F.col("t").alias("_id"), F.lit(1).alias("_is_t")).unionByName(pairs.select(F.col("c").alias("_id"), F.lit(0).alias("_is_t")))
        free = s.select("_id", "_p", "_is_t", "_is_c").join(gone, ["_id", "_is_t"], "left_anti")
    if not won:
        kind = treated.schema[key].dataType.simpleString()
        won, rounds = [treated.sparkSession.createDataFrame([], f"t {kind}, c {kind}, pt double, pc double")], 0
    else:
        rounds = len(won)
    pairs = reduce(DataFrame.unionByName, won)
    return pairs.select(F.col("t").alias("treated_" + key), F.col("c").alias("control_" + key),
                        F.col("pt").alias("pscore_treated"), F.col("pc").alias("pscore_control")), rounds


def match_nearest(treated: DataFrame, controls: DataFrame, key: str = "channel_id",
                  score: str = "propensity") -> DataFrame:
    """Pairs (treated_<key>, control_<key>, pscore_treated, pscore_control);
    keys must be unique within each side. Rows without a score take no part."""
    return match_rounds(treated, controls, key, score)[0]


def matched_outcomes(pairs: DataFrame, units: DataFrame, key: str = "channel_id",
                     outcome: str = "avg_views") -> DataFrame:
    """Attach the outcome of both members of each pair."""
    u = units.select(key, outcome)
    return pairs.join(u.select(F.col(key).alias("treated_" + key), F.col(outcome).alias("treated_views")),
                      "treated_" + key) \
        .join(u.select(F.col(key).alias("control_" + key), F.col(outcome).alias("control_views")),
              "control_" + key)
