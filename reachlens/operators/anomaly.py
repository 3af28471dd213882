"""Upload anomaly flags.

z-scores use per-creator mean / sample std pre-aggregated with ``groupBy`` and
joined back; the isolation forest is built from bounded per-tree samples and
scored with a vectorised pandas UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.session import materialize


def z_anomalies(videos: DataFrame, entity: str = "channel_id", measure: str = "views",
                z_threshold: float = 2.0) -> DataFrame:
    """Per upload: engagement (0 on zero views), z of views and of engagement
    against the creator's mean and sample std (+1e-8), the z flag and the
    over/under-performer label (from z_views only). A creator's only upload
    has an undefined std and is never flagged."""
    v = videos.withColumn("engagement_rate", C.engagement_rate_or_zero(views=measure))
    stats = v.groupBy(entity).agg(F.avg(measure).alias("mean_views"), F.stddev_samp(measure).alias("std_views"),
                                  F.avg("engagement_rate").alias("mean_eng"),
                                  F.stddev_samp("engagement_rate").alias("std_eng")).checkpoint()  # stored: the join can split a hot entity
    j = v.join(stats, entity, "left")
    zv = C.zscore(measure, "mean_views", "std_views")
    ze = C.zscore("engagement_rate", "mean_eng", "std_eng")
    j = j.withColumn("z_views", zv).withColumn("z_eng", ze)
    flag = (F.abs("z_views") > z_threshold) | (F.abs("z_eng") > z_threshold)
    return j.withColumn("z_anomaly", F.coalesce(flag, F.lit(False))) \
        .withColumn("anomaly_type", C.performer_label("z_views"))


def anomaly_summary(flags: DataFrame, flag_col: str = "is_anomaly") -> DataFrame:
    """One row: uploads, flagged uploads, flagged share (%), and counts by type."""
    return flags.agg(
        F.count(F.lit(1)).alias("videos"),
        F.count_if(F.col(flag_col)).alias("anomalies"),
        (F.avg(F.col(flag_col).cast("double")) * 100).alias("anomaly_pct"),
        F.count_if(F.col("anomaly_type") == "over-performer").alias("over_performers"),
        F.count_if(F.col("anomaly_type") == "under-performer").alias("under_performers"))


# M15 / M16 -------------------------------------------------------------------
def _c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a binary search tree of n points."""
    import math
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _build_tree(features: list[str], psi: int, seed: int):
    import numpy as np
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values("_h").head(psi)
        X = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree_id])
        max_depth = int(np.ceil(np.log2(max(len(X), 2))))
        nodes = []   # (feature, threshold, left, right, size)

        def grow(idx, depth):
            me = len(nodes)
            nodes.append([-1, 0.0, -1, -1, len(idx)])
            if depth >= max_depth or len(idx) <= 1:
                return me
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if len(cand) == 0:
                return me
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            left = idx[sub[:, f] < thr]
            right = idx[sub[:, f] >= thr]
            nodes[me][0], nodes[me][1] = f, thr
            nodes[me][2] = grow(left, depth + 1)
            nodes[me][3] = grow(right, depth + 1)
            return me

        grow(np.arange(len(X)), 0)
        return pd.DataFrame({"tree_id": [tree_id], "feature": [[n[0] for n in nodes]],
                             "threshold": [[n[1] for n in nodes]], "left": [[n[2] for n in nodes]],
                             "right": [[n[3] for n in nodes]], "size": [[n[4] for n in nodes]],
                             "psi": [len(X)]})
    return run


def _flat_tree(t) -> tuple:
    """(feature, threshold, children, path length, levels) of a tree's nodes, for ``path_lengths``.

    A leaf is its own child on both sides; a node's children stand at 2 * node (not below the threshold) and
    2 * node + 1 (below). A leaf's path length counts what its unsplit rows would still take."""
    import numpy as np

    inner = np.array(t["feature"]) >= 0
    own = np.arange(len(inner))
    left, right = np.where(inner, t["left"], own), np.where(inner, t["right"], own)
    level = np.zeros(len(inner))
    for i in np.flatnonzero(inner):  # parents stand before their children
        level[left[i]] = level[right[i]] = level[i] + 1
    children = np.column_stack([right, left]).ravel().astype(np.int32)
    return (np.where(inner, t["feature"], 0).astype(np.int32), np.array(t["threshold"], float), children,
            level + np.array([_c_factor(s) for s in t["size"]]), int(level.max()))


def path_lengths(X, forest: list[tuple]):
    """Sum over the trees of every row's path length: all rows go down a tree together, those at a leaf stay there."""
    import numpy as np

    rows, width = X.shape
    values, base = X.ravel(), np.arange(rows) * width
    total = np.zeros(rows)
    for feature, threshold, children, length, levels in forest:
        node = np.zeros(rows, np.int32)
        for _ in range(levels):
            node = children[2 * node + (values[base + feature[node]] < threshold[node])]
        total += length[node]
    return total


def sample_limit(n: int, wanted: int) -> int:
    """Limit on a 63-bit hash that about ``wanted`` of ``n`` rows stay below;
    integer arithmetic, so it is exact for any table size."""
    return min((1 << 63) - 1, (wanted << 63) // max(n, 1))


def isolation_forest(df: DataFrame, features: list[str], key: str, n_trees: int = 100, psi: int = 256,
                     contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """Isolation-forest score and flag per row.

    One hash a row cuts out a joint sample of about 2 * psi rows a tree (all
    rows of a smaller table); of these, each tree keeps the psi smallest by a
    hash of its own, so per-tree work does not grow with the table. Trees are built with numpy in a grouped map,
    collected (n_trees small trees) and applied with a vectorised pandas UDF.
    ``anomaly_score`` is minus the normalised score 2^(-E[h]/c(psi)); rows
    below the ``contamination`` quantile of the scores are flagged."""
    from pyspark.sql import types as T
    from reachlens.operators.quantiles import exact_percentiles

    # stored: the rows are counted, sampled and scored, and computed once
    d = materialize(df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]), "forest-rows")
    n = d.count()
    # one hash a row: rows below the joint limit, about 2 * psi for every tree, are all that trees choose from
    joint = d.withColumn("_u", F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 1)) \
        .where(F.col("_u") < F.lit(sample_limit(n, 2 * psi * n_trees))).drop("_u")
    limit = sample_limit(min(n, 2 * psi * n_trees), 2 * psi)
    samples = joint.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id")) \
        .withColumn("_h", F.shiftrightunsigned(F.xxhash64(F.col(key), F.col("tree_id"), F.lit(seed + 1)), 1)).where(F.col("_h") < F.lit(limit))
    schema = T.StructType([T.StructField("tree_id", T.IntegerType()),
                           T.StructField("feature", T.ArrayType(T.IntegerType())),
                           T.StructField("threshold", T.ArrayType(T.DoubleType())),
                           T.StructField("left", T.ArrayType(T.IntegerType())),
                           T.StructField("right", T.ArrayType(T.IntegerType())),
                           T.StructField("size", T.ArrayType(T.IntegerType())),
                           T.StructField("psi", T.IntegerType())])
    trees = samples.groupBy("tree_id").applyInPandas(_build_tree(features, psi, seed), schema).collect()
    forest = [_flat_tree(t) for t in trees]
    psi_eff = max((t["psi"] for t in trees), default=1)
    c_psi = _c_factor(psi_eff)
    bc = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def path_score(*cols):
        import numpy as np
        import pandas as pd
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        mean_depth = path_lengths(X, bc.value) / max(len(bc.value), 1)
        return pd.Series(-np.power(2.0, -mean_depth / c_psi if c_psi > 0 else 0.0))

    # stored: the cut and the flags read the scores, which are taken once
    scored = materialize(d.withColumn("anomaly_score", path_score(*[F.col(c) for c in features])), "forest-scores")
    cut = exact_percentiles(scored, [], "anomaly_score", [contamination], ["_cut"])
    return scored.crossJoin(F.broadcast(cut)) \
        .withColumn("if_anomaly", F.col("anomaly_score") < F.col("_cut")).drop("_cut")


def detect_anomalies(videos: DataFrame, entity: str = "channel_id", key: str = "video_id",
                     contamination: float = 0.05, n_trees: int = 100, seed: int = 42) -> DataFrame:
    """z-score flags (M14) + isolation forest on (views, engagement) (M15),
    combined flag and type label (M16)."""
    # stored: the creators' means, the z-scores and the forest read the uploads, which are put together once
    v = materialize(videos, "uploads")
    z = z_anomalies(v, entity)
    rate = v.select(key, "views", C.engagement_rate_or_zero().alias("engagement_rate"))
    forest = isolation_forest(rate, ["views", "engagement_rate"], key,
                              n_trees=n_trees, contamination=contamination, seed=seed)
    j = z.join(forest.select(key, "anomaly_score", "if_anomaly"), key)
    return j.withColumn("is_anomaly", F.col("z_anomaly") | F.col("if_anomaly"))
