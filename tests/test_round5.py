"""Rows that several steps read are computed once."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.operators import anomaly, features, gram, models
from reachlens.plans import catalog_models


def counted(spark, df, col):
    """``df`` with ``col`` through a function that counts its rows in the accumulator."""
    seen = spark.sparkContext.accumulator(0)

    def same(x):
        seen.add(1)
        return x

    return df.withColumn(col, F.udf(same, df.schema[col].dataType)(F.col(col))), seen


def test_levels_are_found_without_a_second_computation(spark):
    df, seen = counted(spark, spark.range(50).select("id", F.concat(F.lit("l"), F.col("id") % 3).alias("c")), "c")
    out = features.one_hot_drop_first(df, "c")
    assert out.columns == ["id", "c_l1", "c_l2"] and out.agg(F.sum("c_l1"), F.sum("c_l2")).first() == (17.0, 16.0)
    assert seen.value == 50


def test_state_of_the_tables_reads_no_rows(spark, tmp_path):
    for t in ("orders", "lineitem", "customer"):
        (tmp_path / f"{t}.parquet").write_bytes(b"not read")
    (tmp_path / "nation.parquet").mkdir()
    for k in range(2):
        (tmp_path / "nation.parquet" / f"part-{k}.parquet").write_bytes(b"not read")
    was = catalog_models._state(spark, str(tmp_path))
    assert was[0] == 5 and catalog_models._state(spark, str(tmp_path)) == was
    (tmp_path / "orders.parquet").write_bytes(b"other")
    assert catalog_models._state(spark, str(tmp_path)) != was


def test_moments_of_many_columns(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(40, 12))
    df = spark.createDataFrame([(int(i % 2) if i % 5 else None, *map(float, r)) for i, r in enumerate(x)], "fold int, " + ", ".join(f"x{k} double" for k in range(12)))
    sizes, agg = [], type(df.groupBy("fold")).agg
    monkeypatch.setattr(type(df.groupBy("fold")), "agg", lambda self, *c: sizes.append(len(c)) or agg(self, *c))
    found = gram.moments(df, [f"x{k}" for k in range(12)], "fold")
    assert max(sizes) <= gram.AT_ONCE and set(found) == {0, 1, None}
    for fold, m in found.items():
        own = x[[i for i in range(40) if (i % 2 if i % 5 else None) == fold]]
        assert m.n == len(own)
        np.testing.assert_allclose(m.s, own.sum(axis=0))
        np.testing.assert_allclose(m.p, own.T @ own)


def test_growth_rows_are_ranked_once(spark):
    feat = spark.range(40).select(F.col("id").alias("channel_id"), F.rand(1).alias("a"), F.rand(2).alias("growth_rate"))
    z, cols, _ = models.growth_moments(feat)
    assert cols == ["a"] and {r.fold: r["count"] for r in z.groupBy("fold").count().collect()} == dict.fromkeys(range(5), 8)
    assert "Window" not in z._jdf.queryExecution().optimizedPlan().toString()


def walked(row, tree):
    node = depth = 0
    while tree["feature"][node] >= 0:
        node, depth = tree["left" if row[tree["feature"][node]] < tree["threshold"][node] else "right"][node], depth + 1
    return depth + anomaly._c_factor(tree["size"][node])


def test_path_lengths_are_those_of_a_plain_walk():
    import pandas as pd

    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 3)), 1)  # ties, and values on thresholds
    trees = []
    for k, rows in enumerate((200, 50, 2, 1)):
        pdf = pd.DataFrame(x[:rows], columns=list("abc")).assign(tree_id=k, _h=rng.permutation(rows))
        trees.append(anomaly._build_tree(list("abc"), 64, 7)(pdf).iloc[0])
    x[0, 0] = np.nan
    x[1, 1] = trees[0]["threshold"][0]
    want = [sum(walked(r, t) for t in trees) for r in x]
    assert anomaly.path_lengths(x, [anomaly._flat_tree(t) for t in trees]).tolist() == pytest.approx(want, rel=1e-12)


def test_forest_computes_its_rows_once(spark):
    df, seen = counted(spark, spark.range(300).select(F.col("id").alias("k"), F.col("id").cast(T.DoubleType()).alias("x")), "x")
    assert anomaly.isolation_forest(df, ["x"], "k", n_trees=5, psi=32).count() == 300
    assert seen.value == 300


def test_flags_compute_the_uploads_once(spark):
    v = spark.range(200).select(F.col("id").alias("video_id"), (F.col("id") % 7).alias("channel_id"), (F.col("id") * 10 % 370).alias("views"),
                                F.lit(3).alias("likes"), F.lit(1).alias("comment_count"))
    v, seen = counted(spark, v, "views")
    assert anomaly.detect_anomalies(v, n_trees=5).count() == 200
    assert seen.value == 200
