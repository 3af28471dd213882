"""The skew-safe ordered primitive against native window functions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reachlens.operators.concentration import gini, ntile
from reachlens.operators.quantiles import exact_percentiles, order_statistics, ordered_image
from reachlens.operators.sequence import global_rank, sequence


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 4000
    # entity 0 holds a third of the rows (the hot key); values have ties and NULLs
    ent = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 60, n))
    val = rng.integers(0, 50, n).astype(float)
    val[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"e": ent.astype("int64"), "t": rng.integers(0, 500, n).astype("int64"),
                        "id": np.arange(n, dtype="int64"), "v": val})
    return spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))


@pytest.mark.parametrize("parts", [1, 7, None])
def test_sequence_matches_windows(spark, skewed, parts):
    s = sequence(skewed, "e", ["t", "id"], lags=["t"], cums=["v"], ffills=["v"], num_partitions=parts)
    w = Window.partitionBy("e").orderBy("t", "id")
    ref = skewed.select(
        "id", F.row_number().over(w).alias("r_seq"), F.lag("t").over(w).alias("r_prev"),
        F.sum(F.coalesce("v", F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r_cum"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("r_ff"))
    j = s.join(ref, "id").toPandas()
    assert len(j) == skewed.count()
    assert (j["seq"] == j["r_seq"]).all()
    assert ((j["prev_t"] == j["r_prev"]) | (j["prev_t"].isna() & j["r_prev"].isna())).all()
    assert np.allclose(j["cum_v"], j["r_cum"])
    assert ((j["last_v"] == j["r_ff"]) | (j["last_v"].isna() & j["r_ff"].isna())).all()


def test_hot_entity_is_split_over_partitions(spark, skewed):
    s = sequence(skewed.where("e = 0"), "e", ["t", "id"], num_partitions=6)
    assert s.rdd.getNumPartitions() >= 1
    # seq is a dense 1..n sequence even though the entity spans several partitions
    got = sorted(r[0] for r in s.select("seq").collect())
    assert got == list(range(1, len(got) + 1))


def test_global_rank_and_ntile(spark, skewed):
    r = global_rank(skewed, ["t", "id"], rank_col="rk", num_partitions=5).select("id", "rk")
    ref = skewed.select("id", F.row_number().over(Window.orderBy("t", "id")).alias("x"))
    assert r.join(ref, "id").where("rk != x").count() == 0
    nt = ntile(skewed.select("id", "t"), ["t", "id"], 7, "b")
    ref = skewed.select("id", F.ntile(7).over(Window.orderBy("t", "id")).alias("x"))
    assert nt.join(ref, "id").where("b != x").count() == 0


def test_exact_percentiles_match_pandas(spark, skewed):
    got = exact_percentiles(skewed, ["e"], "v", [0.25, 0.5, 0.9], ["a", "b", "c"]).toPandas().set_index("e")
    pdf = skewed.toPandas().dropna(subset=["v"])
    want = pdf.groupby("e")["v"].quantile([0.25, 0.5, 0.9]).unstack()
    for q, c in zip([0.25, 0.5, 0.9], ["a", "b", "c"]):
        assert np.allclose(got.loc[want.index, c].to_numpy(), want[q].to_numpy())


def test_gini_exact_values(spark):
    eq = spark.createDataFrame([(1.0,)] * 100, "x double")
    assert abs(gini(eq, "x").first()[0]) < 1e-9
    one = spark.createDataFrame([(0.0,)] * 99 + [(100.0,)], "x double")
    assert gini(one, "x").first()[0] == pytest.approx(0.99)
    empty = spark.createDataFrame([], "x double")
    assert gini(empty, "x").first()[0] == 0.0
    zeros = spark.createDataFrame([(0.0,)] * 3, "x double")
    assert gini(zeros, "x").first()[0] is None


def test_any_type_null_entities_and_large_integers(spark):
    big = 9007199254740993
    rows = [(None, 1, big, "a", "1.5"), (None, 2, None, None, None), (None, 3, 1, "c", "2.5"), ("x", 1, None, None, "1"), ("x", 2, 7, "z", None)]
    df = spark.createDataFrame(rows, "e string, t int, k long, s string, x string").withColumn("x", F.col("x").cast("decimal(20,2)")).withColumn("_p", F.lit(1))
    for parts in (1, 2, 5):
        got = {(r.e, r.t): (r.seq, r.prev_k, r.prev_s, r.cum_k, str(r.cum_x), r.last_s, r._p)
               for r in sequence(df, "e", ["t"], ["k", "s"], ["k", "x"], ffills=["s"], num_partitions=parts).collect()}
        assert got == {(None, 1): (1, None, None, big, "1.50", None, 1), (None, 2): (2, big, "a", big, "1.50", "a", 1),
                       (None, 3): (3, None, None, big + 1, "4.00", "a", 1), ("x", 1): (1, None, None, 0, "1.00", None, 1),
                       ("x", 2): (2, None, None, 7, "1.00", None, 1)}
    total = global_rank(df.drop("_p"), ["k", "t"], cums=["k"], num_partitions=4)
    assert max(r.cum_k for r in total.collect()) == big + 8
    assert sequence(df.limit(0), "e", ["t"], ["k"], ["k"], ffills=["k"]).collect() == []


def test_no_single_partition_over_the_input(spark, skewed):
    """Only the table of one row a partition, which is broadcast, is put in one place."""
    for s in (global_rank(skewed, ["t", "id"], num_partitions=5), global_rank(skewed, ["t", "id"], cums=["v"], num_partitions=5),
              sequence(skewed, "e", ["t", "id"], cums=["v"], num_partitions=5)):
        text = s._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in text and "Arrow" not in text and "Python" not in text
        above: list[tuple[int, str]] = []
        for line in text.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            above = [x for x in above if x[0] < depth] + [(depth, line)]
            if "SinglePartition" in line:
                assert any("BroadcastExchange" in x for _, x in above), text


def test_image_keeps_the_order_of_doubles(spark):
    vals = [0.0, -0.0, 1.0, 1.5, 2.0, 3.0, 4.0, 0.1, 1e-300, 5e-324, 2.0 ** -1022, np.nextafter(2.0 ** -1022, 0), 1.7976931348623157e308,
            float("inf"), 2.0 ** 53, 2.0 ** 53 + 2, np.nextafter(8.0, 0), np.nextafter(8.0, 9), 1e22, 123456.789, float("nan")]
    vals = [float(v) for v in vals] + [-float(v) for v in vals if v == v] + [float(2.0 ** e) for e in range(-1074, 1024, 37)]
    rows = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double").select("v", ordered_image(F.col("v")).alias("im")).collect()
    assert [r.im for r in rows if r.v is None] == [None]
    bits = {}
    for r in rows:
        if r.v is not None and r.v == r.v:
            raw = int(np.float64(abs(r.v)).view(np.int64))
            assert r.im == (raw if r.v >= 0 else -raw), r
            bits[r.v] = r.im
    assert max(bits.values()) < [r.im for r in rows if r.v is not None and r.v != r.v][0]


def test_order_statistics_of_hard_values(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), np.repeat([7.0, -7.0, 0.0], 50), 1e15 + np.arange(100)])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(vals)) % 3 == 0, "a", None), "v": vals})
    df = spark.createDataFrame([(g, float(v)) for g, v in pdf.itertuples(index=False)] + [("empty", None)], "g string, v double")
    got = order_statistics(df, ["g"], "v", F.array(F.lit(0), F.lit(5), F.col("n") - 1, F.floor(F.col("n") / 2), F.col("n")))
    out = {(r.g, r.i): r.v for r in got.collect()}
    for g in ("a", None):
        own = np.sort(pdf.loc[pdf.g == g if g else pdf.g.isna(), "v"].to_numpy())
        assert [out[g, i] for i in range(4)] == [own[0], own[5], own[-1], own[len(own) // 2]]
        assert (g, 4) not in out
    assert {k[0] for k in out} == {"a", None}


def test_percentiles_of_groups_and_of_all(spark, skewed):
    pdf = skewed.toPandas().dropna(subset=["v"])
    g = exact_percentiles(skewed, [], "v", [0.0, 0.37, 1.0], ["lo", "mid", "hi"]).first()
    assert (g["lo"], g["hi"]) == (pdf["v"].min(), pdf["v"].max())
    assert g["mid"] == pytest.approx(pdf["v"].quantile(0.37))
    none = exact_percentiles(skewed.limit(0), [], "v", [0.5], ["m"]).collect()
    assert len(none) == 1 and none[0].m is None
    assert exact_percentiles(skewed.limit(0), ["e"], "v", [0.5]).collect() == []
