"""Regressions from cross products, exact splits, ranks, matching and clustering against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachlens.operators import anomaly, features, gram, matching, models
from reachlens.operators.clustering import k_means


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(8)
    n = 211
    a, b = rng.normal(size=n) * 3 + 1000, rng.normal(size=n)
    x = np.column_stack([a, b, a * 0.5 + b * 2 + rng.normal(size=n) * 0.1, np.full(n, 4.0), rng.integers(0, 2, n)])
    y = 0.3 * a - b + rng.normal(size=n) + 50
    names = [f"x{i}" for i in range(5)]
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "channel_id long, " + ", ".join(f"{c} double" for c in names) + ", growth_rate double").repartition(4)
    return x, y, names, models.growth_regression(df)


def test_least_squares_table(regression):
    x, y, names, out = regression
    z = np.column_stack([np.ones(len(y))] + [(c - c.mean()) / (c.std() or 1) for c in x.T])
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    error = ((y - z @ beta) ** 2).sum()
    free = len(y) - 5
    fit = out["fit"].first()
    total = ((y - y.mean()) ** 2).sum()
    assert fit.n == len(y) and fit.r2 == pytest.approx(1 - error / total, abs=1e-10)
    assert fit.f_stat == pytest.approx((total - error) / 4 / (error / free), rel=1e-8)
    assert fit.adj_r2 == pytest.approx(1 - error / free / (total / (len(y) - 1)), abs=1e-10)
    table = {r.term: r for r in out["ols"].collect()}
    keep = [0, 1, 2, 3, 5]
    se = np.sqrt(error / free * np.diag(np.linalg.inv(z[:, keep].T @ z[:, keep])))
    for k, s in zip(keep, se):
        row = table["const" if k == 0 else names[k - 1]]
        assert row.coef == pytest.approx(beta[k], rel=1e-6, abs=1e-9) and row.std_err == pytest.approx(s, rel=1e-6)
    vif = {r.feature: r.vif for r in out["vif"].collect()}
    keep = [0, 1, 2, 4]
    want = np.diag(np.linalg.inv(np.corrcoef(x[:, keep].T)))
    assert [vif[names[k]] for k in keep] == pytest.approx(want, rel=1e-6)


def test_ridge_and_lasso_of_all_rows(regression):
    x, y, names, out = regression
    z = np.column_stack([(c - c.mean()) / (c.std() or 1) for c in x.T])
    t = y - y.mean()
    want = np.linalg.solve(z.T @ z + np.eye(5), z.T @ t)
    assert [r.coef for r in out["ridge"].collect()] == pytest.approx(list(want), rel=1e-6, abs=1e-9)
    w = np.array([r.coef for r in out["lasso"].collect()])
    # optimality: the pull of the residual is alpha where a weight is used, and at most alpha elsewhere
    pull = z.T @ (t - z @ w) / len(t)
    assert all(p == pytest.approx(0.01 * np.sign(v), abs=1e-8) if v else abs(p) <= 0.01 + 1e-8 for p, v in zip(pull, w))
    assert {r.feature for r in out["lasso_surviving"].collect()} == {n for n, v in zip(names, w) if v}


def test_lasso_drops_features_and_empty_frames_give_no_model():
    m = gram.Moments(4, np.zeros(3), np.array([[4.0, 0, 0.01], [0, 4, 3], [0.01, 3, 9]]))
    w = gram.lasso(m, 0.01)
    assert w[0] == 0 and w[1] == pytest.approx(0.74)
    none = gram.Moments(0, np.zeros(3), np.zeros((3, 3)))
    assert not gram.ridge(none, 1.0).any() and math.isnan(gram.least_squares(none)["r2"])


def test_every_label_is_split_exactly(spark):
    rows = [(i, "a" if i % 3 else None, i) for i in range(1000)] + [(2000 + i, "few", i) for i in range(4)] + [(3000, "one", 0)]
    df = spark.createDataFrame(rows, "id long, label string, _x int").repartition(7)
    out = models.stratified_split(df, "id", "label").collect()
    assert len(out) == len(rows)
    for label in ("a", None, "few", "one"):
        own = [r for r in out if r.label == label]
        assert sum(r.is_train for r in own) == math.floor(0.8 * len(own))
    again = models.stratified_split(df.repartition(3), "id", "label").collect()
    assert {(r.id, r.is_train) for r in out} == {(r.id, r.is_train) for r in again}
    # rows with one and the same hash are told apart by key order
    same = spark.createDataFrame([(1, "a")] * 10, "id long, label string")
    assert models.stratified_split(same, "id", "label").where("is_train").count() == 8
    assert models.stratified_split(df.limit(0), "id", "label").collect() == []


def test_area_under_roc(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0.1, 0.2, 0.2, 0.5, rng.random()]), rng.randint(0, 1)) for _ in range(300)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    df = spark.createDataFrame([*rows, (None, 1), (0.3, None)], "s double, y int").repartition(5)
    assert models.area_under_roc(df, "s", "y").first().auc == pytest.approx(want, abs=1e-12)
    assert models.area_under_roc(df.where("y = 1"), "s", "y").first().auc is None


def test_report_has_accuracy_and_averages(spark):
    y = [1] * 30 + [0] * 70
    p = [1] * 20 + [0] * 10 + [1] * 5 + [0] * 65
    got = {r["class"]: r for r in models.classification_report(spark.createDataFrame(list(zip(y, p)), "label int, prediction int")).collect()}
    p0, r0, p1, r1 = 65 / 75, 65 / 70, 20 / 25, 20 / 30
    f = lambda a, b: 2 * a * b / (a + b)
    assert (got["0"].precision, got["1"].recall, got["1"].f1) == pytest.approx((p0, r1, f(p1, r1)))
    assert got["accuracy"].f1 == pytest.approx(0.85) and got["accuracy"].support == 100
    assert got["macro avg"].precision == pytest.approx((p0 + p1) / 2) and got["macro avg"].f1 == pytest.approx((f(p0, r0) + f(p1, r1)) / 2)
    assert got["weighted avg"].recall == pytest.approx(0.85) and got["weighted avg"].precision == pytest.approx(0.7 * p0 + 0.3 * p1)
    none = {r["class"]: r for r in models.classification_report(spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")).collect()}
    assert none["1"].f1 == 0 and none["macro avg"].precision == pytest.approx(0.25)


def test_unknown_level_is_an_error(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("f", 4)], "c string, x int")
    assert features.one_hot_drop_first(df, "c").columns == ["x", "c_b", "c_f"]
    with pytest.raises(Exception, match="unknown level"):
        features.one_hot_drop_first(df, "c", levels=["a", "b"]).collect()
    assert features.one_hot_drop_first(df.where("x < 4"), "c", levels=["a", "b"]).count() == 3


# matching

def free_control_is_closer(pairs, controls):
    used = {c for _, c, _, _ in pairs}
    free = sorted(p for i, p in controls if i not in used)
    return any(abs(f - pt) < abs(pc - pt) - 1e-12 for _, _, pt, pc in pairs for f in free)


@pytest.mark.parametrize("shape", ["cluster", "two clusters", "random", "few controls", "chain", "ties"])
def test_matching_ends_early_and_leaves_no_closer_control(spark, shape):
    rng = random.Random(shape)
    if shape == "cluster":
        t, c = [0.5 + i * 1e-6 for i in range(600)], [rng.random() for _ in range(900)]
    elif shape == "two clusters":
        t = [0.4 + i * 1e-6 for i in range(300)] + [0.6 + i * 1e-6 for i in range(300)]
        c = [0.45 + i * 1e-4 for i in range(150)] + [i * 1e-4 for i in range(500)] + [0.9 + i * 1e-4 for i in range(500)]
    elif shape == "random":
        t, c = [rng.random() for _ in range(300)], [rng.random() for _ in range(350)]
    elif shape == "few controls":
        t, c = [rng.random() for _ in range(300)], [rng.random() for _ in range(20)]
    elif shape == "chain":
        at, t, c = 0.0, [], []
        for k in range(120):
            at += 0.9 ** k
            (t if k % 2 else c).append(at)
        c += [100.0 + i for i in range(5)]
    else:
        t, c = [rng.choice([0.1, 0.2, 0.3]) for _ in range(100)], [rng.choice([0.1, 0.2, 0.3]) for _ in range(120)]
    treated = spark.createDataFrame([(i, float(p)) for i, p in enumerate(t)] + [(9999, None)], "channel_id long, propensity double")
    control = [(10_000 + i, float(p)) for i, p in enumerate(c)]
    got, rounds = matching.match_rounds(treated, spark.createDataFrame(control, "channel_id long, propensity double"))
    pairs = [tuple(r) for r in got.collect()]
    assert len(pairs) == min(len(t), len(c)) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
    order = sorted([(p, 0) for p in c] + [(p, 1) for p in t])
    runs = sum(a[1] == 1 and (i == 0 or order[i - 1][1] == 0) for i, a in enumerate(order))
    assert rounds <= math.log2(runs) + 2
    assert not free_control_is_closer(pairs, control)


def test_nothing_to_match(spark):
    some = spark.createDataFrame([(1, 0.5)], "channel_id long, propensity double")
    got, rounds = matching.match_rounds(some, some.limit(0))
    assert got.collect() == [] and rounds == 0


# clustering

def test_all_starts_in_one_loop(spark):
    rng = np.random.default_rng(6)
    middle = np.array([[0, 0], [10, 0], [0, 10], [10, 10], [5, 25]], float)
    x = np.concatenate([m + rng.normal(size=(60, 2)) for m in middle])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double").repartition(4)
    out, centres, cost, rounds = k_means(df, ["a", "b"], "id", 5)
    want = sum(((g - g.mean(axis=0)) ** 2).sum() for g in x.reshape(5, 60, 2))
    assert cost == pytest.approx(want, rel=1e-9) and rounds < 60
    rows = {r.id: r.cluster for r in out.collect()}
    assert all(len({rows[60 * g + i] for i in range(60)}) == 1 for g in range(5)) and len(set(rows.values())) == 5
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ten = min(KMeans(k=5, seed=42 + i, maxIter=300).fit(v).summary.trainingCost for i in range(3))
    assert cost <= ten * (1 + 1e-9)


def test_k_means_of_few_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id long, a double")
    out, _, cost, _ = k_means(df, ["a"], "id", 3, starts=2)
    assert cost == 0 and out.count() == 3
    with pytest.raises(ValueError):
        k_means(df.limit(0), ["a"], "id", 2)


def test_trees_hash_only_the_joint_sample(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("x"))
    out = anomaly.isolation_forest(df, ["x"], "k", n_trees=10, psi=64)
    assert out.count() == 5000
    rate = out.agg(F.avg(F.col("if_anomaly").cast("double"))).first()[0]
    assert rate <= 0.06
