"""Models on creator and upload features.

Fitting uses ``pyspark.ml`` estimators (distributed, iterative over the
feature frame). Features are standardised with population statistics taken
from one aggregate, matching the usual scaler convention. Only fitted model
parameters and k x k summaries (coefficients, correlation matrices, cluster
centres) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.functions.numerics import f_sf, t_sf_two_sided
from reachlens.operators import gram
from reachlens.operators.clustering import k_means
from reachlens.operators.quantiles import order_statistics
from reachlens.operators.sequence import global_rank, sequence, with_group_count
from reachlens.session import materialize, stored_for_fit

NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
# Segment names produced by the centroid labelling rule.
SEGMENT_NAMES = ["Grinders", "One-Hit Wonders", "Community Builders", "Algorithm Surfers", "Rising Stars"]
CLUSTER_COLS = ["avg_weekly_uploads", "avg_engagement", "avg_views", "gap_std", "upload_x_engagement",
                "sub_growth_proxy"]


# helpers ---------------------------------------------------------------------
def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in frame order, minus ``exclude``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def hash_split(df: DataFrame, key: str, seed: int = 42, train_pct: int = 80, col: str = "is_train") -> DataFrame:
    """Deterministic split: pmod(xxhash64(key, seed), 100) < train_pct.
    A uniform hash keeps every label close to the requested share."""
    return df.withColumn(col, F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < train_pct)


def stratified_split(df: DataFrame, key: str, label: str, train_share: float = 0.8, seed: int = 42, col: str = "is_train") -> DataFrame:
    """Deterministic split in which floor(train_share * n) rows of each label train.

    The rows with the smallest key hashes train; the hash at the cut comes from
    ``order_statistics``, so no label's rows are sorted or put in one task. Rows
    that share that hash go in key order. A NULL label is a label."""
    h = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 12).cast("double")  # 52 bits: exact as a double
    rows = df.withColumn("_h", h)
    cut = order_statistics(rows, [label], "_h", F.array(F.floor(F.col("n") * train_share) - 1))
    cut = cut.select(F.struct(F.col(label).alias("l")).alias("_l"), F.col("v").alias("_cut"), (F.col("tie") + 1).alias("_need"))
    # one row a label; the struct joins NULL with NULL
    rows = rows.withColumn("_l", F.struct(F.col(label).alias("l"))).join(cut, "_l", "left")
    at_cut = F.coalesce(F.col("_h") == F.col("_cut"), F.lit(False))
    tied = rows.where(at_cut).withColumn(col, F.row_number().over(Window.partitionBy("_l").orderBy(key)) <= F.col("_need"))
    rest = rows.where(~at_cut).withColumn(col, F.coalesce(F.col("_h") < F.col("_cut"), F.lit(False)))
    return rest.unionByName(tied).select(*df.columns, col)


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``auc``: the chance that a positive row scores higher than a negative one, ties half (Mann-Whitney).

    Rows are counted by distinct score; average ranks come from prefix counts
    over the scores (``global_rank``), so ties of any size and any number of
    rows stay distributed. Without both labels it is NULL; rows with a NULL
    score or label are left out."""
    d = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("int").alias("_y")).dropna()
    by_score = d.groupBy("_s").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    r = global_rank(by_score, ["_s"], cums=["neg"], rank_col="_r")
    # negatives below a positive, and half of those beside it
    below = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)
    return r.agg(F.try_divide(F.sum(below), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "", fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std for each column (std 0 -> 0), of ``fit`` if given, else of ``df``."""
    stats = (df if fit is None else fit).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        z = F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(F.lit(0.0))
        j = j.withColumn(c + suffix, z)
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def _assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# M2-M5 -----------------------------------------------------------------------
GROWTH_EXCLUDE = ["channel_id", "channel_name", "country", "growth_rate", "total_views", "earnings_min",
                  "earnings_max"]


def growth_moments(feat: DataFrame, target: str = "growth_rate", exclude: Sequence[str] = GROWTH_EXCLUDE, folds: int = 5,
                   order_key: str = "channel_id") -> tuple[DataFrame, list[str], float]:
    """Rows with standardised features, the target less its mean (``_y``) and ``fold``: contiguous folds in key order, as
    an unshuffled k-fold split would cut them. Also the features' names and the target's mean. NULL features count as
    0; rows without a target are left out."""
    cols = numeric_columns(feat, list(exclude))
    d = feat.select(order_key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols],
                    F.col(target).cast("double").alias("_y")).where(F.col("_y").isNotNull())
    # the rank stores the rows, so that the features are computed once
    r = with_group_count(global_rank(d, [order_key], rank_col="_r"), [], "_n")
    r = r.withColumn("fold", F.floor((F.col("_r") - 1) * folds / F.col("_n")).cast("int"))
    # stored: means and moments read plain columns, the rank is not put together anew for each
    r = materialize(r.select(order_key, "fold", *cols, "_y"), "growth")
    z, means, devs = gram.scaled(r, [*cols, "_y"])
    return z.withColumn("_y", F.col("_y") * F.lit(float(devs[-1]))).select(order_key, "fold", *cols, "_y"), cols, float(means[-1])


def growth_regression(feat: DataFrame, target: str = "growth_rate", exclude: Sequence[str] = GROWTH_EXCLUDE,
                      ridge_alpha: float = 1.0, lasso_alpha: float = 0.01, folds: int = 5,
                      order_key: str = "channel_id") -> dict[str, DataFrame]:
    """OLS (with standard errors and p-values) and VIF on standardised
    features, ridge and lasso coefficients, and contiguous k-fold CV R^2, all
    from the cross products by fold (``gram``). A fold's models are
    scaled and fitted by the other folds alone.

    Returns frames: ``ols`` (term, coef, std_err, t, p_value), ``fit`` (n, r2,
    adj_r2, f_stat, f_p_value), ``vif`` (feature, vif), ``ridge`` / ``lasso``
    (feature, coef), ``lasso_surviving`` (non-zero lasso coefficients by
    |coef|), ``cv`` (model, cv_r2)."""
    spark = feat.sparkSession
    z, cols, mean = growth_moments(feat, target, exclude, folds, order_key)
    parts = gram.moments(z, [*cols, "_y"], "fold")
    width = len(cols) + 1
    total = sum(parts.values(), gram.Moments(0, np.zeros(width), np.zeros((width, width))))

    fit = gram.least_squares(total)
    fit["coef"][0] += mean
    t = [float(c / e) if e > 0 else float("nan") for c, e in zip(fit["coef"], fit["std_err"])]
    ols_df = spark.createDataFrame([(term, float(c), float(e), v, float(t_sf_two_sided(v, fit["df"])))
                                    for term, c, e, v in zip(["const", *cols], fit["coef"], fit["std_err"], t)],
                                   "term string, coef double, std_err double, t double, p_value double")
    fit_df = spark.createDataFrame([(fit["n"], float(fit["r2"]), float(fit["adj_r2"]), float(fit["f"]), float(f_sf(fit["f"], fit["rank"], fit["df"])))],
                                   "n long, r2 double, adj_r2 double, f_stat double, f_p_value double")

    def named(values, first=()) -> list[tuple]:
        return [*first, *((c, float(v)) for c, v in zip(cols, values))]

    models = {"ridge": lambda m: gram.ridge(m, ridge_alpha), "lasso": lambda m: gram.lasso(m, lasso_alpha)}
    out = {name: spark.createDataFrame(named(fitted(total)), "feature string, coef double") for name, fitted in models.items()}
    cv = []
    for name, fitted in models.items():
        scores = []
        for part in parts.values():
            rest = total - part
            scores.append(gram.r_squared(part, gram.unscaled(rest, fitted(rest))))
        cv.append((name, float(np.mean(scores)) if scores else float("nan")))
    return {"ols": ols_df, "fit": fit_df, "vif": spark.createDataFrame(named(gram.inflation(total), [("const", 1.0)]), "feature string, vif double"),
            **out, "lasso_surviving": out["lasso"].where(F.col("coef") != 0).orderBy(F.abs("coef").desc()),
            "cv": spark.createDataFrame(cv, "model string, cv_r2 double")}


# M7 / M8 / M9 ----------------------------------------------------------------
def segment_creators(feat: DataFrame, k: int = 5, seed: int = 42, n_init: int = 10,
                     cols: Sequence[str] = CLUSTER_COLS, key: str = "channel_id") -> tuple[DataFrame, DataFrame]:
    """K-means on standardised features, best of ``n_init`` starts by cost, all in
    one loop; returns (rows with ``cluster`` and ``segment``, cluster profiles)."""
    d = feat.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    z = standardize(d, cols, "_z").checkpoint()
    out = k_means(z, [c + "_z" for c in cols], key, k, starts=n_init, seed=seed)[0].select(key, *cols, "cluster")
    prof = cluster_profiles(out, "cluster", cols)
    labels = segment_labels(prof, "cluster")
    # k rows: bounded by the number of clusters
    return out.join(F.broadcast(labels), "cluster"), prof


def cluster_profiles(df: DataFrame, group: str, cols: Sequence[str] = CLUSTER_COLS) -> DataFrame:
    """Mean of each feature per group."""
    return df.groupBy(group).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("size"))


def _avg_rank(col: str) -> F.Column:
    """Average-tie ascending rank over a k-row frame."""
    w = Window.orderBy(col)
    ties = Window.partitionBy(col)
    return F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def segment_labels(profiles: DataFrame, group: str) -> DataFrame:
    """Name each group from the ranks of its centroid (M8). ``profiles``
    has one row per group, so the rank windows see k rows."""
    p = profiles.select(group, "avg_views",
                        _avg_rank("avg_weekly_uploads").alias("upload_rank"),
                        _avg_rank("avg_engagement").alias("engage_rank"),
                        _avg_rank("sub_growth_proxy").alias("growth_rank"))
    med = profiles.agg(F.median("avg_views").alias("_med"))
    p = p.crossJoin(F.broadcast(med))
    name = (F.when((F.col("upload_rank") >= 4) & (F.col("growth_rank") <= 2), SEGMENT_NAMES[0])
            .when((F.col("growth_rank") >= 4) & (F.col("engage_rank") <= 2), SEGMENT_NAMES[3])
            .when(F.col("engage_rank") >= 4, SEGMENT_NAMES[2])
            .when((F.col("avg_views") > F.col("_med")) & (F.col("growth_rank") <= 2), SEGMENT_NAMES[1])
            .otherwise(SEGMENT_NAMES[4]))
    return p.select(group, "upload_rank", "engage_rank", "growth_rank", name.alias("segment"))


def pca_projection(feat: DataFrame, cols: Sequence[str] = CLUSTER_COLS, k: int = 2,
                   key: str = "channel_id") -> tuple[DataFrame, DataFrame]:
    """2-D PCA of standardised features; each component's sign is fixed so
    its largest loading is positive. Returns (projection, explained variance)."""
    d = feat.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    z = _assemble(standardize(d, cols, "_z"), [c + "_z" for c in cols])
    m = PCA(k=k, inputCol="features", outputCol="_pc").fit(z)
    pcs = m.pc.toArray()
    signs = [1.0 if pcs[np.argmax(np.abs(pcs[:, j])), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array("_pc")
    proj = m.transform(z).select(key, *[(arr[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)])
    ev = feat.sparkSession.createDataFrame(
        [(f"pc{j + 1}", float(v)) for j, v in enumerate(m.explainedVariance)], "component string, explained_variance double")
    return proj, ev


# M11 / M12 -------------------------------------------------------------------
VIDEO_FEATURES = ["subscribers", "avg_weekly_uploads", "hist_avg_views", "days_since_last", "publish_hour",
                  "publish_dow", "title_len", "duration_seconds"]


def train_video_predictor(feat: DataFrame, max_iter: int = 200, seed: int = 42,
                          key: str = "video_id") -> dict[str, DataFrame]:
    """Boosted trees on log1p(views) (200 trees, step 0.05, depth 5,
    row/column subsampling 0.8); MAPE on the view scale and RMSE on the log
    scale over a hash hold-out; feature importances."""
    # the fit and both results read it many times
    d = stored_for_fit(hash_split(_assemble(feat, VIDEO_FEATURES), key, seed))
    gbt = GBTRegressor(featuresCol="features", labelCol="log_views", maxIter=max_iter, stepSize=0.05, maxDepth=5,
                       subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    m = gbt.fit(d.where("is_train"))
    pred = m.transform(d.where(~F.col("is_train")))
    metrics = pred.agg(
        F.avg(F.try_divide(F.abs(F.expm1("log_views") - F.expm1("prediction")), F.abs(F.expm1("log_views")))).alias("mape"),
        F.sqrt(F.avg(F.pow(F.col("log_views") - F.col("prediction"), 2))).alias("rmse"),
        F.count(F.lit(1)).alias("n_test"))
    imp = feat.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(VIDEO_FEATURES, m.featureImportances.toArray())],
        "feature string, importance double").orderBy(F.desc("importance"))
    test = d.where(~F.col("is_train")).drop("features", "is_train")
    return {"metrics": metrics, "importance": imp, "model": m, "test": test}


def permutation_importance(model, test: DataFrame, features: Sequence[str], label: str, key: str,
                           seed: int = 42) -> DataFrame:
    """Increase of hold-out RMSE when one feature's values are shuffled across
    the rows (M12). The shuffle gives row i (in key order) the value of row i
    in the feature's hash order: one rank of the rows, one of all (feature,
    hash) pairs, and an equi-join on the rank; all features are scored in one
    pass, and no pairs are formed."""
    features = list(features)
    base = test.select(key, label, *[F.col(c).cast("double").alias(c) for c in features]).checkpoint()
    by_key = global_rank(base, [key], rank_col="_rk")
    donors = base.select(key, F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).alias("_perm")) for i, c in enumerate(features)])).alias("_d")) \
        .select(key, "_d._f", "_d._perm").withColumn("_h", F.xxhash64(F.col(key), F.lit(seed), F.col("_f")))
    donors = sequence(donors, ["_f"], ["_h", key], seq_col="_rk").select("_rk", "_f", "_perm")
    rows = by_key.join(donors, "_rk").select(label, "_f", *[F.when(F.col("_f") == i, F.col("_perm")).otherwise(F.col(c)).alias(c) for i, c in enumerate(features)])
    # the rows as they are, as feature -1
    rows = rows.unionByName(base.select(label, F.lit(-1).alias("_f"), *features))
    pred = model.transform(_assemble(rows, features))
    rmse = pred.groupBy("_f").agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).alias("rmse")).checkpoint()
    ref = rmse.where("_f = -1").select(F.col("rmse").alias("_base"))
    names = F.array(*map(F.lit, features))
    return rmse.where("_f >= 0").crossJoin(F.broadcast(ref)).select(
        F.get(names, F.col("_f")).alias("feature"), (F.col("rmse") - F.col("_base")).alias("rmse_increase"), F.col("rmse").alias("permuted_rmse"),
        F.col("_base").alias("baseline_rmse")).orderBy(F.desc("rmse_increase"))


# M18-M20 ---------------------------------------------------------------------
def train_churn_model(feat: DataFrame, max_iter: int = 200, seed: int = 42, exclude_leaky: bool = False,
                      key: str = "channel_id", label: str = "churned") -> dict:
    """Scaled logistic regression (C=1) and boosted trees (200, 0.05, depth 4)
    on the churn features; AUC of each on a hold-out stratified by label, the better model,
    GBT importances, a per-class report and churn scores for every creator.
    ``exclude_leaky`` drops days_since_last, which defines the label."""
    drop = [key, label] + (["days_since_last"] if exclude_leaky else [])
    cols = numeric_columns(feat, drop)
    d = feat.select(key, F.col(label).cast("double").alias("label"),
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    # one row per creator, reused by every fit and evaluation: materialise once
    d = stored_for_fit(stratified_split(_assemble(d, cols, "raw"), key, "label", seed=seed))
    train, test = d.where("is_train"), d.where(~F.col("is_train"))
    n_train = train.count()
    lr = Pipeline(stages=[
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / max(n_train, 1),
                           elasticNetParam=0.0, standardization=False, maxIter=500)]).fit(train)
    gbt = GBTClassifier(featuresCol="raw", labelCol="label", maxIter=max_iter, stepSize=0.05, maxDepth=4,
                        seed=seed).fit(train)
    chance = vector_to_array("probability")[1].alias("p")
    gbt_pred = gbt.transform(test)
    lr_auc, gbt_auc = (area_under_roc(p.select(chance, "label"), "p", "label").first()[0] for p in (lr.transform(test), gbt_pred))
    spark = feat.sparkSession
    aucs = spark.createDataFrame([("logistic", lr_auc), ("gbt", gbt_auc)], "model string, auc double")
    imp = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, gbt.featureImportances.toArray())],
                                "feature string, importance double").orderBy(F.desc("importance"))
    scores = gbt.transform(d).select(key, vector_to_array("probability")[1].alias("churn_probability"))
    scores = scores.join(feat.select(key, label, *[c for c in ("gap_trend", "engagement_trend", "days_since_last")
                                                   if c in feat.columns]), key)
    return {"auc": aucs, "best_model": "gbt" if (gbt_auc or 0) > (lr_auc or 0) else "logistic",
            "importance": imp, "report": classification_report(gbt_pred, "label", "prediction"),
            "scores": scores, "gbt": gbt, "logistic": lr}


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with rows for accuracy, macro and weighted
    averages, from one confusion aggregate (M19)."""
    conf = pred.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).count()
    per = conf.groupBy().agg(*[
        F.sum(F.when((F.col("y") == c) & (F.col("p") == c), F.col("count")).otherwise(0)).alias(f"tp{c}")
        for c in (0, 1)], *[
        F.sum(F.when(F.col("p") == c, F.col("count")).otherwise(0)).alias(f"pp{c}") for c in (0, 1)], *[
        F.sum(F.when(F.col("y") == c, F.col("count")).otherwise(0)).alias(f"sup{c}") for c in (0, 1)])
    rows = []
    for c in (0, 1):
        prec = F.try_divide(F.col(f"tp{c}").cast("double"), F.col(f"pp{c}"))
        rec = F.try_divide(F.col(f"tp{c}").cast("double"), F.col(f"sup{c}"))
        f1 = F.coalesce(F.try_divide(2 * prec, 1 + F.try_divide(prec, rec)), F.lit(0.0))
        rows.append(F.struct(F.lit(str(c)).alias("class"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), F.col(f"sup{c}").alias("support")))
    n = F.col("sup0") + F.col("sup1")
    share = F.try_divide((F.col("tp0") + F.col("tp1")).cast("double"), n)
    rows.append(F.struct(F.lit("accuracy").alias("class"), share.alias("precision"), share.alias("recall"), share.alias("f1"), n.alias("support")))

    def mean(name: str, weighted: bool):
        # a class without predictions or rows counts with 0
        zero, one = (F.coalesce(rows[c][name], F.lit(0.0)) for c in (0, 1))
        return F.try_divide(zero * F.col("sup0") + one * F.col("sup1"), n) if weighted else (zero + one) / 2

    for label, weighted in (("macro avg", False), ("weighted avg", True)):
        rows.append(F.struct(F.lit(label).alias("class"), *[mean(x, weighted).alias(x) for x in ("precision", "recall", "f1")], n.alias("support")))
    return per.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def at_risk_creators(scores: DataFrame, channels: DataFrame, top: int = 20, key: str = "channel_id") -> DataFrame:
    """Top-N creators by churn probability with their attributes."""
    shown = [c for c in ("channel_name", "category", "country", "subscribers") if c in channels.columns]
    j = scores.join(channels.select(key, *shown), key, "left")
    return j.orderBy(F.desc("churn_probability"), key).limit(top)


# X3 --------------------------------------------------------------------------
PROPENSITY_FEATURES = ["subscribers", "avg_weekly_uploads", "avg_views", "avg_engagement", "video_count"]


def propensity_scores(channels: DataFrame, videos: DataFrame, treated_quantile: float = 0.8,
                      key: str = "channel_id") -> DataFrame:
    """Per creator: upload stats, treatment = engagement in the top
    (1 - q) share, and the logistic propensity P(treated | standardised
    features) with an L2 penalty equivalent to C=1."""
    from reachlens.functions import columns as C
    from reachlens.operators.causal import flag_top_quantile

    st = videos.groupBy(key).agg(F.avg("views").alias("avg_views"),
                                 F.avg(C.engagement_rate_or_zero()).alias("avg_engagement"),
                                 F.count("video_id").alias("video_count"))
    df = channels.select(key, "subscribers", "avg_weekly_uploads").join(st, key, "left")
    df = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in PROPENSITY_FEATURES])
    df = flag_top_quantile(df, "avg_engagement", treated_quantile)
    # one row per creator, used by several actions (count, fit, score): materialise once
    z = _assemble(standardize(df, PROPENSITY_FEATURES, "_z"), [c + "_z" for c in PROPENSITY_FEATURES])
    z = stored_for_fit(z)
    n = z.count()
    m = LogisticRegression(featuresCol="features", labelCol="treated", regParam=1.0 / max(n, 1),
                           elasticNetParam=0.0, standardization=False, maxIter=500).fit(
        z.withColumn("treated", F.col("treated").cast("double")))
    return m.transform(z.withColumn("treated", F.col("treated").cast("double"))).select(
        key, *PROPENSITY_FEATURES, F.col("treated").cast("int").alias("treated"),
        vector_to_array("probability")[1].alias("propensity"))
