"""Registered queries: experiment design, factorial analysis and causal estimates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reachlens.functions.numerics import norm_ppf
from reachlens.operators import causal as CA
from reachlens.operators import experiments as EX
from reachlens.operators.timeseries import week_end
from reachlens.plans.oracle import with_adapter
from reachlens.plans.registry import register
from reachlens.sources import adapters as A

MDE_PCTS = (0.05, 0.10, 0.30)
ALPHA, POWER = 0.05, 0.80
TREATED_QUANTILE = 0.95
CUT = dt.date(1998, 6, 7)          # first post-period week of the counterfactual queries
CUT_SQL = "DATE '1998-06-07'"


def _prepost(spark, sf_dir):
    return CA.pre_post_means(A.videos(spark, sf_dir))


_PREPOST_CTE = """
mid AS (SELECT quantile_cont(epoch_us(publish_time)::DOUBLE, 0.5) AS m FROM videos),
pp AS (SELECT channel_id, AVG(CASE WHEN epoch_us(publish_time) < m THEN views END) AS pre_views,
              AVG(CASE WHEN epoch_us(publish_time) >= m THEN views END) AS post_views
       FROM videos, mid GROUP BY channel_id
       HAVING pre_views IS NOT NULL AND post_views IS NOT NULL),
th AS (SELECT quantile_cont(pre_views, 0.95) AS t FROM pp),
tr AS (SELECT pp.*, CAST(pre_views >= t AS INTEGER) AS treated FROM pp, th)"""


@register("a27_pre_post_means", with_adapter("SELECT * FROM pp", _PREPOST_CTE),
          round_cols=["pre_views", "post_views"])
def a27(spark, sf_dir):
    return _prepost(spark, sf_dir)


@register("a28_treatment_flag", with_adapter("SELECT * FROM tr", _PREPOST_CTE),
          round_cols=["pre_views", "post_views"])
def a28(spark, sf_dir):
    return CA.flag_top_quantile(_prepost(spark, sf_dir), "pre_views", TREATED_QUANTILE)


@register("x1_trending_did", with_adapter("""
SELECT (AVG(y) FILTER (WHERE x1 = 1) - AVG(x2) FILTER (WHERE x1 = 1))
       - (AVG(y) FILTER (WHERE x1 = 0) - AVG(x2) FILTER (WHERE x1 = 0)) AS did_estimate,
       COUNT(*) FILTER (WHERE x1 = 1) AS treated_count, COUNT(*) FILTER (WHERE x1 = 0) AS control_count,
       ANY_VALUE(b1) AS treated_coef, ANY_VALUE(se) AS treated_se, ANY_VALUE(b1) / ANY_VALUE(se) AS treated_t
FROM d, (SELECT b1, SQRT((s.yy - b1 * s.x1y - b2 * s.x2y) / (s.n - 3) * s.x2x2 / (s.x1x1 * s.x2x2 - s.x1x2 * s.x1x2)) AS se
         FROM (SELECT s.*, (s.x2x2 * s.x1y - s.x1x2 * s.x2y) / (s.x1x1 * s.x2x2 - s.x1x2 * s.x1x2) AS b1,
                      (s.x1x1 * s.x2y - s.x1x2 * s.x1y) / (s.x1x1 * s.x2x2 - s.x1x2 * s.x1x2) AS b2
               FROM (SELECT COUNT(*) AS n, regr_sxx(x1, x1) AS x1x1, regr_sxx(x2, x2) AS x2x2,
                            regr_sxy(x1, x2) AS x1x2, regr_sxy(y, x1) AS x1y, regr_sxy(y, x2) AS x2y,
                            regr_syy(y, y) AS yy FROM d) s) s)""", _PREPOST_CTE + """,
d AS (SELECT treated::DOUBLE AS x1, ln(1 + pre_views) AS x2, ln(1 + post_views) AS y FROM tr)"""),
          round_cols=["did_estimate", "treated_coef", "treated_se", "treated_t"])
def x1(spark, sf_dir):
    pp = CA.flag_top_quantile(_prepost(spark, sf_dir), "pre_views", TREATED_QUANTILE)
    return CA.trending_did(pp, with_p=False)


def _z(p):
    return repr(norm_ppf(p))


_GRID = " UNION ALL ".join(f"SELECT {m}::DOUBLE AS mde_pct, {ALPHA}::DOUBLE AS alpha, {POWER}::DOUBLE AS power, "
                           f"{_z(1 - ALPHA / 2)} AS z_alpha, {_z(POWER)} AS z_power" for m in MDE_PCTS)


@register("x6_power_grid", with_adapter("""
SELECT category, baseline, std_estimate, mde_pct, alpha, power, baseline * mde_pct AS minimum_detectable_effect,
       baseline * mde_pct / std_estimate AS cohens_d,
       CAST(CEIL(2 * POW((z_alpha + z_power) / (baseline * mde_pct / std_estimate), 2) + POW(z_alpha, 2) / 4)
            AS BIGINT) AS n_per_group,
       2 * CAST(CEIL(2 * POW((z_alpha + z_power) / (baseline * mde_pct / std_estimate), 2) + POW(z_alpha, 2) / 4)
                AS BIGINT) AS total_n,
       CAST(CEIL(2 * CAST(CEIL(2 * POW((z_alpha + z_power) / (baseline * mde_pct / std_estimate), 2)
                               + POW(z_alpha, 2) / 4) AS BIGINT) / 5000.0) AS BIGINT) AS runtime_days
FROM (SELECT category, AVG(avg_weekly_uploads) AS baseline, STDDEV_SAMP(avg_weekly_uploads) AS std_estimate
      FROM channels GROUP BY category), g""", f"g AS ({_GRID})"),
          round_cols=["baseline", "std_estimate", "minimum_detectable_effect", "cohens_d", "mde_pct", "alpha",
                      "power"])
def x6(spark, sf_dir):
    return EX.power_grid(A.channels(spark, sf_dir), "avg_weekly_uploads", "category", MDE_PCTS, (ALPHA,), (POWER,))


@register("x7_power_curve")
def x7(spark, sf_dir):
    g = EX.power_grid(A.channels(spark, sf_dir), "avg_weekly_uploads", "category", MDE_PCTS, (ALPHA,), (POWER,))
    return EX.power_curve(g, [0.1, 0.2, 0.3, 0.5, 0.8])


def _factorial(spark, sf_dir):
    v = A.videos(spark, sf_dir)
    return v.select((F.weekday("publish_time") >= 5).cast("int").alias("weekend"),
                    F.col("title").isin("1-URGENT", "2-HIGH").cast("int").alias("high_priority"),
                    "views")


_FACT_CTE = """
fx AS (SELECT CAST(isodow(publish_time) >= 6 AS INTEGER) AS a,
              CAST(title IN ('1-URGENT', '2-HIGH') AS INTEGER) AS b, views::DOUBLE AS y FROM videos)"""


@register("x9_two_way_anova", with_adapter("""
SELECT 'weekend' AS term, rss_b - rss_add AS sum_sq, 1.0::DOUBLE AS df,
       (rss_b - rss_add) / (rss_full / (n - 4)) AS F FROM r
UNION ALL SELECT 'high_priority', rss_a - rss_add, 1.0::DOUBLE, (rss_a - rss_add) / (rss_full / (n - 4)) FROM r
UNION ALL SELECT 'weekend:high_priority', rss_add - rss_full, 1.0::DOUBLE,
                 (rss_add - rss_full) / (rss_full / (n - 4)) FROM r
UNION ALL SELECT 'Residual', rss_full, (n - 4)::DOUBLE, NULL FROM r""", _FACT_CTE + """,
cm AS (SELECT a, b, AVG(y) AS m FROM fx GROUP BY a, b),
am AS (SELECT a, AVG(y) AS m FROM fx GROUP BY a),
bm AS (SELECT b, AVG(y) AS m FROM fx GROUP BY b),
reg AS (SELECT COUNT(*) AS n, regr_sxx(a, a) AS aa, regr_sxx(b, b) AS bb, regr_sxy(a, b) AS ab,
               regr_sxy(y, a) AS ay, regr_sxy(y, b) AS by_, regr_syy(y, y) AS yy FROM fx),
r AS (SELECT reg.n,
             (SELECT SUM((y - cm.m) * (y - cm.m)) FROM fx JOIN cm USING (a, b)) AS rss_full,
             (SELECT SUM((y - am.m) * (y - am.m)) FROM fx JOIN am USING (a)) AS rss_a,
             (SELECT SUM((y - bm.m) * (y - bm.m)) FROM fx JOIN bm USING (b)) AS rss_b,
             yy - ((bb * ay - ab * by_) / (aa * bb - ab * ab)) * ay - ((aa * by_ - ab * ay) / (aa * bb - ab * ab)) * by_
               AS rss_add
      FROM reg)"""), round_cols={"sum_sq": -4, "F": 6})
def x9(spark, sf_dir):
    return EX.two_way_anova(_factorial(spark, sf_dir), "weekend", "high_priority", "views", with_p=False)


@register("a29_cell_means", with_adapter("""
SELECT a AS weekend, AVG(y) FILTER (WHERE b = 0) AS high_priority_0, AVG(y) FILTER (WHERE b = 1) AS high_priority_1
FROM fx GROUP BY a""", _FACT_CTE), round_cols=["high_priority_0", "high_priority_1"])
def a29(spark, sf_dir):
    return EX.cell_means(_factorial(spark, sf_dir), "weekend", "high_priority", "views")


@register("x10_interaction_contrast", with_adapter("""
SELECT m00, m01, m10, m11, (m11 - m10) - (m01 - m00) AS interaction FROM (
  SELECT AVG(y) FILTER (WHERE a = 0 AND b = 0) AS m00, AVG(y) FILTER (WHERE a = 0 AND b = 1) AS m01,
         AVG(y) FILTER (WHERE a = 1 AND b = 0) AS m10, AVG(y) FILTER (WHERE a = 1 AND b = 1) AS m11 FROM fx)""",
    _FACT_CTE), round_cols=["m00", "m01", "m10", "m11", "interaction"])
def x10(spark, sf_dir):
    return EX.interaction_contrast(_factorial(spark, sf_dir), "weekend", "high_priority", "views")


def category_weekly(spark, sf_dir):
    """Weekly views of each category (y) against the weekly views of all
    other categories (x)."""
    v = A.videos(spark, sf_dir)
    c = A.channels(spark, sf_dir, v).select("channel_id", "category")
    wk = v.join(c, "channel_id").groupBy("category", week_end("publish_time").alias("week_end")) \
        .agg(F.sum("views").alias("y"))
    tot = wk.groupBy("week_end").agg(F.sum("y").alias("_t"))
    return wk.join(tot, "week_end").select("category", "week_end", "y", (F.col("_t") - F.col("y")).alias("x"))


_CAT_CTE = """
cw AS (SELECT c.category, CAST(date_trunc('week', v.publish_time) AS DATE) + 6 AS week_end, SUM(v.views) AS y
       FROM videos v JOIN channels c USING (channel_id) GROUP BY 1, 2),
ser2 AS (SELECT cw.category, cw.week_end, CAST(cw.y AS BIGINT) AS y, CAST(t.t - cw.y AS BIGINT) AS x
         FROM cw JOIN (SELECT week_end, SUM(y) AS t FROM cw GROUP BY 1) t USING (week_end))"""


@register("x11_counterfactual", with_adapter(f"""
SELECT s.category, s.week_end, s.y, s.x, f.n_pre, f.a + f.b * s.x AS counterfactual,
       f.a + f.b * s.x - {_z(0.975)} * SQRT(f.s2 * (1 + 1.0 / f.n_pre + POW(s.x - f.xbar, 2) / f.sxx)) AS lower,
       f.a + f.b * s.x + {_z(0.975)} * SQRT(f.s2 * (1 + 1.0 / f.n_pre + POW(s.x - f.xbar, 2) / f.sxx)) AS upper,
       s.y - (f.a + f.b * s.x) AS effect,
       SUM(s.y - (f.a + f.b * s.x)) OVER (PARTITION BY s.category ORDER BY s.week_end
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_effect
FROM ser2 s JOIN f USING (category) WHERE s.week_end >= {CUT_SQL}""", _CAT_CTE + f""",
f AS (SELECT category, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, CAST(regr_count(y, x) AS BIGINT) AS n_pre,
             regr_avgx(y, x) AS xbar, regr_sxx(y, x) AS sxx,
             (regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (regr_count(y, x) - 2) AS s2
      FROM ser2 WHERE week_end < {CUT_SQL} GROUP BY category)"""),
          round_cols=["counterfactual", "lower", "upper", "effect", "cum_effect"], digits=2)
def x11(spark, sf_dir):
    return CA.pre_post_counterfactual(category_weekly(spark, sf_dir), "category", "week_end", "y", "x", CUT)


@register("x12_did_prepost", with_adapter(f"""
SELECT category, n_pre, n_post, pre_mean, post_mean, ctrl_pre, ctrl_post,
       (post_mean - pre_mean) - (ctrl_post - ctrl_pre) AS did_estimate,
       ((post_mean - pre_mean) - (ctrl_post - ctrl_pre)) / pre_mean * 100 AS pct_lift,
       (post_mean - pre_mean) / SQRT(((n_post - 1) * v1 + (n_pre - 1) * v0) / (n_pre + n_post - 2)
                                      * (1.0 / n_post + 1.0 / n_pre)) AS t_statistic
FROM (SELECT category,
             COUNT(*) FILTER (WHERE week_end < {CUT_SQL}) AS n_pre, COUNT(*) FILTER (WHERE week_end >= {CUT_SQL}) AS n_post,
             AVG(y) FILTER (WHERE week_end < {CUT_SQL}) AS pre_mean, AVG(y) FILTER (WHERE week_end >= {CUT_SQL}) AS post_mean,
             AVG(x) FILTER (WHERE week_end < {CUT_SQL}) AS ctrl_pre, AVG(x) FILTER (WHERE week_end >= {CUT_SQL}) AS ctrl_post,
             VAR_SAMP(y) FILTER (WHERE week_end < {CUT_SQL}) AS v0, VAR_SAMP(y) FILTER (WHERE week_end >= {CUT_SQL}) AS v1
      FROM ser2 GROUP BY category)""", _CAT_CTE),
          round_cols=["pre_mean", "post_mean", "ctrl_pre", "ctrl_post", "did_estimate", "pct_lift", "t_statistic"],
          digits=4)
def x12(spark, sf_dir):
    return CA.did_prepost(category_weekly(spark, sf_dir), "category", "week_end", "y", "x", CUT, with_p=False)


@register("x13_ols_table")
def x13(spark, sf_dir):
    pp = CA.flag_top_quantile(_prepost(spark, sf_dir), "pre_views", TREATED_QUANTILE)
    d = pp.select(F.col("treated"), F.log1p("pre_views").alias("log_pre"), F.log1p("post_views").alias("log_post"))
    return CA.ols_table(d, "log_post", ["treated", "log_pre"])


@register("x9_anova_pvalues")
def x9_p(spark, sf_dir):
    return EX.two_way_anova(_factorial(spark, sf_dir), "weekend", "high_priority", "views", with_p=True)


@register("x12_did_ttest")
def x12_p(spark, sf_dir):
    return CA.did_prepost(category_weekly(spark, sf_dir), "category", "week_end", "y", "x", CUT, with_p=True)


@register("x2_did_pvalue")
def x2_p(spark, sf_dir):
    pp = CA.flag_top_quantile(_prepost(spark, sf_dir), "pre_views", TREATED_QUANTILE)
    return CA.trending_did(pp, with_p=True)
