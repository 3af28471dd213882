"""Registered queries: cohorts, feature tables, anomaly flags, weekly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from reachlens.operators import anomaly as AN
from reachlens.operators import cohorts as CH
from reachlens.operators import features as FE
from reachlens.operators import timeseries as TS
from reachlens.plans.catalog_kpi import DAYS, ENG0
from reachlens.plans.oracle import with_adapter
from reachlens.plans.registry import register
from reachlens.sources import adapters as A

# Thresholds that are not degenerate on the driver's data (FIXTURES.md §2)
SURVIVAL_DAYS = (365, 1460, 1825, 2190)
AHA_WINDOWS = (90, 180, 365)
AHA_RETAINED_DAYS = 1825
CHURN_INACTIVITY_DAYS = 365
FORECAST_STEPS = 8
FUTURE_STEPS = 12
# The five market segments of the customer table, alphabetical.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_DUMMIES = ", ".join(f"CAST(CASE WHEN c.category = '{s}' THEN 1 ELSE 0 END AS DOUBLE) AS category_{s}"
                     for s in SEGMENTS[1:])
_SPAN = "SELECT channel_id, MIN(publish_time) AS f, MAX(publish_time) AS l FROM videos GROUP BY 1"
_SERIES = """
wk AS (SELECT channel_id, CAST(date_trunc('week', publish_time) AS DATE) + 6 AS week_end, SUM(views) AS views
       FROM videos GROUP BY 1, 2),
wspan AS (SELECT channel_id, MIN(week_end) AS a, MAX(week_end) AS b FROM wk GROUP BY 1),
spine AS (SELECT channel_id, a, CAST(UNNEST(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week_end FROM wspan),
ser AS (SELECT s.channel_id, s.week_end, CAST(COALESCE(w.views, 0) AS BIGINT) AS views,
               CAST((s.week_end - s.a) // 7 AS INTEGER) AS week_idx
        FROM spine s LEFT JOIN wk w USING (channel_id, week_end))"""


def _vc(spark, sf_dir):
    v = A.videos(spark, sf_dir)
    return v, A.channels(spark, sf_dir, v)


@register("a19_cohorts", with_adapter("""
SELECT channel_id, MIN(publish_time) AS first_upload,
       CAST(year(MIN(publish_time)) AS VARCHAR) || 'Q' || CAST(quarter(MIN(publish_time)) AS VARCHAR) AS cohort
FROM videos GROUP BY channel_id"""))
def a19(spark, sf_dir):
    return CH.build_cohorts(A.videos(spark, sf_dir), "Q")


_SURV = ", ".join(f"AVG(CASE WHEN GREATEST({DAYS.format(a='f', b='l')}, 0) >= {t} THEN 1.0 ELSE 0.0 END) "
                  f"AS survival_{t}d" for t in SURVIVAL_DAYS)


@register("a20_survival_curve", with_adapter(f"""
SELECT CAST(year(f) AS VARCHAR) AS cohort, COUNT(*) AS n, {_SURV} FROM ({_SPAN}) GROUP BY 1"""),
          round_cols=[f"survival_{t}d" for t in SURVIVAL_DAYS])
def a20(spark, sf_dir):
    v = A.videos(spark, sf_dir)
    return CH.survival_curve(v, CH.build_cohorts(v, "Y"), SURVIVAL_DAYS)


_EARLY = ", ".join(f"CAST(SUM(CASE WHEN v.publish_time <= s.f + INTERVAL {d} DAY THEN v.views ELSE 0 END) AS BIGINT)"
                   f" AS views_in_{d}d" for d in AHA_WINDOWS)
_EARLY_SQL = f"""SELECT v.channel_id, {_EARLY}, {DAYS.format(a='s.f', b='s.l')} AS active_days
FROM videos v JOIN ({_SPAN}) s USING (channel_id) GROUP BY v.channel_id, s.f, s.l"""


@register("a21_early_volume", with_adapter(_EARLY_SQL))
def a21(spark, sf_dir):
    return CH.early_volume(A.videos(spark, sf_dir), AHA_WINDOWS)


_STACK = " UNION ALL ".join(f"SELECT channel_id, ret, {d} AS days_window, views_in_{d}d AS v FROM e"
                            for d in AHA_WINDOWS)
_THL = " UNION ALL ".join(f"SELECT days_window, {p} AS percentile, quantile_cont(v, {q}) AS threshold FROM st GROUP BY 1"
                          for p, q in ((25, 0.25), (50, 0.5), (75, 0.75)))


@register("a22_aha_moment", with_adapter("""
SELECT st.days_window, thl.percentile, CAST(TRUNC(thl.threshold) AS BIGINT) AS view_threshold,
       ROUND(AVG(CASE WHEN v >= threshold THEN ret END), 3) AS retention_if_hit,
       ROUND(AVG(CASE WHEN v < threshold THEN ret END), 3) AS retention_if_miss,
       ROUND(AVG(CASE WHEN v >= threshold THEN ret END) / (AVG(CASE WHEN v < threshold THEN ret END) + 1e-9), 2)
         AS lift
FROM st JOIN thl USING (days_window)
GROUP BY st.days_window, thl.percentile, thl.threshold""", f"""
e AS (SELECT *, CASE WHEN active_days >= {AHA_RETAINED_DAYS} THEN 1.0 ELSE 0.0 END::DOUBLE AS ret
      FROM ({_EARLY_SQL})),
st AS ({_STACK}),
thl AS ({_THL})"""))
def a22(spark, sf_dir):
    return CH.aha_moment(A.videos(spark, sf_dir), AHA_WINDOWS, retained_days=AHA_RETAINED_DAYS)


@register("a26_creator_retention_view", with_adapter(f"""
SELECT s.channel_id, s.f AS first_video_date, s.l AS last_video_date,
       {DAYS.format(a='s.f', b='s.l')} AS active_days,
       {DAYS.format(a='s.f', b='s.l')} >= 30 AS retained_d30,
       {DAYS.format(a='s.f', b='s.l')} >= 90 AS retained_d90,
       {DAYS.format(a='s.f', b='s.l')} >= 180 AS retained_d180,
       COUNT(*) FILTER (WHERE v.publish_time BETWEEN s.f AND s.f + INTERVAL 30 DAY) AS videos_in_first_30_days
FROM ({_SPAN}) s JOIN videos v USING (channel_id) GROUP BY s.channel_id, s.f, s.l"""))
def a26(spark, sf_dir):
    return CH.creator_retention_view(A.videos(spark, sf_dir))


REGRESSION_SQL = with_adapter(f"""
SELECT c.channel_id, c.channel_name, c.country, c.subscribers, c.total_views,
       c.total_videos AS total_videos_declared, c.avg_weekly_uploads, c.created_year, c.created_month,
       vs.avg_engagement, vs.avg_views, vs.total_videos_observed, vs.avg_duration, gp.avg_gap, gp.consistency_score,
       ln(1 + COALESCE(vs.avg_views, 0) / COALESCE(NULLIF(c.subscribers::DOUBLE, 0), 1)
              * COALESCE(gp.consistency_score, 1)) AS growth_rate,
       {_DUMMIES}
FROM channels c LEFT JOIN vs USING (channel_id) LEFT JOIN gp USING (channel_id)""", f"""
vs AS (SELECT channel_id, AVG({ENG0}) AS avg_engagement, AVG(views) AS avg_views,
              COUNT(video_id) AS total_videos_observed, AVG(duration_seconds) AS avg_duration
       FROM videos GROUP BY 1),
gp AS (SELECT channel_id, AVG(gap_days) AS avg_gap,
              1.0 / COALESCE(NULLIF(STDDEV_SAMP(gap_days), 0), 0.01) AS consistency_score
       FROM gaps GROUP BY 1)""")


@register("m1_regression_features", REGRESSION_SQL,
          round_cols=["avg_weekly_uploads", "avg_engagement", "avg_views", "avg_duration", "avg_gap",
                      "consistency_score", "growth_rate"])
def m1(spark, sf_dir):
    v, c = _vc(spark, sf_dir)
    return FE.regression_features(c, v)


@register("m6_cluster_features", with_adapter("""
SELECT c.channel_id, COALESCE(c.subscribers, 0) AS subscribers,
       COALESCE(c.avg_weekly_uploads, 0) AS avg_weekly_uploads,
       COALESCE(vs.avg_engagement, 0) AS avg_engagement, COALESCE(vs.avg_views, 0) AS avg_views,
       COALESCE(vs.total_videos, 0) AS total_videos, COALESCE(vs.std_views, 0) AS std_views,
       COALESCE(gp.gap_std, 0) AS gap_std,
       COALESCE(c.avg_weekly_uploads, 0) * COALESCE(vs.avg_engagement, 0) AS upload_x_engagement,
       COALESCE(ln(1 + COALESCE(vs.avg_views, 0)) / NULLIF(ln(1 + COALESCE(c.subscribers::DOUBLE, 1)), 0), 0)
         AS sub_growth_proxy
FROM channels c LEFT JOIN vs USING (channel_id) LEFT JOIN gp USING (channel_id)""", f"""
vs AS (SELECT channel_id, AVG({ENG0}) AS avg_engagement, AVG(views) AS avg_views, COUNT(video_id) AS total_videos,
              STDDEV_SAMP(views) AS std_views FROM videos GROUP BY 1),
gp AS (SELECT channel_id, STDDEV_SAMP(gap_days) AS gap_std FROM gaps GROUP BY 1)"""),
          round_cols=["avg_weekly_uploads", "avg_engagement", "avg_views", "std_views", "gap_std",
                      "upload_x_engagement", "sub_growth_proxy"])
def m6(spark, sf_dir):
    v, c = _vc(spark, sf_dir)
    return FE.cluster_features(c, v)


@register("m10_video_features", with_adapter("""
SELECT c.subscribers, c.avg_weekly_uploads, g.hist_avg_views, g.days_since_last,
       CAST(hour(g.publish_time) AS INTEGER) AS publish_hour,
       CAST(isodow(g.publish_time) - 1 AS INTEGER) AS publish_dow,
       CAST(length(COALESCE(g.title, '')) AS INTEGER) AS title_len, g.duration_seconds,
       ln(1 + g.views) AS log_views, g.channel_id, g.video_id
FROM (SELECT *, AVG(views) OVER (PARTITION BY channel_id ORDER BY publish_time, video_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist_avg_views,
             gap_whole_days AS days_since_last FROM gaps) g
JOIN channels c USING (channel_id)
WHERE g.hist_avg_views IS NOT NULL AND g.days_since_last IS NOT NULL AND c.subscribers IS NOT NULL
  AND c.avg_weekly_uploads IS NOT NULL"""),
          round_cols=["avg_weekly_uploads", "hist_avg_views", "log_views"])
def m10(spark, sf_dir):
    v, c = _vc(spark, sf_dir)
    return FE.video_features(c, v)


@register("m14_z_anomalies", with_adapter(f"""
SELECT *, COALESCE(ABS(z_views) > 2 OR ABS(z_eng) > 2, FALSE) AS z_anomaly,
       CASE WHEN z_views > 2 THEN 'over-performer' WHEN z_views < -2 THEN 'under-performer' ELSE 'normal' END
         AS anomaly_type
FROM (SELECT v.*, st.mean_views, st.std_views, st.mean_eng, st.std_eng,
             (v.views - st.mean_views) / (st.std_views + 1e-8) AS z_views,
             (v.engagement_rate - st.mean_eng) / (st.std_eng + 1e-8) AS z_eng
      FROM ev v LEFT JOIN st USING (channel_id))""", f"""
ev AS (SELECT *, {ENG0} AS engagement_rate FROM videos),
st AS (SELECT channel_id, AVG(views) AS mean_views, STDDEV_SAMP(views) AS std_views,
              AVG(engagement_rate) AS mean_eng, STDDEV_SAMP(engagement_rate) AS std_eng FROM ev GROUP BY 1)"""),
          round_cols=["engagement_rate", "mean_views", "std_views", "mean_eng", "std_eng", "z_views", "z_eng"])
def m14(spark, sf_dir):
    return AN.z_anomalies(A.videos(spark, sf_dir))


@register("a31_anomaly_summary", with_adapter(f"""
SELECT COUNT(*) AS videos, COUNT(*) FILTER (WHERE za) AS anomalies, AVG(CASE WHEN za THEN 1.0 ELSE 0.0 END) * 100
         AS anomaly_pct,
       COUNT(*) FILTER (WHERE zv > 2) AS over_performers, COUNT(*) FILTER (WHERE zv < -2) AS under_performers
FROM (SELECT COALESCE(ABS(zv) > 2 OR ABS(ze) > 2, FALSE) AS za, zv FROM (
  SELECT (v.views - st.mv) / (st.sv + 1e-8) AS zv, (v.er - st.me) / (st.se + 1e-8) AS ze
  FROM ev v LEFT JOIN st USING (channel_id)))""", f"""
ev AS (SELECT *, {ENG0} AS er FROM videos),
st AS (SELECT channel_id, AVG(views) AS mv, STDDEV_SAMP(views) AS sv, AVG(er) AS me, STDDEV_SAMP(er) AS se
       FROM ev GROUP BY 1)"""), round_cols=["anomaly_pct"])
def a31_anomaly(spark, sf_dir):
    z = AN.z_anomalies(A.videos(spark, sf_dir)).withColumnRenamed("z_anomaly", "is_anomaly")
    return AN.anomaly_summary(z, "is_anomaly")


_CHURN_SQL = f"""
SELECT p.channel_id, p.total_videos, p.avg_gap,
       CASE WHEN p.ng >= 6 THEN p.gl - p.gf ELSE 0.0 END AS gap_trend,
       p.el - p.ef AS engagement_trend, (p.vl - p.vf) / (p.vf + 1) AS view_trend,
       {DAYS.format(a='p.last', b='nw.now')} AS days_since_last,
       CAST({DAYS.format(a='p.last', b='nw.now')} >= {CHURN_INACTIVITY_DAYS} AS INTEGER) AS churned,
       c.subscribers, c.avg_weekly_uploads, {_DUMMIES}
FROM per p CROSS JOIN (SELECT MAX(publish_time) AS now FROM videos) nw
LEFT JOIN channels c USING (channel_id)"""
_CHURN_CTES = f"""
gn AS (SELECT *, COUNT(*) OVER (PARTITION BY channel_id) AS n FROM gaps),
per AS (SELECT channel_id, COUNT(*) AS total_videos, AVG(gap_whole_days) AS avg_gap,
               AVG(CASE WHEN seq - 1 >= 1 AND seq - 1 > n - 1 - 3 THEN gap_whole_days END) AS gl,
               AVG(CASE WHEN seq - 1 >= 1 AND seq - 1 <= 3 THEN gap_whole_days END) AS gf,
               MAX(n - 1) AS ng,
               AVG(CASE WHEN seq > n - 5 THEN {ENG0} END) AS el, AVG(CASE WHEN seq <= 5 THEN {ENG0} END) AS ef,
               AVG(CASE WHEN seq > n - 5 THEN views END) AS vl, AVG(CASE WHEN seq <= 5 THEN views END) AS vf,
               MAX(publish_time) AS last
        FROM gn GROUP BY channel_id)"""


@register("m17_churn_features", with_adapter(_CHURN_SQL, _CHURN_CTES),
          round_cols=["avg_gap", "gap_trend", "engagement_trend", "view_trend", "avg_weekly_uploads"])
def m17(spark, sf_dir):
    v, c = _vc(spark, sf_dir)
    return FE.churn_features(c, v, CHURN_INACTIVITY_DAYS)


@register("a31_churn_rate", with_adapter(
    "SELECT AVG(churned::DOUBLE) * 100 AS churn_rate_pct, COUNT(*) AS creators FROM (" + _CHURN_SQL + ")",
    _CHURN_CTES), round_cols=["churn_rate_pct"])
def a31_churn(spark, sf_dir):
    v, c = _vc(spark, sf_dir)
    f = FE.churn_features(c, v, CHURN_INACTIVITY_DAYS, one_hot=False)
    return f.agg((F.avg(F.col("churned").cast("double")) * 100).alias("churn_rate_pct"),
                 F.count(F.lit(1)).alias("creators"))


@register("t1_weekly_series", with_adapter("SELECT * FROM ser", _SERIES), headline=True)
def t1(spark, sf_dir):
    return TS.weekly_series(A.videos(spark, sf_dir))


@register("t6_seasonal_naive", with_adapter(f"""
SELECT channel_id, 'seasonal_naive' AS model, AVG(ABS(a - p) / (a + 1)) AS mape,
       SQRT(AVG(((a - p) * (a - p))::DOUBLE)) AS rmse, COUNT(*) AS n_test
FROM (SELECT channel_id, week_idx, views AS a, sp, sp - 4 + ((week_idx - sp) % 4) AS src
      FROM sx WHERE week_idx >= sp AND week_idx < sp + {FORECAST_STEPS} AND sp >= 4) t
JOIN (SELECT channel_id, week_idx AS src, views AS p FROM sx WHERE week_idx < sp) r USING (channel_id, src)
GROUP BY channel_id""", _SERIES + """,
nn AS (SELECT channel_id, COUNT(*) AS n FROM ser GROUP BY 1),
sx AS (SELECT ser.*, CAST(FLOOR(n * 0.8) AS INTEGER) AS sp FROM ser JOIN nn USING (channel_id))"""),
          round_cols=["mape", "rmse"])
def t6(spark, sf_dir):
    return TS.seasonal_naive_holdout(A.videos(spark, sf_dir), steps=FORECAST_STEPS)


@register("t7_future_weeks", with_adapter(f"""
SELECT channel_id, CAST(step AS INTEGER) AS step, CAST(b + CAST(7 * step AS INTEGER) AS DATE) AS week_end
FROM (SELECT channel_id, MAX(week_end) AS b FROM ser GROUP BY 1), range(1, {FUTURE_STEPS + 1}) AS t(step)""",
    _SERIES))
def t7(spark, sf_dir):
    return TS.future_weeks(TS.weekly_series(A.videos(spark, sf_dir)), FUTURE_STEPS)
