"""Registered queries: creator feature tables."""

from __future__ import annotations

from reachlens.operators import features as FE
from reachlens.plans.oracle import with_adapter
from reachlens.plans.registry import register
from reachlens.sources import adapters as A


A25_SQL = with_adapter("""
SELECT c.channel_id, c.channel_name, c.category, c.country, c.subscribers, c.total_views,
       c.avg_weekly_uploads, s.total_videos, s.avg_views, s.avg_engagement_rate,
       s.consistency_score_raw, s.avg_upload_gap_days, s.breakout_ratio,
       CASE WHEN s.consistency_score_raw > 0 THEN 1.0 / s.consistency_score_raw END AS consistency_score,
       CASE WHEN c.subscribers > 0 THEN s.avg_views / c.subscribers END AS view_sub_ratio,
       c.created_year, c.created_month
FROM channels c JOIN stats s USING (channel_id)
""", """
mean_v AS (SELECT channel_id, AVG(views) AS mv FROM videos GROUP BY channel_id),
stats AS (
  SELECT g.channel_id, COUNT(*) AS total_videos, AVG(views) AS avg_views,
         AVG(CASE WHEN views > 0 THEN (likes + comment_count)::DOUBLE / views END) AS avg_engagement_rate,
         STDDEV_SAMP(gap_days) AS consistency_score_raw, AVG(gap_days) AS avg_upload_gap_days,
         SUM(CASE WHEN views > 2 * m.mv THEN 1 ELSE 0 END)::DOUBLE / COUNT(*) AS breakout_ratio
  FROM gaps g JOIN mean_v m USING (channel_id) GROUP BY g.channel_id
)""")


@register("a25_creator_features", A25_SQL,
          round_cols=["avg_weekly_uploads", "avg_views", "avg_engagement_rate", "consistency_score_raw",
                      "avg_upload_gap_days", "breakout_ratio", "consistency_score", "view_sub_ratio"],
          headline=True)
def a25_creator_features(spark, sf_dir):
    v = A.videos(spark, sf_dir)
    return FE.creator_features(A.channels(spark, sf_dir, v), v)
