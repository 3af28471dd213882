"""DuckDB SQL that re-derives each registered query independently.

The adapter CTEs mirror ``reachlens.sources.adapters`` (FIXTURES.md §2); each
query body is written against the contract tables ``videos``, ``channels``,
``channel_daily`` and ``trending``.
"""

from __future__ import annotations

ADAPTER_CTES = """
li_agg AS (
  SELECT l_orderkey, SUM(l_quantity) AS qty, COUNT(*) AS lines FROM lineitem GROUP BY l_orderkey
),
videos AS (
  SELECT o.o_orderkey AS video_id, o.o_custkey AS channel_id, o.o_orderpriority AS title,
         o.o_orderdate AS publish_time,
         CAST(FLOOR(o.o_totalprice) AS BIGINT) AS views,
         COALESCE(CAST(FLOOR(li.qty * 10) AS BIGINT), 0) AS likes,
         CAST(COALESCE(li.lines * 10, 0) AS BIGINT) AS comment_count,
         CAST(60 + o.o_orderkey % 1740 AS INTEGER) AS duration_seconds
  FROM orders o LEFT JOIN li_agg li ON li.l_orderkey = o.o_orderkey
),
v_per_ch AS (
  SELECT channel_id, CAST(SUM(views) AS BIGINT) AS tv, COUNT(*) AS nv FROM videos GROUP BY channel_id
),
channels AS (
  SELECT c.c_custkey AS channel_id, c.c_name AS channel_name, c.c_mktsegment AS category,
         n.n_name AS country,
         CAST(FLOOR(c.c_acctbal * c.c_acctbal) AS BIGINT) AS subscribers,
         vc.tv AS total_views,
         CAST(COALESCE(vc.nv, 0) AS BIGINT) AS total_videos,
         COALESCE(vc.nv, 0) / (GREATEST(2024 - (2008 + c.c_custkey % 16), 1) * 52.0) AS avg_weekly_uploads,
         CAST(2008 + c.c_custkey % 16 AS INTEGER) AS created_year,
         CAST(1 + c.c_custkey % 12 AS INTEGER) AS created_month
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN v_per_ch vc ON vc.channel_id = c.c_custkey
),
channel_daily AS (
  SELECT user_id AS channel_id, CAST(ts AS DATE) AS metric_date,
         COUNT(*) FILTER (WHERE event_type = 'view') AS views_day,
         COUNT(*) FILTER (WHERE event_type = 'signup') AS subs_day,
         COUNT(*) AS events_day
  FROM events GROUP BY 1, 2
),
trending AS (
  SELECT DISTINCT o.o_orderkey AS video_id, o.o_custkey AS channel_id
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'
),
gaps AS (
  SELECT channel_id, video_id, publish_time, views, likes, comment_count, duration_seconds, title,
         ROW_NUMBER() OVER (PARTITION BY channel_id ORDER BY publish_time, video_id) AS seq,
         (epoch_us(publish_time) - epoch_us(LAG(publish_time) OVER (PARTITION BY channel_id ORDER BY publish_time, video_id))) / 86400000000.0 AS gap_days,
         CAST(FLOOR((epoch_us(publish_time) - epoch_us(LAG(publish_time) OVER (PARTITION BY channel_id ORDER BY publish_time, video_id))) / 86400000000.0) AS BIGINT) AS gap_whole_days
  FROM videos
)"""


def with_adapter(body: str, extra_ctes: str = "") -> str:
    """Prefix a query body with the adapter CTEs (plus optional extra CTEs)."""
    ctes = ADAPTER_CTES + ("," + extra_ctes if extra_ctes.strip() else "")
    return f"WITH {ctes}\n{body}"
