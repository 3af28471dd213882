"""Hand-built edge frames (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.operators import concentration as CO
from reachlens.operators import features as FE
from reachlens.operators import kpi as K
from reachlens.operators import timeseries as TS

VSCHEMA = "video_id long, channel_id long, title string, publish_time timestamp_ntz, views long, likes long, " \
          "comment_count long, duration_seconds int"


def ts(d, h=0):
    return dt.datetime(2024, 1, d, h)


@pytest.fixture(scope="module")
def videos(spark):
    rows = [
        (1, 10, "a", ts(1), 100, 5, 5, 60),        # creator 10: single upload
        (2, 20, "b", ts(1), 0, 0, 0, 60),          # creator 20: zero views, equal timestamps
        (3, 20, "c", ts(1), 50, 5, 0, 60),
        (4, 20, "d", ts(3), 1000, 10, 10, 60),
        (5, 30, "e", ts(1), 10, 1, 0, 60),         # creator 30: constant gaps
        (6, 30, "f", ts(2), 10, 1, 0, 60),
        (7, 30, "g", ts(3), 10, 1, 0, 60),
    ]
    return spark.createDataFrame(rows, VSCHEMA)


def test_engagement_variants(spark, videos):
    r = {x["video_id"]: x for x in videos.select("video_id", C.engagement_rate().alias("p1"),
                                                  C.engagement_rate_or_zero().alias("p2")).collect()}
    assert r[2]["p1"] is None and r[2]["p2"] == 0.0
    assert r[1]["p1"] == pytest.approx(0.1)


def test_consistency_single_upload_and_constant_gaps(spark, videos):
    r = {x["channel_id"]: x for x in K.consistency_score(videos).collect()}
    assert r[10]["avg_gap_days"] is None and r[10]["consistency_score"] is None
    assert r[30]["std_gap_days"] == 0.0 and r[30]["consistency_score"] is None      # std 0 -> NULL
    assert r[20]["avg_gap_days"] == pytest.approx(1.0)                            # gaps 0 and 2 days
    f = {x["channel_id"]: x for x in FE.regression_features(
        spark.createDataFrame([(10, "x", None, 5), (20, "y", "B", 0), (30, "z", "A", 7)],
                              "channel_id long, channel_name string, category string, subscribers long")
        .withColumn("total_videos", F.lit(1)), videos).collect()}
    assert f[30]["consistency_score"] == pytest.approx(100.0)                     # std 0 -> 0.01 -> 100
    assert f[10]["category_B"] == 0.0                                             # NULL category -> zeros


def test_tiers_boundaries(spark):
    df = spark.createDataFrame([(0,), (10_000,), (10_001,), (100_000,), (None,), (20_000_000,)], "s long")
    got = [(r["s"], r["a"], r["b"]) for r in df.select("s", C.size_tier("s").alias("a"),
                                                      C.size_tier_sql("s").alias("b")).collect()]
    d = {s: (a, b) for s, a, b in got}
    assert d[0] == (None, "Nano (<10K)")
    assert d[10_000] == ("Nano", "Micro (10K-100K)")
    assert d[10_001] == ("Micro", "Micro (10K-100K)")
    assert d[100_000] == ("Micro", "Mid (100K-1M)")
    assert d[None] == (None, "Mega (10M+)")
    assert d[20_000_000] == ("Mega", "Mega (10M+)")


def test_hhi_ignores_null_and_single_category(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",), ("b",)], "category string")
    assert K.hhi(df).first()[0] == pytest.approx(5000.0)
    one = spark.createDataFrame([("a",)] * 4, "category string")
    assert K.hhi(one).first()[0] == pytest.approx(10_000.0)


def test_top_share_ntile_needs_100_rows(spark):
    small = spark.createDataFrame([(i, float(i)) for i in range(50)], "channel_id long, total_views double")
    assert CO.top_share_ntile(small).first()[0] is None
    big = spark.createDataFrame([(i, 1.0) for i in range(200)], "channel_id long, total_views double")
    assert CO.top_share_ntile(big).first()[0] == pytest.approx(1.0)


def test_trending_unknown_channel_counts_in_denominator(spark):
    tr = spark.createDataFrame([(1, 1), (2, 2), (3, 99)], "video_id long, channel_id long")
    ch = spark.createDataFrame([(1, 50), (2, 500_000)], "channel_id long, subscribers long")
    assert K.trending_accessibility(tr, ch).first()[0] == pytest.approx(100 / 3)


def test_weekly_series_fills_gaps_and_sunday_afternoon(spark):
    rows = [(1, 1, "t", dt.datetime(2024, 1, 7, 15), 5, 0, 0, 60),    # Sunday afternoon -> week ending Jan 7
            (2, 1, "t", dt.datetime(2024, 1, 8, 0), 7, 0, 0, 60),     # Monday -> week ending Jan 14
            (3, 1, "t", dt.datetime(2024, 1, 24, 0), 1, 0, 0, 60)]    # week ending Jan 28; Jan 21 empty
    s = TS.weekly_series(spark.createDataFrame(rows, VSCHEMA)).orderBy("week_end").collect()
    assert [(r["week_end"], r["views"], r["week_idx"]) for r in s] == [
        (dt.date(2024, 1, 7), 5, 0), (dt.date(2024, 1, 14), 7, 1), (dt.date(2024, 1, 21), 0, 2),
        (dt.date(2024, 1, 28), 1, 3)]


def test_slug_is_unicode_aware(spark):
    df = spark.createDataFrame([("Café Crème  TV!",), ("Ωmega-Studio",)], "n string")
    assert [r[0] for r in df.select(C.slug("n")).collect()] == ["café_crème_tv_", "ωmega_studio"]


def test_day_differences_floor_vs_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3, 6))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(C.whole_days("a", "b").alias("w"), C.fractional_days("a", "b").alias("f")).first()
    assert r["w"] == 1 and r["f"] == pytest.approx(1.75)


def test_retention_and_activation(spark, videos):
    r = {x["channel_id"]: x for x in K.creator_retention(videos, (1, 2)).collect()}
    assert r[10]["active_days"] == 0 and not r[10]["retained_d1"]
    assert r[20]["retained_d2"]
    act = K.activation_rate(videos, min_videos=3, window_days=2).first()[0]
    assert act == pytest.approx(200 / 3)    # creators 20 and 30 have 3 uploads within 2 days
