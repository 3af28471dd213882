"""CSV sources, sinks, de-duplicating ingest and streaming ingest."""

import os

import pytest
from pyspark.sql import functions as F

from reachlens.sources import files as S
from reachlens.sources import schemas as SC
from reachlens.sources import adapters as A
from reachlens.streaming import ingest as ST
from reachlens.operators import kpi as K
from tests.conftest import SF_SMALL

CHANNEL_CSV = ("﻿Youtuber,subscribers,video views,uploads,Country,channel_type,created_year,created_month,"
               "lowest_monthly_earnings,highest_monthly_earnings\n"
               "Café Crème TV,1200000,50000000,520,France,Music,2019,5,100.5,1600.0\n"
               "Ωmega Studio,15000,900000,104,Greece,Games,,3,1.0,20.0\n"
               "Brand New,5000,1000,10,Chile,Games,2024,1,0.1,1.0\n")
TRENDING_CSV = ("video_id,title,channel_title,category_id,publish_time,trending_date,views,likes,dislikes,"
                "comment_count,tags,description\n"
                "v1,Hello,Café Crème TV,10,2023-01-02T10:00:00,2023-01-05,1000,50,1,10,a|b,desc\n"
                "v2,Zero,Ωmega Studio,20,not a date,2023-01-06,0,0,0,0,,\n")
ANALYTICS_CSV = ("Video,Video publish time,Views,Likes,Comments,Subscribers,Impressions,"
                 "Impressions click-through rate (%),Average view duration\n"
                 "Intro,2021-03-01,100,5,1,2,1000,4.5,60.0\n"
                 "Broken,garbage,50,1,0,0,500,2.0,30.0\n"
                 "Third,2021-03-08,70,2,1,1,700,3.0,45.0\n")


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_channel_stats_loader(spark, tmp_dir):
    df = S.load_channel_stats(spark, _write(tmp_dir, "ch.csv", CHANNEL_CSV))
    r = {x["channel_id"]: x for x in df.collect()}
    assert set(r) == {"café_crème_tv", "ωmega_studio", "brand_new"}       # BOM stripped, unicode slug
    assert r["café_crème_tv"]["years_active"] == 5
    assert r["ωmega_studio"]["years_active"] == 3                           # unknown year -> 3 years
    assert r["brand_new"]["years_active"] == 1                              # clipped at 1
    assert r["café_crème_tv"]["avg_weekly_uploads"] == pytest.approx(520 / (5 * 52))
    assert "category" in df.columns and "earnings_max" in df.columns


def test_trending_loader(spark, tmp_dir):
    df = S.load_trending(spark, _write(tmp_dir, "tr.csv", TRENDING_CSV))
    r = {x["video_id"]: x for x in df.collect()}
    assert r["v2"]["publish_time"] is None                                  # unparseable -> NULL
    assert r["v2"]["engagement_rate"] == 0.0
    assert r["v1"]["engagement_rate"] == pytest.approx(0.06)
    assert r["v1"]["channel_id"] == "café_crème_tv"


def test_analytics_loader_row_ids(spark, tmp_dir):
    df = S.load_video_analytics(spark, _write(tmp_dir, "an.csv", ANALYTICS_CSV), "creator_1").orderBy("video_id").collect()
    assert [x["video_id"] for x in df] == ["0", "1", "2"]
    assert [x["title"] for x in df] == ["Intro", "Broken", "Third"]
    assert df[1]["publish_time"] is None
    assert {x["channel_id"] for x in df} == {"creator_1"}


def test_large_files_are_split_and_read_once(spark, tmp_dir):
    path = _write(tmp_dir, "big.csv", CHANNEL_CSV + "".join(f"Name {i},{i},{i}.0,1E3,France,Music,2019,nan,bad,2.5\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = S.load_channel_stats(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 1
        assert S.load_channel_stats(spark, path).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    r = df.where("channel_name = 'Name 7'").first()
    assert (r.subscribers, r.total_views, r.total_videos, r.created_month, r.earnings_min, r.earnings_max) == (7, 7, 1000, None, None, 2.5)
    assert dict(df.dtypes)["subscribers"] == "bigint" and df.count() == 20_003


def test_quoted_line_ends_need_multi_line(spark, tmp_dir):
    path = _write(tmp_dir, "tr.csv", TRENDING_CSV + 'v3,"two\nlines",X,1,2023-01-02,2023-01-05,1,1,1,1,,\n')
    assert {r.video_id: r.title for r in S.load_trending(spark, path).collect()}["v3"] == "two\nlines"


def test_ingest_is_idempotent(spark, tmp_dir):
    v = A.videos(spark, SF_SMALL).withColumn("video_id", F.col("video_id").cast("string")) \
        .withColumn("channel_id", F.col("channel_id").cast("string"))
    c = A.channels(spark, SF_SMALL, A.videos(spark, SF_SMALL)).withColumn("channel_id", F.col("channel_id").cast("string"))
    dup = v.unionByName(v.limit(10))
    first = S.ingest(c, dup, tmp_dir)
    again = S.ingest(c, v, tmp_dir)
    assert first == {"channels": c.count(), "videos": v.count()}
    assert again == {"channels": 0, "videos": 0}
    stored = spark.read.parquet(f"{tmp_dir}/videos")
    assert SC.validate(stored, SC.VIDEOS) == []
    assert SC.key_violations(stored, ["video_id"]).count() == 0


def test_run_sql_and_init(spark, tmp_dir):
    ch = _write(tmp_dir, "ch.csv", CHANNEL_CSV)
    tr = _write(tmp_dir, "tr.csv", TRENDING_CSV)
    out = S.init_data(spark, ch, tr, os.path.join(tmp_dir, "out"))
    assert out == {"channels": 3, "videos": 2}
    res = S.run_sql(spark, "SELECT COUNT(*) AS n FROM c WHERE subscribers > 10000",
                    {"c": spark.read.parquet(os.path.join(tmp_dir, "out", "tables", "channels"))})
    assert res.first()["n"] == 2
    with pytest.raises(Exception):
        S.init_data(spark, os.path.join(tmp_dir, "missing.csv"), tr, os.path.join(tmp_dir, "out2"))


def test_streaming_ingest_and_rollup(spark, tmp_dir):
    v = A.videos(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "landing")
    v.where("video_id % 2 = 0").write.parquet(src + "/part1")
    v.write.mode("append").parquet(src + "/part1")              # repeated keys across files
    q = ST.stream_append_new(spark, src + "/part1", v.schema, os.path.join(tmp_dir, "table"), ["video_id"],
                             checkpoint_location=os.path.join(tmp_dir, "ck1"))
    q.awaitTermination()
    stored = spark.read.parquet(os.path.join(tmp_dir, "table"))
    assert stored.count() == v.count()
    assert stored.select("video_id").distinct().count() == v.count()

    q2 = ST.stream_daily_rollup(spark, src + "/part1", v.schema, os.path.join(tmp_dir, "daily"),
                                checkpoint_location=os.path.join(tmp_dir, "ck2"), lateness="0 seconds")
    q2.awaitTermination()
    got = spark.read.parquet(os.path.join(tmp_dir, "daily"))
    # every day except the last (still open under the watermark) is emitted once
    want = K.daily_rollup(v.dropDuplicates(["video_id"]).unionByName(v.where("video_id % 2 = 0")))
    last_day = want.agg(F.max("metric_date")).first()[0]
    want = want.where(F.col("metric_date") < last_day)
    got = got.where(F.col("metric_date") < last_day)
    assert got.count() == want.count()
    diff = got.join(want, ["channel_id", "metric_date"]).where(
        (got["views_day"] != want["views_day"]) | (got["videos_published"] != want["videos_published"]))
    assert diff.count() == 0
