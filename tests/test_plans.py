"""Plan-shape checks: pruning, no row-at-a-time Python, lineage cut."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from reachlens.operators.sequence import sequence
from reachlens.sources import adapters as A
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["a1_uploads_by_category", "a8_hhi", "a12_kpi_report", "a25_creator_features",
                                  "m17_churn_features", "x9_two_way_anova", "t1_weekly_series"])
def test_sql_checked_queries_stay_jvm_side(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p           # no row-at-a-time Python UDF
    assert "ArrowEvalPython" not in p


def test_scan_reads_only_needed_columns(spark):
    spark.catalog.clearCache()          # a cached frame would replace the scans in the plan
    p = plan(A.videos(spark, SF_SMALL).groupBy("channel_id").agg(F.sum("views")))
    orders = [line for line in p.splitlines() if "ReadSchema" in line and "o_" in line]
    assert orders and all("o_orderpriority" not in line and "o_orderstatus" not in line for line in orders)
    assert not [line for line in p.splitlines() if "ReadSchema" in line and "l_" in line]   # line items pruned


def test_pushed_filters_reach_the_scan(spark):
    spark.catalog.clearCache()
    p = plan(A.table(spark, SF_SMALL, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p


def test_sequence_output_is_checkpointed(spark):
    v = A.videos(spark, SF_SMALL).select("channel_id", "video_id", "views")
    p = plan(sequence(v, "channel_id", ["video_id"], cums=["views"]))
    assert "InPandas" not in p and "RangePartitioning" not in p      # lineage cut at the checkpoint
    assert "ExistingRDD" in p and "Window" in p
