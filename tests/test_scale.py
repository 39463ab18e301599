"""Skew and environment robustness: hot keys, time zones."""

import datetime as dt
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clipstat.operators import core as core_ops
from clipstat.operators import quality
from scripts.compare_oracle import TABLES, canon
from tests.conftest import SF_SMALL


def test_hot_video_dedupe(spark):
    # one video holds a third of all rows, spread over every input partition
    n = 3000
    rows = spark.range(n, numPartitions=6).select(
        F.col("id").alias("extraction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("video_id"),
        (F.lit(dt.datetime(2025, 1, 1)) + F.make_interval(mins=(F.col("id") % 50).cast("int"))).cast("timestamp_ntz").alias("loaded_at"))
    out = core_ops.dedupe_newest(rows)
    hot = out.where("video_id = 'hot'").collect()
    assert len(hot) == 1 and out.count() == 1 + (n - n // 3)
    # newest loaded_at among hot rows is minute 48 (ids = 0 mod 3 and 48 mod 50), greatest id wins
    best = max((i % 50, i) for i in range(0, n, 3))
    assert hot[0].extraction_id == best[1]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_duplicate_count_pre_aggregates(spark):
    df = spark.range(10000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                                    .otherwise(F.col("id").cast("string")).alias("k"))
    m = quality.compute_metrics(df, "t", [("duplicate_count", "k")])
    assert m.first().value == 1
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_results_do_not_depend_on_time_zones(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    old_tz = os.environ.get("TZ")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        for name in ("flatten_items", "upsert_core_sticky", "history_append_refresh", "dq_check_set", "staging_rows"):
            df = entry.queries()[name](spark, SF_SMALL)
            cur = con.execute(entry.oracle_sql()[name])
            cols = [d[0] for d in cur.description]
            assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, cur.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if old_tz is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old_tz
        time.tzset()
