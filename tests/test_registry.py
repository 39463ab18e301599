"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clipstat.functions import durations
from clipstat.operators import staging
from clipstat.plans import oracle, registry
from scripts.compare_oracle import TABLES, canon

from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "engagement_ratio" in df.columns


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, rows) == canon(cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
               "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in plan, (name, op)


# ---- every rule shows: without it some registered query leaves its oracle ------------------
def _no_rule(name):
    """``(module, attribute, replacement)`` with one rule of an operator taken out."""
    from clipstat.operators import core, extract, history, quality
    from clipstat.functions import columns

    return {
        "page stop": (extract, "crawled_pages", lambda pages, by=None: pages),
        "first n": (extract, "first_n", lambda videos, n=None, by=None: videos),
        "once a day": (history, "history_rows_today", lambda rows, as_of: rows),
        "newest row": (core, "dedupe_newest", lambda rows, **_: rows),
        "newest extraction": (core, "latest_extraction", lambda rows, *_, **__: rows),
        "leading @": (extract, "strip_handle", lambda c: F.col(c)),
        "unmatched handles": (extract, "resolve_channels", lambda req, ch, strict=False, f=extract.resolve_channels:
                              f(req, ch).where("channel_id is not null")),
        "prefix durations": (registry, "iso8601_to_seconds", lambda c: F.when(
            F.col(c).rlike("^PT([0-9]+H)?([0-9]+M)?([0-9]+S)?$"), durations.iso8601_to_seconds(c)).otherwise(0)),
        "time zones": (staging, "parse_published_at", lambda c: F.to_timestamp_ntz(F.substring(c, 1, 19))),
        "missing counts": (staging, "count_from_text", lambda c, *_: F.col(c).cast("bigint")),
        "duplicates": (quality, "_short", lambda c: F.substring(c, 1, 1)),
        "content class": (columns, "SHORT_MAX_SECONDS", 59),
        "null counts": (core, "null_safe_count", lambda c: F.col(c)),
        "null duration, class": (core, "content_type", lambda s: F.when(F.col(s) <= 60, "Short").when(F.col(s) <= 300, "Medium")
                                 .when(F.col(s).isNotNull(), "Long")),
        "null duration, short": (core, "is_short", lambda s: F.col(s) <= 60),
        "ties": (core, "dedupe_newest", lambda rows, **_: _first_of_ties(rows)),
        "quota": (extract, "PAGE_SIZE", 49),
        "outcome": (quality, "OUTCOME_SQL", "'pass'"),
        "not evaluated": (quality, "OUTCOME_SQL", quality.OUTCOME_SQL.replace("'not_evaluated'", "'fail'")),
        "comparators": (quality, "OUTCOME_SQL", quality.OUTCOME_SQL.replace("value >= threshold", "value > threshold")),
        "missing and null keys": (staging.F, "is_variant_null", lambda c: F.lit(False)),
    }[name]


def _first_of_ties(rows):
    newest = Window.partitionBy("video_id").orderBy(F.desc("loaded_at"), F.asc("extraction_id"))
    return rows.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


@pytest.mark.parametrize("rule,query", [
    ("null counts", "core_projection"), ("null duration, class", "core_projection"), ("null duration, short", "core_projection"),
    ("ties", "dedupe_newest"), ("ties", "core_projection"), ("quota", "channel_summary"), ("outcome", "dq_check_set"),
    ("outcome", "dq_outcomes"), ("not evaluated", "dq_outcomes"), ("comparators", "dq_outcomes"), ("missing and null keys", "raw_fields"),
    ("page stop", "page_stop"), ("page stop", "detail_join"), ("page stop", "channel_extract"), ("page stop", "channel_summary"),
    ("first n", "first_n_videos"), ("first n", "channel_extract"), ("once a day", "history_append_sticky"),
    ("once a day", "history_append_refresh"), ("newest row", "dedupe_newest"), ("newest row", "core_projection"),
    ("newest extraction", "latest_extraction"), ("leading @", "channel_lookup"), ("unmatched handles", "channel_lookup"),
    ("prefix durations", "iso_to_seconds"), ("time zones", "staging_rows"), ("missing counts", "staging_rows"),
    ("duplicates", "dq_duplicates"), ("content class", "content_type")])
def test_without_the_rule_the_query_leaves_its_oracle(spark, con, monkeypatch, rule, query):
    monkeypatch.setattr(*_no_rule(rule))
    df = registry.QUERIES[query](spark, SF_SMALL)
    cur = con.execute(oracle.ORACLE[query])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) != canon([d[0] for d in cur.description], cur.fetchall())
