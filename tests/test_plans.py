"""Physical plans: JVM-only, no cross joins, no window over everything, filters at the scan."""

from pathlib import Path

import pytest

from registry import QUERIES
from registry.fixtures import Tables
from tidemark.operators import aggregates, indicators, latest, lifecycle, quality, reads
from tidemark.plans import rollups

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

# These write tables or run streams when called; what they return is a plain scan.
EAGER = {
    "insert_records", "upsert_records", "insert_many", "insert_many_result", "insert_ticks",
    "insert_ohlc", "insert_aggregates", "get_aggregates", "copy_table", "run_retention",
    "compact_partitions", "partition_report", "clean_ticks_table", "refresh_rollup", "refresh_due",
    "continuous_aggregate_read", "create_rollup", "route_rollup", "ingest_stream", "get_ohlc_stream",
}
LAZY = sorted(n for n in QUERIES if n not in EAGER and not n.startswith("stream_"))


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", LAZY)
def test_plan_is_distributed(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for banned in ("Python", "CartesianProduct", "NestedLoopJoin", "Generate collect"):
        assert banned not in text
    assert not ("Window [" in text and "SinglePartition" in text)


@pytest.fixture
def t(spark):
    return Tables(spark, SF_DIR)


def test_time_and_value_filters_reach_the_scan(t):
    found = reads.search_records(
        t.records, t.entities, reads.Search(value=(10, 20)), "2024-01-05", "2024-01-06"
    )
    text = plan(found, "formatted")
    assert "GreaterThanOrEqual(ts,2024-01-05" in text and "LessThan(ts,2024-01-06" in text
    assert "GreaterThanOrEqual(value,10.0)" in text and "LessThanOrEqual(value,20.0)" in text


def test_only_needed_columns_are_read(t):
    text = plan(indicators.sma(t.price_ticks, 5, "2024-01-31"), "formatted")
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in text
    text = plan(latest.latest_value(t.records), "formatted")
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,value:double>" in text


def test_retention_cut_is_a_constant_at_the_scan(t):
    text = plan(lifecycle.apply_retention(t.price_ticks, 14, "2024-01-31"), "formatted")
    assert "GreaterThanOrEqual(ts,2024-01-17" in text


def test_aggregates_hash_and_combine_before_the_shuffle(t):
    for df in (
        aggregates.time_bucket_agg(t.records, "1 hour", "2024-01-01", "2024-02-01"),
        rollups.ticks_1day(t.price_ticks),
        rollups.ohlc_summary_1day(t.ohlc_data),
        latest.multi_entity_latest(t.records),
    ):
        text = plan(df)
        assert "partial_" in text and "SortAggregate" not in text


def test_rank_limits_run_before_the_shuffle(t):
    for df in (
        indicators.rsi(t.price_ticks, "2024-01-31"),
        quality.dedupe_records(t.order_records, ["order_key"]),
    ):
        assert "WindowGroupLimit" in plan(df) and ", Partial" in plan(df)


def test_top_k_does_not_sort_everything(t):
    text = plan(reads.high_value_records(t.records, 1, "2024-01-01", "2024-02-01", limit=10))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
