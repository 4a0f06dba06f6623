"""The physical plans keep the properties the design relies on."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def uncached(spark):
    # Other test modules persist frames with the same plan; the cache manager
    # would then show an in-memory scan instead of the Parquet scan.
    spark.catalog.clearCache()


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_time_range_is_pushed_into_the_scan(spark):
    plan = _plan(entry.queries()["range_query"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "LessThanOrEqual(ts," in plan


def test_region_summary_reads_two_columns_and_aggregates_partially(spark):
    plan = _plan(entry.queries()["region_summary"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
    assert plan.count("HashAggregate") >= 2 and "hashpartitioning(region" in plan


def test_top_places_is_a_top_k_not_a_full_sort(spark):
    plan = _plan(entry.queries()["top_places"](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_place_search_stays_in_codegen(spark):
    plan = _plan(entry.queries()["place_search"](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "RLike" in plan or "rlike" in plan.lower()


def test_zone_labels_attach_small_tables_by_broadcast(spark):
    from seisflow.operators.zones import active_zones
    from seisflow.sources.fixture import load_catalogue
    plan = _plan(active_zones(load_catalogue(spark, SF), eps=0.3, order_col="event_id"))
    assert "BroadcastHashJoin" in plan
