"""All summaries from one scan, and the table that a poll updates in place."""

import os

import pytest
from pyspark.sql import functions as F

from seisflow.operators import cube, regions, summaries
from seisflow.sources.fixture import load_catalogue
from seisflow.streaming.revisions import RevisionTable, merging_sink

SF = "/root/testdata/sf0.001"


def rows(df, ordered=True):
    got = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]
    return df.columns, got if ordered else sorted(got, key=str)


def test_tables_equal_the_single_summaries(spark):
    cat = load_catalogue(spark, SF)
    odd = cat.limit(1).withColumns({"magnitude": F.lit(float("nan")), "place": F.lit(None).cast("string"), "time": F.lit(None).cast("timestamp"), "hour": F.lit(None).cast("int")})
    cat = cat.where("magnitude is not null").unionByName(odd.where("false")).unionByName(cat.where("magnitude is null"))
    made = cube.tables(cube.written_cube(cat))
    single = {
        "describe": summaries.describe_magnitude(cat), "kpi": summaries.kpi_row(cat), "magnitude_classes": summaries.class_counts(cat),
        "depth_by_class": summaries.depth_by_class(cat), "place_counts": summaries.place_counts(cat), "top_places": summaries.top_places(cat, 10),
        "region_summary": regions.region_summary(cat), "daily": summaries.daily_series(cat), "hourly": summaries.hourly_series(cat),
        "hours": summaries.hour_counts(cat, source="hour"), "hourly_patterns": summaries.hourly_patterns(cat), "spatial_patterns": summaries.spatial_patterns(cat),
    }
    assert set(made) == set(single)
    for name, frame in single.items():
        assert rows(made[name]) == rows(frame), name


def test_the_cube_reads_its_input_once(spark):
    plan = cube.cube(load_catalogue(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan and "partial_" in plan


def test_empty_catalogue(spark):
    made = cube.tables(cube.written_cube(load_catalogue(spark, SF).limit(0)))
    assert made["kpi"].first().total_events == 0 and made["daily"].count() == 0 and made["spatial_patterns"].count() == 0


SCHEMA = "id string, magnitude double, updated long"


def batch(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)


def held(table):
    return sorted(tuple(r) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_dir):
    return RevisionTable(spark, f"file:{tmp_dir}/t", SCHEMA, buckets=4)


def test_newest_revisions_over_batches_and_merges(spark, table):
    assert held(table) == [] and table.merge() is False
    want = {}
    for b in range(7):
        events = [(f"e{(b * 3 + i) % 8}", float(b * 10 + i), (b * 7 + i * 5) % 11) for i in range(6)]
        for i, m, u in events:
            want[i] = max(want.get(i, (-1, -1.0)), (u, m))
        table.append(batch(spark, *events), b)
        if b in (2, 3, 6):
            table.merge()
        assert held(table) == sorted((i, m, u) for i, (u, m) in want.items())


def test_reads_do_not_grow_with_batches(spark, table):
    sink, most = merging_sink(table, every=3), 0
    for b in range(14):
        sink(batch(spark, (f"e{b % 5}", float(b), b)), b)
        most = max(most, len(table.paths()))
    assert most <= table.buckets + 3 and held(table) == sorted((f"e{b % 5}", float(b), b) for b in range(9, 14))
    folder = table.path[len("file:"):]
    assert len(os.listdir(f"{folder}/base")) <= 2 * table.buckets and len([n for n in os.listdir(f"{folder}/batches") if n.startswith("batch=")]) <= 8
    assert len([n for n in os.listdir(f"{folder}/manifests") if n.endswith(".json")]) <= 2


@pytest.mark.parametrize("step", ["_commit", "_sweep"])
def test_a_crash_in_a_merge_loses_and_doubles_nothing(spark, table, monkeypatch, step):
    table.append(batch(spark, ("a", 1.0, 1), ("b", 1.0, 1)), 0)
    table.merge()
    table.append(batch(spark, ("a", 2.0, 2), ("c", 1.0, 1)), 1)
    want = [("a", 2.0, 2), ("b", 1.0, 1), ("c", 1.0, 1)]

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(table, step, crash)
    with pytest.raises(OSError):
        table.merge()
    monkeypatch.undo()
    assert held(table) == want
    # The retried batch and the next merges go on from there.
    table.append(batch(spark, ("a", 2.0, 2), ("c", 1.0, 1)), 1)
    assert held(table) == want
    table.append(batch(spark, ("d", 4.0, 4)), 2)
    table.merge()
    table.merge()
    assert held(table) == [*want, ("d", 4.0, 4)]


def test_incomplete_batches_are_not_read(spark, table):
    table.append(batch(spark, ("a", 1.0, 1)), 0)
    table.append(batch(spark, ("a", 9.0, 9)), 1)
    folder = table.path[len("file:"):]
    os.remove(f"{folder}/batches/batch=1/_SUCCESS")
    assert held(table) == [("a", 1.0, 1)]
    table.append(batch(spark, ("a", 9.0, 9)), 1)
    assert held(table) == [("a", 9.0, 9)]


def test_a_reader_of_the_manifest_before_can_finish(spark, table):
    table.append(batch(spark, ("a", 1.0, 1)), 0)
    table.merge()
    before = table.read()
    table.append(batch(spark, ("a", 2.0, 2)), 1)
    table.merge()
    assert [tuple(r) for r in before.collect()] == [("a", 1.0, 1)] and held(table) == [("a", 2.0, 2)]


def test_a_number_is_committed_once(spark, table):
    table.append(batch(spark, ("a", 1.0, 1)), 0)
    table.merge()
    with pytest.raises(Exception, match="(?i)exist"):
        table._commit({"number": 1, "through": 5, "versions": {}})
    assert held(table) == [("a", 1.0, 1)]
