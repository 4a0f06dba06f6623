"""Operators give the same result whatever the input partitioning."""

import math

import pytest

from seisflow.operators import features, grids, regions, summaries
from seisflow.sources.fixture import load_catalogue

OPS = {
    "region_summary": lambda df: regions.region_summary(df),
    "region_summary_sum": lambda df: regions.region_summary(df, "sum"),
    "class_counts": summaries.class_counts,
    "daily_series": summaries.daily_series,
    "hourly_patterns": summaries.hourly_patterns,
    "spatial_patterns": summaries.spatial_patterns,
    "top_places": lambda df: summaries.top_places(df, 10),
    "histogram": grids.magnitude_histogram,
    "kde": lambda df: grids.magnitude_kde(df, gridsize=50),
    "density_grid": grids.density_grid,
    "marker_tiles": grids.marker_tiles,
    "zscores": lambda df: features.standardize(df)[0].select("id", "magnitude_z", "depth_z"),
    "hash_split": lambda df: features.hash_split(df).select("id", "split"),
}


def _rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def cats(spark):
    cat = load_catalogue(spark, "/root/testdata/sf0.001").persist()
    return cat.repartition(1), cat.repartition(8, "id")


@pytest.mark.parametrize("name", sorted(OPS))
def test_same_result_at_1_and_8_partitions(cats, name):
    one, eight = cats
    assert _rows(OPS[name](one)) == _rows(OPS[name](eight))
