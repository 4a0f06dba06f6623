import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from seisflow.schema import CATALOGUE_COLUMNS
from seisflow.sources.catalogue import (EmptyInputError, read_catalogue_csv, read_catalogue_parquet,
                                         require_rows, write_catalogue_csv, write_catalogue_parquet)
from seisflow.sources.geojson import read_feed, write_feed

HEADER = ",".join(CATALOGUE_COLUMNS)


def _csv_line(**kw):
    vals = {c: "" for c in CATALOGUE_COLUMNS}
    vals.update(kw)
    return ",".join(vals[c] for c in CATALOGUE_COLUMNS)


def test_csv_quirks(spark, tmp_dir):
    lines = [
        HEADER,
        _csv_line(id="a", magnitude="4.5", place='"10 km N of X, Y"', time="2024-01-02 03:04:05", felt="12.0",
                  longitude="1.5", latitude="2.5", depth="10"),
        _csv_line(id="b", magnitude="-0.7", place='"the ""quoted"" place, Z"', time="2024-01-02 03:04:05.123456",
                  felt="3"),
        _csv_line(id="c", time="2024-01-02T03:04:05"),
    ]
    path = os.path.join(tmp_dir, "c.csv")
    open(path, "w").write("\n".join(lines) + "\n")
    rows = {r["id"]: r for r in read_catalogue_csv(spark, path).collect()}
    assert rows["a"]["place"] == "10 km N of X, Y" and rows["a"]["felt"] == 12 and rows["a"]["depth"] == 10.0
    assert rows["b"]["place"] == 'the "quoted" place, Z' and rows["b"]["magnitude"] == -0.7
    assert rows["b"]["time"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert rows["c"]["time"] == dt.datetime(2024, 1, 2, 3, 4, 5) and rows["c"]["magnitude"] is None


def test_csv_reordered_header_is_rejected(spark, tmp_dir):
    cols = CATALOGUE_COLUMNS[1:] + CATALOGUE_COLUMNS[:1]
    path = os.path.join(tmp_dir, "bad.csv")
    open(path, "w").write(",".join(cols) + "\n" + ",".join("1" for _ in cols) + "\n")
    with pytest.raises(Exception):
        read_catalogue_csv(spark, path).collect()


def test_csv_and_parquet_round_trip(spark, tmp_dir):
    from seisflow.sources.fixture import load_catalogue
    cat = load_catalogue(spark, "/root/testdata/sf0.001").drop("event_id")
    write_catalogue_csv(cat, os.path.join(tmp_dir, "csv"))
    back = read_catalogue_csv(spark, os.path.join(tmp_dir, "csv"))
    assert back.exceptAll(cat).count() == 0 and cat.exceptAll(back).count() == 0
    write_catalogue_parquet(cat, os.path.join(tmp_dir, "pq"))
    pq = read_catalogue_parquet(spark, os.path.join(tmp_dir, "pq"))
    assert pq.exceptAll(cat).count() == 0 and pq.count() == cat.count()


def test_geojson_edge_cases(spark, tmp_dir):
    def feat(fid, props, coords):
        return {"id": fid, "properties": props, "geometry": {"coordinates": coords}}
    docs = [
        {"features": [
            feat("full", {"mag": 4.2, "place": "P", "time": 1704067200000, "updated": 1704067260000, "felt": 3,
                          "tsunami": 0, "sig": 100, "net": "us"}, [10.0, 20.0, 5.0]),
            feat("nomag", {"mag": None, "time": 0}, [1.0, 2.0]),
            feat("short1", {"time": None}, [1.0]),
            feat("short0", {}, []),
            feat("nullcoords", {"place": "Q"}, None),
        ]},
        {"features": []},
        {"type": "FeatureCollection"},
    ]
    for i, d in enumerate(docs):
        open(os.path.join(tmp_dir, f"d{i}.json"), "w").write(json.dumps(d, indent=1))
    rows = {r["id"]: r for r in read_feed(spark, tmp_dir).collect()}
    assert set(rows) == {"full", "nomag", "short1", "short0", "nullcoords"}
    full = rows["full"]
    assert full["time"] == dt.datetime(2024, 1, 1) and full["updated"] == dt.datetime(2024, 1, 1, 0, 1)
    assert (full["longitude"], full["latitude"], full["depth"]) == (10.0, 20.0, 5.0)
    assert full["date"] == "2024-01-01" and full["hour"] == 0 and full["felt"] == 3 and full["sig"] == 100
    assert rows["nomag"]["magnitude"] is None and rows["nomag"]["time"] is None
    assert rows["nomag"]["depth"] is None and rows["nomag"]["latitude"] == 2.0
    assert rows["short1"]["latitude"] is None and rows["short0"]["longitude"] is None
    assert rows["nullcoords"]["longitude"] is None and rows["nullcoords"]["place"] == "Q"


def test_feed_round_trip(spark, tmp_dir):
    from seisflow.sources.fixture import load_catalogue
    cat = load_catalogue(spark, "/root/testdata/sf0.001").drop("event_id")
    write_feed(cat, tmp_dir + "/feed")
    back = read_feed(spark, tmp_dir + "/feed", line_delimited=True)
    trunc = cat.withColumn("time", F.date_trunc("millisecond", "time")).withColumn(
        "updated", F.date_trunc("millisecond", "updated"))
    assert back.exceptAll(trunc).count() == 0 and back.count() == cat.count()


def test_require_rows(spark):
    empty = spark.createDataFrame([], "x int")
    with pytest.raises(EmptyInputError):
        require_rows(empty, 1)
    assert require_rows(spark.range(20), 10) is not None


def test_fixture_catalogue_has_fixed_schema(spark):
    from seisflow.schema import CATALOGUE_SCHEMA
    from seisflow.sources.fixture import load_catalogue
    cat = load_catalogue(spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType) for f in cat.schema.fields[1:]] == [(f.name, f.dataType) for f in CATALOGUE_SCHEMA]
