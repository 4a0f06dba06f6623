"""Marker clusters that merge by distance, per zoom (C28), by greedy clustering bottom-up over zooms.

An item is a marker or a cluster of the level below, at the place of its first marker. Items go in the order of a hash
of their first marker's id: an item becomes a centre unless a centre before it can take it, and otherwise joins the
first centre that can. A centre takes an item if the item's farthest marker, by distance to the item plus the item's
own reach, lies within the radius; so all markers of a cluster lie within the radius of its centre. The order is
part of the data, so neither partitions nor the borders of the search grid change a cluster.

Below the deepest zoom markers first meet in cells of a sixteenth and then within a quarter of the radius. Centres of
a level are more than a fixed part of their radius apart, so an item has a bounded number of neighbours at the next
level, however crowded the map is, and pairs stay in proportion to items.

What comes first is decided in rounds over the pairs (u, v), v before u and able to take it: a v that nothing can take
is a centre, and what it takes is out. With few pairs left one task finishes. Rounds follow the logarithm of the
number of items, as the order is random.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seisflow.operators.filters import drop_incomplete
from seisflow.operators.grids import DEG2RAD, WEB_MERCATOR_MAX_LAT
from seisflow.session import drop_scratch, scratch_path

#: Pixels of a map tile, the radius of a cluster in pixels, and pairs that one task decides by itself.
TILE, RADIUS, FINISH = 256, 80, 1 << 16


def _cut(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _drop(*tables: DataFrame) -> None:
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def unit_xy(lon: str = "longitude", lat: str = "latitude") -> tuple[Column, Column]:
    """Web-Mercator position in units of the world's width; latitudes beyond the map lie on its edge."""
    la = F.least(F.greatest(F.col(lat), F.lit(-WEB_MERCATOR_MAX_LAT)), F.lit(WEB_MERCATOR_MAX_LAT)) * F.lit(DEG2RAD)
    return ((F.col(lon) + F.lit(180.0)) / F.lit(360.0),
            (F.lit(1.0) - F.log(F.tan(la) + F.lit(1.0) / F.cos(la)) / F.lit(math.pi)) / F.lit(2.0))


def radius_at(zoom: int, radius: float = RADIUS) -> float:
    """The radius in units of the world's width."""
    return radius / (TILE * 2.0 ** zoom)


def base_items(df: DataFrame, side: float) -> DataFrame:
    """Markers of one cell of ``side``: (p, x, y, latitude, longitude, reach, count, slat, slon, top)."""
    x, y = unit_xy()
    rows = drop_incomplete(df, ["latitude", "longitude", "magnitude"]).select(F.md5(F.col("id").cast("string")).alias("p"), x.alias("x"), y.alias("y"), "latitude", "longitude", "magnitude")
    first = F.min(F.struct("p", "x", "y", "latitude", "longitude")).alias("first")
    cells = rows.groupBy(F.floor(F.col("x") / F.lit(side)).alias("cx"), F.floor(F.col("y") / F.lit(side)).alias("cy")).agg(
        first, F.count(F.lit(1)).alias("count"), F.sum("latitude").alias("slat"), F.sum("longitude").alias("slon"), F.max("magnitude").alias("top"))
    # An id may mark several cells: its place makes the order total.
    key = F.concat_ws("/", "first.p", F.col("cx").cast("string"), F.col("cy").cast("string"))
    return cells.select(key.alias("p"), "first.x", "first.y", "first.latitude", "first.longitude", F.lit(side * math.sqrt(2.0)).alias("reach"), "count", "slat", "slon", "top")


def _around() -> Column:
    return F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))


def takers(items: DataFrame, radius: float) -> DataFrame:
    """(u, v, far): v comes before u and, as a centre, can take it; ``far`` is u's reach from v."""
    at = items.select("p", "x", "y", "reach", F.floor(F.col("x") / F.lit(radius)).alias("gx"), F.floor(F.col("y") / F.lit(radius)).alias("gy"))
    asks = at.select(F.col("p").alias("u"), F.col("x").alias("ux"), F.col("y").alias("uy"), "reach", "gx", "gy", _around().alias("o")).select(
        "u", "ux", "uy", "reach", (F.col("gx") + F.col("o.dx")).alias("gx"), (F.col("gy") + F.col("o.dy")).alias("gy"))
    met = asks.join(at.select(F.col("p").alias("v"), "x", "y", "gx", "gy"), ["gx", "gy"])
    dx, dy = F.col("x") - F.col("ux"), F.col("y") - F.col("uy")
    return met.withColumn("far", F.sqrt(dx * dx + dy * dy) + F.col("reach")).where((F.col("v") < F.col("u")) & (F.col("far") <= F.lit(radius))).select("u", "v", "far")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u) of a bounded table of pairs: the items that a centre takes, in order."""
    before = defaultdict(list)
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before[u].append(v)
    taken = set()
    for u in sorted(before):
        if any(v not in taken for v in before[u]):
            taken.add(u)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(taken), pa.string())], names=["u"])


def taken_items(pairs: DataFrame, finish: int = FINISH) -> list[DataFrame]:
    """Written tables (u) of all items that are not centres."""
    out, left = [], pairs.select("u", "v")
    while n := left.count():
        if n <= finish:
            out.append(_cut(left.repartition(1).mapInArrow(_decide, "u string"), "taken"))
            break
        free = left.select("v").distinct().join(left.select(F.col("u").alias("v")), "v", "left_anti")
        gone = _cut(left.join(free, "v", "left_semi").select("u").distinct(), "taken")
        out.append(gone)
        rest = _cut(left.join(gone, "u", "left_anti").join(gone.withColumnRenamed("u", "v"), "v", "left_anti").select("u", "v"), "pairs")
        if hasattr(left, "_scratch"):
            _drop(left)
        left = rest
    if hasattr(left, "_scratch"):
        _drop(left)
    return out


def merged(items: DataFrame, radius: float, finish: int = FINISH) -> DataFrame:
    """The items of the next level: centres with all that they take."""
    pairs = _cut(takers(items, radius), "takers")
    parts = taken_items(pairs, finish)
    if not parts:
        _drop(pairs)
        return _cut(items, "items")
    taken = parts[0]
    for t in parts[1:]:
        taken = taken.unionByName(t)
    chosen = pairs.join(taken.withColumnRenamed("u", "v"), "v", "left_anti").join(taken, "u", "left_semi").groupBy("u").agg(F.min(F.struct("v", "far")).alias("to"))
    own = items.join(chosen.select(F.col("u").alias("p"), "to"), "p", "left")
    centre = own.withColumn("c", F.coalesce("to.v", "p")).withColumn("far", F.coalesce("to.far", "reach"))
    at = F.min(F.when(F.col("c") == F.col("p"), F.struct("x", "y", "latitude", "longitude")))
    out = centre.groupBy("c").agg(at.alias("at"), F.max("far").alias("reach"), F.sum("count").alias("count"), F.sum("slat").alias("slat"), F.sum("slon").alias("slon"), F.max("top").alias("top"))
    made = _cut(out.select(F.col("c").alias("p"), "at.x", "at.y", "at.latitude", "at.longitude", "reach", "count", "slat", "slon", "top"), "items")
    _drop(pairs, *parts)
    return made


def ladder(zooms, radius: float = RADIUS) -> list[tuple[int | None, float]]:
    """(zoom, radius) of the levels, deepest first; the first one belongs to no zoom."""
    deep = sorted(set(int(z) for z in zooms), reverse=True)
    return [(None, radius_at(deep[0], radius) / 4)] + [(z, radius_at(z, radius)) for z in deep]


def marker_clusters(df: DataFrame, zooms=(2, 4, 6), radius: float = RADIUS, finish: int = FINISH) -> DataFrame:
    """One row per cluster and zoom: markers, centre, mean position, reach in pixels, largest magnitude.

    Rows without position or magnitude are left out; rows that share an id and a cell count each. An empty frame
    gives an empty frame.
    """
    items, out = _cut(base_items(df, ladder(zooms, radius)[0][1] / 4), "items"), None
    for zoom, r in ladder(zooms, radius):
        below, items = items, merged(items, r, finish)
        if zoom is None or zoom == max(zooms):
            _drop(below)
        if zoom is not None:
            rows = items.select(F.lit(zoom).alias("zoom"), "count", F.col("latitude").alias("center_latitude"), F.col("longitude").alias("center_longitude"),
                                (F.col("slat") / F.col("count")).alias("mean_latitude"), (F.col("slon") / F.col("count")).alias("mean_longitude"),
                                (F.col("reach") * F.lit(TILE * 2.0 ** zoom)).alias("reach_px"), F.col("top").alias("max_magnitude"))
            out = rows if out is None else out.unionByName(rows)
    return out
