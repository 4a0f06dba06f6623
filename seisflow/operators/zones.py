"""Exact density-based zones (DBSCAN) on a grid, as DataFrame jobs.

Pairwise neighbour search is what makes DBSCAN expensive: with eps equal to a
whole standard deviation most pairs are neighbours.  Following the exact grid
formulation of DBSCAN (Gunawan 2013; Gan & Tao 2015), the work is done on
cells instead of pairs:

Rows at one place count as one point with a weight (step 0).  Then:

1. Cells of side ``eps/√2``: any two points in one cell are neighbours, so a
   cell holding ``min_samples`` points is all core, with no pair work.
2. Points of sparser cells count neighbours in the 5×5 surrounding cells.  Each
   cell is summarised by sub-cells (``sub × sub`` per cell) with a count and a
   bounding box; a sub-cell whose box lies wholly within eps adds its count,
   one wholly beyond eps adds nothing, and only the rest is checked point by
   point.
3. Two core cells are connected when some pair of their core points is within
   eps: decided on cell boxes, then sub-cell boxes, then points for what is
   left.
4. Connected components of the cell graph by contraction; each round is
   written to the shared checkpoint folder.
5. Clusters are numbered by their first core point in ``order_col`` order;
   a border point joins the smallest-numbered cluster with a core point within
   eps; the rest is noise (-1).  This is the labelling a sequential scan in
   row order produces, and it does not depend on partitioning.

Every frame beyond the input is an aggregate over cells, sub-cells or sparse
points; the input itself is only scanned, aggregated and joined with those
small frames (AQE turns those joins into broadcasts at runtime when they are
small, and keeps them as shuffled joins when not).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from seisflow.functions.scalars import round2
from seisflow.operators.common import bounded_by, broadcast_if_small, dense_index, known_rows
from seisflow.operators.components import components
from seisflow.operators.features import fit_standardizer
from seisflow.operators.filters import drop_incomplete
from seisflow.session import checkpoint_dir, drop_scratch, scratch_path

NOISE = -1
_OFFSETS = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3)]


def _offsets(include_self: bool) -> Column:
    pairs = [(dx, dy) for dx, dy in _OFFSETS if include_self or (dx, dy) != (0, 0)]
    return F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in pairs]))


def _box_dist2(px, py, minx, maxx, miny, maxy):
    """(min, max) squared distance from a point to a box."""
    dx = F.greatest(minx - px, F.lit(0.0), px - maxx)
    dy = F.greatest(miny - py, F.lit(0.0), py - maxy)
    fx = F.greatest(F.abs(px - minx), F.abs(px - maxx))
    fy = F.greatest(F.abs(py - miny), F.abs(py - maxy))
    return dx * dx + dy * dy, fx * fx + fy * fy


def _boxbox_dist2(a, b):
    """(min, max) squared distance between boxes given as dicts of Columns."""
    dx = F.greatest(b["minx"] - a["maxx"], F.lit(0.0), a["minx"] - b["maxx"])
    dy = F.greatest(b["miny"] - a["maxy"], F.lit(0.0), a["miny"] - b["maxy"])
    fx = F.greatest(a["maxx"] - b["minx"], b["maxx"] - a["minx"])
    fy = F.greatest(a["maxy"] - b["miny"], b["maxy"] - a["miny"])
    return dx * dx + dy * dy, fx * fx + fy * fy


def _box_aggs():
    return [F.sum("n").alias("n"), F.min("x").alias("minx"), F.max("x").alias("maxx"), F.min("y").alias("miny"),
            F.max("y").alias("maxy")]


def _cols(prefix: str):
    return {k: F.col(f"{prefix}{k}") for k in ("minx", "maxx", "miny", "maxy")}


def _near(queries: DataFrame, subs: DataFrame, pts: DataFrame, eps2: float, extra=()) -> DataFrame:
    """For query points (qx, qy, qcx, qcy): (qx, qy, <extra sub-cell columns>, hit) of the sub-cells around them.

    ``hit`` counts rows within eps of the query point: a sub-cell's whole count
    when its box is within eps, otherwise its points one by one.
    """
    req = queries.select("qx", "qy", "qcx", "qcy", _offsets(True).alias("o")) \
        .select("qx", "qy", (F.col("qcx") + F.col("o.dx")).alias("cx"), (F.col("qcy") + F.col("o.dy")).alias("cy"))
    j = req.join(subs, ["cx", "cy"])
    mind2, maxd2 = _box_dist2(F.col("qx"), F.col("qy"), F.col("minx"), F.col("maxx"), F.col("miny"), F.col("maxy"))
    j = j.withColumn("maxd2", maxd2).where(mind2 <= eps2)
    keep = ["qx", "qy", *extra]
    full = j.where(F.col("maxd2") <= eps2).select(*keep, F.col("n").alias("hit"))
    partial = _cut(j.where(F.col("maxd2") > eps2).select(*keep, "sx", "sy"))
    d2 = (F.col("x") - F.col("qx")) ** 2 + (F.col("y") - F.col("qy")) ** 2
    # Where the requests are few, broadcasting them lets every partition of the points join locally, so a crowded
    # sub-cell never lands in one task.
    checked = (pts.select("sx", "sy", "x", "y", "n").join(broadcast_if_small(partial), ["sx", "sy"])
               .where(d2 <= eps2).select(*keep, F.col("n").alias("hit")))
    return full.unionByName(checked).groupBy(*keep).agg(F.sum("hit").alias("hit"))


def _cut(df: DataFrame, observe=None):
    """Write a small intermediate as a table in the shared checkpoint folder and read it back.

    Later plans start at the written files: planning stays cheap and a lost
    executor recomputes nothing upstream.  The row count (and any extra
    ``observe`` metrics) is gathered during the write, so cutting costs one
    job.  Returns the re-read frame, or (frame, metrics row) with ``observe``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "zones")
    obs = Observation()
    metrics = [F.count(F.lit(1)).alias("__rows")] + list(observe or [])
    df.observe(obs, *metrics).write.mode("overwrite").parquet(path)
    got = obs.get
    out = known_rows(spark.read.schema(df.schema).parquet(path), got["__rows"])
    out._scratch = path
    return (out, got) if observe else out


def _drop(*tables: DataFrame) -> None:
    """Delete cut tables that nothing reads any more."""
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def _components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(cx, cy, label): the smallest label among the cells connected with each cell.

    ``vertices`` (cx, cy, label) have distinct labels; ``edges`` (acx, acy, bcx, bcy).  The cell graph is contracted
    round by round (:mod:`seisflow.operators.components`), so rounds follow the logarithm of the number of cells.
    """
    cell = lambda x, y: F.concat_ws(":", x, y)
    found = components(edges.select(cell("acx", "acy").alias("a"), cell("bcx", "bcy").alias("b")))
    named = vertices.withColumn("node", cell("cx", "cy")).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("label").alias("least"))
    out = _cut(named.join(least, "root").select("cx", "cy", F.col("least").alias("label")))
    _drop(found)
    return out


def dbscan(df: DataFrame, x: str, y: str, order_col: str, eps: float = 1.0, min_samples: int = 3,
           sub: int = 8, out: str = "zone") -> DataFrame:
    """Label every row of ``df`` (non-null x, y) with a cluster number or -1 (noise).

    Rows at one place are one point with a count, so copies and repeated ids cost nothing and keep their rows.
    ``order_col`` must be orderable; clusters are numbered by their smallest key among core points (then by cell).
    ``min_samples`` counts the row itself.  Distances are Euclidean and a
    neighbour at exactly ``eps`` counts.  An empty frame gives an empty frame.
    """
    eps2 = float(eps) * float(eps)
    side = eps / math.sqrt(2.0) * (1.0 - 1e-9)
    r = side / sub
    checkpoint_dir(df.sparkSession)
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    p = (base.withColumn("__x", F.col(x).cast("double")).withColumn("__y", F.col(y).cast("double"))
             .withColumn("__cx", F.floor(F.floor(F.col(x) / F.lit(r)) / F.lit(sub)))
             .withColumn("__cy", F.floor(F.floor(F.col(y) / F.lit(r)) / F.lit(sub))))
    places = p.groupBy(F.col("__x").alias("x"), F.col("__y").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("k"))
    places = (places.withColumn("sx", F.floor(F.col("x") / F.lit(r))).withColumn("sy", F.floor(F.col("y") / F.lit(r)))
              .withColumn("cx", F.floor(F.col("sx") / F.lit(sub))).withColumn("cy", F.floor(F.col("sy") / F.lit(sub))))
    pts = _cut(places)

    # 1. cell populations, summed from the sub-cells; dense cells are all core.
    subs = _cut(pts.groupBy("cx", "cy", "sx", "sy").agg(*_box_aggs()))
    cells = bounded_by(subs, subs.groupBy("cx", "cy").agg(F.sum("n").alias("cn")))
    thin = bounded_by(subs, cells.where(F.col("cn") < min_samples).select("cx", "cy"))

    # 2. points of thin cells: neighbours (themselves included) through sub-cell boxes.
    queries = _cut(pts.join(broadcast_if_small(thin), ["cx", "cy"])
                   .select(F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("cx").alias("qcx"), F.col("cy").alias("qcy")))
    counted = _cut(_near(queries, subs, pts, eps2).select("qx", "qy", (F.col("hit") >= min_samples).alias("is_core")))
    thin_core = bounded_by(counted, counted.where("is_core").select(F.col("qx").alias("x"), F.col("qy").alias("y")))
    dense = bounded_by(subs, cells.where(F.col("cn") >= min_samples).select("cx", "cy"))
    core = _cut(pts.join(broadcast_if_small(dense), ["cx", "cy"], "left_semi")
                .unionByName(pts.join(broadcast_if_small(thin_core), ["x", "y"], "left_semi"), allowMissingColumns=False))
    csubs = _cut(core.groupBy("cx", "cy", "sx", "sy").agg(*_box_aggs(), F.min("k").alias("first_k")))
    ccells = _cut(csubs.groupBy("cx", "cy").agg(F.min("minx").alias("minx"), F.max("maxx").alias("maxx"), F.min("miny").alias("miny"),
                                                F.max("maxy").alias("maxy"), F.min("first_k").alias("first_k")))

    # 3. edges between core cells: cell boxes, then sub-cell boxes, then points.
    box = ["cx", "cy", "minx", "maxx", "miny", "maxy"]
    a = ccells.select(*[F.col(c).alias("a" + c) for c in box])
    b = ccells.select(*[F.col(c).alias("b" + c) for c in box])
    pairs = (a.select("*", _offsets(False).alias("o"))
              .withColumn("bcx", F.col("acx") + F.col("o.dx")).withColumn("bcy", F.col("acy") + F.col("o.dy"))
              .where((F.col("acx") < F.col("bcx")) | ((F.col("acx") == F.col("bcx")) & (F.col("acy") < F.col("bcy"))))
              .drop("o").join(b, ["bcx", "bcy"]))
    cmin, cmax = _boxbox_dist2(_cols("a"), _cols("b"))
    pairs = _cut(pairs.withColumn("maxd2", cmax).where(cmin <= eps2))
    key4 = ["acx", "acy", "bcx", "bcy"]
    sure = pairs.where(F.col("maxd2") <= eps2).select(*key4)
    unsure = pairs.where(F.col("maxd2") > eps2)

    def side_of(own: str, other: str) -> DataFrame:
        """Sub-cells of one side that reach within eps of the other cell's box."""
        mine = csubs.select(F.col("cx").alias(f"{own}cx"), F.col("cy").alias(f"{own}cy"), F.col("sx").alias(f"{own}sx"), F.col("sy").alias(f"{own}sy"),
                            *[F.col(c).alias(f"s{c}") for c in box[2:]])
        near, _ = _boxbox_dist2(_cols("s"), _cols(other))
        met = unsure.select(*key4, *[f"{other}{c}" for c in box[2:]]).join(mine, [f"{own}cx", f"{own}cy"]).where(near <= eps2)
        return met.select(*key4, f"{own}sx", f"{own}sy", *[F.col(f"s{c}").alias(f"{own}{c}") for c in box[2:]])

    sp = side_of("a", "b").join(side_of("b", "a"), key4)
    smin, smax = _boxbox_dist2(_cols("a"), _cols("b"))
    sp = sp.withColumn("maxd2", smax).where(smin <= eps2)
    # A pair of cells is settled as soon as one pair of sub-cells lies wholly within eps.
    settled = F.min("maxd2").over(Window.partitionBy(*key4)) <= eps2
    sp = _cut(sp.select(*key4, "asx", "asy", "bsx", "bsy", *[f"b{c}" for c in box[2:]], settled.alias("done")))
    edges = sure.unionByName(sp.where("done").select(*key4))
    left = bounded_by(sp, sp.where(~F.col("done")))
    near_a, _ = _box_dist2(F.col("x"), F.col("y"), F.col("bminx"), F.col("bmaxx"), F.col("bminy"), F.col("bmaxy"))
    # What boxes could not decide: each side keeps the points within eps of the other sub-cell's box.
    cand = _cut(core.select(F.col("sx").alias("asx"), F.col("sy").alias("asy"), "x", "y").join(broadcast_if_small(left), ["asx", "asy"])
                .where(near_a <= eps2).select(*key4, "bsx", "bsy", F.col("x").alias("ax"), F.col("y").alias("ay")))
    met = core.select(F.col("sx").alias("bsx"), F.col("sy").alias("bsy"), "x", "y").join(broadcast_if_small(cand), ["bsx", "bsy"])
    edges = edges.unionByName(met.where((F.col("ax") - F.col("x")) ** 2 + (F.col("ay") - F.col("y")) ** 2 <= eps2).select(*key4)).distinct()

    # 4. components → cluster numbers by first core row.
    comp = _components(ccells.select("cx", "cy", F.struct("first_k", "cx", "cy").alias("label")), edges)
    numbers = dense_index(comp, "label", "zone_no")
    cell_zone = _cut(comp.join(numbers, "label").select("cx", "cy", "zone_no"))
    numbers._held.unpersist()

    # 5. points of thin cells: core ones take their cell's number, the others the smallest among core points within eps.
    rest = queries.join(bounded_by(counted, counted.where(~F.col("is_core"))), ["qx", "qy"])
    zsubs = csubs.join(broadcast_if_small(cell_zone), ["cx", "cy"])
    border = _near(rest, zsubs, core, eps2, extra=("zone_no",)).groupBy("qx", "qy").agg(F.min("zone_no").alias("zone_no"))
    own = (queries.join(counted.where("is_core"), ["qx", "qy"])
           .join(broadcast_if_small(bounded_by(cell_zone, cell_zone.withColumnsRenamed({"cx": "qcx", "cy": "qcy"}))), ["qcx", "qcy"]))
    thin_zone = _cut(border.unionByName(own.select("qx", "qy", "zone_no")).select(F.col("qx").alias("__x"), F.col("qy").alias("__y"), F.col("zone_no").alias("__thin")))
    dense_zone = _cut(cell_zone.join(broadcast_if_small(dense), ["cx", "cy"]).select(F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), F.col("zone_no").alias("__dense")))
    _drop(pts, subs, queries, counted, core, csubs, ccells, pairs, sp, cand, comp, cell_zone)
    labelled = p.join(broadcast_if_small(dense_zone), ["__cx", "__cy"], "left").join(broadcast_if_small(thin_zone), ["__x", "__y"], "left")
    zone = F.coalesce(F.col("__dense"), F.col("__thin"), F.lit(NOISE)).cast("int")
    return labelled.select(*[F.col(f"`{c}`") for c in df.columns if c != out], zone.alias(out))


def active_zones(df: DataFrame, eps: float = 1.0, min_samples: int = 3, order_col: str = "id") -> DataFrame:
    """Z-score latitude/longitude (population std) and label zones with DBSCAN.

    Rows without coordinates are dropped first (they cannot be placed).
    """
    clean = drop_incomplete(df, ["latitude", "longitude"])
    scaler = fit_standardizer(clean, ["latitude", "longitude"])
    z = scaler.transform(clean, suffix="_z")
    return dbscan(z, "latitude_z", "longitude_z", order_col, eps, min_samples).drop("latitude_z", "longitude_z")


def zone_stats(zoned: DataFrame, min_count: int = 3, digits: int = 2) -> DataFrame:
    """C13 + B13 + B14: per zone (noise removed): magnitude count/mean/max, mean position; count ≥ min_count."""
    z = zoned.where(F.col("zone") != NOISE)
    stats = z.groupBy("zone").agg(
        F.count("magnitude").alias("magnitude_count"), round2(F.avg("magnitude"), digits).alias("magnitude_mean"),
        round2(F.max("magnitude"), digits).alias("magnitude_max"),
        round2(F.avg("latitude"), digits).alias("latitude_mean"),
        round2(F.avg("longitude"), digits).alias("longitude_mean"))
    return stats.where(F.col("magnitude_count") >= min_count).orderBy("zone")
