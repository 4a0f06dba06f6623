"""Histograms, density curves and spatial grids.

Grid keys are computed per row with ``floor`` arithmetic and counted with a
hash aggregate; fitted constants (min, max, std) come from one global
aggregate, collected as a single row.  Nothing proportional to the data ever
reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from seisflow.operators.filters import drop_incomplete

DEG2RAD = 0.017453292519943295
WEB_MERCATOR_MAX_LAT = 85.0511287798066


def _range(df: DataFrame, col: str):
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n"),
                  F.stddev_samp(col).alias("sd")).first()
    return row["lo"], row["hi"], row["n"], row["sd"]


def _fill_bins(spark, counts: DataFrame, bins: int, key: str = "bin") -> DataFrame:
    """Left-join counts onto every bin index so empty bins show 0 (both sides tiny)."""
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias(key))
    return all_bins.join(counts, key, "left").fillna(0, subset=["count"])


def magnitude_histogram(df: DataFrame, col: str = "magnitude", bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins from min to max; the last bin is closed; nulls ignored.

    Bin = ``least(floor((x - min) * bins / (max - min)), bins - 1)``.
    """
    lo, hi, n, _ = _range(df, col)
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([], f"bin int, bin_start double, bin_end double, count long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = hi - lo
    b = F.least(F.floor((F.col(col) - F.lit(lo)) * float(bins) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    out = _fill_bins(spark, counts, bins)
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width) / float(bins)).alias("bin_start"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width) / float(bins)).alias("bin_end"),
                      "count").orderBy("bin")


def magnitude_kde(df: DataFrame, col: str = "magnitude", gridsize: int = 200, hist_bins: int = 20) -> DataFrame:
    """C20: Gaussian KDE (Scott bandwidth ``std · n^(-1/5)``) on ``gridsize`` points min..max.

    ``density`` integrates to 1; ``count_density`` is scaled to the histogram's
    counts (``n × bin width``).  Rows are first reduced to (value, count), then
    each distinct value emits ``gridsize`` kernel terms that are summed per
    grid point — work is O(distinct values × gridsize), no pairwise step.
    """
    lo, hi, n, sd = _range(df, col)
    spark = df.sparkSession
    if not n or n < 2 or not sd:
        return spark.createDataFrame([], "grid_index int, x double, density double, count_density double")
    bw = sd * n ** (-0.2)
    step = (hi - lo) / (gridsize - 1)
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    bin_width = (hi - lo) / hist_bins
    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("w"))
    terms = (values.select("v", "w", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_index"))
             .withColumn("x", F.lit(lo) + F.col("grid_index") * F.lit(step))
             .withColumn("k", F.col("w") * F.exp(F.lit(-0.5) * F.pow((F.col("x") - F.col("v")) / F.lit(bw), 2))))
    dens = terms.groupBy("grid_index", "x").agg(F.sum("k").alias("ksum"))
    return dens.select("grid_index", "x", (F.col("ksum") * F.lit(norm)).alias("density"),
                       (F.col("ksum") * F.lit(norm * n * bin_width)).alias("count_density")).orderBy("grid_index")


def density_grid(df: DataFrame, bins: int = 50, lon_range=(-180.0, 180.0), lat_range=(-90.0, 90.0)) -> DataFrame:
    """``bins × bins`` counts over a lon/lat box; right edges closed, outside and nulls dropped."""
    (x0, x1), (y0, y1) = lon_range, lat_range
    lon, lat = F.col("longitude"), F.col("latitude")
    inside = lon.between(x0, x1) & lat.between(y0, y1)
    xb = F.least(F.floor((lon - F.lit(x0)) * float(bins) / F.lit(x1 - x0)), F.lit(bins - 1)).cast("int")
    yb = F.least(F.floor((lat - F.lit(y0)) * float(bins) / F.lit(y1 - y0)), F.lit(bins - 1)).cast("int")
    return (df.where(inside).groupBy(xb.alias("x_bin"), yb.alias("y_bin")).agg(F.count(F.lit(1)).alias("count"))
              .select("x_bin", "y_bin",
                      (F.lit(x0) + F.col("x_bin") * F.lit((x1 - x0) / bins)).alias("lon_start"),
                      (F.lit(y0) + F.col("y_bin") * F.lit((y1 - y0) / bins)).alias("lat_start"), "count"))


def heat_cells(df: DataFrame, cell_deg: float = 1.0) -> DataFrame:
    """Heat-map weights aggregated per ``cell_deg`` cell: Σ magnitude and event count."""
    rows = drop_incomplete(df, ["latitude", "longitude", "magnitude"])
    return (rows.groupBy(F.floor(F.col("latitude") / F.lit(cell_deg)).alias("lat_cell"),
                         F.floor(F.col("longitude") / F.lit(cell_deg)).alias("lon_cell"))
                .agg(F.sum("magnitude").alias("weight"), F.count(F.lit(1)).alias("count")))


def tile_xy(zoom, lon: str = "longitude", lat: str = "latitude"):
    """Web-Mercator tile indices at a zoom level (clamped to the valid tile range)."""
    n = F.pow(F.lit(2.0), zoom)
    la = F.least(F.greatest(F.col(lat), F.lit(-WEB_MERCATOR_MAX_LAT)), F.lit(WEB_MERCATOR_MAX_LAT))
    phi = la * F.lit(DEG2RAD)
    x = F.floor((F.col(lon) + F.lit(180.0)) / F.lit(360.0) * n)
    y = F.floor((F.lit(1.0) - F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)) / F.lit(2.0) * n)
    hi = n - 1
    clamp = lambda c: F.least(F.greatest(c, F.lit(0.0)), hi).cast("int")
    return clamp(x), clamp(y)


def marker_tiles(df: DataFrame, zooms=(2, 4, 6)) -> DataFrame:
    """Marker clusters as per-zoom tile aggregates: count, centroid and max magnitude."""
    rows = drop_incomplete(df, ["latitude", "longitude", "magnitude"])
    z = rows.select("latitude", "longitude", "magnitude",
                    F.explode(F.array(*[F.lit(int(v)) for v in zooms])).alias("zoom"))
    x, y = tile_xy(F.col("zoom"))
    return (z.groupBy("zoom", x.alias("tile_x"), y.alias("tile_y"))
             .agg(F.count(F.lit(1)).alias("count"), F.avg("latitude").alias("center_latitude"),
                  F.avg("longitude").alias("center_longitude"), F.max("magnitude").alias("max_magnitude")))


def heat_raster(df: DataFrame, zoom: int = 3, radius: int = 15, tile: int = 256) -> DataFrame:
    """The heat layer's values: each event spread over ``radius`` pixels by a triangular kernel in both directions.

    A sparse raster of Σ magnitude per pixel, then one pass along x and one along y: each explodes a pixel into
    ``2 · radius + 1`` offsets and sums them up with partials, so work follows occupied pixels and not events. Pixels
    carry the tile they lie in, and kernels run on over tile borders. Weights are ``radius + 1 - |d|`` over their
    sum: the total of ``weight`` is Σ magnitude. The map wraps in x; in y what would lie beyond an edge stays on it.
    """
    rows = drop_incomplete(df, ["latitude", "longitude", "magnitude"])
    size = tile * 2 ** zoom
    la = F.least(F.greatest(F.col("latitude"), F.lit(-WEB_MERCATOR_MAX_LAT)), F.lit(WEB_MERCATOR_MAX_LAT)) * F.lit(DEG2RAD)
    px = F.floor((F.col("longitude") + F.lit(180.0)) / F.lit(360.0) * float(size))
    py = F.floor((F.lit(1.0) - F.log(F.tan(la) + F.lit(1.0) / F.cos(la)) / F.lit(math.pi)) / F.lit(2.0) * float(size))
    edge = lambda c: F.least(F.greatest(c, F.lit(0)), F.lit(size - 1))
    raster = rows.groupBy(F.pmod(px, F.lit(size)).alias("px"), edge(py).alias("py")).agg(F.sum("magnitude").alias("weight"))
    share = (F.lit(radius + 1) - F.abs("d")) / F.lit(float((radius + 1) ** 2))
    offsets = F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("d")
    wide = raster.select("px", "py", "weight", offsets).groupBy(F.pmod(F.col("px") + F.col("d"), F.lit(size)).alias("px"), "py").agg(F.sum(F.col("weight") * share).alias("weight"))
    full = wide.select("px", "py", "weight", offsets).groupBy("px", edge(F.col("py") + F.col("d")).alias("py")).agg(F.sum(F.col("weight") * share).alias("weight"))
    return full.select(F.floor(F.col("px") / tile).cast("int").alias("tile_x"), F.floor(F.col("py") / tile).cast("int").alias("tile_y"),
                       F.col("px").cast("int").alias("px"), F.col("py").cast("int").alias("py"), "weight")


def time_ordered(df: DataFrame) -> DataFrame:
    """E5: (time, magnitude) points in time order (id breaks ties)."""
    return df.select("time", "magnitude", "id").orderBy("time", "id")


def series_points(df: DataFrame, points: int = 500) -> DataFrame:
    """E5: at most ``points`` of the (time, magnitude) points that keep the line's shape, in time order.

    The span is cut into ``points - 2`` stretches of equal time. Of each the point stays that makes the largest triangle
    with the mean points of the nearest occupied stretches before and after (at the ends: with the first and last
    point, which stay too). Two passes of hash aggregates; only the stretches' means, at most ``points`` rows, are
    joined back, so no rows are sorted but the result. Equal triangles go to the earlier point, then the smaller id.
    Points without time or magnitude are left out.
    """
    if points < 3:
        raise ValueError("a series keeps at least three points")
    rows = df.where(F.col("time").isNotNull() & F.col("magnitude").isNotNull()).select("id", "time", "magnitude", F.unix_micros(F.col("time").cast("timestamp")).alias("us"))
    place = F.struct("us", "id", "magnitude", "time")
    ends = rows.agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
    if ends["first"] is None:
        return rows.select("time", "magnitude", "id")
    first, last = ends["first"], ends["last"]
    # Times count from the first point, so that means and triangles do not depend on how large epoch numbers round.
    t = ((F.col("us") - F.lit(first["us"])) / F.lit(1e6)).alias("t")
    width = max((last["us"] - first["us"]) / 1e6 / (points - 2), 1e-6)
    cut = rows.select("*", t).withColumn("stretch", F.least(F.floor(F.col("t") / F.lit(width)), F.lit(points - 3)).cast("int"))
    means = cut.groupBy("stretch").agg(F.round(F.avg("t"), 6).alias("mt"), F.round(F.avg("magnitude"), 9).alias("mm"))
    order = Window.orderBy("stretch")  # over at most ``points`` rows
    end_t = (last["us"] - first["us"]) / 1e6
    around = means.select("stretch", F.coalesce(F.lag("mt").over(order), F.lit(0.0)).alias("pt"), F.coalesce(F.lag("mm").over(order), F.lit(first["magnitude"])).alias("pm"),
                          F.coalesce(F.lead("mt").over(order), F.lit(end_t)).alias("nt"), F.coalesce(F.lead("mm").over(order), F.lit(last["magnitude"])).alias("nm"))
    area = F.abs((F.col("pt") - F.col("nt")) * (F.col("magnitude") - F.col("pm")) - (F.col("pt") - F.col("t")) * (F.col("nm") - F.col("pm")))
    best = cut.join(F.broadcast(around), "stretch").withColumn("area", F.round(area, 6)).groupBy("stretch").agg(
        F.min(F.struct((-F.col("area")).alias("less"), F.col("us"), F.col("id"), F.col("magnitude"), F.col("time"))).alias("kept"))
    picked = best.select("kept.us", "kept.id", "kept.magnitude", "kept.time")
    tips = rows.where(F.col("us").isin(first["us"], last["us"])).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    tips = tips.select(F.explode(F.array("a", "b")).alias("p")).select("p.us", "p.id", "p.magnitude", "p.time")
    return picked.unionByName(tips).distinct().orderBy("us", "id").select("time", "magnitude", "id")


def scatter_points(df: DataFrame, points: int = 1000, sizes=(20.0, 200.0)) -> DataFrame:
    """At most ``points`` rows of :func:`depth_scatter`, those with the smallest hash of their id.

    The sizes span the magnitudes of all rows. Top-k per task and then over tasks; the same rows at any partitioning.
    """
    return depth_scatter(df, sizes).orderBy(F.md5(F.col("id").cast("string")), "id").limit(points)


def depth_scatter(df: DataFrame, sizes=(20.0, 200.0)) -> DataFrame:
    """Depth-magnitude points with the magnitude mapped linearly onto a marker-size range."""
    lo, hi, _, _ = _range(df, "magnitude")
    span = (hi - lo) if (lo is not None and hi != lo) else 1.0
    rows = df.where(F.col("depth").isNotNull() & F.col("magnitude").isNotNull())
    size = F.lit(sizes[0]) + (F.col("magnitude") - F.lit(lo)) / F.lit(span) * F.lit(sizes[1] - sizes[0])
    return rows.select("id", "depth", "magnitude", size.alias("marker_size"))


def cluster_points(df: DataFrame, label_col: str = "prediction", factor: float = 3.0) -> DataFrame:
    """Map points coloured by cluster, sized by magnitude × factor."""
    return df.select("id", "longitude", "latitude", F.col(label_col).alias("prediction"),
                     (F.col("magnitude") * factor).alias("marker_size"))
