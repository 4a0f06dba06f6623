"""Radius join (J2): per row the rows within ``eps`` and the distance to the nearest, never all pairs.

Rows at one place are one point with a count. Cells of side ``eps`` are halved level by level, and pairs of cells are
decided on the bounding boxes of their points: a pair wholly within ``eps`` adds the one cell's count to the other, a
pair wholly beyond adds nothing, only the rest goes on. A place lies in one cell of a level, and a pair of cells
is either decided, checked or handed to its children, so each pair of places counts once. Crowded cells therefore split
until a pair holds few places; these are compared one by one. For the nearest place a pair goes on only while the
boxes do not rule it out by what another pair promises, which leaves a bounded number of pairs a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from seisflow.session import drop_scratch, scratch_path

#: Places of a cell up to which its places are compared one by one.
LEAF = 32
_BOX = ["minx", "maxx", "miny", "maxy"]


def _cut(df: DataFrame, name: str, **metrics: Column):
    path, seen = scratch_path(df.sparkSession, name), Observation()
    (df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return (out, seen.get) if metrics else out


def _drop(*tables: DataFrame) -> None:
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def _cell(c: str, eps: float, level: int) -> Column:
    """Halving is exact: a cell's parent is its number halved and rounded down."""
    return F.floor(F.col(c) / F.lit(eps) * F.lit(2.0 ** level))


def _cells(places: DataFrame, eps: float, level: int) -> DataFrame:
    return places.groupBy(_cell("x", eps, level).alias("cx"), _cell("y", eps, level).alias("cy")).agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"), F.min("x").alias("minx"), F.max("x").alias("maxx"), F.min("y").alias("miny"), F.max("y").alias("maxy"))


def _side(cells: DataFrame, s: str) -> DataFrame:
    return cells.select(*[F.col(c).alias(s + c) for c in ("cx", "cy", "m", "n", *_BOX)])


def _distances() -> tuple[Column, Column]:
    """(least, greatest) squared distance between the boxes a and b. Both round like the distances they bound."""
    def gap(lo: str, hi: str) -> tuple[Column, Column]:
        a0, a1, b0, b1 = F.col("a" + lo), F.col("a" + hi), F.col("b" + lo), F.col("b" + hi)
        return F.greatest(b0 - a1, F.lit(0.0), a0 - b1), F.greatest(a1 - b0, b1 - a0)

    (dx, fx), (dy, fy) = gap("minx", "maxx"), gap("miny", "maxy")
    return dx * dx + dy * dy, fx * fx + fy * fy


def _judged(pairs: DataFrame, eps2: float) -> DataFrame:
    """Pairs with (full, count, near): wholly within eps, undecided for the count, and possibly nearest."""
    low, high = _distances()
    same = (F.col("acx") == F.col("bcx")) & (F.col("acy") == F.col("bcy"))
    # Another place within this distance of each of a's: in b, or in a itself if it has two.
    promise = F.when(~same | (F.col("am") > 1), F.col("high"))
    p = pairs.withColumn("low", low).withColumn("high", high).where((F.col("low") <= eps2) & (F.col("count") | F.col("near")))
    best = p.groupBy("acx", "acy").agg(F.min(F.least(promise, F.col("best"))).alias("least"))
    p = p.join(best, ["acx", "acy"]).withColumn("best", F.least("best", "least")).drop("least")
    p = p.withColumn("full", F.col("count") & (F.col("high") <= eps2)).withColumn("count", F.col("count") & (F.col("high") > eps2))
    return p.withColumn("near", F.col("near") & (F.col("low") <= F.col("best")) & (~same | (F.col("am") > 1)))


def radius_neighbours(df: DataFrame, x: str, y: str, eps: float, leaf: int = LEAF) -> DataFrame:
    """``df`` with ``neighbours`` (other rows within ``eps``, the radius included) and ``nearest`` (distance to the nearest of them, null without).

    Distances are Euclidean. Rows without a position have null in both. Columns of ``df`` with those names are
    replaced; an empty frame gives an empty frame.
    """
    if not eps > 0:
        raise ValueError("eps must be above 0")
    eps2 = float(eps) * float(eps)
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    # Adding zero makes a negative zero equal to zero as a key.
    places = _cut(rows.groupBy((F.col("x") + 0.0).alias("x"), (F.col("y") + 0.0).alias("y")).agg(F.count(F.lit(1)).alias("n")), "places")
    active, level, found = places, 0, []
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    cells = _cells(places, eps, 0)
    pairs = (_side(cells, "a").withColumn("o", around).withColumn("bcx", F.col("acx") + F.col("o.dx")).withColumn("bcy", F.col("acy") + F.col("o.dy")).drop("o")
             .join(_side(cells, "b"), ["bcx", "bcy"]).withColumns({"count": F.lit(True), "near": F.lit(True), "best": F.lit(eps2)}))
    while True:
        few = (F.col("am") <= leaf) & (F.col("bm") <= leaf)
        judged, seen = _cut(_judged(pairs, eps2), "radius", crowded=F.count_if((F.col("count") | F.col("near")) & ~few), open=F.count_if((F.col("count") | F.col("near")) & few))
        here = active.withColumns({"cx": _cell("x", eps, level), "cy": _cell("y", eps, level)})
        adds = judged.where("full").groupBy(F.col("acx").alias("cx"), F.col("acy").alias("cy")).agg(F.sum("bn").alias("hit"))
        found.append(_cut(here.join(adds, ["cx", "cy"]).select("x", "y", "hit", F.lit(None).cast("double").alias("d2")), "hits"))
        undecided = judged.where(F.col("count") | F.col("near"))
        if seen["open"]:
            close = undecided.where(few).select("acx", "acy", "bcx", "bcy", "count", "near")
            a = here.select("x", "y", F.col("cx").alias("acx"), F.col("cy").alias("acy"))
            b = here.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("n").alias("n2"), F.col("cx").alias("bcx"), F.col("cy").alias("bcy"))
            dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
            met = close.join(a, ["acx", "acy"]).join(b, ["bcx", "bcy"]).withColumn("d2", dx * dx + dy * dy).where(F.col("d2") <= eps2)
            other = (F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2"))
            found.append(_cut(met.groupBy("x", "y").agg(F.sum(F.when(F.col("count"), F.col("n2")).otherwise(0)).alias("hit"), F.min(F.when(F.col("near") & other, F.col("d2"))).alias("d2")), "hits"))
        if not seen["crowded"]:
            _drop(judged)
            break
        going = _cut(undecided.where(~few).select("acx", "acy", "bcx", "bcy", "count", "near", "best"), "radius")
        _drop(judged)
        ends = going.select(F.col("acx").alias("cx"), F.col("acy").alias("cy")).unionByName(going.select(F.col("bcx").alias("cx"), F.col("bcy").alias("cy"))).distinct()
        kept = _cut(here.join(ends, ["cx", "cy"], "left_semi").select("x", "y", "n"), "places")
        if active is not places:
            _drop(active)
        active, level = kept, level + 1
        cells = _cells(active, eps, level)
        half = lambda s: {f"{s}px": F.floor(F.col(f"{s}cx") / 2), f"{s}py": F.floor(F.col(f"{s}cy") / 2)}
        old = going.select(F.col("acx").alias("apx"), F.col("acy").alias("apy"), F.col("bcx").alias("bpx"), F.col("bcy").alias("bpy"), "count", "near", "best")
        pairs = old.join(_side(cells, "a").withColumns(half("a")), ["apx", "apy"]).join(_side(cells, "b").withColumns(half("b")), ["bpx", "bpy"]).drop("apx", "apy", "bpx", "bpy")
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    per_place = hits.groupBy("x", "y").agg(F.sum("hit").alias("hit"), F.min("d2").alias("d2"))
    done = places.join(per_place, ["x", "y"], "left").select(F.col("x").alias("__x"), F.col("y").alias("__y"), (F.coalesce("hit", F.lit(1)) - 1).cast("long").alias("__neighbours"),
                                                            F.when(F.col("n") > 1, F.lit(0.0)).otherwise(F.sqrt("d2")).alias("__nearest"))
    result = _cut(done, "neighbours")
    _drop(*found, *({id(t): t for t in (places, active)}.values()))
    placed = df.withColumns({"__x": F.col(x).cast("double") + 0.0, "__y": F.col(y).cast("double") + 0.0})
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("neighbours", "nearest")]
    return placed.join(result, ["__x", "__y"], "left").select(*kept, F.col("__neighbours").alias("neighbours"), F.col("__nearest").alias("nearest"))
