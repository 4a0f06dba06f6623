"""Regression forests whose trees grow to the end, by exact splits.

Rows at one place of the feature space are one place with a weight and a sum of labels per tree; the weight of a row in
a tree is a Poisson draw from a hash of its key and the tree (1 without bootstrap), so a forest depends on the rows and
the seed alone. All open nodes of all trees grow a level at a time: per (tree, node, feature) the values are summed up,
running totals over ordered blocks give every split's gain, and the best goes back to the places. A node with at most
``finish`` places is grown to the end in one task, so tasks are bounded and only large nodes cost rounds.

A tree that fits its rows exactly is as large as the data, so no model is kept: the places to be predicted, those of
the training rows and any others, go along with weight 0 and come out with the mean of the leaf they end in.

A split is the largest decrease of squared error; ties go to the earlier feature, then the lower threshold. Thresholds
lie half-way between neighbouring values. A node without two different places, or with one label only, is a leaf.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from seisflow.operators.filters import drop_incomplete
from seisflow.session import drop_scratch, scratch_path

#: Places of a node that one task grows to the end.
FINISH = 1_000_000
#: Cells of a block of nodes whose splits are sought together.
BLOCK = 1 << 20
# Cumulative probabilities of a Poisson count with mean 1.
_POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183,
            0.9999167588507119, 0.9999897508033253, 0.9999988747974021, 0.9999998885745217, 0.9999999899522336)


def _cut(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _drop(*tables: DataFrame) -> None:
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def best_splits(x: np.ndarray, n: np.ndarray, s: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, threshold) of the exact best split of each node; feature -1 where all its places are one.

    A node is a run of two or more places (rows of ``x``) with weights and label sums. Nodes of like size are the lines
    of a block, filled up at their ends, so that a level costs few calls and not some for each node.
    """
    feature, at = np.full(len(sizes), -1), np.zeros(len(sizes))
    width = 1 << np.ceil(np.log2(sizes)).astype(int)
    for w in np.unique(width).tolist():
        alike = np.flatnonzero(width == w)
        for part in np.array_split(alike, -(-len(alike) * w // BLOCK)):
            filled, lines = np.arange(w) < sizes[part, None], np.arange(len(part))
            place = np.where(filled, starts[part, None] + np.arange(w), starts[part, None])
            of_n, of_s = np.where(filled, n[place], 0.0), np.where(filled, s[place], 0.0)
            best = np.full(len(part), -np.inf)
            for f in range(x.shape[1]):
                v = np.where(filled, x[place, f], np.inf)
                order = np.argsort(v, axis=1, kind="stable")
                v, cn, cs = (np.take_along_axis(a, order, 1) for a in (v, of_n, of_s))
                cn, cs = np.cumsum(cn, axis=1), np.cumsum(cs, axis=1)
                left_n, left_s = cn[:, :-1], cs[:, :-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = left_s * left_s / left_n + (cs[:, -1:] - left_s) ** 2 / (cn[:, -1:] - left_n)
                gain = np.where((v[:, 1:] > v[:, :-1]) & filled[:, 1:], gain, -np.inf)
                i = gain.argmax(axis=1)
                better = gain[lines, i] > best
                low, high = v[lines, i][better], v[lines, i + 1][better]
                best[better], feature[part[better]] = gain[lines, i][better], f
                # Between two neighbouring numbers there is no third: the lower one goes left.
                middle = (low + high) / 2
                at[part[better]] = np.where(middle < high, middle, low)
    return feature, at


def grow(x: np.ndarray, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The prediction of every place by one tree grown to the end on the places with weight, all nodes of a level at once."""
    out, rows, sizes = np.full(len(x), np.nan), np.arange(len(x) if (n > 0).any() else 0), np.array([len(x)])
    while len(rows):
        # ``rows`` are the places of the open nodes, node after node; both sides of a split hold places with weight.
        node = np.repeat(np.arange(len(sizes)), sizes)
        weighty = n[rows] > 0
        live, count = rows[weighty], np.bincount(node[weighty], minlength=len(sizes))
        starts = np.cumsum(count) - count
        live_n, live_s = n[live], s[live]
        mean = live_s / live_n
        mixed = np.flatnonzero(np.minimum.reduceat(mean, starts) < np.maximum.reduceat(mean, starts))
        feature, at = np.full(len(sizes), -1), np.zeros(len(sizes))
        feature[mixed], at[mixed] = best_splits(x[live], live_n, live_s, starts[mixed], count[mixed])
        leaf = feature[node] < 0
        out[rows[leaf]] = (np.add.reduceat(live_s, starts) / np.add.reduceat(live_n, starts))[node[leaf]]
        rows, node = rows[~leaf], node[~leaf]
        side = 2 * node + (x[rows, feature[node]] > at[node])
        rows, sizes = rows[np.argsort(side, kind="stable")], np.bincount(side)
        sizes = sizes[sizes > 0]
    return out


def _running(values: DataFrame, group: list[str]) -> DataFrame:
    """``values`` with running totals of n and s over ``v`` within ``group``, over ordered blocks."""
    spark, path = values.sparkSession, scratch_path(values.sparkSession, "values")
    values.repartitionByRange(*group, "v").withColumn("block", F.spark_partition_id()).write.parquet(path)
    table = spark.read.parquet(path)
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, "block").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = table.groupBy(*group, "block").agg(F.sum("n").alias("bn"), F.sum("s").alias("bs"))
    off = sums.select(*group, "block", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("on"), F.coalesce(F.sum("bs").over(before), F.lit(0.0)).alias("os"))
    out = table.join(off, [*group, "block"]).select(*group, "v", (F.sum("n").over(inside) + F.col("on")).alias("ln"), (F.sum("s").over(inside) + F.col("os")).alias("ls"))
    out._scratch = path
    return out


def _level(open_rows: DataFrame, cols: list[str]) -> DataFrame:
    """One level of all open nodes: rows with their new node, or a null node and the leaf's mean."""
    live = open_rows.where("n > 0")
    totals = live.groupBy("tree", "node").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("v")) for i, c in enumerate(cols)])).alias("e")
    values = _cut(live.select("tree", "node", "n", "s", each).groupBy("tree", "node", F.col("e.f").alias("f"), F.col("e.v").alias("v")).agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "values")
    run = _running(values, ["tree", "node", "f"])
    cand = run.join(totals, ["tree", "node"]).where("ln < tn").withColumn("gain", F.col("ls") * F.col("ls") / F.col("ln") + (F.col("ts") - F.col("ls")) * (F.col("ts") - F.col("ls")) / (F.col("tn") - F.col("ln")))
    best = cand.groupBy("tree", "node").agg(F.max(F.struct("gain", (-F.col("f")).alias("f"), (-F.col("v")).alias("v"))).alias("b"))
    best = _cut(best.select("tree", "node", (-F.col("b.f")).alias("f"), (-F.col("b.v")).alias("low")), "splits")
    # The threshold lies half-way to the next value of the chosen feature, where a number lies there.
    middle = (F.col("low") + F.col("high")) / 2
    above = values.join(best, ["tree", "node", "f"]).where("v > low").groupBy("tree", "node").agg(F.min("v").alias("high"))
    best_at = _cut(best.join(above, ["tree", "node"]).join(totals, ["tree", "node"], "right").select(
        "tree", "node", "f", F.when(middle < F.col("high"), middle).otherwise(F.col("low")).alias("at"), (F.col("ts") / F.col("tn")).alias("mean")), "splits")
    drop_scratch(open_rows.sparkSession, run._scratch)
    own = F.element_at(F.array(*[F.col(c) for c in cols]), F.col("f") + 1)
    side = F.when(own > F.col("at"), "R").otherwise("L")
    routed = open_rows.join(best_at, ["tree", "node"], "left")
    out = _cut(routed.select("tree", F.when(F.col("f").isNotNull(), F.md5(F.concat("node", side))).alias("node"), "place", *cols, "n", "s", "mean"), "routed")
    _drop(best, best_at, values)
    return out


def tree_predictions(rows: DataFrame, cols: list[str], finish: int = FINISH) -> DataFrame:
    """(tree, place, prediction) of ``rows`` (tree, place, cols, n, s): weight and label sum of each place in each tree."""
    cols = list(cols)
    todo, done = _cut(rows.select("tree", F.lit("").alias("node"), "place", *cols, "n", "s"), "grow"), []

    def end(group: pd.DataFrame) -> pd.DataFrame:
        # In the order of the places, so that sums do not depend on how rows came.
        group = group.sort_values("place", ignore_index=True)
        made = grow(group[cols].to_numpy(np.float64), group["n"].to_numpy(np.float64), group["s"].to_numpy(np.float64))
        return pd.DataFrame({"tree": group["tree"], "place": group["place"], "prediction": made})

    kind = f"tree int, place {dict(rows.dtypes)['place']}, prediction double"
    while True:
        sizes = todo.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("places"))
        small = todo.join(sizes.where(F.col("places") <= finish), ["tree", "node"], "left_semi")
        done.append(_cut(small.groupBy("tree", "node").applyInPandas(end, kind), "grown"))
        large = _cut(todo.join(sizes.where(F.col("places") > finish), ["tree", "node"], "left_semi"), "grow")
        _drop(todo)
        if large.isEmpty():
            _drop(large)
            break
        routed = _level(large, cols)
        _drop(large)
        done.append(_cut(routed.where("node is null").select("tree", "place", F.col("mean").alias("prediction")), "grown"))
        todo = _cut(routed.where("node is not null").drop("mean"), "grow")
        _drop(routed)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _place(cols: list[str]) -> Column:
    return F.md5(F.concat_ws(",", *[F.col(c).cast("string") for c in cols])).alias("place")


def _values(cols: list[str]) -> list[Column]:
    """Adding zero makes a negative zero the zero it equals."""
    return [(F.col(c).cast("double") + 0.0).alias(c) for c in cols]


def drawn_rows(train: DataFrame, cols, label: str, key: str, trees: int, seed: int, bootstrap: bool = True) -> DataFrame:
    """(tree, place, cols, __key, __y, w): every complete row with its weight in every tree."""
    cols = list(cols)
    rows = drop_incomplete(train, [*cols, label]).select(F.col(key).cast("string").alias("__key"), *_values(cols), F.col(label).cast("double").alias("__y"))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", "__key", "tree", F.lit(str(seed)))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    # As an array's one value the draw is computed once, and not for each bound it is compared with.
    weight = F.transform(F.array(u), lambda v: sum(((v >= F.lit(p)).cast("int") for p in _POISSON), F.lit(0)))[0] if bootstrap else F.lit(1)
    # The place is known before a row is repeated for the trees.
    return rows.select("*", _place(cols)).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("w", weight)


def drawn_places(train: DataFrame, cols, label: str, key: str, trees: int, seed: int, bootstrap: bool = True) -> DataFrame:
    """(tree, place, cols, n, s): the weight and label sum of each place in each tree."""
    rows = drawn_rows(train, cols, label, key, trees, seed, bootstrap)
    return rows.groupBy("tree", "place", *cols).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("__y")).alias("s"))


def forest_predictions(train: DataFrame, cols, label: str, key: str = "id", trees: int = 100, seed: int = 42, bootstrap: bool = True,
                       queries: DataFrame | None = None, finish: int = FINISH, out: str = "prediction") -> DataFrame:
    """``queries`` (by default the training rows) with the mean of the trees' predictions.

    Rows that lack a feature or the label do not train; queries that lack a feature have a null prediction. Without
    training rows every prediction is null. Trees that drew no row at all are left out of the mean.
    """
    cols = list(cols)
    drawn = drawn_places(train, cols, label, key, trees, seed, bootstrap)
    asked = queries if queries is not None else train
    spots = drop_incomplete(asked, cols).select(*_values(cols)).distinct().select(_place(cols), *cols)
    blank = spots.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "place", *cols, F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"))
    both = drawn.unionByName(blank).groupBy("tree", "place", *cols).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    per_tree = tree_predictions(both, cols, finish).where(~F.isnan("prediction"))
    mean = _cut(per_tree.groupBy(F.col("place").alias("__place")).agg(F.avg(F.round("prediction", 12)).alias("__mean")), "forest")
    full = F.lit(True)
    for c in cols:
        full = full & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    spot = F.md5(F.concat_ws(",", *[(F.col(c).cast("double") + 0.0).cast("string") for c in cols]))
    kept = [F.col(f"`{c}`") for c in asked.columns if c != out]
    return asked.withColumn("__place", spot).join(mean, "__place", "left").select(*kept, F.when(full, F.col("__mean")).alias(out))
