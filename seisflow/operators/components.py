"""Connected components of an edge table by random-priority contraction.

Each round every node points at the neighbour (or itself) with the smallest priority, a hash that changes with the
round; the pointers are followed once more, and the nodes that meet become one. On a chain two nodes in five stay, on
a star one, so rounds follow the logarithm of the size and not the length of chains or the order of ids. The edge
table shrinks with the nodes. Each round's pointers are written; from the last round back they give every node its
component, joins whose sizes shrink in the same way.

The least pointer is a hash aggregate with map-side partials, so a node with very many neighbours is cheap. Nothing
but counts reaches the driver. Once an edge table is as small as a single task's share (``FINISH`` edges), one task
finishes it; with ``finish=0`` rounds go on to the end. No number of rounds is a failure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisflow.session import drop_scratch, scratch_path

#: Edges that one task joins up by itself.
FINISH = 1 << 16


def _cut(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _drop(*tables: DataFrame) -> None:
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def pointers(edges: DataFrame, turn: int) -> DataFrame:
    """(node, to): for every node of ``edges`` the smallest of itself and its neighbours in the order of this turn."""
    priority = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("v"))
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
    nearest = both.groupBy("node").agg(F.min(priority("to")).alias("near"))
    return nearest.select("node", F.least("near", priority("node"))["v"].alias("to"))


def contracted(edges: DataFrame, steps: DataFrame) -> DataFrame:
    """The edges between what the nodes became, each once and none within one."""
    a, b = (steps.select(F.col("node").alias(c), F.col("to").alias(t)) for c, t in (("a", "x"), ("b", "y")))
    moved = edges.join(a, "a").join(b, "b").where("x <> y")
    return moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, to) of a bounded edge table: sets of joined nodes, each named by one of its nodes."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    flat = pa.concat_arrays([table.column(0).combine_chunks(), table.column(1).combine_chunks()]).dictionary_encode()
    ends = np.asarray(flat.indices).reshape(2, -1)
    parent = list(range(len(flat.dictionary)))

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for a, b in zip(*ends.tolist()):
        parent[top(a)] = top(b)
    named = pa.array([top(v) for v in range(len(parent))], pa.int64())
    yield pa.RecordBatch.from_arrays([flat.dictionary, flat.dictionary.take(named)], names=["node", "to"])


def components(edges: DataFrame, finish: int = FINISH, rounds: list[int] | None = None) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b), longs or strings.

    Edges with a null end and loops of one node are ignored. The number of edges left before each round is appended
    to ``rounds``. The result is a written table.
    """
    left = _cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    kind = left.schema["a"].dataType.simpleString()
    levels = []
    while n := left.count():
        if rounds is not None:
            rounds.append(n)
        if n <= finish:
            levels.append(_cut(left.repartition(1).mapInArrow(_join_up, f"node {kind}, to {kind}"), "joined"))
            break
        once = _cut(pointers(left, len(levels)), "pointers")
        on = once.select(F.col("node").alias("to"), F.col("to").alias("then"))
        twice = _cut(once.join(on, "to").select("node", F.col("then").alias("to")), "steps")
        smaller = _cut(contracted(left, twice), "edges")
        _drop(once, left)
        levels.append(twice)
        left = smaller
    _drop(left)
    if not levels:
        return _cut(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0), "components")
    found = levels.pop()
    while levels:
        above = levels.pop()
        later = found.select(F.col("node").alias("to"), F.col("to").alias("then"))
        lower = _cut(above.join(later, "to", "left").select("node", F.coalesce("then", "to").alias("to")), "labels")
        _drop(found, above)
        found = lower
    least = found.groupBy("to").agg(F.min("node").alias("root"))
    out = _cut(found.join(least, "to").select("node", "root"), "components")
    _drop(found)
    return out
