"""Running totals inside groups of any size: rows are cut into ordered blocks, blocks get offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from seisflow.llm.common import written

BLOCK = "__block"


def blocks(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with the number of each row's part as ``__block``.

    The written table fixes the parts, so later reads agree about them. A group whose rows differ in ``order``
    spreads over as many parts as its size needs.
    """
    return written(df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id()), name)


def running(table: DataFrame, group: str, order: list[str], totals: dict[str, str]) -> DataFrame:
    """``table`` (of :func:`blocks`) with, per ``totals`` (column → new name), the total up to and with each row.

    A group's blocks must follow one another in ``order``. One row per group and block gives the offsets; a task
    sorts the rows of a group within one block and never a whole group. ``group`` is not null.
    """
    before = Window.partitionBy(group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = table.groupBy(group, BLOCK).agg(*[F.sum(c).alias(f"__sum_{c}") for c in totals])
    offsets = sums.select(group, BLOCK, *[F.coalesce(F.sum(f"__sum_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in totals])
    joined = table.join(offsets, [group, BLOCK])
    return joined.select(*table.columns, *[(F.sum(c).over(inside) + F.col(f"__off_{c}")).alias(new) for c, new in totals.items()])
