"""Sharding (11) by a hierarchical weighted hash tree, in DataFrame functions only.

A tree has regions, racks and shards; a node weighs as much as the shards below it. A row descends: at each level
every child draws ``-ln(u) / weight``, with ``u`` in (0, 1) from a hash of the row's key and the child's name, and
the smallest draw wins, so that a child wins with the probability of its share. A child's draw depends on its own
name and weight alone. A changed weight therefore moves rows only into or out of the child it belongs to, and below
every other child nothing moves. A region added to a tree (:func:`grown`) takes rows only into itself.

Law of :func:`place`: the key and the tree decide, nothing else. :func:`shard_rows` numbers the rows of each shard
from 0 without gaps, by doc_id, size and checksum: rows are cut into ordered blocks whose counts give the offsets, so
no task holds a shard. Texts are not shuffled, only ids, sizes and checksums.

Defined results: a null text has size 1 and the checksum of an empty text; rows with a null id all have the key ``""``,
so they share a shard; repeated rows get slots of their own, one after the other; other columns are not looked at and
not returned; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from seisflow.llm.common import written
from seisflow.llm.scan import blocks, running

#: Equal rows are numbered in runs of at most so many at a time.
COPIES = 1 << 16
#: Bits of a hash that make a draw; a double holds them and the half that keeps a draw from 0 and 1.
DRAW_BITS = 52
#: Shards that :func:`tree_of` puts into regions of two racks of two; each later shard opens a region.
FOUNDING = 8


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def tree_of(shards: int, founding: int = FOUNDING) -> list[Shard]:
    """The tree of ``shards`` equal shards; of two counts from ``founding`` on, the smaller is a part of the larger."""
    rows = [Shard(s, f"region{s // 4}", f"rack{s // 2}") for s in range(min(shards, founding))]
    for s in range(founding, shards):
        rows = grown(rows)
    return rows


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """``tree`` with one more shard, in a region and a rack of its own."""
    s = max((t.shard for t in tree), default=-1) + 1
    return [*tree, Shard(s, f"added-region{s}", f"added-rack{s}", weight)]


def _draw(key: Column, name: Column, weight: Column) -> Column:
    hashed = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name)), 1, DRAW_BITS // 4), 16, 10).cast("long")
    return -F.log((hashed + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))) / weight


def _winner(key: Column, children: Column) -> Column:
    """The child (name, weight, at) with the smallest draw; equal draws go to the smaller name."""
    drawn = F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name"), c["at"].alias("at")))
    return F.array_min(drawn)


def _children(rows: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(a).alias("at")) for n, w, a in rows])


def place(df: DataFrame, key: Column, tree: list[Shard], region: str, rack: str, shard: str) -> DataFrame:
    """``df`` with the names of the region and rack and the number of the shard that ``key`` (a string) descends to."""
    live = [t for t in tree if t.weight > 0]
    if not live or any(t.weight < 0 for t in tree) or len({t.shard for t in live}) < len(live):
        raise ValueError("a tree needs shards with different numbers, no weight below 0 and one above")
    nested: dict[str, dict[str, list[Shard]]] = defaultdict(lambda: defaultdict(list))
    for t in sorted(live, key=lambda t: t.shard):
        nested[t.region][t.rack].append(t)
    weigh = lambda ts: sum(t.weight for t in ts)
    regions = _children([(r, weigh(sum(racks.values(), [])), i) for i, (r, racks) in enumerate(nested.items())])
    racks = F.array(*[_children([(f"{r}/{k}", weigh(ts), i) for i, (k, ts) in enumerate(racks.items())]) for r, racks in nested.items()])
    shards = F.array(*[F.array(*[_children([(f"shard{t.shard}", t.weight, t.shard) for t in ts]) for ts in racks.values()]) for racks in nested.values()])
    kept = [c for c in df.columns if c not in (region, rack, shard)]
    step = df.withColumn("__key", key).withColumn("__region", _winner(F.col("__key"), regions))
    step = step.withColumn("__rack", _winner(F.col("__key"), F.get(racks, F.col("__region.at"))))
    step = step.withColumn("__shard", _winner(F.col("__key"), F.get(F.get(shards, F.col("__region.at")), F.col("__rack.at"))))
    return step.select(*[F.col(f"`{c}`") for c in kept], F.col("__region.name").alias(region),
                       F.substring_index("__rack.name", "/", -1).alias(rack), F.col("__shard.at").alias(shard))


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shard_rows(docs: DataFrame, tree: list[Shard]) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, region, rack, shard and its slot there, and the shard of the grown tree."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = place(rows, id_key(), tree, "region", "rack", "shard")
    rows = place(rows, id_key(), grown(tree), "__grown_region", "__grown_rack", "grown_shard").drop("__grown_region", "__grown_rack")
    # Equal rows are one row with a count while the slots are made, so that no key is too large for a block.
    order = ["doc_id", "size", "text_crc32"]
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    made = written(running(blocks(distinct, ["shard", *order], "shard_blocks"), "shard", order, {"n": "upto"}), "shard_slots")
    first = F.col("upto") - F.col("n")
    alone = made.where(F.col("n") == 1).withColumn("slot", first)
    # Runs of a repeated row are dealt out before they unfold.
    runs = made.where(F.col("n") > 1).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    runs = runs.repartition("shard", *order, "run").withColumn("start", F.col("run") * COPIES)
    copies = runs.withColumn("copy", F.explode(F.sequence("start", F.least(F.col("start") + COPIES, F.col("n")) - 1))).withColumn("slot", first + F.col("copy"))
    columns = [*order, "region", "rack", "shard", "slot", "grown_shard"]
    return alone.select(*columns).unionByName(copies.select(*columns))


def shard_digests(docs: DataFrame, shards: int = FOUNDING) -> DataFrame:
    """Documents in ``shards`` equal shards under the law ``key``."""
    rows = shard_rows(docs, tree_of(shards))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                       "grown_shard", "region", "rack")


def oracle(shards: int = FOUNDING) -> str:
    """Draws by md5 in SQL; the checksum byte by byte over the table of its polynomial."""
    def values(tree: list[Shard]) -> str:
        return ", ".join(f"({len(tree)}, '{t.region}', '{t.rack}', {t.shard}, {t.weight}::DOUBLE)" for t in tree)

    draw = f"-ln((('0x' || md5(p.k || ':' || c.name)[1:{DRAW_BITS // 4}])::BIGINT::DOUBLE + 0.5::DOUBLE) / {1 << DRAW_BITS}::DOUBLE) / c.w"
    tree = tree_of(shards)
    return f"""WITH bytes AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
e AS (SELECT doc_id, (strlen(x) + 1)::BIGINT AS size, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(x), '..'),
 lambda j: ('0x' || j)::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32 FROM d, bytes),
keys AS (SELECT DISTINCT doc_id, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
tree(n, region, rack, shard, weight) AS (VALUES {values(tree)}, {values(grown(tree))}),
c1 AS (SELECT n AS m, region AS at, region AS name, sum(weight) AS w FROM tree GROUP BY n, region),
c2 AS (SELECT n AS m, region, rack AS at, region || '/' || rack AS name, sum(weight) AS w FROM tree GROUP BY n, region, rack),
c3 AS (SELECT n AS m, region, rack, shard AS at, 'shard' || shard AS name, weight AS w FROM tree),
p1 AS (SELECT p.k, c.m AS n, arg_min(c.at, {draw}) AS region FROM keys p, c1 c GROUP BY p.k, c.m),
p2 AS (SELECT p.k, p.n, p.region, arg_min(c.at, {draw}) AS rack FROM p1 p JOIN c2 c ON c.m = p.n AND c.region = p.region GROUP BY p.k, p.n, p.region),
p3 AS (SELECT p.k, p.n, p.region, p.rack, arg_min(c.at, {draw}) AS shard FROM p2 p JOIN c3 c ON c.m = p.n AND c.region = p.region AND c.rack = p.rack
 GROUP BY p.k, p.n, p.region, p.rack)
SELECT e.doc_id, size, text_crc32, 'key' AS law, a.shard, row_number() OVER (PARTITION BY a.shard ORDER BY e.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
 b.shard AS grown_shard, a.region, a.rack FROM e JOIN keys ON keys.doc_id IS NOT DISTINCT FROM e.doc_id
 JOIN p3 a ON a.k = keys.k AND a.n = {shards} JOIN p3 b ON b.k = keys.k AND b.n = {shards + 1}"""
