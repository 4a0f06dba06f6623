"""Prefix trie of conversations (12): shards in balanced parentheses, and spines that shards share merged.

A node is a distinct sequence of first turns. Its key is a digest of the sums of its turns' digests, each taken with
its position, so keys come from running totals and a conversation of any length spreads over tasks
(:mod:`seisflow.llm.scan`). One aggregate by key makes the nodes with their smallest member, members and ends.

Nodes one under the other with the same members form a run, and (smallest member, members) names it. Nodes of one
member are leaves' tails: nothing is shared there, their values are plain. The trie of runs is what gets encoded:

1. Leaves are range-partitioned by their path of runs, so that a shard is an interval in depth-first order.
2. A shard writes its paths as balanced parentheses. ``findclose`` skips whole blocks by their least excess (a range
   min-max directory) to the end of a subtree; the rank of ``()`` pairs counts the leaves in it; a cumulative array
   over the opening parentheses gives its savings.
3. Runs above several shards, the shared spines, are there in each of them. A run's own saving is charged in one
   shard only, where its first leaf lies, so partial values add up.

Members that end at a node are digested from blocks of sorted ids, joined per block and hashed in order, so that a
node where a third of all conversations end is read as a few long pieces.

Defined results: a null role or text is empty; turns follow turn (null first), then the digest of role and text;
repeated rows are turns of their own; rows without a conv_id belong to no conversation; other columns are not looked
at; an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seisflow.llm.common import bound_batches, drop_written, written
from seisflow.llm.scan import BLOCK, blocks, running

#: Parentheses per block of the range min-max directory.
PAREN_BLOCK = 512
#: A conversation c takes the first turns of c - c % GROUP, at most BORROWED - 1 of them.
GROUP, BORROWED = 100, 6
_LIMBS = [f"t{i}" for i in range(4)]
_NOTHING = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, __block, at, digest, chars): turns numbered from 1 within their conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"))
    # The last key tells equal rows apart, so that they can lie in several blocks.
    dealt = blocks(rows.withColumn("tie", F.monotonically_increasing_id()), ["conv_id", "turn", "digest", "tie"], "trie_turns")
    out = written(running(dealt, "conv_id", ["turn", "digest", "tie"], {"one": "at"}).select("conv_id", BLOCK, "at", "digest", "chars"), "trie_ranked")
    drop_written(dealt)
    return out


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that borrow their first turns: rows (conv_id, __block, at, digest, chars), and (conv_id, total) of all."""
    convs = turns.groupBy("conv_id").agg(F.max("at").alias("n"))
    convs = convs.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP)))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % BORROWED)
    there = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = convs.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
    convs = written(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "trie_convs")
    heads = turns.where((F.pmod("conv_id", F.lit(GROUP)) == 0) & (F.col("at") < BORROWED)).select(F.col("conv_id").alias("base"), "at", "digest", "chars")
    first = convs.join(heads, "base").where("at <= h").select("conv_id", F.lit(-1).alias(BLOCK), "at", "digest", "chars")
    own = turns.join(convs, "conv_id").where("at > h").select("conv_id", BLOCK, (F.col("taken") + F.col("at") - F.col("h")).alias("at"), "digest", "chars")
    return first.unionByName(own), convs


def node_rows(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members' rows with node and parent keys, nodes, and members by the node they end at. The root's key is empty."""
    tag = F.md5(F.concat(F.col("at").cast("string"), F.lit(":"), F.col("digest")))
    tagged = rows.select("*", *[F.conv(F.substring(tag, 8 * i + 1, 8), 16, 10).cast("long").alias(t) for i, t in enumerate(_LIMBS)])
    summed = running(tagged, "conv_id", ["at"], {**{t: f"s{t}" for t in _LIMBS}, "chars": "path_chars"})

    def key(sums: list[Column], depth: Column) -> Column:
        return F.md5(F.concat_ws(".", depth.cast("string"), *[s.cast("string") for s in sums]))

    parent = F.when(F.col("at") > 1, key([F.col(f"s{t}") - F.col(t) for t in _LIMBS], F.col("at") - 1)).otherwise(F.lit(""))
    totals = convs.select("conv_id", "total")
    members = written(summed.join(totals, "conv_id").select(
        "conv_id", F.col("at").alias("depth"), key([F.col(f"s{t}") for t in _LIMBS], F.col("at")).alias("node"), parent.alias("parent"),
        "chars", "path_chars", (F.col("at") == F.col("total")).alias("last")), "trie_members")
    nodes = members.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("depth").alias("depth"),
                                        F.first("parent").alias("parent"), F.first("chars").alias("chars"), F.first("path_chars").alias("path_chars"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit("").alias("node"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("path_chars"))
    nodes = written(nodes.unionByName(root), "trie_nodes")
    ends = members.where("last").select("node", "conv_id").unionByName(convs.where("total = 0").select(F.lit("").alias("node"), "conv_id"))
    return members, nodes, ends


def with_kin(nodes: DataFrame) -> DataFrame:
    """``nodes`` with n_children and parent_conv_id."""
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    # Only first children can have another smallest member than their parent has; the root's are not joined at all.
    top = nodes.where("depth = 0").select(F.col("conv_id").alias("root_id")).first()
    above = nodes.where("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    return (nodes.join(children, "node", "left").join(above, "parent", "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
            .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(top["root_id"] if top else None).cast("long")).otherwise(F.col("above"))).drop("above"))


class Parentheses:
    """Balanced parentheses with a range min-max directory: excess after each one, and the least excess per block."""

    def __init__(self, bits: np.ndarray, block: int = PAREN_BLOCK) -> None:
        self.bits, self.block = bits, block
        self.excess = np.cumsum(np.where(bits, 1, -1))
        self.least = np.minimum.reduceat(self.excess, np.arange(0, len(bits), block)) if len(bits) else self.excess
        pairs = np.zeros(len(bits), np.int64)
        pairs[:-1] = bits[:-1] & ~bits[1:]
        #: Number of ``()`` pairs that open before each position.
        self.pairs = np.concatenate([[0], np.cumsum(pairs)])

    def findclose(self, at: int) -> int:
        """The parenthesis that closes the one that opens at ``at``: the first after it with a smaller excess."""
        below = self.excess[at]
        end = min((at // self.block + 1) * self.block, len(self.bits))
        hit = np.flatnonzero(self.excess[at + 1:end] < below)
        if len(hit):
            return at + 1 + int(hit[0])
        later = end // self.block + int(np.flatnonzero(self.least[end // self.block:] < below)[0])
        start = later * self.block
        return start + int(np.flatnonzero(self.excess[start:start + self.block] < below)[0])

    def leaves(self, at: int, close: int) -> int:
        return int(self.pairs[close] - self.pairs[at])


def shard_subtrees(paths: list[tuple[list[int], list[int], list[int], bool]]) -> list[tuple[int, int, int, int]]:
    """(conv_id, n_convs, leaves, saved) of every run in a shard, from its leaves in depth-first order.

    A leaf is (ids, members, saving charged here) of the runs on its path, and whether it has a tail of its own.
    """
    bits, opened, runs, charged, stack = bytearray(), [], [], [], []
    for ids, members, saved, tail in paths:
        common = 0
        while common < len(stack) and common < len(ids) and runs[stack[common]] == (ids[common], members[common]):
            common += 1
        bits += b"\0" * (len(stack) - common)
        del stack[common:]
        for i, run in enumerate(zip(ids, members)):
            if i >= common:
                stack.append(len(runs))
                runs.append(run)
                opened.append(len(bits))
                charged.append(0)
                bits.append(1)
            charged[stack[i]] += saved[i]
        if tail:
            bits += b"\1\0"
    bits += b"\0" * len(stack)
    shape = Parentheses(np.frombuffer(bytes(bits), np.uint8).astype(bool))
    upto = np.concatenate([[0], np.cumsum(np.array(charged, np.int64))])
    opened = np.array(opened, np.int64)
    out = []
    for i, (c, n) in enumerate(runs):
        close = shape.findclose(opened[i])
        inside = int(np.searchsorted(opened, close))
        out.append((c, n, shape.leaves(int(opened[i]), close), int(upto[inside] - upto[i])))
    return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths = []
    for batch in batches:
        rows = batch.to_pydict()
        paths += zip(rows["ids"], rows["members"], rows["charged"], rows["tail"])
    if paths:
        c, n, leaves, saved = zip(*shard_subtrees(paths))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (c, n, leaves, saved)], names=["conv_id", "n_convs", "n_leaves", "saved"])


def run_totals(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, n_convs, n_leaves, saved, above) of every run that members share, and of the root's.

    ``above`` is the number of code points on the path over the run's top.
    """
    shared = nodes.where("n_convs > 1 or depth = 0")
    runs = written(shared.groupBy("conv_id", "n_convs").agg(F.min("depth").alias("top"), (F.sum("chars") * (F.col("n_convs") - 1)).alias("own"),
                                                            F.min(F.col("path_chars") - F.col("chars")).alias("above")), "trie_runs")
    # A leaf's smallest member stands for it: (leaf, run) for the runs on its path.
    leaves = nodes.where("n_children = 0").select(F.col("conv_id").alias("leaf"), F.col("n_convs").alias("leaf_n"), "depth")
    tops = shared.join(runs, ["conv_id", "n_convs"]).where("depth = top and depth > 0").select("node", F.col("conv_id").alias("id"), F.col("n_convs").alias("members"))
    walked = members.join(leaves.select(F.col("leaf").alias("conv_id")), "conv_id", "left_semi").select(F.col("conv_id").alias("leaf"), "depth", "node")
    root = nodes.where("depth = 0").select(F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("id"), F.col("n_convs").alias("members")).first()
    steps = walked.join(tops, "node").select("leaf", "depth", "id", "members")
    if root is not None:
        above_all = leaves.select("leaf", *[F.lit(root[c]).cast("long").alias(c) for c in ("depth", "id", "members")])
        steps = above_all.unionByName(steps)
    steps = written(steps, "trie_steps")
    owners = steps.groupBy("id", "members").agg(F.min("leaf").alias("leaf")).join(
        runs.select(F.col("conv_id").alias("id"), F.col("n_convs").alias("members"), "own"), ["id", "members"])
    charged = steps.join(owners, ["id", "members", "leaf"], "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
    paths = charged.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "id", "members", "own"))).alias("p"))
    paths = paths.join(leaves, "leaf").select(F.col("p.id").alias("ids"), F.col("p.members").alias("members"), F.col("p.own").alias("charged"),
                                              ((F.col("leaf_n") == 1) & (F.col("depth") > 0)).alias("tail"), "leaf")
    bound_batches(members.sparkSession)
    order = written(paths, "trie_paths")
    parts = order.repartitionByRange("ids", "leaf").sortWithinPartitions("ids", "leaf").select("ids", "members", "charged", "tail")
    totals = parts.mapInArrow(_subtrees, "conv_id long, n_convs long, n_leaves long, saved long")
    merged = totals.groupBy("conv_id", "n_convs").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    out = written(merged.join(runs.drop("own", "top"), ["conv_id", "n_convs"]), "trie_totals")
    drop_written(runs, steps, order)
    return out


def _ordered_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) from rows (node, piece) that are sorted by node and place."""
    def out(nodes: list, hashes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"])

    node, state = None, None
    for batch in batches:
        nodes, hashes = [], []
        for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if state is not None and at == node:
                state.update(b",")
            else:
                if state is not None:
                    nodes.append(node)
                    hashes.append(state.hexdigest())
                node, state = at, hashlib.sha256()
            state.update(piece.encode())
        yield out(nodes, hashes)
    if state is not None:
        yield out([node], [state.hexdigest()])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ascending ids of the members that end at a node, comma-joined and hashed."""
    dealt = blocks(ends, ["node", "conv_id"], "trie_ends")
    pieces = dealt.groupBy("node", BLOCK).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece"))
    bound_batches(ends.sparkSession)
    sorted_pieces = pieces.repartition("node").sortWithinPartitions("node", BLOCK).select("node", "piece")
    out = written(sorted_pieces.mapInArrow(_ordered_hash, "node string, ends_sha256 string"), "trie_hashes")
    drop_written(dealt)
    return out


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie over ``rows`` (see :func:`rebuild`)."""
    members, bare, ends = node_rows(rows, convs)
    nodes = written(with_kin(bare), "trie_kin")
    drop_written(bare)
    totals = run_totals(members, nodes)
    hashes = end_digests(ends)
    drop_written(members, convs)
    within = nodes.where("n_convs > 1 or depth = 0").join(totals, ["conv_id", "n_convs"])
    spent = (F.col("n_convs") - 1) * (F.col("path_chars") - F.col("chars") - F.col("above"))
    within = within.withColumn("saved_tokens", F.col("saved") - spent)
    alone = nodes.where("n_convs = 1 and depth > 0").select("*", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    both = within.select(*alone.columns).unionByName(alone).join(hashes, "node", "left")
    return both.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def trie_rows(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns = turn_rows(conversations)
    out = prefix_trie(*rebuild(turns))
    drop_written(turns)
    return out


def oracle() -> str:
    """Nodes by their whole sequence of turn digests; a node's subtree through the conversations that own its nodes."""
    crc = """list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(c::VARCHAR), '..'), lambda j: ('0x' || j)::BIGINT)),
 lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))"""
    return f"""WITH bytes AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS t FROM range(256) r(i)),
raw AS (SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS chars
 FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS n FROM raw),
cs AS (SELECT c, xor({crc}, 4294967295) % {BORROWED} AS h FROM (SELECT DISTINCT c FROM o), bytes),
seq AS (SELECT cs.c, o.n AS k, o.d, o.chars FROM cs JOIN o ON o.c = cs.c - cs.c % {GROUP} AND o.n <= h UNION ALL SELECT cs.c, o.n, o.d, o.chars FROM cs JOIN o ON o.c = cs.c AND o.n > h),
r AS (SELECT c, chars, d, row_number() OVER (PARTITION BY c ORDER BY k) AS depth, count(*) OVER (PARTITION BY c) AS total FROM seq),
m AS MATERIALIZED (SELECT c, depth, chars, depth = total AS last, string_agg(d, '/') OVER (PARTITION BY c ORDER BY depth) AS node,
 coalesce(string_agg(d, '/') OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent FROM r
 UNION ALL SELECT c, 0, 0, NOT EXISTS (FROM r WHERE r.c = cs.c), '', NULL FROM cs),
v AS MATERIALIZED (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM m GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM v WHERE parent IS NOT NULL GROUP BY parent),
w AS MATERIALIZED (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k ON k.node = v.node),
s AS (SELECT m.node, sum((x.n_children = 0)::BIGINT) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved_tokens FROM m JOIN w x ON x.conv_id = m.c AND x.depth >= m.depth GROUP BY m.node)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.node = w.node LEFT JOIN v p ON p.node = w.parent"""
