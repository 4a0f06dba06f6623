import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from seisflow.llm import prefixtrie
from seisflow.llm.prefixtrie import Parentheses

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The contract over a list of (conv_id, turn, role, text), with tuples as nodes."""
    own = defaultdict(list)
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, n, r, t in rows:
        if c is not None:
            own[c].append((n is not None, n or 0, digest(r or "", t or ""), (r or "", t or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        saved[node] = sum(saved[k] for k in kids) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted((min(m), len(v), min(members[v[:-1]]) if v else None, len(m), len(children[v]), leaves[v], saved[v],
                   hashlib.sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest()) for v, m in members.items())


def got(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(parts)
    out = prefixtrie.trie_rows(df)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def conversations(seed, n=160):
    """Few texts, so that conversations share beginnings at every depth, end inside others and repeat them."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(420, n, replace=False):
        turns = ["a" if rng.random() < 0.7 else str(rng.choice(["b", "é日", "", None])) for _ in range(rng.integers(1, 14))]
        rows += [(int(c), i, ["user", "assistant"][i % 2], None if t == "None" else t) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_plain_version(spark, seed):
    rows = conversations(seed)
    assert got(spark, rows) == plain(rows)


def test_many_shards_and_one_agree(spark):
    rows = conversations(9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_odd_rows(spark):
    rows = [(300, None, None, None), (300, 2, "user", "x"), (300, 2, "user", "x"), (300, 2, "system", ""), (301, 1, "user", "x"), (302, 5, "u", "y" * 50000),
            (None, 0, "user", "lost"), (7, 0, "user", ""), (8, None, None, None), (0, 1, "a", "b")] + [(399, 3, "user", "again")] * 40
    rows += [(500, i, "user", f"turn {i % 3}") for i in range(400)] + [(501, i, "user", f"turn {i % 3}") for i in range(400)]
    assert got(spark, rows) == plain(rows)


def test_one_and_none(spark):
    assert got(spark, [(100, 0, "user", "hi")]) == plain([(100, 0, "user", "hi")])
    assert got(spark, [(103, 0, "user", "hi")]) == plain([(103, 0, "user", "hi")])
    assert got(spark, []) == []


def test_equal_conversations_with_many_ends(spark):
    rows = [(c, i, "user", f"t{i}") for c in range(0, 3000) for i in (0, 1)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("block", [2, 7, 512])
def test_findclose_and_leaf_rank(block):
    rng = np.random.default_rng(block)
    bits, depth = [], 0
    while len(bits) < 3000:
        up = depth == 0 or rng.random() < 0.5
        bits.append(up)
        depth += 1 if up else -1
    bits += [False] * depth
    shape, stack, close = Parentheses(np.array(bits), block), [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    assert all(shape.findclose(i) == j for i, j in close.items())
    assert all(shape.leaves(i, j) == sum(bits[k] and not bits[k + 1] for k in range(i, j)) for i, j in list(close.items())[:300])
