"""Exact substring deduplication (7) by sorted suffixes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id.

Which suffixes are sorted: every ``LENGTH``-byte window names one of its ``GRAM``-byte grams, the one with the
smallest hash, as its anchor; equal windows name the same anchor. So two documents can share a window
only at anchors with equal grams. A first pass finds the anchor hashes that two documents hold (a hash
aggregate with map-side partials) and marks them in a bitmap of fixed size; a second pass ships the different
contexts of marked anchors (the bytes that windows around them can cover), each with the documents it lies
between. The bitmap only saves shuffling: what it marks by chance finds no partner later.

Per anchor hash the texts to the right of the anchor, and those to the left read backwards, are sorted
deep-shallow: multikey quicksort on eight-byte words to a shallow depth, then a blind trie orders each
group that still agrees. Neighbours' common prefixes give, for each of the windows around an anchor,
the classes of equal windows, and each class its smallest document id.

A third pass joins each anchor's place with what was decided for its context (a join that Spark can split where
one context is hot). Spans are gathered per document and the text is joined once more to cut them out. Contexts of
one hash are sorted by document id and streamed, so copies of any number cost no memory.

An anchor hash with more than ``MOST`` places may have as many different contexts, too many for one task. Its contexts
are not sorted: each names its windows by digests, an aggregate with map-side partials takes the smallest document of
each (hash, window), and a join that Spark can split brings it back to the contexts.

A context is known by its hash and a digest, 128 bits together, and a window of a hot hash by 128 bits besides the hash.

Defined results: a null text is an empty one; texts shorter than ``LENGTH`` bytes keep everything; a null id
counts as larger than all others; rows that share an id never remove each other's bytes, and equal rows
come out as often as they went in; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisflow.llm.common import bound_batches, byte_view, mix64, shuffles_freed, text_slices, written

LENGTH, GRAM = 50, 16
#: Bits of the map of shared anchor hashes that ships to the tasks (32 MB).
MAP_BITS = 1 << 28
#: The map is gathered in blocks of so many bits.
BLOCK_BITS = 1 << 20
#: Bytes to which the multikey sort goes before blind tries take over.
SHALLOW = 32
#: Bytes whose anchors are found at once.
STRETCH = 1 << 18
#: Anchors handled at once in a task.
ROWS = 50_000
#: Places of an anchor hash up to which one task sorts its contexts.
MOST = ROWS
_LAST = (1 << 63) - 1
#: Odd factors of the two words of a window's digest.
WORDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    eights = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    size = n - gram + 1
    h = eights[:size] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for k in [*range(8, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
        h ^= eights[k:k + size]
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(32)
    # Half of the bits rank the grams; zero stands for windows that leave their text.
    rank = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = _slide(rank, width, np.minimum)
    for start in offsets[1:-1].tolist():
        low[max(0, start - length + 1):start] = 0
    # A gram is named if the largest minimum of the windows that hold it is its own rank.
    padded = np.zeros(len(low) + 2 * (width - 1), np.uint32)
    padded[width - 1:width - 1 + len(low)] = low
    at = np.flatnonzero(_slide(padded, width, np.maximum) == rank)
    return at, h[at]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the grams that some window inside a text names; all of them among equal ranks.

    Whole texts at a time, about ``stretch`` bytes, so that the arrays of a step stay in the processor's cache.
    """
    out, i = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + stretch, side="right")) - 1)
        at, h = _anchors(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], length, gram)
        out.append((at + offsets[i], h))
        i = j
    return np.concatenate([at for at, _ in out]), np.concatenate([h for _, h in out])


def multikey_sort(words: np.ndarray, group: np.ndarray, lengths: np.ndarray, raw: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of byte strings within their groups (groups ascending); shorter strings come before their extensions.

    ``words``: the strings as big-endian words, zero-padded; ``raw``: the same bytes.
    """
    order = np.argsort(group, kind="stable")
    run = np.cumsum(np.diff(group[order], prepend=group[order][:1] if len(group) else 0) != 0)
    depth = 0
    while True:
        # Rows of runs with more than one string.
        sizes = np.bincount(run, minlength=int(run.max(initial=0)) + 1)
        open_ = np.flatnonzero(sizes[run] > 1)
        if not len(open_) or 8 * depth >= shallow or depth >= words.shape[1]:
            break
        key = words[order[open_], depth]
        ranked = np.lexsort((key, run[open_]))
        order[open_] = order[open_][ranked]
        key = key[ranked]
        fresh = np.zeros(len(order), bool)
        fresh[open_[1:]] = (np.diff(open_) == 1) & (key[1:] != key[:-1])
        run = np.cumsum((np.diff(run, prepend=run[:1]) != 0) | fresh)
        depth += 1
    if len(open_):
        for part in np.split(open_, np.flatnonzero(np.diff(run[open_])) + 1):
            ids = order[part]
            order[part] = ids[blind_trie_order([raw[i, :lengths[i]].tobytes() for i in ids])]
    return order


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of a few strings with long common prefixes, by a compacted trie that keeps branching bytes only."""
    common = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    byte = lambda s, k: s[k] if k < len(s) else -1
    root: tuple | list = [0]  # a leaf: numbers of equal strings; a node: (depth, children by byte)
    for i, s in enumerate(strings[1:], 1):
        node = root
        while isinstance(node, tuple):  # blind: unknown bytes go to any child
            node = node[1].get(byte(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[0]]
        if s == other:
            node.append(i)
            continue
        depth, above, node = common(s, other), None, root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][byte(s, node[0])]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][byte(s, depth)] = [i]
            continue
        split = (depth, {byte(other, depth): node, byte(s, depth): [i]})
        if above is None:
            root = split
        else:
            above[1][byte(s, above[0])] = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def sorted_classes(raw: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the strings' order within groups, and each one's common prefix with the one before; -1 opens a group."""
    n, width = raw.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = raw
    order = multikey_sort(padded.view(">u8").astype(np.uint64), group, lengths, raw)
    common = np.full(n, -1, np.int64)
    if n > 1:
        a, b = raw[order[1:]], raw[order[:-1]]
        differ = a != b
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        both = np.minimum(lengths[order[1:]], lengths[order[:-1]])
        common[1:] = np.where(group[order[1:]] == group[order[:-1]], np.minimum(first, both), -1)
    return order, common


def earlier_offsets(h: np.ndarray, lead: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray,
                    length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of some different contexts the smallest and largest offset of a window that starts that far before the
    anchor and also occurs in a context of the same hash with a smaller document; -1: none.

    ``lead``: a context's smallest document. All windows of an anchor hold its gram, so their union is one span.
    """
    lo, hi = np.full(len(h), -1), np.full(len(h), -1)
    group = np.unique(h, return_inverse=True)[1]
    many = np.flatnonzero(np.bincount(group)[group] > 1) if len(h) else np.zeros(0, np.int64)
    if not len(many):
        return lo, hi
    group, lead, left, n_left, right, n_right = (x[many] for x in (group, lead, left, n_left, right, n_right))
    r_order, r_common = sorted_classes(right, n_right, group)
    l_order, l_common = sorted_classes(left, n_left, group)
    m = len(many)
    c_lo, c_hi = np.full(m, -1), np.full(m, -1)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(length - gram + 1):
        fits = np.flatnonzero((n_left >= o) & (n_right >= length - o))
        if len(fits) < 2:
            continue
        r_class[r_order], l_class[l_order] = np.cumsum(r_common < length - o), np.cumsum(l_common < o)
        _, of = np.unique(r_class[fits] * (m + 1) + l_class[fits], return_inverse=True)
        least = np.full(int(of.max()) + 1, _LAST, np.int64)
        np.minimum.at(least, of, lead[fits])
        hit = fits[least[of] < lead[fits]]
        c_lo[hit] = np.where(c_lo[hit] < 0, o, c_lo[hit])
        c_hi[hit] = o
    lo[many], hi[many] = c_lo, c_hi
    return lo, hi


def distinct_pairs(h: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, of): the first row of each different (hash, digest), and the number of each row's pair."""
    order = np.lexsort((digest, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (digest[order[1:]] != digest[order[:-1]])
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def _digest(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit digest of zero-padded rows and their lengths."""
    padded = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    padded[:, :raw.shape[1]] = raw
    out = lengths.astype(np.uint64)
    for word in padded.view("<u8").T:
        out = mix64((out ^ word) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return out


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Zero-padded rows of ``width`` bytes read from ``starts`` on, forwards or backwards."""
    k = np.arange(width)
    held = k < np.minimum(lengths, width)[:, None]
    return np.where(held, data[np.where(held, starts[:, None] + step * k, 0)], 0).astype(np.uint8) if len(data) else np.zeros((len(starts), width), np.uint8)


def window_digests(left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, length: int, gram: int, odd: int = WORDS[0]):
    """(offset, rows, digests) of the windows that start so far before the anchor, for each offset and the contexts that hold it."""
    step = lambda x, byte: mix64((x ^ (byte.astype(np.uint64) + np.uint64(1))) * np.uint64(odd))
    reach = length - gram
    ends, x = [], np.zeros(len(right), np.uint64)
    for k in range(length):
        x = step(x, right[:, k])
        if k + 1 >= gram:
            ends.append(x)
    x = np.full(len(left), length, np.uint64)
    for o in range(reach + 1):
        if o:
            x = step(x, left[:, o - 1])
        fits = np.flatnonzero((n_left >= o) & (n_right >= length - o))
        yield o, fits, mix64(x[fits] * np.uint64(3) ^ ends[reach - o][fits] + np.uint64(o))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, map_bits: int = MAP_BITS, most: int = MOST) -> DataFrame:
    """(doc, tag, start, end): byte spans to remove from ``docs`` (doc, tag, text); they may overlap."""
    if not 8 <= gram <= length:
        raise ValueError("the gram must have 8 bytes at least and fit into the length")
    spark, reach = docs.sparkSession, length - gram
    bound_batches(spark)

    def hashes(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = byte_view(part.column(1))
                at, h = anchors(data, offsets, length, gram)
                ids = np.asarray(part.column(0))[np.searchsorted(offsets, at, side="right") - 1]
                order = np.lexsort((ids, h))
                h, ids = h[order], ids[order]
                first = np.flatnonzero(np.diff(h, prepend=~h[:1]) != 0)
                last = np.append(first[1:], len(h))[:len(first)] - 1
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(ids[first]), pa.array(ids[last]), pa.array(last - first + 1)], names=["h", "lo", "hi", "n"])

    held = docs.select("doc", "text").mapInArrow(hashes, "h long, lo long, hi long, n long").groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))

    def blocks(batches):
        maps: dict[int, np.ndarray] = {}  # 1: shared, 2: hot
        for batch in batches:
            bit, both, hot = np.asarray(batch.column(1)), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            for k in np.unique(bit // BLOCK_BITS).tolist():
                own = bit // BLOCK_BITS == k
                m = maps.setdefault(k, np.zeros(BLOCK_BITS, np.uint8))
                m[bit[own & both] % BLOCK_BITS] |= 1
                m[bit[own & hot] % BLOCK_BITS] |= 2
        for k, m in maps.items():
            packed = [zlib.compress(np.packbits(m & 1, bitorder="little").tobytes(), 1), (np.flatnonzero(m & 2) + k * BLOCK_BITS).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], names=["block", "bits", "hot"])

    bit = F.pmod("h", F.lit(map_bits))
    dealt = held.where((F.col("lo") < F.col("hi")) | (F.col("n") > most)).select((bit / BLOCK_BITS).cast("long").alias("block"), bit.alias("bit"), F.expr("lo < hi").alias("both"), (F.col("n") > most).alias("hot")).repartition("block")
    marks = np.zeros(-(-map_bits // BLOCK_BITS) * BLOCK_BITS // 8, np.uint8)
    hot = [np.zeros(0, np.int64)]
    with shuffles_freed(spark):
        # At most map_bits in all, and one number for each ``most`` places.
        for r in dealt.mapInArrow(blocks, "block long, bits binary, hot binary").collect():
            hot.append(np.frombuffer(r["hot"], np.int64))
            part = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
            marks[r["block"] * (BLOCK_BITS // 8):][:len(part)] |= part
    hot = np.sort(np.concatenate(hot))
    shared, crowded = spark.sparkContext.broadcast(marks), spark.sparkContext.broadcast(hot)

    def marked_anchors(texts: pa.Array, only_hot: bool | None = None):
        """(row, position, hash, context digest, left, n_left, right, n_right) of the anchors on the map: all, or only the hot ones, or only the others."""
        data, offsets = byte_view(texts)
        at, h = anchors(data, offsets, length, gram)
        place = h.view(np.int64) % map_bits
        keep = (shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        if only_hot is not None and len(crowded.value):
            keep &= np.isin(place, crowded.value) == only_hot
        at, h = at[keep], h[keep]
        row = np.searchsorted(offsets, at, side="right") - 1
        n_left, n_right = np.minimum(reach, at - offsets[row]), np.minimum(length, offsets[row + 1] - at)
        left, right = _matrix(data, at - 1, n_left, max(1, reach), -1), _matrix(data, at, n_right, length)
        return row, at - offsets[row], h, mix64(h ^ _digest(left, n_left) * np.uint64(3) ^ _digest(right, n_right)), left, n_left, right, n_right

    def different(part: pa.RecordBatch, only_hot: bool):
        """Different contexts of a slice with the smallest and largest document that holds each."""
        row, _, h, digest, left, n_left, right, n_right = marked_anchors(part.column(1), only_hot)
        first, of = distinct_pairs(h, digest)
        doc = np.asarray(part.column(0))[row]
        lo, hi = np.full(len(first), _LAST), np.full(len(first), -_LAST)
        np.minimum.at(lo, of, doc)
        np.maximum.at(hi, of, doc)
        return h[first].view(np.int64), lo, hi, digest[first].view(np.int64), left[first], n_left[first], right[first], n_right[first]

    def contexts(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                h, lo, hi, digest, left, n_left, right, n_right = different(part, False)
                both = np.hstack([left, right])
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(lo), pa.array(hi), pa.array(digest), pa.array(n_left.astype(np.int32)),
                                                  pa.array(n_right.astype(np.int32)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(both.shape[1]), len(h), [None, pa.py_buffer(np.ascontiguousarray(both))]).cast(pa.binary())],
                                                 names=["h", "lo", "hi", "digest", "n_left", "n_right", "context"])

    def windows(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                h, lo, hi, digest, left, n_left, right, n_right = different(part, True)
                words = [window_digests(left, n_left, right, n_right, length, gram, odd) for odd in WORDS]
                for (o, of, window), (_, _, more) in zip(*words) if len(h) else ():
                    yield pa.RecordBatch.from_arrays([pa.array(h[of]), pa.array(window.view(np.int64)), pa.array(more.view(np.int64)), pa.array(digest[of]), pa.array(lo[of]), pa.array(hi[of]),
                                                      pa.array(np.full(len(of), o))], names=["h", "window", "more", "digest", "lo", "hi", "o"])

    def decided_by_window() -> DataFrame:
        """What ``decide`` says, for the hot hashes."""
        named = docs.select("doc", "text").mapInArrow(windows, "h long, window long, more long, digest long, lo long, hi long, o long")
        named = written(named.groupBy("h", "window", "more", "digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("o").alias("o")), "windows")
        # Written, so that the join has two plain exchanges and Spark can split a window that very many contexts hold.
        least = written(named.groupBy("h", "window", "more").agg(F.min("lo").alias("least")), "least")
        own = F.when(F.col("least") < F.col("lo"), F.col("o"))
        of = named.join(least, ["h", "window", "more"]).groupBy("h", "digest").agg(F.min("lo").alias("lead"), F.max("hi").alias("last"), F.min("o").alias("full_lo"), F.max("o").alias("full_hi"),
                                                                     F.coalesce(F.min(own), F.lit(-1)).alias("own_lo"), F.coalesce(F.max(own), F.lit(-1)).alias("own_hi"))
        return of.where("own_lo >= 0 or last > lead").drop("last")

    def decide(batches):
        """Rows of one hash come by ascending document: a context's first row has its smallest one."""
        names = ["h", "digest", "lead", "full_lo", "full_hi", "own_lo", "own_hi"]
        kept, rows, count = None, [], 0  # kept: the contexts of the hash that goes on

        def close():
            nonlocal kept
            h, lo, hi, digest, n_left, n_right, both = (np.concatenate([r[i] for r in rows]) for i in range(7))
            old = len(kept[0]) if kept is not None and kept[0][0] == h[0] else 0
            if old:
                h, lo, hi, digest, n_left, n_right, both = (np.concatenate([k, x]) for k, x in zip(kept, (h, lo, hi, digest, n_left, n_right, both)))
            first, of = distinct_pairs(h, digest)
            last = np.full(len(first), -_LAST)
            np.maximum.at(last, of, hi)
            h, lead, digest, n_left, n_right, both = (x[first] for x in (h, lo, digest, n_left, n_right, both))
            width = max(1, reach)
            own_lo, own_hi = earlier_offsets(h, lead, both[:, :width], n_left, both[:, width:], n_right, length, gram)
            on = h == np.concatenate([r[0] for r in rows])[-1]
            kept = tuple(x[on] for x in (h, lead, last, digest, n_left, n_right, both))
            say = (own_lo >= 0) | (last > lead) & (length - n_right <= n_left)
            return pa.RecordBatch.from_arrays([pa.array(x[say]) for x in (h, digest, lead, length - n_right, n_left, own_lo, own_hi)], names=names)

        for batch in batches:
            if batch.num_rows:
                h, lo, hi, digest, n_left, n_right = (np.asarray(batch.column(i)).astype(np.int64) for i in range(6))
                rows.append((h, lo, hi, digest, n_left, n_right, byte_view(batch.column(6))[0].reshape(len(h), -1)))
                count += len(h)
                if count >= ROWS:
                    yield close()
                    rows, count = [], 0
        if rows:
            yield close()

    def occurrences(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                row, at, h, digest, *_ = marked_anchors(part.column(2))
                doc, tag = (np.asarray(part.column(i))[row] for i in range(2))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(doc), pa.array(tag), pa.array(at.astype(np.int32))],
                                                 names=["h", "digest", "doc", "tag", "at"])

    # Texts are cut off before the shuffles: of copies a task sends one context, and the rows of a hot hash are its different contexts.
    dealt = docs.select("doc", "text").mapInArrow(contexts, "h long, lo long, hi long, digest long, n_left int, n_right int, context binary")
    dealt = dealt.repartition("h").sortWithinPartitions("h", "lo")
    decided = dealt.mapInArrow(decide, "h long, digest long, lead long, full_lo long, full_hi long, own_lo long, own_hi long")
    # Summed up before it is written, so that the join below has two plain exchanges and Spark can split a hot context.
    decided = decided.groupBy("h", "digest").agg(F.min("lead").alias("lead"), *[F.max(c).alias(c) for c in ("full_lo", "full_hi", "own_lo", "own_hi")])
    decided = written(decided.unionByName(decided_by_window()) if len(hot) else decided, "contexts")
    met = docs.select("doc", "tag", "text").mapInArrow(occurrences, "h long, digest long, doc long, tag long, at int").join(decided, ["h", "digest"])
    later = F.col("doc") > F.col("lead")
    met = met.select("doc", "tag", "at", F.when(later, F.col("full_lo")).otherwise(F.col("own_lo")).alias("lo"), F.when(later, F.col("full_hi")).otherwise(F.col("own_hi")).alias("hi"))
    return met.where("lo >= 0 and lo <= hi").select("doc", "tag", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + length).alias("end"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, map_bits: int = MAP_BITS, most: int = MOST) -> DataFrame:
    """(id, text, kept, spans): the kept bytes and the removed runs (start, end) of each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.select(F.coalesce("id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("tag"), "text", "id")
    found = written(spans(keyed.select("doc", "tag", "text"), length, gram, map_bits, most), "spans")
    of = found.distinct().groupBy("doc", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    both = keyed.join(of, ["doc", "tag"], "left").select("id", "text", "spans.start", "spans.end")
    bound_batches(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                kept, runs = [], []
                data, offsets = byte_view(part.column(1))
                for i, (starts, ends) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    body, out, at = data[offsets[i]:offsets[i + 1]].tobytes(), [], []
                    for a, b in zip(starts or (), ends or ()):
                        if at and a <= at[-1][1]:
                            at[-1][1] = max(at[-1][1], b)
                        else:
                            at.append([a, b])
                    last = 0
                    for a, b in at:
                        out.append(body[last:a])
                        last = b
                    kept.append(b"".join([*out, body[last:]]))
                    runs.append([{"start": a, "end": b} for a, b in at])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(kept, pa.binary()),
                                                  pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["id", "text", "kept", "spans"])

    return both.mapInArrow(cut, "id long, text string, kept binary, spans array<struct<start:bigint,end:bigint>>").withColumnRenamed("id", id_col)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of what is kept."""
    made = remove_repeats(docs)
    n = F.octet_length("text").cast("long")
    return made.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
