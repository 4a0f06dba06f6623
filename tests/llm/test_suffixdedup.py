import hashlib
import random

import pytest

from seisflow.llm import suffixdedup


def brute(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first[b[p:p + length]] = min(i, first.get(b[p:p + length], i))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


def mixed(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcd é\0") for _ in range(rng.randrange(30, 160))) for _ in range(30)]
    rows = []
    for i in range(150):
        t = ""
        for _ in range(rng.randrange(0, 6)):
            x = rng.choice(pool)
            a = rng.randrange(len(x))
            t += (x[a:] if rng.random() < .5 else x[:a]) + ("" if rng.random() < .5 else "".join(rng.choice("xyz") for _ in range(rng.randrange(1, 40))))
        rows.append((i, t))
    rows += [(1000, "a" * 500), (1001, "a" * 300), (1002, "ab" * 200), (1003, "ab" * 100 + "c" + "ab" * 100), (1004, ""), (1005, "\0" * 200), (1006, "\0" * 60), (1007, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("at_once", [50_000, 60])
def test_equals_brute_force(frame, monkeypatch, at_once):
    monkeypatch.setattr(suffixdedup, "ROWS", at_once)
    rows = mixed(at_once)
    got = {r[0]: tuple(r)[1:] for r in suffixdedup.repeat_digests(frame(rows, parts=5)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("most, tables", [(2, ["windows", "least", "contexts", "spans"]), (10**6, ["contexts", "spans"])])
def test_hot_hashes_go_by_window(frame, monkeypatch, most, tables):
    """One gram in very many contexts, and all kinds of texts, when few places make a hash hot."""
    seen, kept = [], suffixdedup.written
    monkeypatch.setattr(suffixdedup, "written", lambda df, name: seen.append(name) or kept(df, name))
    rng = random.Random(most)
    around = lambda n: "".join(rng.choice("ab") for _ in range(n)) + rng.choice(["", "c" * 20, "d" * 30])
    rows = mixed(3) + [(2000 + i, around(rng.randrange(4)) + "-" * 16 + around(rng.randrange(4)) + "e" * rng.randrange(40)) for i in range(400)]
    want = brute(rows)
    assert sum(x[1] > 0 for i, x in want.items() if i >= 2000) > 50
    made = suffixdedup.remove_repeats(frame(rows, parts=5), most=most).collect()
    assert {r.doc_id: (len((r.text or "").encode()), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in made} == {i: (x[0], x[3]) for i, x in want.items()}
    assert seen == tables


def test_window_digests_are_equal_where_windows_are():
    import numpy as np

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(12)) for _ in range(60)]
    left, right = (np.array([list(t[a:b].encode()) for t in texts], np.uint8) for a, b in ((0, 4), (4, 12)))
    names: dict = {}
    for o, of, window in suffixdedup.window_digests(left, np.full(60, 3), right, np.full(60, 8), 8, 4):
        assert len(of) == (60 if o < 4 else 0)
        for i, w in zip(of.tolist(), window.tolist()):
            names.setdefault((o, bytes(left[i, :o]), bytes(right[i, :8 - o])), set()).add(w)
    assert all(len(x) == 1 for x in names.values()) and len(set.union(*names.values())) == len(names)


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r[0]: tuple(r)[1:] for r in suffixdedup.repeat_digests(docs).collect()} == brute(rows)


def test_blind_trie_and_multikey_order():
    rng = random.Random(1)
    strings = [b"x" * 30 + bytes(rng.choices(b"ab\0", k=rng.randrange(0, 9))) for _ in range(200)]
    assert [strings[i] for i in suffixdedup.blind_trie_order(strings)] == sorted(strings)
    import numpy as np

    raw = np.zeros((200, 40), np.uint8)
    for i, s in enumerate(strings):
        raw[i, :len(s)] = np.frombuffer(s, np.uint8)
    lengths, group = np.array([len(s) for s in strings]), np.array([i % 3 for i in range(200)])
    order, common = suffixdedup.sorted_classes(raw, lengths, group)
    want = sorted(range(200), key=lambda i: (i % 3, strings[i]))
    assert [strings[i] for i in order] == [strings[i] for i in want]
    assert (common == -1).sum() == 3


def test_odd_rows(frame, odd):
    assert suffixdedup.repeat_digests(frame([])).count() == 0
    assert suffixdedup.repeat_digests(odd).count() == odd.count()
    same = frame([(1, "z" * 60), (1, "z" * 60), (2, "z" * 60), (None, "z" * 60)])
    got = sorted((r.doc_id or 99, r.n_removed) for r in suffixdedup.repeat_digests(same).collect())
    assert got == [(1, 0), (1, 0), (2, 60), (99, 60)]


def test_contexts_with_equal_digests_differ_by_their_hash():
    np = suffixdedup.np
    h, digest = np.array([5, 9, 5, 5, 9], np.uint64), np.array([1, 1, 1, 2, 1], np.uint64)
    first, of = suffixdedup.distinct_pairs(h, digest)
    assert sorted(zip(h[first].tolist(), digest[first].tolist())) == [(5, 1), (5, 2), (9, 1)]
    assert (h[first][of] == h).all() and (digest[first][of] == digest).all()


@pytest.mark.parametrize("gram", [8, 10, 16, 24])
def test_equal_windows_name_equal_anchors(gram):
    """Each window of a text names a gram inside it, and where the window stands or how texts are cut up does not matter."""
    np, rng = suffixdedup.np, random.Random(gram)
    texts = ["".join(rng.choice("abé ") for _ in range(rng.randrange(0, 300))) for _ in range(40)] + ["a" * 200, "", "x" * 49]
    texts += [rng.choice(texts) + rng.choice(texts) for _ in range(20)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    named = {}
    for stretch in (1, 700, 1 << 18):
        at, h = suffixdedup.anchors(data, offsets, 50, gram, stretch)
        found = list(zip(at.tolist(), h.tolist()))
        named.setdefault("all", found)
        assert found == named["all"]
    place = dict(named["all"])
    windows = {}
    for i, t in enumerate(raw):
        for p in range(len(t) - 49):
            inside = tuple((q, place[offsets[i] + p + q]) for q in range(50 - gram + 1) if int(offsets[i]) + p + q in place)
            assert inside
            windows.setdefault(t[p:p + 50], []).append(set(inside))
    assert all(set.intersection(*seen) for seen in windows.values())
