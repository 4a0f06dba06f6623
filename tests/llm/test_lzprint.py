import hashlib

from seisflow.llm import lzprint


def phrases(data):
    """The parse, phrase by phrase, with a plain set."""
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


def test_parse_gives_the_phrase_set():
    for data in (b"", b"a", b"aaaaaaa", b"abracadabra abracadabra", bytes(range(256)) * 3):
        ends = lzprint.phrase_ends(data)
        assert {data[a:b] for a, b in zip([0, *ends], ends)} == phrases(data)


def test_likeness_estimates_the_share_of_common_phrases(docs):
    texts = [r.text.encode() for r in docs.where("length(text) between 2000 and 6000").limit(12).collect()]
    for a, b in zip(texts, texts[1:]):
        mixed = a[:len(a) // 2] + b[len(b) // 2:]
        p, q = phrases(a), phrases(mixed)
        assert abs(lzprint.likeness(lzprint.signature(a), lzprint.signature(mixed)) - len(p & q) / len(p | q)) < 0.2
        assert lzprint.likeness(lzprint.signature(a), lzprint.signature(a)) == 1.0


def test_successors_and_edited_texts(docs):
    rows = sorted([(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()], reverse=True)
    got = {r.doc_id: r for r in lzprint.compare_with_successor(docs.repartition(5)).collect()}
    assert len(got) == len(rows)
    for (i, x), (_, y) in zip(rows, rows[1:] + rows[:1]):
        half = len(x) // 2
        edited = x[:len(x) - half] + y[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        sigs = [lzprint.signature(t.encode()) for t in (x, edited, y)]
        assert got[i].fingerprint == lzprint.text_of(sigs[0]) and got[i].edited_fingerprint == lzprint.text_of(sigs[1])
        assert (got[i].near_edited, got[i].near_next) == (lzprint.likeness(sigs[0], sigs[1]), lzprint.likeness(sigs[0], sigs[2]))


def test_odd_rows(frame, odd):
    assert lzprint.compare_with_successor(frame([])).count() == 0
    one = lzprint.compare_with_successor(frame([(7, "abc")])).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(7, 3, 1.0)]
    rows = {(r.doc_id, r.n_chars): r for r in lzprint.compare_with_successor(frame([(None, None), (3, "ab"), (3, "aaa"), (1, None)])).collect()}
    assert set(rows) == {(3, 3), (3, 2), (1, 0), (None, 0)}
    assert rows[1, 0].near_next == 1.0 and rows[None, 0].near_next == 0.0
    assert lzprint.compare_with_successor(odd).count() == odd.count()
    assert lzprint.fingerprints(odd, out="spans").where("length(spans) = 512").count() == odd.count()
