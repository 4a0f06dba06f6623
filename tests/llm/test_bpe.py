import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seisflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a  <|endoftext|> b", "<|endoftext|><|endoftext|>", None, "", "  x  ", "it's  John's\n\n  ok\t\tb", "日本語 123４５ ñandú   ", "!!'s '  ' 're",
         "a b　 c\x85d​q", "😀😀 é é", "<|endoftext", "x\r\n\r\ny \n z", "x" * 30000, "<|endoftext|>" * 50]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_text_as_the_library(frame, docs, tokenizer):
    texts = TEXTS + [r.text for r in docs.limit(80).collect()]
    got = {r.doc_id: r for r in bpe.token_digests(frame(list(enumerate(texts))), PATH).collect()}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_unknown_ids_and_null_lists(spark):
    df = spark.createDataFrame([(1, [31373, 99999999, -1, None]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, bpe.Vocabulary(PATH)).collect()} == {1: "hello", 2: "", 3: ""}


def test_odd_rows(odd, frame):
    made = bpe.encode(odd, bpe.Vocabulary(PATH))
    assert set(made.columns) == {"doc_id", "spans", "score", "ids"} and made.count() == odd.count()
    assert bpe.token_digests(frame([]), PATH).count() == 0


def test_words_of_rows_and_single_words_have_their_own_ids(tokenizer):
    """Ids of each word, whether it goes in a row with others or by itself."""
    words = [" the", " abc", "abc", " 123", " ñandú", " 日本", " a1", "  ", " é", ".", " .", "'s", " x" * 2, " " + "q" * 3000, "<|endoftext|>", " Ⅷ", " ²", " ́a"]
    words += [f" w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9000)]
    words = list(dict.fromkeys(words))
    flat, lengths = bpe.Vocabulary(PATH).encode_words(bpe.pa.array(words))
    at = 0
    for w, n in zip(words, lengths.tolist()):
        assert flat[at:at + n].tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w
        at += n
    assert at == len(flat)
    assert [len(x) for x in bpe.Vocabulary(PATH).encode_words(bpe.pa.array([], bpe.pa.string()))] == [0, 0]
