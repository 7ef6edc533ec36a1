import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from cubagem.llm.token_counts import Counter, count_tokens, load_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  a", "a  b ", "The thing", "zażółć\n\ngęślą jaźń", "\x00\x01", "日本語の文章です。😀😀 end", "▁x", "x▁ y",
    "a" * 500, "word " * 300, "1234567890", "<|im_start|>",
]


def tokenizer(pieces):
    own = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))
    own.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return own


def check(pieces, texts):
    own, counter = tokenizer(pieces), Counter(pieces, by_bytes=False)
    for text in texts:
        assert counter.text(text)[0] == len(own.encode(text).ids), text


def test_real_vocabulary():
    check(load_pieces(MODEL), TEXTS)


def test_ties():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"".join(rng.choices("▁abc", k=rng.randint(1, 4))): float(-rng.randint(1, 4)) for _ in range(12)}
        texts = ["".join(rng.choices(" abcd", k=rng.randint(0, 30))) for _ in range(20)]
        check(list(pieces.items()), texts)


@pytest.fixture(scope="module")
def byte_tokenizer():
    pieces = [(f"<0x{b:02X}>", 0.0) for b in range(256)] + load_pieces(MODEL)
    own = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=True))
    own.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return own


def test_documents(spark, byte_tokenizer):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, None, 1), (3, "a", 1), (3, "a", 1), (9, "é" * 30000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = count_tokens(docs, MODEL).collect()
    expected = [(i, len(byte_tokenizer.encode(t or "").ids)) for i, t, _ in rows]
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in found), key=str) == sorted(expected, key=str)
    assert count_tokens(docs.limit(0), MODEL).collect() == []
