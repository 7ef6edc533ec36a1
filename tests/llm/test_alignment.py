import functools
import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cubagem.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", None, "The thing is that", "zażółć\n\ngęślą jaźń", "\x00\x01 odd", "日本語の文章です。😀😀 end", "a▁b", "  two  spaces  ",
    "<|endoftext|> <s> </s> <unk> <0x41>", "a" * 300, "The thing is that", " ", "1234567890 ¼ ​  x",
]


@functools.cache
def encoders():
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    return own, alignment._byte_letters(), sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text):
    """Ids and byte ranges by the libraries' own encoders; none where bytes differ."""
    own, letters, pieces = encoders()
    if not text:
        return [], []
    a = [(i, bytes(letters[c] for c in own.id_to_token(i))) for i in own.encode(" " + text, add_special_tokens=False).ids]
    b = [
        (i, bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
        for i in pieces.encode(text) for p in [pieces.id_to_piece(i)]
    ]
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        at, ranges = 0, []
        for i, piece in side:
            ranges.append((i, at, at + len(piece)))
            at += len(piece)
        out.append(ranges)
    return out


def brute(rows):
    both = [(doc_id, *tokens(text)) for doc_id, text in rows]
    links = [[(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] for _, a, b in both]
    counts = Counter(pair for own in links for pair in set(own))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    out = []
    for (doc_id, a, b), own in zip(both, links, strict=True):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts = [
            ",".join(str(i) for i, s, e in a if lo <= s and e <= hi) + "|" + ",".join(str(i) for i, s, e in b if lo <= s and e <= hi)
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""
        best = sum(counts[p] == highest[p[0]] for p in own)
        out.append((doc_id, len(a), len(b), len(cuts), len(own), best, sum(counts[p] for p in own), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [(1 << 20, 16 << 20), (64, 200)])
def test_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(alignment, "SLICE_BYTES", limits[0])
    monkeypatch.setattr(alignment, "BLOCK_BYTES", limits[1])
    rows = [*enumerate(TEXTS), (None, "no id"), (2, "The thing is that"), (50, "word here and there. " * 200)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id int, text string, pair string, n int")
    found = alignment.align_tokenizers(docs.repartition(3), A, B)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
    assert alignment.align_tokenizers(docs.limit(0), A, B).collect() == []


def test_groups_and_links_of_lengths():
    found = alignment.align(np.array([2, 3, 1, 4]), np.array([1, 1, 5, 3]))
    assert found.group_a.tolist() == [0, 1, 1, 1]
    assert found.group_b.tolist() == [0, 0, 1, 1]
    assert list(zip(found.link_a.tolist(), found.link_b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (2, 2), (3, 2), (3, 3)]


def test_encoders_agree():
    coder = alignment.ByteLevel(A)
    assert coder.fast is not None
    for text in filter(None, TEXTS):
        assert coder.encode(" " + text) == encoders()[0].encode(" " + text, add_special_tokens=False).ids
    coder.fast = None
    assert coder.encode(" a b") == alignment.ByteLevel(A).encode(" a b")


def test_other_merge_orders_use_the_files_own_library(tmp_path):
    described = json.load(open(A, encoding="utf-8"))
    described["model"]["merges"] = described["model"]["merges"][1:]
    path = tmp_path / "own.json"
    path.write_text(json.dumps(described))
    coder = alignment.ByteLevel(str(path))
    assert coder.fast is None and coder.encode(" the a")
