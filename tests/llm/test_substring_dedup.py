import hashlib
import random
from collections import Counter

import pytest

from cubagem.llm.substring_dedup import deduplicated_texts, remove_repeats

DOCS = "doc_id long, text string, bucket int, n_words string, gram string"


def brute(rows, size=35):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(seed, letters):
    rng = random.Random(seed)
    word = (lambda: rng.choice(letters)) if letters else (lambda: f"w{rng.randrange(10**6)}")
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 90, 35, 400)]
    texts = []
    for i in range(120):
        text = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1)))
            text += p[a:b] if i % 2 else p
            text += [word() for _ in range(rng.randint(0, 20))]
        texts.append(text)
    texts += [texts[5], texts[6], ["x"] * 300, ["x"] * 35, ["x"] * 36, ["a", "b"] * 200, [word() for _ in range(9000)] + passages[4]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (902, "é\tÉ \n x"), (None, rows[7][1]), rows[8], rows[8]]


@pytest.mark.parametrize("seed,letters", [(1, None), (2, "ab"), (3, "abcdefgh")])
def test_equals_all_windows(spark, seed, letters):
    rows = corpus(seed, letters)
    docs = spark.createDataFrame([(*r, 1, "", "") for r in rows], DOCS).repartition(3)
    found = [tuple(r) for r in remove_repeats(docs).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def test_texts(spark):
    rows = corpus(4, None)
    docs = spark.createDataFrame([(*r, 1, "", "") for r in rows], DOCS)
    digests = Counter((r[0], r[3]) for r in brute(rows))
    texts = deduplicated_texts(docs).collect()
    assert Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in texts) == digests


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
