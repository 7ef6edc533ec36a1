import random

import pytest

from cubagem.llm import language_id as L

DOCS = "doc_id long, text string, lang string, source string, score string"


def cross_parse(text, sample):
    """Phrases by search, block by block."""
    count = 0
    for begin in range(0, len(text), L.BLOCK):
        block, at = text[begin : begin + L.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at : at + size + 1] in sample and block[at : at + size] in sample:
                size += 1
            count, at = count + 1, at + size
    return count


def test_phrases_equal_search():
    rng = random.Random(2)
    samples = tuple((name, bytes(rng.choices(letters, k=700))) for name, letters in (("x", b"abc "), ("y", b"abde")))
    parser = L.CrossParser(samples)
    texts = [bytes(rng.choices(b"abcdez ", k=n)) for n in (1, 5, 300, 5000)] + [b"zzzz", samples[0][1]]
    bits = parser.phrases(texts)
    for i, text in enumerate(texts):
        for k, (_, sample) in enumerate(samples):
            assert bits[i, k] * len(text) / parser.cost[k] == pytest.approx(cross_parse(text, sample))


def words(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def test_documents(spark):
    rng = random.Random(3)
    kinds = {"p": ["ka", "lo", "mi", "té"], "q": ["sch", "un", "ge", "ei"], "r": ["ion", "the", "an", "er"]}
    rows = [(i, words(rng, kinds[k], 5 + i % 60), k, "s", "") for i in range(150) for k in "pqr"]
    rows += [(9001, None, "p", "s", ""), (9002, "", "q", "s", ""), (9003, "123 ..", "r", "s", ""),
             (None, words(rng, kinds["p"], 9), None, None, ""), (9004, words(rng, kinds["q"], 30000), None, "s", "")]
    rows += rows[-2:]
    found = L.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (9001, 9002, 9003, 9004, None)] == ["und", "und", "und", "q", "p"]
    held = [r for r in found if r["held_out"] and r["doc_id"] < 9000]
    truth = {(r[0], r[1]): r[2] for r in rows}
    assert held and all(0 <= r["score"] <= 1 for r in found)
    counts = {k: sum(r["lang_pred"] == k for r in held) for k in "pqr"}
    assert len(set(counts.values())) == 1 and truth


def test_nothing_to_learn(spark):
    found = L.identify(spark.createDataFrame([(1, "abc", None, "s", "")], DOCS)).collect()
    assert [r["lang_pred"] for r in found] == ["und"]
    assert L.identify(spark.createDataFrame([], DOCS)).collect() == []
