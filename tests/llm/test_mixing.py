import hashlib
import re
from collections import defaultdict

import pytest

from cubagem.llm.mixing import mix_documents, mixture

DOCS = "doc_id long, text string, source string, size string, copies int, rate string"


def levelled(sizes):
    """Targets by sharing again and again until none is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, rest, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 3 * sizes[s]
            rest -= target[s]
            open_.remove(s)
    return target


def count(text):
    return len(re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode()))


@pytest.mark.parametrize("shape", [{"a": 3, "b": 90, "c": 40, "d": 1, None: 20, "é": 0}, {"a": 5}, {"b": 1, "a": 100}])
def test_mixture(spark, shape):
    rows, n = [], 0
    for source, words in shape.items():
        for k in range(8):
            rows.append((n if n % 7 else None, "w x " * (words * (k % 3)), source))
            n += 1
    rows += [(1, None, "a"), (2, "", None), (3, "x\ty", "b")] * 2
    docs = spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    targets = levelled(sizes)
    found = mixture(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        key = "mix:" + ("" if r["doc_id"] is None else str(r["doc_id"]))
        drawn = int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / 2**32
        assert r["copies"] == int(rate + 1e-12) + (drawn < rate - int(rate + 1e-12))
    assert mix_documents(docs).columns == docs.columns
    assert mix_documents(docs).count() == sum(r["copies"] for r in found)


def test_taken_comes_near_the_target(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(4000)]
    docs = spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS)
    for r in mixture(docs).groupBy("source").agg({"target": "max"}).collect():
        taken = sum(x["size"] * x["copies"] for x in mixture(docs).where(f"source = '{r[0]}'").collect())
        assert taken == pytest.approx(r[1], rel=0.05)


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixture(docs).collect() == [] and mix_documents(docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a", "", 1, ""), (2, " ", "b", "", 1, "")], DOCS)
    assert [r["copies"] for r in mixture(blank).collect()] == [0, 0]
