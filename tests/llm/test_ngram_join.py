import random

import pytest
from pyspark.sql import functions as F

from cubagem.llm import ngram_join as N
from cubagem.llm.components import components

DOCS = "doc_id long, text string, key string, size int, label string"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    n = min(len(words), 5)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    sets, label = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 75 * len(sets[i] | sets[k]):
                label[max(top(i), top(k))] = min(top(i), top(k))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc_id)
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(d, len(sets[i]), smallest[top(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    vocabulary, passage, texts = [f"w{i}" for i in range(300)], [f"p{i}" for i in range(50)], []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(4, 120))
        texts += [base, *(edited(rng, base, rng.randint(0, max(1, len(base) // 15))) for _ in range(rng.randint(0, 5)))]
    base = rng.choices(vocabulary, k=80)  # one large group, not all of which link
    texts += [edited(rng, base, rng.randint(0, 3)) for _ in range(60)]
    texts += [base[i:] + rng.choices(vocabulary, k=i) for i in range(0, 60, 2)]  # a chain
    texts += [passage + rng.choices(vocabulary, k=rng.randint(5, 40)) for _ in range(60)]
    rows = [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (None, rows[0][1]), (None, "a lonely text"), (5003, "A b\tC"),
             (5004, "a B c"), (5005, "a b c d"), (5006, "w " * 9000), (5007, "w " * 40), (5008, "É a b c d e"), (5009, "é a b c d e"),
             rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hubs", [(1, (4, 16, 64)), (2, (1, 2))])
def test_components_equal_all_pairs(spark, monkeypatch, seed, hubs):
    monkeypatch.setattr(N, "HUBS", hubs)
    rows = corpus(seed)
    found = N.link_documents(spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS).repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows), key=str)


def test_later_turns_see_open_buckets_only(spark, monkeypatch):
    """Each turn dealt all entries once more, and all segments of sets."""
    monkeypatch.setattr(N, "HUBS", (1, 2))
    seen, own = [], N.later_pairs

    def later_pairs(entries, first, *others):
        buckets = entries.groupBy("shingle").agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels"))
        seen.append((first, [tuple(r)[1:] for r in buckets.collect()]))
        return own(entries, first, *others)

    monkeypatch.setattr(N, "later_pairs", later_pairs)
    rows = corpus(4)
    found = N.link_documents(spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows), key=str)
    assert seen and all(n > first + 1 and labels > 1 for first, buckets in seen for n, labels in buckets)


def test_sets_have_as_many_segments_however_fine_the_order_is_cut(spark, monkeypatch):
    """A set's rows grew with the fragments, so their join with wanted sets grew with the square of the input."""
    monkeypatch.setattr(N, "FRAGMENT", 100)
    monkeypatch.setattr(N, "HUBS", (1, 2))
    seen, opened, linked, open_buckets = [], [], N.linked, N.open_buckets

    def counted(pairs, sets, *others):
        seen.append([r["fragment"] for r in sets.where("fragment >= 0").select("fragment").distinct().collect()])
        return linked(pairs, sets, *others)

    def opening(entries, labels, first, *others):
        opened.append((first, [r["count"] for r in entries.groupBy("shingle").count().collect()]))
        return open_buckets(entries, labels, first, *others)

    monkeypatch.setattr(N, "linked", counted)
    monkeypatch.setattr(N, "open_buckets", opening)
    rows = corpus(5)
    found = N.link_documents(spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows), key=str)
    assert seen and all(sorted(f) == list(range(N.COUNTING)) for f in seen)
    assert min(opened[0][1]) > opened[0][0] + 1


def test_packed_buckets_are_whole(spark, monkeypatch):
    monkeypatch.setattr(N, "PACKED", 8)
    rows = [(s, 100 * s + k, 40, k) for s, n in enumerate([1, 2, 7, 30, 1, 8, 3, 2, 2]) for k in range(n)]
    packed = N.packed_buckets(spark.createDataFrame(rows, N.ENTRIES), 2)
    assert packed.count() > 2
    assert sorted(map(tuple, N.large_buckets(packed, 0).collect())) == sorted(r for r in rows if r[0] not in (0, 4))
    assert {r["shingle"] for r in N.large_buckets(packed, 2).collect()} == {2, 3, 5}


def test_keep_one(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, "", 1, "") for r in rows], DOCS)
    kept = N.keep_one(docs)
    expected = {d for d, _, c in brute(rows) if d is not None and d == c} | {None}
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert N.link_documents(docs).collect() == [] and N.keep_one(docs).collect() == []


def test_components(spark):
    path = [(i, i + 1) for i in range(70)] + [(200, 100), (100, 150), (300, 300)] + [(500, i) for i in range(400, 500)]
    random.Random(1).shuffle(path)
    found = dict(components(spark.createDataFrame(path, "a long, b long").repartition(5)).collect())
    expected = {i: 0 for i in range(71)} | {i: 100 for i in (100, 150, 200)} | {i: 400 for i in range(400, 501)}
    assert found == expected
