import random
from collections import Counter

import pytest

import corpus_pipeline
from cubagem.llm import decontamination as D
from cubagem.llm import queries

DOCS = "doc_id long, text string, item_id string, share int"
ITEMS = "item_id long, text string, doc_id int"


def cut(text, length):
    """Each window of a text: its words without punctuation, what they are, whether case tells nothing there."""
    own = D.tagged((text or "").split(), D.Words()) if (text or "").split() else None
    if own is None:
        return []
    bare, out = [D.bare_word(w) for w in own.words], []
    for p in range(len(bare) - length + 1):
        words, kinds, capitals = bare[p : p + length], own.kinds[p : p + length].tolist(), own.capitals[p : p + length].tolist()
        lettered = [k in (D.LITERAL, D.NAME) for k in kinds]
        loud = sum(lettered) >= D.LITERAL_SHARE * length and sum(c and x for c, x in zip(capitals, lettered, strict=True)) >= D.LOUD_SHARE * sum(lettered)
        out.append((words, kinds, loud))
    return out


def kinds_as(wanted, other, loud):
    """The kinds of a document's window, with names where the item has them, if its case tells nothing."""
    if not loud:
        return other
    return [w if k in (D.LITERAL, D.NAME) and w == D.NAME else D.LITERAL if k == D.NAME else k for w, k in zip(wanted, other, strict=True)]


def agreeing(hits):
    """Places of an item in a document's windows at one offset, whose open words are those that most places have."""
    places = {(q + k, a, b) for q, open_words in hits for k, a, b in open_words}
    votes = Counter((a, b) for _, a, b in places)
    best = {}
    for (a, b), n in votes.items():
        best[a] = max(best.get(a, (0, False, "")), (n, a == b, b))
    return {q for q, open_words in hits if all(best[a][2] == b for _, a, b in open_words)}


def brute(docs, items):
    """Every window of every document against every window of every item, by words and by templates."""
    out = set()
    for item_id, text in items:
        words = [w for w in (text or "").split() if D.bare_word(w)]
        length = min(D.WINDOW, len(words))
        own = cut(text, length) if words else []
        usable = {q for q, (_, kinds, _) in enumerate(own) if length >= D.SHORTEST and kinds.count(D.LITERAL) >= D.LITERAL_SHARE * length}
        for doc_id, other in docs if own else []:
            offsets, exact = {}, set()
            for p, (theirs, kinds_2, loud) in enumerate(cut(other, length)):
                for q, (ours, kinds, _) in enumerate(own):
                    if [w.lower() for w in ours] == [w.lower() for w in theirs]:
                        exact.add(q)
                    for as_kinds in {tuple(kinds_2), tuple(kinds_as(kinds, kinds_2, loud))} if q in usable else ():
                        same = all(k != D.LITERAL or a.lower() == b.lower() for k, a, b in zip(kinds, ours, theirs, strict=True))
                        if list(as_kinds) == kinds and same:
                            marked = [(k, (kind, a), (kind, b)) for k, (kind, a, b) in enumerate(zip(kinds, ours, theirs, strict=True)) if kind]
                            offsets.setdefault(p - q, []).append((q, marked))
            found = set().union(*map(agreeing, offsets.values()))
            share = len(found) / len(usable) if usable else 0
            if share < D.LEAK_SHARE:
                share = len(found | exact) / len(own)
            if share >= D.LEAK_SHARE:
                out.add((doc_id, item_id, share))
    return out


ITEM = "If Anna walks 5 km to see Bert and then Anna walks 5 km back, how many km did Anna walk after 3 hours with Bert?"
SAME = "If Carl walks 9 mi to see Dora and then Carl walks 9 mi back, how many km did Carl walk after 4 hours with Dora?"
SAME = SAME.replace(" mi ", " miles ")
MIXED = SAME.replace("then Carl", "then Emil").replace("walks 9 miles back", "walks 8 miles back").replace("did Carl", "did Fred")


def filler(rng, n):
    return " ".join(rng.choices(["lorem", "ipsum", "dolor", "Sit", "amet.", "12", "kg", "Paul"], k=n))


def test_templates():
    words = "He paid $3.50 for 5 kg of Rice. Then Bob ran 10km, in May".split()
    _, kinds = D.templated(words, D.Words())
    named = {w: k for w, k in zip(words, kinds.tolist(), strict=True) if k}
    assert named == {"$3.50": D.NUMBER, "5": D.NUMBER, "kg": D.UNIT, "Rice.": D.NAME, "Bob": D.NAME, "10km,": D.QUANTITY, "May": D.NAME}


def test_reparameterised(spark):
    docs = spark.createDataFrame([(1, f"see: {SAME}", "", 0), (2, f"see: {MIXED}", "", 0), (3, ITEM, "", 0)], DOCS)
    items = spark.createDataFrame([(7, ITEM, 0)], ITEMS)
    found = {r["doc_id"]: r for r in D.find_leaks(docs, items).collect()}
    assert found.keys() == {1, 3}
    assert found[1]["reparameterised"] and not found[3]["reparameterised"] and found[3]["share"] == 1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_equal_all_windows(spark, seed):
    rng = random.Random(seed)
    items = [(i, filler(rng, rng.randint(3, 30))) for i in range(8)] + [(90, ITEM), (91, None), (92, ""), (93, "one two"), (90, ITEM)]
    docs = [(i, filler(rng, rng.randint(0, 80))) for i in range(20)]
    for i in range(20, 60):
        text = rng.choice(items)[1] or ""
        words = text.split()
        if i % 3 == 0 and words:
            words[rng.randrange(len(words))] = "changed"
        docs.append((i, f"{filler(rng, rng.randint(0, 20))} {' '.join(words[: rng.randint(len(words) // 3, len(words))])} {filler(rng, 5)}"))
    docs += [(None, ITEM), (None, SAME), (100, None), (101, ""), docs[30], docs[30], (102, f"{filler(rng, 20000)} {MIXED} {ITEM}")]
    d, b = spark.createDataFrame([(*r, "", 0) for r in docs], DOCS), spark.createDataFrame([(*r, 0) for r in items], ITEMS)
    leaks = D.find_leaks(d, b)
    found = {(r["doc_id"], r["item_id"], r["share"]) for r in leaks.collect()}
    assert found == brute(docs, items)
    leaking = {i for i, _, _ in found}
    kept = D.decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, _ in docs if i not in leaking)


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, ITEM, "", 0)], DOCS)
    assert D.find_leaks(docs, items).collect() == [] and D.find_leaks(one, items).collect() == []
    assert [r["doc_id"] for r in D.decontaminate(one, items).collect()] == [1]


def both(spark, tmp_path, docs, items):
    """(doc_id, item_id) by the query, and the doc_ids that the pipeline's stage keeps."""
    d = spark.createDataFrame([(*r, "", 0) for r in docs], DOCS)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*r, 0) for r in items], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op8_decontaminate(spark, str(tmp_path)).collect()
    kept = corpus_pipeline.remove_benchmark_leaks(spark, d, str(tmp_path)).collect()
    return {(r["doc_id"], r["item_id"]) for r in found}, {r["doc_id"] for r in kept}


def test_case_hides_no_copy(spark, tmp_path):
    other = "IF NOBODY WALKS FAR TO SEE A FRIEND AND THEN NOBODY COMES BACK, WHO WALKED AFTER ALL THE HOURS?"
    copies = [ITEM.upper(), f"And Then: {ITEM.title()}", f"so, {ITEM.lower()}", ITEM]
    docs = [*enumerate(copies), (8, other), (9, "")]
    found, kept = both(spark, tmp_path, docs, [(7, ITEM)])
    assert found == {(i, 7) for i in range(4)} and kept == {8, 9}


def test_one_misspelt_value(spark):
    copy = SAME.replace("then Carl", "then Karl")
    docs = spark.createDataFrame([(1, copy, "", 0), (2, ITEM.replace("then Anna", "then Ana"), "", 0), (3, MIXED, "", 0)], DOCS)
    found = {r["doc_id"]: r["share"] for r in D.find_leaks(docs, spark.createDataFrame([(7, ITEM, 0)], ITEMS)).collect()}
    assert found.keys() == {1, 2} and max(found.values()) < 1


def test_items_without_literals(spark, tmp_path):
    items = ["12 7 5 kg 9 3 88 41 6 2 15", "Old Man And Sea Went Home With Paul And Mary", "Why so?", None, ""]
    docs = [(i, f"lorem {text or ''} ipsum") for i, text in enumerate(items)] + [(9, "12 7 5 kg 9 4 88 41 6 3 15. So why?")]
    found, kept = both(spark, tmp_path, docs, list(enumerate(items)))
    assert found == {(0, 0), (1, 1), (2, 2)} and kept == {3, 4, 9}


@pytest.mark.parametrize("written", [str.upper, str.title, lambda t: t.replace(" ", " , ").replace("?", " ?")], ids=["upper", "title", "stray"])
def test_reparameterised_in_any_writing(spark, written):
    other = "He walks 5 km to see nobody and then she walks 5 km back, how many hours did it take the two of them?"
    texts = [f"see: {written(SAME)} And so on.", written(other), f"once more {written(ITEM)}", written(MIXED), ". , ! ?", None]
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], DOCS)
    found = {(r["doc_id"], r["item_id"], r["share"]): r for r in D.find_leaks(docs, spark.createDataFrame([(7, ITEM, 0), (8, " . ,", 0)], ITEMS)).collect()}
    assert found.keys() == brute(list(enumerate(texts)), [(7, ITEM), (8, " . ,")])
    by_doc = {i: r for (i, _, _), r in found.items()}
    assert {0, 2} <= by_doc.keys() and 1 not in by_doc
    assert by_doc[0]["reparameterised"] and not by_doc[2]["reparameterised"]


def test_repeated_windows(spark):
    item = "the cat sat on the mat and " * 6
    texts = [item * 3, item[:40], "the dog sat on a mat and " * 9]
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], DOCS)
    found = {(r["doc_id"], r["item_id"], r["share"]) for r in D.find_leaks(docs, spark.createDataFrame([(7, item, 0)], ITEMS)).collect()}
    assert found == brute(list(enumerate(texts)), [(7, item)]) and {i for i, _, _ in found} >= {0}
