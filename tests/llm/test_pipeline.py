"""The pipeline against a plain version of it that goes through the rows one by one."""

import random
import zlib
from pathlib import Path

import corpus_pipeline
from cubagem.llm import decontamination, language_id
from cubagem.llm.mixing import hashed_fraction
from tests.llm import test_decontamination, test_mixing, test_ngram_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": ["the", "ing", "and", "er"], "de": ["sch", "ung", "ein", "ge"]}


def corpus(seed):
    rng = random.Random(seed)

    def prose(lang, n):
        return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) + str(rng.randrange(50)) for _ in range(n))

    items = [(i, prose("en", 15)) for i in range(4)]
    rows, texts = [], []
    for i in range(150):
        lang = rng.choice(["en", "de"])
        text = prose(lang, rng.randint(3, 90))
        if texts and i % 5 == 0:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = "edit"
            text = " ".join(words)
        if i % 11 == 0:
            text += " " + rng.choice(items)[1]
        texts.append(text)
        rows.append((i, text, lang, f"src{rng.randrange(4)}", len(text)))
    rows += [(900, None, "en", "src1", 0), (901, "12 34", "de", None, 5), (None, prose("en", 30), None, None, 1), rows[3], rows[3]]
    return rows, items


def expected(spark, docs, items):
    """Rows of the last stage, from rows of documents without repeated doc_ids but for equal rows."""
    rows = [tuple(r) for r in docs.collect()]
    parser = language_id.CrossParser(language_id.training_samples(docs))
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert len(parser.languages) == 2
    numbered = [(r[0] if r[0] is not None else 10**9, r[1]) for r in rows]
    first = {d for d, _, c in test_ngram_join.brute(numbered) if d == c}
    rows = list({n[0]: r for n, r in zip(numbered, rows, strict=True) if n[0] in first}.values())
    leaking = {d for d, _, _ in test_decontamination.brute([(r[0], r[1]) for r in rows], items)}
    rows = [r for r in rows if r[0] not in leaking]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + test_mixing.count(r[1])
    targets = test_mixing.levelled(sizes)
    draws = dict(spark.createDataFrame([(r[0],) for r in rows], "doc_id long").select("doc_id", hashed_fraction("doc_id", "mix")).collect())
    mixed = []
    for r in rows:
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        whole = int(rate + 1e-12)
        mixed += [r] * (whole + (draws[r[0]] < rate - whole))
    mixed.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    total, before, out, slots = sum(len(r[1].encode()) + 1 for r in mixed), 0, [], {}
    for r in mixed:
        shard, size = before * 16 // total, len(r[1].encode()) + 1
        out.append((r[0], size, zlib.crc32(r[1].encode()), "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return out


def test_pipeline(spark, tmp_path):
    rows, items = corpus(7)
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(expected(spark, docs, items), key=str)
    assert decontamination.WINDOW == 8 and Path(corpus_pipeline.__file__).parent == Path(__file__).parents[2]


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        assert found.collect() == []
        if stage is not corpus_pipeline.shard:
            assert found.columns == docs.columns


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None, "s", 3), (2, "12", None, "s", 2), (3, None, None, "s", 0)], DOCS)
    assert [tuple(r) for r in corpus_pipeline.identify_language(spark, docs, "").collect()] == [(1, "abc", None, "s", 3)]
