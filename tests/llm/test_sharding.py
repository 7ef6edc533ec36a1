import zlib

from cubagem.llm.sharding import shard_by_bytes

DOCS = "doc_id long, text string, shard int, size string"


def expected(rows, n):
    keyed = sorted(
        (i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows
    )
    total, before, out, slots = sum(k[3] for k in keyed), 0, [], {}
    for known, i, crc, size in keyed:
        shard = before * n // total
        out.append((i if known else None, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return out


def test_shards(spark):
    rows = [(i % 90, "é" * (i * 7 % 50)) for i in range(200)] + [(None, "x"), (5, None), (6, ""), (7, "y" * 3000)] * 2
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows], DOCS)
    for n in (1, 4, 16):
        found = [tuple(r) for r in shard_by_bytes(docs, n).collect()]
        assert sorted(found, key=str) == sorted(expected(rows, n), key=str)


def test_one_repeated_row_is_split(spark):
    docs = spark.createDataFrame([(1, "same", 0, "")] * 64, DOCS)
    counts = dict(shard_by_bytes(docs, 4).groupBy("shard").count().collect())
    assert counts == {0: 16, 1: 16, 2: 16, 3: 16}


def test_empty(spark):
    found = shard_by_bytes(spark.createDataFrame([], DOCS))
    assert found.collect() == [] and found.columns[:2] == ["doc_id", "size"]
