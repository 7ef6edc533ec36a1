"""Connected components of links, by rounds of large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import written

EDGES = "a bigint, b bigint"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars around the smallest members of its own components."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above.setdefault(y, y)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    rows = [(x, top(x)) for x in above]
    rows = [r for r in rows if r[0] != r[1]]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(key, label): each member of a link and the smallest key of its component, written.

    ``links`` has long columns (a, b). Tasks first reduce their own links to stars. Then, in turn, all
    larger neighbours of a key, and all smaller ones, are linked to its smallest neighbour instead,
    until nothing changes; the number of rounds grows with the logarithm of the longest path.
    Minima are aggregated before the shuffle, so a key with many links is no hot spot.
    """
    edges = written(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").mapInArrow(_forest, EDGES), "edges")
    state = _state(edges)
    while True:
        edges = written(_star(_star(edges, True), False), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("key"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("key"), F.col("b").alias("label")).union(roots)


def _state(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(sums)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    near = both.where("b > a" if large else "b < a").join(least, "a")
    moved = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.union(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
