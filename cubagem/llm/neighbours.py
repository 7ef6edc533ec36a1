"""Approximate nearest neighbours by collision counting on single projections."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Half the first window, by the largest norm, and how much wider the next one is. There are 255
#: projections at most.
FIRST_WINDOW, WIDER = 0.8, 1.12

FOUND = "query_id bigint, vec_id bigint, score double"
FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim) of the vectors that take part.

    Left out: null ids, and vectors that are null, empty, zero, or hold null or non-finite components.
    """
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
        .where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .where(~bad & F.exists(e, lambda x: x != 0))
        .withColumn("dim", F.size("embedding"))
    )


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    projections: int = 64,
    threshold: float = 0.6,
    share: float = 0.25,
    block: int = 32768,
    query_block: int = 1024,
    seed: int = 9,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the largest inner product found.

    Queries are the rows whose vec_id is divisible by ``every``. Vectors are dealt into blocks by
    a hash of their id, queries into groups, and each group meets each block. A block keeps one
    sorted array per random projection. Around a query's own projections, windows open on all arrays
    at once and widen (virtual rehashing); a vector that falls into at least ``threshold`` of
    the windows is a candidate. Once a block has k + ``share`` of its size of candidates, all of
    them are verified by their inner product in double precision. Nothing is capped: windows that
    cover the block make every vector a candidate.

    Inner products become distances by one more component, which brings all vectors to the largest
    norm. Vectors meet only those of their own length. Rows with the query's own id are no
    candidates; a query id that is repeated counts once, with its smallest vector, while repeated
    candidates all stay. Ties go to the smaller vec_id. Vectors left out by ``usable``, and empty
    tables, give no rows.
    """
    found = usable(vectors)
    peaks = found.groupBy("dim").agg(F.max(F.array_max(F.transform("embedding", F.abs))).alias("peak"))
    rows = found.join(peaks, "dim")
    # Divided by the largest component, so no square is too large for a double.
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x / F.col("peak")) * (x / F.col("peak"))))
    sizes = rows.groupBy("dim").agg(
        F.max(norm).alias("largest"),
        F.ceil(F.count("*") / block).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if(F.col("vec_id") % every == 0) / query_block)).cast("int").alias("groups"),
    )
    sized = rows.join(sizes, "dim")
    candidates = sized.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks").cast("long"))).withColumn(
        "query_group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    )
    queries = (
        sized.where(F.col("vec_id") % every == 0)
        .groupBy("dim", "vec_id", "blocks", "groups", "largest", "peak")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("query_group", F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col("groups")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    )
    keys, columns = ["dim", "block", "query_group"], ["vec_id", "embedding", "largest", "peak"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return FOUND_ARROW.empty_table()
        right = right.rename_columns(left.column_names)
        largest = left.column("largest")[0].as_py()
        index = Block(_matrix(left), _ids(left), largest, projections, seed, left.column("peak")[0].as_py())
        found = [
            index.search(i, q, k, threshold, share) for i, q in zip(_ids(right).tolist(), _matrix(right), strict=True)
        ]
        n = [len(ids) for ids, _ in found]
        return pa.table(
            [np.repeat(_ids(right), n), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])],
            schema=FOUND_ARROW,
        )

    found = (
        candidates.select(*keys, *columns)
        .groupBy(*keys)
        .cogroup(queries.select(*(F.col(c).alias(f"q_{c}") for c in [*keys, *columns])).groupBy(*(f"q_{c}" for c in keys)))
        .applyInArrow(search, FOUND)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("vec_id").to_numpy()


def _matrix(table: pa.Table) -> np.ndarray:
    flat = pa.concat_arrays([chunk.flatten() for chunk in table.column("embedding").chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).astype(np.float64)


class Block:
    """Sorted projections of some vectors, and the search in them."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, largest: float, projections: int, seed: int, peak: float = 1.0):
        self.vectors, self.ids, self.largest = vectors, ids, largest
        vectors = vectors / peak  # ``largest`` is a norm of these
        self.rough = vectors.astype(np.float32)
        self.lines = _lines(vectors.shape[1] + 1, projections, seed)
        lift = np.sqrt(np.maximum(largest**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0))
        heights = (vectors @ self.lines[:-1] + lift[:, None] * self.lines[-1]).T
        order = np.argsort(heights, axis=1, kind="stable")
        self.sorted = np.take_along_axis(heights, order, axis=1)
        # Where each vector stands in each sorted array: a window is a range of these places.
        self.place = np.empty(heights.shape, np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.uint32)[None, :], axis=1)

    def search(self, own: int, query: np.ndarray, k: int, threshold: float, share: float):
        near = self.candidates(query, threshold, k + 1 + int(share * len(self.ids)))
        near = near[self.ids[near] != own]
        unit = _unit(query)
        if len(near) > 4 * k:
            # Single precision is off by less than this, so nothing of the first k is lost.
            rough = self.rough[near] @ unit.astype(np.float32)
            slack = 1e-5 * self.largest * np.sqrt(len(query))
            near = near[rough >= np.partition(rough, len(near) - k)[len(near) - k] - slack]
        scores = np.einsum("ij,j->i", self.vectors[near], query)
        top = np.lexsort((self.ids[near], -scores))[:k]
        return self.ids[near[top]], scores[top]

    def candidates(self, query: np.ndarray, threshold: float, wanted: int) -> np.ndarray:
        """Positions of the vectors that share enough windows, from the smallest windows that give enough."""
        n, least = len(self.ids), int(np.ceil(threshold * len(self.place)))
        centres = (_unit(query) * self.largest) @ self.lines[:-1]
        half = FIRST_WINDOW * self.largest
        while True:
            hits, whole = np.zeros(n, np.uint8), True
            for line, place, centre in zip(self.sorted, self.place, centres, strict=True):
                low, high = int(line.searchsorted(centre - half)), int(line.searchsorted(centre + half, "right"))
                if high - low == n:
                    hits += 1
                else:
                    hits += (place - np.uint32(low) < np.uint32(high - low)).view(np.uint8)
                    whole = False
            enough = np.flatnonzero(hits >= least)
            if len(enough) >= min(wanted, n) or whole:
                return enough
            half *= WIDER


def _unit(vector: np.ndarray) -> np.ndarray:
    scaled = vector / np.abs(vector).max()
    return scaled / np.sqrt(scaled @ scaled)


def _lines(dim: int, projections: int, seed: int) -> np.ndarray:
    """Random directions, each group of ``dim`` of them orthogonal, scaled like normal random vectors."""
    rng = np.random.default_rng(seed)
    bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-projections // dim))]
    return np.concatenate(bases, axis=1)[:, :projections] * np.sqrt(dim)
