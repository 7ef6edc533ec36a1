"""What several operators share: tables, tables written on the way, and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem.session import shared_dir, shuffle_width

#: A word, as a Java regular expression: a run of anything but the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """The rows, written once to the shared folder, so that later steps agree on them.

    It cuts the lineage as well: a lost executor costs no more than the steps after the table.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    return shuffle_width(spark)


def remainder(key: str, divisor: int) -> Column:
    """CRC-32 of the key as text, modulo the divisor; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text in UTF-8."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` consecutive values."""
    n = len(hashes) - length + 1
    return _hashed([hashes[k : n + k] for k in range(length)]) if n > 0 else np.empty(0, np.uint64)


def row_hashes(values: np.ndarray) -> np.ndarray:
    """The hash of each row of a table, equal to that of a run of its values."""
    return _hashed(list(values.T))


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0].copy()
    for column in columns[1:]:
        out *= _MULTIPLIER
        out += column
        out ^= out >> np.uint64(29)
    return mixed(out)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that high bits can choose a partition."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def groups(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct value and its ascending positions."""
    order = np.argsort(values, kind="stable")
    limits = np.append(starts(values[order]), len(order))
    for begin, end in zip(limits[:-1], limits[1:], strict=True):
        yield int(values[order[begin]]), order[begin:end]


def packed(column, kind) -> np.ndarray:
    """The packed arrays in all rows of a binary column, one after the other, without copying rows."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)
            begin, end = int(ends[chunk.offset]), int(ends[chunk.offset + len(chunk)])
            if end > begin:
                parts.append(np.frombuffer(data, np.uint8)[begin:end])
    if not parts:
        return np.empty(0, kind)
    return (np.concatenate(parts) if len(parts) > 1 else parts[0].copy()).view(kind)
