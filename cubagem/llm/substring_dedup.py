"""Removal of long passages that repeat, from suffix trees partitioned by prefix."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import groups, mixed, run_hashes, starts, width, word_hashes

#: Words of a window, of the prefix that a suffix is filed under, and what lies around the prefix.
WINDOW, PREFIX = 35, 20
AROUND = WINDOW - PREFIX

GRAMS = "part int, bucket int, grams binary, twice binary"
ALIVE = "bucket int, grams binary"
CONTEXTS = "part int, bucket int, context binary, gram binary, before binary, after binary, reach binary, twice binary"
MASKS = "bucket int, context binary, mask binary"
KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"

_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [part.strip().split() for part in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.table(arrays, [name for name, _ in fields])


def _whole(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, prefix hash) of the suffixes that are filed: some in each window, chosen by its words.

    A suffix is filed if its prefix hash is the smallest of the prefixes of some window around it.
    Equal windows hold their smallest prefix at the same place, so they are filed together.
    """
    grams = run_hashes(words, PREFIX)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), grams[:0]
    least, size = grams, 1
    while size < AROUND + 1:
        step = min(size, AROUND + 1 - size)
        least, size = np.minimum(least[:-step], least[step:]), size + step
    filed = np.zeros(len(grams), bool)
    for k in range(AROUND + 1):
        filed[k : k + n] |= grams[k : k + n] == least
    position = np.flatnonzero(filed)
    return position, grams[position]


def contexts(words: np.ndarray, position: np.ndarray, gram: np.ndarray):
    """Around each prefix: (hash, words before from near to far, words after, how many of each there are)."""
    short = words.astype(np.uint32)
    step = np.arange(AROUND)
    left, right = position[:, None] - 1 - step, position[:, None] + PREFIX + step
    before = np.where(left >= 0, short[np.maximum(left, 0)], 0).astype(np.uint32)
    after = np.where(right < len(words), short[np.minimum(right, len(words) - 1)], 0).astype(np.uint32)
    reach = np.stack([np.minimum(position, AROUND), np.minimum(len(words) - PREFIX - position, AROUND)], axis=1)
    name = gram + mixed(reach[:, 0].astype(np.uint64) * np.uint64(64) + reach[:, 1].astype(np.uint64))
    for side in (before, after):
        for k in range(AROUND):
            name = mixed(name + side[:, k])
    return name, before, after, reach.astype(np.uint8)


def _twice(values: np.ndarray, weight: np.ndarray | None = None):
    """(positions of distinct values, whether each occurs twice)."""
    order = np.argsort(values, kind="stable")
    begins = starts(values[order])
    counts = np.add.reduceat(weight[order] if weight is not None else np.ones(len(order), np.int64), begins) if len(order) else begins
    return order[begins], counts > 1


def _parts(grams: np.ndarray, n_parts: int) -> np.ndarray:
    return ((mixed(grams) >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int32)


def repeated_windows(gram, before, after, reach, weight) -> np.ndarray:
    """For each filed suffix, which windows around it occur twice: bit k is the window k words before it.

    The suffixes of one prefix are a subtree. From the root down, each node is split by the next
    word into its children. The window k words before a suffix has its remaining words in the
    node at depth WINDOW - k, so at that depth, suffixes of one inner node with the same k words
    before them are repeats. ``weight`` counts a suffix that stands for several.
    """
    n = len(gram)
    mask = np.zeros(n, np.uint16)
    names = [np.zeros(n, np.int64)]
    for k in range(AROUND):
        names.append(np.unique((names[-1] << 32) | before[:, k], return_inverse=True)[1])
    own = np.arange(n)  # suffixes of inner nodes; leaves have no repeats below
    node = np.unique(gram, return_inverse=True)[1]
    for below in range(AROUND + 1):
        k = AROUND - below
        inner = np.bincount(node, weight[own], minlength=1)[node] > 1
        own, node = own[inner], node[inner]
        if not len(own):
            break
        fits = (reach[own, 0] >= k) & (reach[own, 1] >= below)
        some = own[fits]
        group = np.unique((node[fits].astype(np.int64) << 32) | names[k][some], return_inverse=True)[1]
        found = some[np.bincount(group, weight[some], minlength=1)[group] > 1] if len(some) else some
        mask[found] |= np.uint16(1 << k)
        if below < AROUND:
            deeper = reach[own, 1] > below
            own, node = own[deeper], node[deeper]
            node = np.unique((node.astype(np.int64) << 32) | after[own, below], return_inverse=True)[1]
    return mask


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): documents without their repeated passages.

    A word goes if a window of 35 words that covers it also starts anywhere else, in the same
    document or another; windows are judged on the input. ``kept_sha256`` is the digest of the words
    that stay, joined by one space. Null and short texts lose nothing; repeated rows are
    repeats of each other, and each comes out; null doc_ids stay null. An empty table gives no
    rows. Other columns are ignored.

    Documents are dealt into buckets by a hash. Of their suffixes, those are filed whose first 20
    words have the smallest hash in some window, so that all occurrences of a window meet
    under one prefix. Prefixes that occur once in the whole corpus are leaves of the tree's top
    and go at once. For the others, a longer prefix is needed: each bucket sends every different
    context once, with the 15 words on both sides, to the group of the prefix, which builds its
    subtree and tells the buckets which windows repeat. A passage that is everywhere is one row per
    bucket, so no group grows with the number of its copies.
    """
    return _with_masks(docs, _digests, KEPT)


def _with_masks(docs: DataFrame, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    n_parts = width(spark)
    n_buckets = 4 * n_parts
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_buckets)).cast("int").alias("bucket"),
    )
    dealt = rows.repartition(n_parts, "bucket")

    def file_prefixes(table: pa.Table) -> pa.Table:
        bucket, found = table.column("bucket")[0].as_py(), []
        for text in table.column("text").to_pylist():
            found.append(suffixes(word_hashes(text or b""))[1])
        grams = np.concatenate(found)
        first, twice = _twice(grams)
        grams = grams[first]
        return _table(
            GRAMS,
            [(p, bucket, grams[own].tobytes(), twice[own].tobytes()) for p, own in groups(_parts(grams, n_parts))],
        )

    def inner_prefixes(table: pa.Table) -> pa.Table:
        grams, twice = _whole(table, "grams", np.uint64), _whole(table, "twice", bool)
        sizes = [len(g) // 8 for g in table.column("grams").to_pylist()]
        bucket = np.repeat(table.column("bucket").to_numpy(), sizes)
        _, place = np.unique(grams, return_inverse=True)
        inner = np.bincount(place, 1 + twice, minlength=1)[place] > 1
        grams, bucket = grams[inner], bucket[inner]
        return _table(ALIVE, [(b, grams[own].tobytes()) for b, own in groups(bucket)])

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(CONTEXTS, [])
        inner, parts = np.sort(_whole(right, "alive_grams", np.uint64)), []
        for text in left.column("text").to_pylist():
            words = word_hashes(text or b"")
            position, gram = suffixes(words)
            kept = _among(gram, inner)
            if kept.any():
                parts.append((gram[kept], *contexts(words, position[kept], gram[kept])))
        if not parts:
            return _table(CONTEXTS, [])
        gram, name, before, after, reach = (np.concatenate(x) for x in zip(*parts, strict=True))
        first, twice = _twice(name)
        bucket = left.column("bucket")[0].as_py()
        return _table(
            CONTEXTS,
            [
                (p, bucket, *(x[first[own]].tobytes() for x in (name, gram, before, after, reach)), twice[own].tobytes())
                for p, own in groups(_parts(gram[first], n_parts))
            ],
        )

    def grow(table: pa.Table) -> pa.Table:
        name, gram = _whole(table, "context", np.uint64), _whole(table, "gram", np.uint64)
        before = _whole(table, "before", np.uint32).reshape(-1, AROUND)
        after = _whole(table, "after", np.uint32).reshape(-1, AROUND)
        reach = _whole(table, "reach", np.uint8).reshape(-1, 2)
        mask = repeated_windows(gram, before, after, reach, 1 + _whole(table, "twice", bool).astype(np.int64))
        bucket = np.repeat(table.column("bucket").to_numpy(), [len(c) // 8 for c in table.column("context").to_pylist()])
        hit = np.flatnonzero(mask)
        return _table(
            MASKS, [(b, name[hit[own]].tobytes(), mask[hit[own]].tobytes()) for b, own in groups(bucket[hit])]
        )

    grams = dealt.groupBy("bucket").applyInArrow(file_prefixes, GRAMS)
    alive = grams.groupBy("part").applyInArrow(inner_prefixes, ALIVE)
    alive = alive.select(F.col("bucket").alias("alive_bucket"), F.col("grams").alias("alive_grams"))
    sent = dealt.groupBy("bucket").cogroup(alive.groupBy("alive_bucket")).applyInArrow(send_contexts, CONTEXTS)
    masks = sent.groupBy("part").applyInArrow(grow, MASKS)
    masks = masks.select(F.col("bucket").alias("mask_bucket"), "context", "mask")
    return dealt.groupBy("bucket").cogroup(masks.groupBy("mask_bucket")).applyInArrow(finish, schema)


def _among(values: np.ndarray, inner: np.ndarray) -> np.ndarray:
    if not len(inner):
        return np.zeros(len(values), bool)
    at = np.searchsorted(inner, values)
    at[at == len(inner)] = 0
    return inner[at] == values


def removed_words(text: bytes, names: np.ndarray, masks: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and which of them lie in a repeated window; names ascend."""
    words = text.split()
    hashes = word_hashes(text)
    change = np.zeros(len(words) + 1, np.int64)
    position, gram = suffixes(hashes)
    if len(position) and len(names):
        name = contexts(hashes, position, gram)[0]
        at = np.searchsorted(names, name)
        at[at == len(names)] = 0
        mask = np.where(names[at] == name, masks[at], 0)
        for k in range(AROUND + 1):
            begin = np.unique(position[mask >> k & 1 == 1] - k)
            change[begin] += 1
            change[begin + WINDOW] -= 1
    return words, np.cumsum(change[:-1]) > 0


def _digests(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows:
        return _table(KEPT, [])
    names, masks = _whole(right, "context", np.uint64), _whole(right, "mask", np.uint16)
    order = np.argsort(names)
    names, masks, rows = names[order], masks[order], []
    for doc_id, text in zip(left.column("doc_id").to_pylist(), left.column("text").to_pylist(), strict=True):
        words, gone = removed_words(text or b"", names, masks)
        kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
        rows.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return _table(KEPT, rows)


def deduplicated_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words that stay, joined by one space; null stays null."""

    def texts(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = "doc_id bigint, text string"
        if not left.num_rows:
            return _table(schema, [])
        names, masks = _whole(right, "context", np.uint64), _whole(right, "mask", np.uint16)
        order = np.argsort(names)
        rows = []
        for doc_id, text in zip(left.column("doc_id").to_pylist(), left.column("text").to_pylist(), strict=True):
            words, gone = removed_words(text or b"", names[order], masks[order])
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
            rows.append((doc_id, None if text is None else kept.decode(errors="replace")))
        return _table(schema, rows)

    return _with_masks(docs, texts, "doc_id bigint, text string")
