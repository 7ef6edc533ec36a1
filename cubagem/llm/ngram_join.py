"""Jaccard self-join on word n-grams by vertical partitioning of the n-gram order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubagem.llm.common import groups, mixed, packed, run_hashes, starts, width, word_hashes, written
from cubagem.llm.components import components

#: Words of a shingle.
SHINGLE = 5
#: Sets link from this percentage of shared shingles.
PERCENT = 75
#: Distinct shingles that one fragment should hold, and those that a map task packs at once.
FRAGMENT, PACKED = 5 << 19, 1 << 20
#: The first members of a bucket are compared with all others of it, then the next ones up to each of
#: these with those of other components, and at last all that are left.
HUBS = (4, 16, 64)
#: Fragments in which overlaps of pairs are counted; however many the order was cut into, these are as many.
COUNTING = 4
#: Pairs of a block, pairs of a group of blocks, and shingles of all its pairs in one fragment.
PAIR_BLOCK, PAIR_GROUP, GROUP_SHINGLES = 1 << 15, 1 << 20, 1 << 25
#: Shingles that a bucket of sets should hold.
BUCKET = 1 << 22

SEGMENTS = "fragment int, keys binary, counts binary, shingles binary"
SHARED = "fragment int, bucket int, keys binary, sizes binary, alone binary, counts binary, shingles binary, ranks binary"
SETS = "bucket int, fragment int, keys binary, sizes binary, counts binary, shingles binary, positions binary"
ENTRIES = "shingle bigint, key bigint, size int, position int"
BUCKETS = "shingles binary, keys binary, sizes binary, positions binary"
LABELLED = f"{ENTRIES}, label bigint"
PAIRS = "a bigint, b bigint, size_a int, size_b int"
BLOCK = "grp int, block bigint, a binary, b binary, sizes binary"
WANTED = "wanted bigint, grp int"
SEGMENT = "key bigint, f int, shingles binary"
COUNTED = "block bigint, a binary, b binary, sizes binary, overlaps binary"


def _batch(schema: str, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [part.strip().split() for part in schema.split(",")]
    arrays = [pa.array(columns[name], kinds[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([(name, kinds[kind]) for name, kind in fields]))


def _whole(table, column: str, kind) -> np.ndarray:
    return packed(table.column(column), kind)


def set_key(text: bytes) -> int | None:
    """A 64-bit key of the words of a lower-cased text; none without words."""
    words = text.split()
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def shingles(text: bytes) -> np.ndarray:
    """The sorted set of hashed shingles of a lower-cased text."""
    hashes = word_hashes(text)
    return np.unique(run_hashes(hashes, min(SHINGLE, len(hashes))) if len(hashes) else hashes)


def least_overlap(size_a, size_b):
    """Shared shingles from which two sets of these sizes link: 100 i >= 75 (a + b - i)."""
    return -(-PERCENT * (size_a + size_b) // (100 + PERCENT))


def prefix_length(size):
    """Shingles of a set that a linked set can lack."""
    return size - -(-PERCENT * size // 100)


def _bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words); equal word sequences share a key, which is null without words."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").lower() for t in batch.column(1).to_pylist()]
            found = [set_key(t) for t in texts]
            n = [len(t) // 6 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "key", "about"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(keys, "doc_id bigint, key bigint, about bigint")


def segments(docs: DataFrame, n_fragments: int) -> DataFrame:
    """Each set cut by the fragments of the global order of shingles, packed per fragment.

    The order is that of the hashes; fragments are equal ranges of it, so they fill alike and any
    document, however common or long, is spread over them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, sets, held = [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = (text or b"").lower()
                key = set_key(text)
                if key is None or key in seen:
                    continue
                seen.add(key)
                keys.append(key)
                sets.append(shingles(text))
                held += len(sets[-1])
                if held >= PACKED:
                    yield pack(keys, sets)
                    keys, sets, held = [], [], 0
        if keys:
            yield pack(keys, sets)

    def pack(keys: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(keys)), sizes)
        fragment = ((values >> np.uint64(32)) * np.uint64(n_fragments) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(fragment, kind="stable")
        values, owner, fragment = values[order], owner[order], fragment[order]
        begins = starts(fragment)
        ends, rows = np.append(begins[1:], len(fragment)), []
        for begin, end in zip(begins, ends, strict=True):
            runs = starts(owner[begin:end])
            counts = np.diff(np.append(runs, end - begin)).astype(np.uint32)
            own = np.array(keys, np.int64)[owner[begin:end][runs]]
            rows.append((own.tobytes(), counts.tobytes(), values[begin:end].tobytes()))
        columns = dict(zip(("keys", "counts", "shingles"), zip(*rows, strict=True), strict=True))
        return _batch(SEGMENTS, fragment=fragment[begins], **columns)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(cut, SEGMENTS)


def shared_segments(cut: DataFrame, n_buckets: int) -> DataFrame:
    """What each fragment knows of each set: its shingles there, how many no other set has, and the rest."""

    def share(table: pa.Table) -> pa.Table:
        keys, counts = _whole(table, "keys", np.int64), _whole(table, "counts", np.uint32).astype(np.int64)
        values = _whole(table, "shingles", np.uint64)
        fragment = table.column("fragment")[0].as_py()
        unique, first = np.unique(keys, return_index=True)
        if len(unique) < len(keys):  # copies met only here
            once = np.zeros(len(keys), bool)
            once[first] = True
            values, keys, counts = values[np.repeat(once, counts)], keys[once], counts[once]
        owner = np.repeat(np.arange(len(keys), dtype=np.int32), counts)
        order = np.argsort(values).astype(np.int32)
        begins = starts(values[order])
        frequency = np.diff(np.append(begins, len(values)))
        rank = np.empty(len(values), np.uint8)
        rank[order] = np.repeat(np.ceil(np.log2(frequency)).astype(np.uint8), frequency)  # 0: in one set only
        del order, begins, frequency
        common = rank > 0
        shared = np.bincount(owner[common], minlength=len(keys))
        bucket = _bucket(keys, n_buckets)
        entries = np.flatnonzero(common)
        entries = entries[np.argsort(bucket[owner[entries]], kind="stable")]
        limits = np.searchsorted(bucket[owner[entries]], np.arange(n_buckets + 1))
        rows = [(fragment, b, own, entries[limits[b] : limits[b + 1]]) for b, own in groups(bucket)]
        return pa.Table.from_batches([
            _batch(
                SHARED,
                fragment=[r[0] for r in rows],
                bucket=[r[1] for r in rows],
                keys=[keys[r[2]].tobytes() for r in rows],
                sizes=[counts[r[2]].astype(np.uint32).tobytes() for r in rows],
                alone=[(counts - shared)[r[2]].astype(np.uint32).tobytes() for r in rows],
                counts=[shared[r[2]].astype(np.uint32).tobytes() for r in rows],
                shingles=[values[r[3]].tobytes() for r in rows],
                ranks=[rank[r[3]].tobytes() for r in rows],
            )
        ])

    return cut.groupBy("fragment").applyInArrow(share, SHARED)


def set_rows(shared: DataFrame, n_fragments: int) -> DataFrame:
    """Sums over the fragments: the size of every set, and what the comparisons need of those that may link.

    A set of which more shingles occur nowhere else than a linked set may lack has no link. Rows with
    fragment -1 hold all keys and sizes. Of the other sets, rows from 0 to COUNTING - 1 hold the shared shingles in the
    fragments in which pairs are counted, and rows with fragment -2 the rarest ones, as many as a linked set
    may lack, and one more: linked sets share one of these. Shingles that only one set has come first, and meet no other.
    """

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("fragment")  # a set's shingles come in their order
        own = _whole(table, "keys", np.int64)
        keys, place = np.unique(own, return_inverse=True)
        sizes = np.bincount(place, _whole(table, "sizes", np.uint32)).astype(np.int64)
        alone = np.bincount(place, _whole(table, "alone", np.uint32)).astype(np.int64)
        bucket = table.column("bucket")[0].as_py()
        out = [(bucket, -1, keys.tobytes(), sizes.astype(np.uint32).tobytes(), b"", b"", b"")]
        counts = _whole(table, "counts", np.uint32)
        per_row = [len(x.as_buffer()) // 8 for x in table.column("keys")]
        counting = np.repeat(table.column("fragment").to_numpy().astype(np.int64) * COUNTING // n_fragments, per_row).astype(np.int8)
        kept = np.repeat((alone <= prefix_length(sizes))[place], counts)
        owner, counting = np.repeat(place.astype(np.int32), counts)[kept], np.repeat(counting, counts)[kept]
        values, ranks = _whole(table, "shingles", np.uint64)[kept], _whole(table, "ranks", np.uint8)[kept]
        for part in range(COUNTING):
            here = np.flatnonzero(counting == part)
            here = here[np.argsort(owner[here], kind="stable")]
            begins = starts(owner[here])
            if len(here):
                lengths = np.diff(np.append(begins, len(here))).astype(np.uint32)
                out.append((bucket, part, keys[owner[here][begins]].tobytes(), b"", lengths.tobytes(), values[here].tobytes(), b""))
        order = np.lexsort((values, ranks, owner))
        owner, values = owner[order], values[order]
        begins = starts(owner)
        position = np.arange(len(owner)) - np.repeat(begins - alone[owner[begins]], np.diff(np.append(begins, len(owner))))
        first = position <= prefix_length(sizes[owner])
        owner, values, position = owner[first], values[first], position[first].astype(np.int32)
        if len(owner):
            begins = starts(owner)
            lengths, named = np.diff(np.append(begins, len(owner))).astype(np.uint32), owner[begins]
            own_sizes = sizes[named].astype(np.uint32)
            out.append((bucket, -2, keys[named].tobytes(), own_sizes.tobytes(), lengths.tobytes(), values.tobytes(), position.tobytes()))
        names = [part.split()[0] for part in SETS.split(", ")]
        return pa.Table.from_batches([_batch(SETS, **dict(zip(names, zip(*out, strict=True), strict=True)))])

    return shared.groupBy("bucket").applyInArrow(gather, SETS)


def set_sizes(sets: DataFrame) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_whole(batch, "keys", np.int64)), pa.array(_whole(batch, "sizes", np.uint32).astype(np.int64))],
                ["key", "size"],
            )

    return sets.where("fragment = -1").select("keys", "sizes").mapInArrow(unpack, "key bigint, size bigint")


def prefix_entries(sets: DataFrame) -> DataFrame:
    """The rarest shingles of the sets that may link, with the places they have in these."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            counts = _whole(row, "counts", np.uint32)
            yield _batch(
                ENTRIES,
                shingle=_whole(row, "shingles", np.int64),
                key=np.repeat(_whole(row, "keys", np.int64), counts),
                size=np.repeat(_whole(row, "sizes", np.uint32), counts).astype(np.int32),
                position=_whole(row, "positions", np.int32),
            )

    return sets.where("fragment = -2").drop("bucket", "fragment").mapInArrow(unpack, ENTRIES)


def _buckets(batches: Iterator[pa.RecordBatch]):
    """Sorted entries of a partition, without shingles of one entry, and where buckets begin."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return None
    columns = {name: np.concatenate([b.column(name).to_numpy() for b in rows]) for name in rows[0].schema.names}
    priority = mixed(columns["key"].view(np.uint64))
    order = np.lexsort((priority, columns["shingle"]))
    columns = {name: c[order] for name, c in columns.items()}
    begins = starts(columns["shingle"])
    return columns, begins, np.diff(np.append(begins, len(order)))


def _candidates(columns: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs of entries whose overlap can suffice, given where in the order they meet."""
    size, position = columns["size"].astype(np.int64), columns["position"].astype(np.int64)
    least = least_overlap(size[left], size[right])
    fits = (size[left] - position[left] >= least) & (size[right] - position[right] >= least)
    left, right = left[fits], right[fits]
    key = columns["key"]
    swapped = key[left] > key[right]
    left, right = np.where(swapped, right, left), np.where(swapped, left, right)
    order = np.lexsort((key[right], key[left]))
    left, right = left[order], right[order]
    if len(order):
        new = np.concatenate([[True], (key[left][1:] != key[left][:-1]) | (key[right][1:] != key[right][:-1])])
        left, right = left[new], right[new]
    return _batch(PAIRS, a=key[left], b=key[right], size_a=columns["size"][left], size_b=columns["size"][right])


def packed_buckets(entries: DataFrame, parts: int) -> DataFrame:
    """The buckets of several entries, dealt once: rows of whole buckets, some PACKED entries each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _buckets(batches)
        if not found:
            return
        columns, begins, counts = found
        kept = np.repeat(counts > 1, counts)
        columns = {name: column[kept] for name, column in columns.items()}
        ends = np.cumsum(counts[counts > 1])
        cuts = np.append(0, ends[np.append(starts(ends // PACKED)[1:] - 1, len(ends) - 1)]) if len(ends) else [0]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield _batch(BUCKETS, **{f"{name}s": [column[x:y].tobytes()] for name, column in columns.items()})

    return entries.repartition(parts, "shingle").mapInArrow(pack, BUCKETS)


def _unpacked(batches: Iterator[pa.RecordBatch]):
    """Each row of whole buckets, as ``_buckets`` tells them."""
    for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
        kinds = {"shingle": np.int64, "key": np.int64, "size": np.int32, "position": np.int32}
        columns = {name: _whole(row, f"{name}s", kind) for name, kind in kinds.items()}
        begins = starts(columns["shingle"])
        yield columns, begins, np.diff(np.append(begins, len(columns["shingle"])))


def hub_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs of the first entries of each bucket, in one order for all buckets, with its others."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, begins, counts in _unpacked(batches):
            at = np.repeat(begins, counts)
            every = np.arange(len(at))
            left = [np.where(at + h < every, at + h, -1) for h in range(HUBS[0])]
            right = np.concatenate([every[x >= 0] for x in left])
            yield _candidates(columns, np.concatenate([x[x >= 0] for x in left]), right)

    return buckets.mapInArrow(pairs, PAIRS).distinct()


def large_buckets(buckets: DataFrame, first: int) -> DataFrame:
    """Entries of the buckets that have members past ``first`` to compare."""

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _, counts in _unpacked(batches):
            kept = np.repeat(counts > first + 1, counts)
            if kept.any():
                yield _batch(ENTRIES, **{name: column[kept] for name, column in columns.items()})

    return buckets.mapInArrow(large, ENTRIES)


def open_buckets(entries: DataFrame, labels: DataFrame, first: int, parts: int) -> DataFrame:
    """Entries, with labels, of buckets that may still have a link: members past ``first``, and several components.

    Components only grow, so a bucket that is left out has no more to tell in later turns either.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _buckets(batches)
        if not found:
            return
        columns, begins, counts = found
        label = columns["label"]
        several = np.minimum.reduceat(label, begins) < np.maximum.reduceat(label, begins)
        kept = np.repeat(several & (counts > first + 1), counts)
        if kept.any():
            yield _batch(LABELLED, **{name: column[kept] for name, column in columns.items()})

    labelled = entries.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    return labelled.repartition(parts, "shingle").mapInArrow(keep, LABELLED)


def later_pairs(entries: DataFrame, first: int, last: int | None, parts: int) -> DataFrame:
    """Pairs of a bucket's members from ``first`` to before ``last`` with later ones of other components.

    Without ``last`` nothing bounds a bucket's pairs but the prefix and position filters: sets that share a
    rare shingle, lie within each other's range of sizes, and are not yet one component.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _buckets(batches)
        if not found:
            return
        columns, begins, counts = found
        label = columns["label"]
        for begin, count in zip(begins.tolist(), counts.tolist(), strict=True):
            end = begin + count
            for i in range(begin + first, min(end, begin + last) if last else end):
                others = np.arange(i + 1, end)
                others = others[label[others] != label[i]]
                if len(others):
                    yield _candidates(columns, np.full(len(others), i), others)

    return entries.repartition(parts, "shingle").mapInArrow(pairs, PAIRS).distinct()


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link: overlaps are counted fragment by fragment, then summed per pair.

    Pairs are sorted into groups of bounded size, by the member that is no hub, and packed into blocks.
    A group gets the segments of its own sets; what is sent is in proportion to the pairs, since a set has a
    segment for each of the COUNTING fragments, however many the order was cut into. One fragment passes a block's pairs on, the others their overlaps alone, and only if there are any.
    """
    found = pairs.agg(F.count(F.lit(1)), F.sum(F.col("size_a").cast("long") + F.col("size_b"))).first()
    n, n_shingles = found[0], found[1] or 0
    if not n:
        return pairs.select("a", "b")
    n_groups = max(-(-n // PAIR_GROUP), -(-n_shingles // (COUNTING * GROUP_SHINGLES)))

    def group_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """By the later member in the order of all buckets: a hub has many pairs, these go to all groups."""
        return (mixed(np.maximum(mixed(a.view(np.uint64)), mixed(b.view(np.uint64)))) % np.uint64(n_groups)).astype(np.int32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def blocks():
            values = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(4)]
            for g, own in groups(group_of(values[0], values[1])):
                for at in range(0, len(own), PAIR_BLOCK):
                    a, b, sa, sb = (v[own[at : at + PAIR_BLOCK]].tobytes() for v in values)
                    block = xxhash.xxh3_64_intdigest(a + b) - (1 << 63)
                    yield _batch(BLOCK, grp=[g], block=[block], a=[a], b=[b], sizes=[sa + sb])

        for batch in batches:
            held, n_held = [*held, batch], n_held + batch.num_rows
            if n_held >= PACKED:
                yield from blocks()
                held, n_held = [], 0
        if n_held:
            yield from blocks()

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if len(a):
                rows = np.unique(np.stack([np.concatenate([a, b]), np.tile(group_of(a, b), 2).astype(np.int64)], 1), axis=0)
                yield _batch(WANTED, wanted=np.ascontiguousarray(rows[:, 0]), grp=rows[:, 1].astype(np.int32))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each set and counting fragment."""
        for batch in batches:
            for row in batch.to_pylist():
                own, ends = np.frombuffer(row["keys"], np.int64), 8 * np.cumsum(np.frombuffer(row["counts"], np.uint32), dtype=np.int64)
                parts = [row["shingles"][x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield _batch(SEGMENT, key=own, f=np.full(len(own), row["fragment"], np.int32), shingles=parts)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in right.column("shingles")]
        held = dict(zip(right.column("key").to_pylist(), parts, strict=True))
        nothing, out = np.empty(0, np.uint64), []
        for row in left.to_pylist():
            a, b = np.frombuffer(row["a"], np.int64).tolist(), np.frombuffer(row["b"], np.int64).tolist()
            overlaps = np.fromiter(
                (_common(held.get(x, nothing), held.get(y, nothing)) for x, y in zip(a, b, strict=True)), np.uint32, len(a)
            )
            if not row["fragment"]:
                out.append((row["block"], row["a"], row["b"], row["sizes"], overlaps.tobytes()))
            elif overlaps.any():
                out.append((row["block"], b"", b"", b"", overlaps.tobytes()))
        names = [part.split()[0] for part in COUNTED.split(", ")]
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.Table.from_batches([_batch(COUNTED, **dict(zip(names, columns, strict=True)))])

    def total(table: pa.Table) -> pa.Table:
        a, b = _whole(table, "a", np.int64), _whole(table, "b", np.int64)
        sizes = _whole(table, "sizes", np.int32).astype(np.int64)
        overlap = _whole(table, "overlaps", np.uint32).reshape(table.num_rows, len(a)).sum(axis=0)
        link = overlap >= least_overlap(sizes[: len(a)], sizes[len(a) :])
        return pa.table([pa.array(a[link]), pa.array(b[link])], ["a", "b"])

    blocks = pairs.mapInArrow(pack, BLOCK)
    everywhere = blocks.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(COUNTING - 1))))
    wanted = pairs.mapInArrow(want, WANTED).distinct()
    held = sets.where("fragment >= 0").select("fragment", "keys", "counts", "shingles").mapInArrow(single, SEGMENT)
    # Where few sets are wanted, Spark sends these to the segments, not all segments to them.
    picked = held.join(wanted, F.col("key") == F.col("wanted")).select(F.col("grp").alias("g"), "f", "key", "shingles")
    counted = everywhere.groupBy("grp", "fragment").cogroup(picked.groupBy("g", "f")).applyInArrow(count, COUNTED)
    return counted.groupBy("block").applyInArrow(total, "a bigint, b bigint")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    Documents link when their sets of distinct 5-word shingles of lower-cased words (ASCII letters)
    share 75 % of their union; a shorter text is one shingle. ``component_id`` is the smallest doc_id
    that links reach, the own included; null doc_ids are passed over, unless there is no other.
    Null texts and texts without words have no shingles and link with nothing, not even each
    other. Repeated rows come out as often. An empty table gives no rows. Other columns are ignored.

    Equal word sequences are compared once. The order of shingles is cut into fragments; a
    fragment counts in how many sets each of its shingles occurs, and the counts of a set over all
    fragments tell whether it can link at all. For the few that can, rare shingles give candidate
    pairs, whose overlaps are counted per fragment and summed. Hubs come first: a few members of
    each bucket meet the others, and of what is then one component no more pairs are looked at. More
    members follow in turn, at last all, so no link that joins components is lost.
    """
    spark = docs.sparkSession
    members = written(keyed(docs), "members")
    about = members.agg(F.sum("about")).first()[0] or 0
    n_fragments = max(16, -(-about // FRAGMENT))
    parts = max(width(spark), -(-about // BUCKET))
    cut = segments(docs, n_fragments)
    sets = written(set_rows(shared_segments(cut, parts), n_fragments), "sets")
    buckets = written(packed_buckets(prefix_entries(sets), parts), "buckets")
    links = written(linked(written(hub_pairs(buckets), "pairs"), sets), "links")
    labels, entries = components(links), large_buckets(buckets, HUBS[0])
    for first, last in zip(HUBS, [*HUBS[1:], None], strict=True):
        entries = written(open_buckets(entries.drop("label"), labels, first, parts), "entries")
        if entries.isEmpty():
            break
        pairs = written(later_pairs(entries, first, last, parts), "pairs")
        if not pairs.isEmpty():
            more = written(linked(pairs, sets), "links")
            labels = components(labels.selectExpr("key AS a", "label AS b").where("a <> b").union(more))
    # From keys to documents: a key's smallest doc_id, then a component's.
    smallest = members.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = smallest.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    reached = named.groupBy("label").agg(F.min("least").alias("component_id"))
    per_key = written(named.join(reached, "label").join(set_sizes(sets), "key").select("key", "size", "component_id"), "keys")
    out = members.join(per_key, "key", "left")
    return out.select(
        "doc_id",
        F.coalesce("size", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: that with the smallest doc_id, one row of it.

    A row without doc_id gets a number from its text, above all ids, so it can stay if nothing
    links with it; of repeated rows without id and words, one stays.
    """
    columns = docs.columns
    stand_in = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    numbered = docs.select(F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("doc_id"), F.struct(*columns).alias("row"), "text")
    found = link_documents(numbered.select("doc_id", "text"))
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = numbered.join(first, "doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("row")))
    return kept.withColumn("_nth", nth).where("_nth = 1").select("row.*")
