"""Alignment of two tokenizers over the bytes of each text."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cubagem.llm.common import packed, written

#: Text a task encodes at a time, and text whose pairs share one numbering.
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 16 << 20

#: How byte-level vocabularies cut text before merging (fixed value).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ENCODED = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "places binary, times binary, pairs binary, held binary"
)
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary in a JSON file; special tokens in texts are plain text.

    Where each merge makes the next id, as usual, ids are merge ranks, and the faster library of the two
    encodes; otherwise, or if it gives up on a text, the one that the file is made for.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary = described["model"]["vocab"]
        decoded = _byte_letters()
        self.bytes: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *(t["id"] for t in described["added_tokens"])]))
        special = {t["content"] for t in described["added_tokens"]}
        for piece, i in vocabulary.items():
            if piece not in special:
                self.bytes[i] = bytes(decoded[c] for c in piece)
        merges = (m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in described["model"]["merges"])
        ranked = all(vocabulary[m] == 256 + k for k, m in enumerate(merges))
        plain = described["normalizer"] is None and described["pre_tokenizer"]["type"] == "ByteLevel"
        self.fast = None
        if ranked and plain and described["pre_tokenizer"]["use_regex"] and not described["pre_tokenizer"]["add_prefix_space"]:
            ranks = {piece: i for i, piece in enumerate(self.bytes) if piece}
            self.fast = tiktoken.Encoding("a", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def exact(self) -> Tokenizer:
        own = Tokenizer.from_file(self.path)
        own.encode_special_tokens = True
        return own

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except Exception:  # noqa: BLE001 - its regular expressions give up on very long runs of white space
                pass
        return self.exact.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a vocabulary of pieces with bytes to fall back on; it puts a space before the text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(self.model.id_to_piece(list(range(self.model.vocab_size()))))
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable ones as they are, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Aligned(NamedTuple):
    """Tokens and links of the texts of a slice, one text after the other."""

    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Groups and overlaps of two tokenizations of the same bytes, given their tokens' lengths.

    All tokens are sorted by start; a group begins where a start reaches the greatest end so far. A token of
    A links to the tokens of B from the first that ends after its start to the last that starts before its end.
    """
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    start_a, start_b = end_a - length_a, end_b - length_b
    starts, ends = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(length_a), len(length_b)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    first = np.searchsorted(end_b, start_a, "right")
    n = np.searchsorted(start_b, end_a, "left") - first
    link_a = np.repeat(np.arange(len(length_a)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n - first, n)
    return Aligned(group[: len(length_a)], group[len(length_a) :], link_a, link_b)


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.length_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.length_b = np.array([len(x) for x in self.b.bytes], np.int64)
        ids_a, ids_b = range(len(self.a.bytes)), range(len(self.b.bytes))
        marks = [*(f"{i}," for i in ids_a), *(f"{i}|" for i in ids_a), *(f"{i}," for i in ids_b), *(f"{i};" for i in ids_b)]
        self.marks = np.array(marks, object)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both tokenizers; none where the text is empty or either doesn't give its bytes."""
        if not text:
            return [], []
        expected = b" " + text.encode()
        b = self.b.encode(text)
        if b"".join(map(self.b.bytes.__getitem__, b)) != expected:
            return [], []
        a = self.a.encode(" " + text)
        if b"".join(map(self.a.bytes.__getitem__, a)) != expected:
            return [], []
        return a, b

    def texts(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Figures per text; the slice's distinct pairs; and text, pair and times of each distinct link of a text."""
        both = [self.tokens(text) for text in texts]
        n_a = np.array([len(a) for a, _ in both], np.int64)
        n_b = np.array([len(b) for _, b in both], np.int64)
        a = np.fromiter((i for ids, _ in both for i in ids), np.int64, n_a.sum())
        b = np.fromiter((i for _, ids in both for i in ids), np.int64, n_b.sum())
        found = align(self.length_a[a], self.length_b[b])
        digests, n_groups = self._digests(a, b, n_a, n_b, found)
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        of_text = text_of_a[found.link_a]
        pairs, pair = np.unique(a[found.link_a] << 32 | b[found.link_b], return_inverse=True)
        distinct, times = np.unique(of_text * max(len(pairs), 1) + pair, return_counts=True)
        n_links = np.bincount(of_text, minlength=len(texts))
        figures = list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), digests, strict=True))
        in_text, pair = np.divmod(distinct, max(len(pairs), 1))
        return figures, pairs, in_text, pair, times

    def _digests(self, a, b, n_a, n_b, found: Aligned) -> tuple[list[str], np.ndarray]:
        """The digest of each text's groups, written as a1,a2|b1;a3|b2,b3, and their number."""
        n_groups = int(found.group_a[-1]) + 1 if len(a) else 0
        in_a, in_b = np.bincount(found.group_a, minlength=n_groups), np.bincount(found.group_b, minlength=n_groups)
        last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
        mark_a, mark_b = a.copy(), b + 2 * len(self.a.bytes)
        mark_a[last_a] += len(self.a.bytes)
        mark_b[last_b] += len(self.b.bytes)
        # In the text, a group's tokens of A stand before its tokens of B.
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + (last_b + 1 - in_b)[found.group_a]] = mark_a
        line[np.arange(len(b)) + (last_a + 1)[found.group_b]] = mark_b
        limits = np.concatenate([[0], np.cumsum(n_a + n_b)])
        digests = []
        for begin, end in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            text = "".join(self.marks[line[begin:end]].tolist())[:-1]
            digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        ends = np.cumsum(n_a)
        before = np.concatenate([found.group_a, [n_groups]])
        return digests, before[ends] - before[ends - n_a]


@functools.cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Block:
    """Texts whose links count places in one sorted list of distinct pairs."""

    def __init__(self, block: int):
        self.block, self.size, self.ids, self.figures, self.slices = block, 0, [], [], []

    def add(self, aligner: Aligner, ids: list, texts: list, size: int) -> None:
        figures, *links = aligner.texts(texts)
        self.ids += ids
        self.figures += figures
        self.slices.append((len(texts), *links))
        self.size += size

    def rows(self) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.concatenate([pairs for _, pairs, _, _, _ in self.slices]))
        held, places, times = np.zeros(len(pairs), np.int64), [], []
        for n, own, in_text, pair, repeated in self.slices:
            place = np.searchsorted(pairs, own)[pair].astype(np.uint32)
            held += np.bincount(place, minlength=len(pairs))
            limits = np.searchsorted(in_text, np.arange(n + 1))
            for begin, end in zip(limits[:-1], limits[1:], strict=True):
                places.append(place[begin:end].tobytes())
                times.append(repeated[begin:end].astype(np.uint32).tobytes())
        n = len(self.ids)
        columns = [[self.block] * n, self.ids, *zip(*self.figures, strict=True), places, times, [None] * n, [None] * n]
        yield _batch(columns, ENCODED_ARROW)
        own = [self.block, None, None, None, None, None, None, None, None, pairs.tobytes(), held.tobytes()]
        yield _batch([[value] for value in own], ENCODED_ARROW)


def _batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


ENCODED_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
     ("pairs", pa.binary()), ("held", pa.binary())]
)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers, and how common the links' id pairs are.

    A (``path_a``) is a byte-level vocabulary in JSON, B (``path_b``) a model of pieces; both paths must exist on
    each executor. A encodes a space and the text, B the text, before which it puts a space itself. Byte
    offsets where tokens of both end cut the tokens into groups; tokens that share a byte are linked.
    A pair of ids counts as many as rows hold it linked.

    Returned per row: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair has the highest count of its
    id of A, ties included), count_sum (of all links), groups_sha256. Null and empty texts, and texts that a tokenizer
    does not give back byte by byte, have zeros and an empty digest, and count nowhere. Repeated rows, and a
    null doc_id, are documents of their own. An empty table gives no rows. Other columns are ignored.

    Texts are encoded once. A task numbers the distinct pairs of a block of texts, and texts refer to
    these numbers, so that a pair crosses the network once per block, not once per link: to be summed with the others,
    and back with its sum. A frequent pair has one row per block. Only the longest single text bounds a task from below.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, first = _aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        block = _Block(first)
        for batch in batches:
            texts, ids, size = [], [], 0
            doc_ids = batch.column(0).to_pylist()
            for k, doc_id in enumerate(doc_ids):
                text = batch.column(1)[k].as_py()
                texts.append(text)
                ids.append(doc_id)
                size += len(text or "")
                if size >= SLICE_BYTES or k == len(doc_ids) - 1:
                    block.add(aligner, ids, texts, size)
                    texts, ids, size = [], [], 0
                    if block.size >= BLOCK_BYTES:
                        yield from block.rows()
                        block = _Block(block.block + 1)
        if block.ids:
            yield from block.rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = written(rows.mapInArrow(encode, ENCODED), "aligned")
    own = encoded.where("pairs IS NOT NULL").select("block", "pairs", "held")
    own = own.mapInArrow(_unpacked, "block bigint, place int, pair bigint, held bigint")
    totals = own.groupBy("pair").agg(F.sum("held").alias("n"))
    totals = totals.withColumn("a", F.shiftright("pair", 32))
    # One row per id of A: bounded by the vocabulary.
    highest = totals.groupBy("a").agg(F.max("n").alias("highest"))
    totals = totals.join(F.broadcast(highest), "a").selectExpr("pair", "n", "n = highest AS best")
    answers = own.select("block", "place", "pair").join(totals, "pair").select("block", "place", "n", "best")
    texts = encoded.where("pairs IS NULL").drop("pairs", "held")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_counted, ALIGNED)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, block in enumerate(batch.column(0).to_pylist()):
            pairs, held = (packed(batch.column(c).slice(k, 1), np.int64) for c in (1, 2))
            columns = [np.full(len(pairs), block), np.arange(len(pairs), dtype=np.int32), pairs, held]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "place", "pair", "held"])


def _counted(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums of each text of a block over its links."""
    place = answers.column("place").to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place] = answers.column("n").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    at, times = packed(texts.column("places"), np.uint32), packed(texts.column("times"), np.uint32).astype(np.int64)
    sizes = [len(x) // 4 for x in texts.column("places").to_pylist()]
    limits = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])

    def summed(values: np.ndarray) -> pa.Array:
        total = np.concatenate([[0], np.cumsum(values[at] * times)])
        return pa.array((total[limits[1:]] - total[limits[:-1]]).astype(np.int64))

    kept = [texts.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.table([*kept, summed(best), summed(n), texts.column("groups_sha256")], names=names)
