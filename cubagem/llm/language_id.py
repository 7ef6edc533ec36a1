"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import remainder, starts, written

UNDETERMINED = "und"
#: A text is parsed in blocks of this many bytes, whose phrases add up.
BLOCK = 2048
#: Blocks that are parsed side by side.
LANES = 4096

_LETTERS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))

PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double, phrases double"
PREDICTED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
     ("phrases", pa.float64())]
)


def suffix_automaton(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The smallest automaton of all substrings: a table state x symbol of next states, and a byte's symbol.

    Symbol 0 is any byte that the text lacks; no transition is -1. State 0 is the start.
    """
    alphabet = np.zeros(256, np.int16)
    for n, byte in enumerate(sorted(set(text))):
        alphabet[byte] = n + 1
    size = int(alphabet.max()) + 1
    following: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in alphabet[np.frombuffer(text, np.uint8)].tolist():
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = new
            state = link[state]
        if state >= 0:
            after = following[state][symbol]
            if longest[after] == longest[state] + 1:
                link[new] = after
            else:
                copy = len(following)
                following.append(following[after].copy())
                longest.append(longest[state] + 1)
                link.append(link[after])
                while state >= 0 and following[state].get(symbol) == after:
                    following[state][symbol] = copy
                    state = link[state]
                link[after] = link[new] = copy
        last = new
    table = np.full((len(following), size), -1, np.int32)
    for state, out in enumerate(following):
        for symbol, after in out.items():
            table[state, symbol] = after
    return table, alphabet


class CrossParser:
    """Counts the phrases of texts, each the longest match in the training text of a language."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.languages = [language for language, _ in samples]
        self.automata = [suffix_automaton(text) for _, text in samples]
        # A phrase costs a pointer into the training text, so longer training texts cost more.
        self.cost = np.array([np.log2(len(text) + 1) for _, text in samples])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Normalised phrases (bits per byte) by text and language."""
        lengths = np.array([len(t) for t in texts], np.int64)
        blocks = -(-lengths // BLOCK)
        data = np.frombuffer(b"".join(texts), np.uint8)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
        size = np.minimum(lengths[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        counts = np.zeros((len(texts), len(self.languages)))
        for k, (table, alphabet) in enumerate(self.automata):
            symbols = alphabet[data]
            for lanes in np.array_split(order, max(1, len(order) // LANES)):
                found = _parse(table, symbols, begin[lanes], size[lanes])
                np.add.at(counts[:, k], owner[lanes], found)
        return counts * self.cost / np.maximum(lengths, 1)[:, None]


def _parse(table: np.ndarray, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Phrases of blocks, longest block first; all blocks take one step at a time."""
    width = table.shape[1]
    flat = table.ravel()
    state = np.zeros(len(begin), np.int64)
    phrases = np.zeros(len(begin), np.int64)
    running = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    position = begin.copy()
    for n in running.tolist():
        symbol = symbols[position[:n]]
        after = flat[state[:n] * width + symbol]
        over = after < 0
        # A byte begins a phrase at the start and where the last match ends; an unknown one stands alone.
        phrases[:n] += over | (state[:n] == 0)
        ends = np.flatnonzero(over)
        after[ends] = np.maximum(flat[symbol[ends]], 0)
        state[:n] = after
        position[:n] += 1
    return phrases


@functools.lru_cache(maxsize=1)
def _parser(samples: tuple[tuple[str, bytes], ...]) -> CrossParser:
    return CrossParser(samples)


def training_samples(
    docs: DataFrame, documents_per_language: int = 400, bytes_per_language: int = 1 << 16
) -> tuple[tuple[str, bytes], ...]:
    """(language, text): a bounded sample of the labelled text of each language.

    Rows with a language and a text, but not those held out (CRC-32 of doc_id modulo 3 is 1), are
    chosen by a hash, about ``documents_per_language`` of each language. The driver receives at
    most ``bytes_per_language`` of each.
    """
    labelled = docs.where((remainder("doc_id", 3) != 1) & F.col("lang").isNotNull() & (F.trim("text") != ""))
    labelled = labelled.select("lang", F.xxhash64("doc_id", "text").alias("place"), "text")
    # A written table has a known size, so Spark needs no shuffle of texts to meet a small one.
    counts = written(labelled.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    # The hash is spread evenly over 64 bits, so a share of its range is a share of the rows.
    share = F.least(F.lit(1.0), F.lit(float(documents_per_language)) / F.col("n"))
    chosen = labelled.join(counts, "lang").where(F.col("place") / F.lit(2.0**63) <= share * 2 - 1)
    clipped = chosen.select("lang", "place", F.substring(F.col("text"), 1, bytes_per_language // 8).alias("text"))
    clipped = clipped.groupBy("lang", "place").agg(F.min("text").alias("text"))  # repeated rows once
    first = F.slice(F.sort_array(F.collect_list(F.struct("place", "text"))), 1, documents_per_language)
    texts = clipped.groupBy("lang").agg(F.array_join(F.transform(first, lambda s: s["text"]), "\n").alias("text"))
    rows = texts.select("lang", F.substring("text", 1, bytes_per_language).alias("text")).orderBy("lang").collect()
    return tuple((r["lang"], normalised(r["text"])[:bytes_per_language]) for r in rows)


def identify(docs: DataFrame, samples: tuple[tuple[str, bytes], ...] | None = None, columns: bool = False) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, phrases) of each document, from its whole text.

    Texts are compared in lower case and by their letters. For each language, the text is cut into the longest pieces that occur in the language's
    training text; the language needing fewest phrases, weighed by the size of a pointer into its
    training text, wins, the first by name among equals. ``score`` is 1 less the ratio of the best to
    the second best, ``phrases`` the bits per byte of the best. Null texts and texts without a letter
    are ``und`` with score 0, as are all if there is nothing to learn from. Each row is judged on
    its own; an empty table gives no rows. ``held_out`` tells rows that were no training text. With
    ``columns``, a struct ``row`` holds the columns of the document as well.
    """
    samples = training_samples(docs) if samples is None else samples
    # Bounded by the parameters of the sample.
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in batches:
            for some in _sliced(batch):
                found = _predicted(parser, some)
                if columns:
                    found = pa.RecordBatch.from_arrays([*found.columns, some.column("row")], [*PREDICTED_ARROW.names, "row"])
                yield found

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (remainder("doc_id", 3) == 1).alias("held_out"),
        lettered.alias("lettered"),
        # A text crosses to Python once, so with its row if that is asked for.
        F.struct(*docs.columns).alias("row") if columns else F.when(lettered, F.col("text")).alias("text"),
    )
    schema = f"{PREDICTED}, row {rows.schema['row'].dataType.simpleString()}" if columns else PREDICTED
    return rows.mapInArrow(predict, schema)


def _texts(batch: pa.RecordBatch) -> pa.Array:
    if "text" in batch.schema.names:
        return batch.column("text")
    return pc.struct_field(batch.column("row"), "text")


def normalised(text: str) -> bytes:
    """A text in lower case, with one space for each run of ASCII characters that are no letters."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def _sliced(batch: pa.RecordBatch, most_bytes: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of text, or single rows of more."""
    lengths = pc.fill_null(pc.binary_length(_texts(batch)), 0).to_numpy()
    part = np.cumsum(lengths, dtype=np.int64) // most_bytes
    begins = [*starts(part).tolist(), batch.num_rows]
    for begin, end in zip(begins[:-1], begins[1:], strict=True):
        yield batch.slice(begin, end - begin)


def _predicted(parser: CrossParser, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = _texts(batch).to_pylist()
    place = np.flatnonzero(batch.column("lettered").to_numpy(zero_copy_only=False))
    n = batch.num_rows
    names = np.full(n, UNDETERMINED, object)
    score, phrases = np.zeros(n), np.zeros(n)
    if len(place) and parser.languages:
        bits = parser.phrases([normalised(texts[i]) for i in place])
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(place)), best]
        second = np.partition(bits, 1, axis=1)[:, 1] if bits.shape[1] > 1 else np.full(len(place), np.inf)
        names[place] = np.array(parser.languages, object)[best]
        score[place], phrases[place] = np.clip(1 - least / second, 0.0, 1.0), least
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(phrases)],
        schema=PREDICTED_ARROW,
    )
