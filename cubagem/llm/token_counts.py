"""Token counts of a unigram tokenizer, without making the tokens."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a space, and before each text.
SPACE = "▁"
#: An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose counts a task remembers; beyond that it begins anew.
REMEMBERED = 500_000

COUNTED = "n_tokens bigint, n_words bigint"


def load_pieces(model_file: str) -> list[tuple[str, float]]:
    """(piece, score) of the normal pieces of a vocabulary file, in order of id."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.vocab_size())
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in ids
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def byte_pieces(model_file: str) -> bool:
    """Whether the vocabulary has a piece for each byte."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return sum(model.is_byte(i) for i in range(model.vocab_size())) == 256


class Counter:
    """Counts the pieces of the best segmentation of a word.

    The automaton lists the pieces that end at each character, the table carries the best score
    and its number of pieces up to there. The tokenizer goes through starts from left to right and
    replaces the best way to an end only by a better one, so of equal scores the earliest start,
    that is the longest last piece, wins. A character that no piece of one character covers may
    stand alone as unknown; a run of unknowns is one piece, or, with pieces for bytes, as many as
    its UTF-8 bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]], by_bytes: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.by_bytes = by_bytes
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.remembered = _Remembered(self.word)

    def word(self, word: str) -> int:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        best, count, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end, matches in enumerate(ends):
            top, pieces, run = None, 0, False
            # Longest first is the order of starts; the unknown character is the last start.
            single = False
            for length, score in sorted(matches, reverse=True):
                single |= length == 1
                total = best[end + 1 - length] + score
                if top is None or total > top:
                    top, pieces, run = total, count[end + 1 - length] + 1, False
            if not single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    size = len(word[end].encode()) if self.by_bytes else int(not open_run[end])
                    top, pieces, run = total, count[end] + size, True
            best[end + 1], count[end + 1], open_run[end + 1] = top, pieces, run
        return count[n]

    def text(self, text: str) -> tuple[int, int]:
        """Pieces and words of a text; a word is what follows a space, or the beginning."""
        if not text:
            return 0, 0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0]:  # the text begins with a space of its own
            words = words[1:]
        return sum(map(self.remembered.__getitem__, words)), len(words)


class _Remembered(dict):
    """Counts by word, without its leading space; bounded, as it begins anew when full."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        pieces = self[word] = self.count(SPACE + word)
        return pieces


@functools.cache
def _counter(model_file: str) -> Counter:
    return Counter(load_pieces(model_file), byte_pieces(model_file))


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, n_words, n_chars) of each document, of its whole text.

    Null and empty texts have 0 tokens. Each row is counted on its own, so repeated rows give
    repeated results, and nothing is shuffled. An empty table gives no rows. Other columns are
    ignored. ``model_file`` must be a path that each executor has.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            counts = [counter.text(text or "") for text in batch.column(1).to_pylist()]
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, batch.column(2)], ["doc_id", "n_tokens", "n_words", "n_chars"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
    )
    return rows.mapInArrow(count, f"doc_id bigint, {COUNTED}, n_chars bigint")
