"""Benchmark decontamination by templates that leave numbers, names and units open."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import mixed, row_hashes, run_hashes, written

#: Words of a template window; a shorter item has one window of all its words, but not below SHORTEST.
WINDOW, SHORTEST = 8, 5
#: A window needs this share of words that are no placeholders.
LITERAL_SHARE = 0.5
#: From this share of capitals among the lettered words of a window, its case tells no names.
LOUD_SHARE = 0.75
#: A document leaks an item from this share of the item's windows.
LEAK_SHARE = 0.5
#: Bits of the filter that tasks test their windows with: 2 MB, whatever the size of the benchmark.
FILTER_BITS = 24

# Units of measurement and of money.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ounce ounces gram grams kilogram "
    "kilograms ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre "
    "kilometres mph kph km/h m/s w kw kwh v hz khz mhz ghz b kb mb gb tb byte bytes c f k degree degrees percent % cent cents "
    "dollar dollars euro euros pound pounds yen usd eur gbp"
)

LITERAL, NUMBER, NAME, UNIT, QUANTITY, EMPTY = 0, 1, 2, 3, 4, 5
_MARKS = ("", "<number>", "<name>", "<unit>", "<quantity>")
_MARK_HASHES = np.array([0] + [xxhash.xxh3_64_intdigest(m) for m in _MARKS[1:]], np.uint64)
_UNITS = frozenset(UNITS.split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$|[+-]?\d[\d.,]*[$€£]$")
_QUANTITY = re.compile(r"[+-]?\d[\d.,]*([^\W\d_]+)$")
_EDGES = re.compile(r"^[^\w$€£+%-]+|[^\w$€£%]+$")
#: Distinct words that a task remembers; beyond that it begins anew.
REMEMBERED = 200_000

WINDOWS = "text_key bigint, window bigint, template string, position int, slots array<string>, places array<int>, n_windows int"
#: Begins the template of a window of exact words; no bare word begins so.
EXACT = "="
_EXACT_SALT = np.uint64(0x5851F42D4C957F2D)

_PAIR = "struct(w.item AS item, w.doc AS doc)"
#: A pair wins if no other document value stands for its item value at more places; of equals, what is unchanged.
_WINS = """p = array_max(transform(filter(pairs, q -> q.item = p.item), q -> struct(
    size(filter(words, w -> w.item = q.item AND w.doc = q.doc)) AS n, q.item = q.doc AS unchanged, q AS pair))).pair"""


class Words(dict):
    """The place of each word in arrays of what words are: hash, kind, whether it ends a sentence or begins with a capital.

    A name is a capitalised word, for now; punctuation that stands alone is empty.
    """

    def __init__(self):
        super().__init__()
        self.values = np.empty(REMEMBERED, np.uint64)
        self.kinds = np.empty(REMEMBERED, np.int8)
        self.ends = np.empty(REMEMBERED, bool)
        self.capitals = np.empty(REMEMBERED, bool)

    def __missing__(self, word: str) -> int:
        # Only letters: nothing to strip, and no number.
        bare = word if word.isalpha() else bare_word(word)
        kind, lower = LITERAL, bare.lower()
        if not bare:
            kind = EMPTY
        elif not bare.isalpha() and _NUMBER.match(bare):
            kind = NUMBER
        elif not bare.isalpha() and (match := _QUANTITY.match(bare)) and match[1].lower() in _UNITS:
            kind = QUANTITY
        elif lower in _UNITS:
            kind = UNIT
        elif bare[:1].isupper():
            kind = NAME
        place = self[word] = len(self)
        self.values[place] = xxhash.xxh3_64_intdigest(lower)
        self.kinds[place] = kind
        self.ends[place] = word[-1:] in ".!?:"
        self.capitals[place] = bare[:1].isupper()
        return place

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, kind, end and capital of each word of a text; begins anew where new words could not be kept."""
        if len(self) + len(words) > REMEMBERED:
            self.clear()
        if len(words) > REMEMBERED:
            parts = [self.of(words[k : k + REMEMBERED]) for k in range(0, len(words), REMEMBERED)]
            return tuple(map(np.concatenate, zip(*parts, strict=True)))
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return tuple(kept.take(places) for kept in (self.values, self.kinds, self.ends, self.capitals))


def bare_word(word: str) -> str:
    return _EDGES.sub("", word)


@dataclass
class Tagged:
    """The words of a text that are not empty: hashes of lower-cased words, kinds, hashes with placeholders, capitals."""

    words: list[str]
    literals: np.ndarray
    kinds: np.ndarray
    capitals: np.ndarray

    @property
    def values(self) -> np.ndarray:
        out, open_places = self.literals.copy(), np.flatnonzero(self.kinds)
        out[open_places] = _MARK_HASHES[self.kinds[open_places]]
        return out

    @property
    def lettered(self) -> np.ndarray:
        return (self.kinds == LITERAL) | (self.kinds == NAME)


def tagged(words: list[str], known: Words) -> Tagged:
    """What the words of a text are.

    Numbers are numbers, also with a currency sign; a unit counts only after a number, or written
    together with it as a quantity; a name is a capitalised word that begins no sentence. All
    others are literals, compared in lower case and without punctuation around them. Punctuation
    alone is no word, but can end a sentence.
    """
    literals, kinds, ends, capitals = known.of(words)
    opens = np.concatenate([[True], ends[:-1]])
    kinds[(kinds == NAME) & opens] = LITERAL
    if (kinds == EMPTY).any():
        kept = np.flatnonzero(kinds != EMPTY)
        words = [words[i] for i in kept.tolist()]
        literals, kinds, capitals = literals[kept], kinds[kept], capitals[kept]
    after_number = np.concatenate([[False], kinds[:-1] == NUMBER])[: len(kinds)]
    kinds[(kinds == UNIT) & ~after_number] = LITERAL
    return Tagged(words, literals, kinds, capitals)


def templated(words: list[str], known: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, kind) of each word of a text that is not empty."""
    text = tagged(words, known)
    return text.values, text.kinds


def _running(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def exact_windows(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of all windows of a length, whatever their words are."""
    hashes = run_hashes(values, length) ^ (_EXACT_SALT + np.uint64(length))
    return hashes, np.arange(len(hashes))


def windows_of(values: np.ndarray, kinds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the windows of a length with enough literals."""
    hashes = run_hashes(values, length)
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    sums = _running(kinds == LITERAL)
    enough = np.flatnonzero(sums[length:] - sums[:-length] >= LITERAL_SHARE * length)
    return mixed(hashes[enough] + np.uint64(length)), enough


def loud_windows(text: Tagged, length: int, masks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, positions, kinds of words) of windows in capitals, for each mask of the places where an item has names.

    There, case tells no names, so the item does: words at its places are names and other words are literals.
    """
    if len(text.kinds) < length or not masks:
        return
    lettered = text.lettered
    sums = _running(text.capitals & lettered)
    at = np.flatnonzero(sums[length:] - sums[:-length] >= LOUD_SHARE * LITERAL_SHARE * length)
    if not len(at):
        return
    n_lettered = (all_sums := _running(lettered))[at + length] - all_sums[at]
    at = at[(sums[at + length] - sums[at] >= LOUD_SHARE * n_lettered) & (n_lettered >= LITERAL_SHARE * length)]
    if not len(at):
        return
    places = at[:, None] + np.arange(length)
    kinds = np.where(lettered, LITERAL, text.kinds)[places]
    values = np.where(kinds == LITERAL, text.literals[places], _MARK_HASHES[kinds])
    for mask in masks:
        named = [k for k in range(length) if mask >> k & 1]
        fits = np.flatnonzero((kinds[:, named] == LITERAL).all(1) & ((kinds == LITERAL).sum(1) - len(named) >= LITERAL_SHARE * length))
        own, own_kinds = values[fits], kinds[fits]
        own[:, named], own_kinds[:, named] = _MARK_HASHES[NAME], NAME
        yield mixed(row_hashes(own) + np.uint64(length)), at[fits], own_kinds


def _rows(words: list[str], kinds: np.ndarray, at: int, length: int) -> tuple[str, list[str]]:
    """A window as text with placeholders, and what they stand for."""
    return _row(words, kinds[at : at + length], at)


def _row(words: list[str], kinds: np.ndarray, at: int) -> tuple[str, list[str]]:
    own, kind = [bare_word(w) for w in words[at : at + len(kinds)]], kinds.tolist()
    template = " ".join(w.lower() if k == LITERAL else _MARKS[k] for w, k in zip(own, kind, strict=True))
    return template, [f"{_MARKS[k]}{w}" for w, k in zip(own, kind, strict=True) if k != LITERAL]


class _Filter:
    """A fixed number of bits, of which those of the benchmark's windows are set."""

    def __init__(self, rows):
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        for place, bits in rows:
            self.bits[place] = bits & 0xFFFFFFFFFFFFFFFF

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.bits.take((at >> np.uint64(6)).view(np.int64)) >> (at & np.uint64(63))) & np.uint64(1) == 1


def template_windows(rows: DataFrame, masks: dict[int, list[int]] | None = None, bits=None) -> DataFrame:
    """Windows of templates and of lower-cased words of rows (text_key, text).

    With ``masks``, whose keys are lengths of windows and whose values are places of names, those windows of
    each length that pass the filter; without, the windows of items: of WINDOW words, or of all
    words of a shorter item. Only templates of SHORTEST words and more count.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = Words(), []
        test = _Filter(bits.value) if bits else None

        def kept(hashes: np.ndarray) -> np.ndarray:
            return np.flatnonzero(test(hashes)) if test else np.arange(len(hashes))

        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").split()
                if not words:
                    continue
                found = tagged(words, known)
                words, values = found.words, found.values
                if not words:
                    continue
                for length in masks or (min(len(words), WINDOW),):
                    templates = []
                    if length >= SHORTEST:
                        hashes, places = windows_of(values, found.kinds, length)
                        own = kept(hashes)
                        templates = [(h, p, found.kinds[p : p + length], len(places)) for h, p in zip(hashes[own], places[own].tolist(), strict=True)]
                        for hashes, places, kinds in loud_windows(found, length, masks[length] if masks else []):
                            own = kept(hashes)
                            templates += [(hashes[i], int(places[i]), kinds[i], len(places)) for i in own.tolist()]
                    for window, at, kinds, n in templates:
                        template, slots = _row(words, kinds, at)
                        out.append((key, int(window.view(np.int64)), template, slots, at, (np.flatnonzero(kinds) + at).tolist(), n))
                    hashes, places = exact_windows(found.literals, length)
                    n, own = len(places), kept(hashes)
                    hashes, places = hashes[own], places[own]
                    if masks and len(places):  # of a document, one of each is enough
                        hashes, first = np.unique(hashes, return_index=True)
                        places = places[first]
                    for window, at in zip(hashes.view(np.int64).tolist(), places.tolist(), strict=True):
                        own = " ".join([bare_word(w).lower() for w in words[at : at + length]])
                        out.append((key, window, EXACT + own, [], at, [], n))
                    if len(out) >= 20_000:
                        yield _windows(out)
                        out = []
        if out:
            yield _windows(out)

    return rows.select("text_key", "text").mapInArrow(cut, WINDOWS)


def _windows(rows: list[tuple]) -> pa.RecordBatch:
    key, window, template, slots, at, places, n = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
    names = [part.split()[0] for part in WINDOWS.split(", ")]
    columns = (key, window, template, at, slots, places, n)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _filter_bits(windows: DataFrame):
    """The benchmark's bits, as at most 2^18 words of 64 bits."""
    at = F.shiftrightunsigned("window", 64 - FILTER_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(window, {64 - FILTER_BITS}) & 63 AS int))")
    words = windows.groupBy(F.shiftright(at, 6).alias("place")).agg(F.bit_or(bit).alias("bits"))
    return [(r["place"], r["bits"]) for r in words.collect()]


def _masks(item_windows: DataFrame) -> dict[int, list[int]]:
    """The lengths of items' windows, and the places of names in templates of a length, as bits: at most 2^WINDOW."""
    named = "filter(arrays_zip(slots, places), z -> startswith(z.slots, '<name>'))"
    mask = F.expr(f"aggregate({named}, 0, (m, z) -> m | shiftleft(1, z.places - position))")
    length = F.size(F.split("template", " "))
    out: dict[int, list[int]] = {}
    for row in item_windows.select(length.alias("length"), mask.alias("mask")).distinct().orderBy("length", "mask").collect():
        out.setdefault(row["length"], []).append(row["mask"])
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, share, n_slots, reparameterised): benchmark items found in documents.

    Texts become templates, with typed placeholders for numbers, names and units. Windows of
    templates are hash-joined. The windows that a document and an item share at one offset
    are consistent if each value of the item stands for one value of the document; where it stands for
    several, the windows with another than the most frequent one don't count. ``share`` is the part of the item's windows that is found, at
    least LEAK_SHARE. ``n_slots`` counts different open values, and ``reparameterised`` tells that one of
    them differs. Tasks drop windows by a filter of fixed size before the join, so only possible
    hits are shuffled.

    Case tells names only where a text is in usual case. Windows mostly in capitals take the places of names from the
    items. The windows of lower-cased words are hash-joined too, all of them, at any offset: a shouted, title-case
    or lower-case copy of an item is found by its words. ``share`` is that of the template windows if they alone are
    enough, and else the part of all windows that is found in either way; an item found by exact words
    only has no slots. A lower-case copy with other values counts by its unchanged words only.

    Null and empty texts and texts of punctuation match nothing; texts below SHORTEST words and items
    without a window of enough literals match by their words only. Rows are told apart by doc_id and text: repeated rows are one, and null ids stay null.
    Repeated items are one per item_id and text. Empty tables give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("item_id", "text").alias("text_key"), "text")
    item_windows = written(template_windows(items).join(items.select("text_key", "item_id").distinct(), "text_key"), "items")
    masks = _masks(item_windows)
    bits = spark.sparkContext.broadcast(_filter_bits(item_windows))
    # A document's windows are joined by a key of id and text, which finds its way back below.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("doc_id", "text").alias("text_key"), "text")
    found = template_windows(keyed, masks or {WINDOW: []}, bits).alias("d")
    # Read twice below.
    hits = found.join(item_windows.alias("i"), F.expr("d.window = i.window AND d.template = i.template")).select(
        F.col("d.text_key").alias("text_key"),
        F.startswith("i.template", F.lit(EXACT)).alias("exact"),
        "i.item_id",
        F.col("i.text_key").alias("item_key"),
        (F.col("d.position") - F.col("i.position")).alias("offset"),
        F.col("i.position").alias("position"),
        F.col("i.n_windows").alias("n_windows"),
        F.arrays_zip(F.col("i.slots").alias("item"), F.col("d.slots").alias("doc"), F.col("i.places").alias("place")).alias("slots"),
    )
    hits = written(hits, "hits")
    same = ["text_key", "item_id", "item_key"]
    by_offset = hits.where("NOT exact").groupBy(*same, "offset").agg(
        F.collect_set(F.struct("position", "slots")).alias("hits"), F.max("n_windows").alias("n_windows")
    )
    # Each open word once, however many windows hold it.
    by_offset = by_offset.withColumn("words", F.expr("array_distinct(flatten(transform(hits, h -> h.slots)))"))
    by_offset = by_offset.withColumn("pairs", F.expr(f"array_distinct(transform(words, w -> {_PAIR}))"))
    # One item value, one document value: as many distinct values as distinct pairs. Else the majority's.
    agree = "size(array_distinct(transform(pairs, p -> p.item))) = size(pairs)"
    by_offset = by_offset.withColumn("chosen", F.expr(f"CASE WHEN {agree} THEN pairs ELSE filter(pairs, p -> {_WINS}) END"))
    by_offset = by_offset.withColumn("hits", F.expr(f"filter(hits, h -> forall(h.slots, w -> array_contains(chosen, {_PAIR})))"))
    consistent = by_offset.where(F.size("hits") > 0).select(
        *same,
        F.col("hits.position").alias("positions"),
        F.expr(f"array_distinct(transform(flatten(transform(hits, h -> h.slots)), w -> {_PAIR}))").alias("slots"),
        "n_windows",
    )
    by_exact = hits.where("exact").groupBy(*same).agg(
        F.collect_set("position").alias("positions"), F.max("n_windows").alias("n_windows")
    )
    of_templates = consistent.select(*same, F.lit(False).alias("exact"), "positions", "slots", "n_windows")
    no_slots = F.lit(None).cast(of_templates.schema["slots"].dataType).alias("slots")
    of_words = by_exact.select(*same, F.lit(True).alias("exact"), "positions", no_slots, "n_windows")
    all_of = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    by_item = of_templates.union(of_words).groupBy(*same).agg(
        (all_of(F.when(~F.col("exact"), F.col("positions"))) / F.max(F.when(~F.col("exact"), F.col("n_windows")))).alias("by_template"),
        (all_of("positions") / F.max(F.when(F.col("exact"), F.col("n_windows")))).alias("by_either"),
        F.coalesce(F.max(F.size("slots")), F.lit(0)).cast("int").alias("n_slots"),
        F.coalesce(F.max(F.exists("slots", lambda s: F.lower(s["item"]) != F.lower(s["doc"]))), F.lit(False)).alias("reparameterised"),
    )
    share = F.when(F.col("by_template") >= LEAK_SHARE, F.col("by_template")).otherwise(F.col("by_either"))
    by_item = by_item.withColumn("share", share).where(F.col("share") >= LEAK_SHARE)
    leaks = written(by_item.select("text_key", "item_id", "share", "n_slots", "reparameterised"), "leaks")
    names = keyed.select("doc_id", "text_key").join(leaks.select("text_key").distinct(), "text_key", "left_semi").distinct()
    return names.join(leaks, "text_key").select("doc_id", "text_key", "item_id", "share", "n_slots", "reparameterised")


def text_key(doc_id: str, text: str):
    return F.xxhash64(doc_id, text)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no benchmark item, unchanged."""
    leaks = written(find_leaks(docs, benchmark).select(F.col("text_key").alias("_leak")).distinct(), "leaks")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), text_key("doc_id", "text").alias("_key"))
    return keyed.join(leaks, F.expr("_key = _leak"), "left_anti").select("row.*")
