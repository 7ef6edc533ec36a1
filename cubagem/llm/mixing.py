"""Mix sources to target weights by repeating and sampling documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import WORD, written
from cubagem.llm.sharding import running_totals

#: A source may be repeated this often at most.
MAX_RATE = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """(source, source_size, target, rate) from rows with source and size, written.

    Sources by code point, null last, take the weights in turn. They share all sizes by weight,
    but none gets more than 3 times its own size; what it can't take is shared among the others by
    weight until none is above its bound. That ends where all open sources have the same target
    per weight, so sources fill up in order of bound per weight, and prefix sums in that order
    tell the first that stays open. A source without words has target and rate 0.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    counted = sources.select("*", F.col("source").isNull().alias("last"), F.lit(1).cast("long").alias("n"))
    ranked = running_totals(counted, ["last", "source"], ["n"], "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("n_before") % len(weights) + 1).cast("int"))
    weighed = ranked.select(
        "source", "last", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * MAX_RATE).alias("bound")
    ).withColumn("fills_at", F.col("bound") / F.col("weight"))
    order = ["fills_at", "last", "source"]
    summed = running_totals(weighed, order, ["bound", "weight", "source_size"], "bounds")
    # What is left once all earlier sources are full, and the weight that shares it.
    rest = F.col("source_size_total") - F.col("bound_before")
    sharing = F.col("weight_total") - F.col("weight_before")
    first_open = summed.where(rest / sharing <= F.col("fills_at")).orderBy(*order).limit(1)
    level = first_open.select(F.struct(rest.cast("double").alias("rest"), sharing.alias("sharing")).alias("level")).scalar()
    shared = F.col("level.rest") * F.col("weight") / F.col("level.sharing")
    target = F.least(F.col("bound").cast("double"), shared)
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(MAX_RATE)))).otherwise(F.lit(0.0))
    levelled = summed.withColumn("level", level)
    return written(levelled.select("source", "source_size", target.alias("target"), rate.alias("rate")), "rates")


def hashed_fraction(key: str, seed: str) -> Column:
    """A number from 0 to below 1 that only the key and the seed decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of all documents, written as it is used more than once."""
    return written(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "sizes")


def with_copies(rows: DataFrame, rates: DataFrame, seed: str) -> DataFrame:
    """Join rows that have doc_id and source with their source's rates, and add ``copies``.

    The rates are a written table with one row per source, so Spark knows its size and broadcasts
    it if it is small; else it joins by source and splits a large one.
    """
    joined = rows.alias("d").join(rates.alias("r"), F.expr("d.source <=> r.source"))
    copies = F.floor("r.rate") + (hashed_fraction("d.doc_id", seed) < F.col("r.rate") - F.floor("r.rate")).cast("long")
    return joined.select("d.*", "r.source_size", "r.target", copies.alias("copies"))


def mixture(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of each document.

    ``copies`` is floor(rate), plus one if a fraction hashed from doc_id and seed lies below the
    rest of the rate; a rate is target by size of the source, never above 3. Null texts have size
    0. Null sources are one source. Repeated rows count each, and draw alike, as do all null
    doc_ids. An empty table gives no rows. Other columns are ignored.
    """
    sizes = document_sizes(docs)
    return with_copies(sizes, source_rates(sizes), seed)


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The documents as the mix takes them: each row ``copies`` times, with all its columns."""
    rates = source_rates(document_sizes(docs))
    rows = docs.select("doc_id", "source", F.struct(*docs.columns).alias("row"))
    taken = with_copies(rows, rates, seed)
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")
