"""Contiguous shards of nearly equal bytes, from prefix sums over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubagem.llm.common import width, written

ROW = "_row"


def running_totals(df: DataFrame, order: list[str], amounts: list[str], purpose: str) -> DataFrame:
    """Add ``<amount>_before`` and ``<amount>_total`` for each amount, over all rows in order.

    Rows are ranged by the order and written, so every later step sees the same ranges. A range
    has one total; the totals of earlier ranges and the rows before it in its own range add up to
    a row's prefix. Only the totals, one row per range, meet in one task. Equal rows are told
    apart by a row number, so that even they can be split over ranges.
    """
    spark = df.sparkSession
    keys = [*order, ROW]
    ranged = written(
        df.withColumn(ROW, F.monotonically_increasing_id())
        .repartitionByRange(width(spark), *keys)
        .withColumn("_range", F.spark_partition_id()),
        purpose,
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = ranged.groupBy("_range").agg(*(F.sum(a).alias(a) for a in amounts))
    offsets = totals.select(
        "_range",
        *(F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"{a}_offset") for a in amounts),
        *(F.sum(a).over(everything).alias(f"{a}_total") for a in amounts),
    )
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *(F.coalesce(F.sum(a).over(within), F.lit(0)).alias(f"{a}_within") for a in amounts))
    joined = local.join(offsets, "_range")
    return joined.select(
        *df.columns,
        "_range",
        *((F.col(f"{a}_offset") + F.col(f"{a}_within")).alias(f"{a}_before") for a in amounts),
        *(f"{a}_total" for a in amounts),
    )


def shard_by_bytes(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Cut the documents, in order of doc_id, into shards of nearly equal bytes.

    The bytes before a document decide its shard: shard k begins at k/n of all bytes, so a shard
    differs from the target by less than one document. ``slot`` numbers a shard's documents
    from 0. The size is the UTF-8 length plus 1; null text counts as empty, and its checksum is
    that of the empty text. A null doc_id comes first; equal doc_ids are ordered by checksum and
    size, and repeated rows all stay. An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(1).cast("long").alias("rows"),
    )
    placed = running_totals(sizes, ["doc_id", "text_crc32", "size"], ["size", "rows"], "shards")
    placed = placed.withColumn("shard", F.expr(f"int(size_before * {n_shards} div size_total)"))
    # A shard's first row is found range by range, as a shard can hold any share of the rows.
    pieces = placed.groupBy("_range", "shard").agg(F.min("rows_before").alias("begin"))
    begins = pieces.select("_range", "shard", F.min("begin").over(Window.partitionBy("shard")).alias("begin"))
    return placed.join(begins, ["_range", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rows_before") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
