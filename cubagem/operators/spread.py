"""Ordinals and ranges computed without ever putting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubagem.session import shuffle_width


def dense_ordinal(
    df: DataFrame, group: list[str], key: str, name: str = "ord", width: int = 1 << 16, parts: int | None = None
) -> DataFrame:
    """Number the rows of each group from 0 in the order of a distinct integer key.

    Rows are ranked inside slices of ``width`` consecutive key values, and each slice
    starts where the ones before it end. A slice holds at most ``width`` rows, and the slices
    of a group are summed by :func:`prefix_sums`, so a group may be arbitrarily large, and
    its keys arbitrarily far apart. Slices are dealt to ``parts`` partitions, if given, which AQE does not merge.
    """
    sliced = df.withColumn("_slice", F.expr(f"`{key}` div {width}"))
    slices = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_rows"))
    starts = prefix_sums(slices, group, "_slice", "_rows", "_start").drop("_rows")
    within = Window.partitionBy(*group, "_slice").orderBy(key)
    dealt = sliced if parts is None else sliced.repartition(parts, *group, "_slice")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    return (
        ranked.join(starts, [*group, "_slice"])
        .withColumn(name, F.col("_start") + F.col("_rank"))
        .drop("_slice", "_start", "_rank")
    )


def prefix_sums(
    df: DataFrame, group: list[str], key: str, value: str, name: str, width: int = 1 << 24
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group that have a smaller key.

    The key is an integer, distinct in its group. Sums run inside slices of ``width`` consecutive keys, and
    over the slices, of which 64 bits have few; so no task goes through a whole group.
    """
    slice_, start = f"{name}_slice", f"{name}_start"
    sliced = df.withColumn(slice_, F.expr(f"`{key}` div {width}"))
    slices = sliced.groupBy(*group, slice_).agg(F.sum(value).alias(start))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.sum(start).over(before.partitionBy(*group).orderBy(slice_))
    slices = slices.withColumn(start, F.coalesce(earlier, F.lit(0).cast("bigint")))
    inside = F.sum(value).over(before.partitionBy(*group, slice_).orderBy(key))
    summed = sliced.withColumn(name, F.coalesce(inside, F.lit(0).cast("bigint")))
    joined = summed.join(slices, [*group, slice_])
    return joined.withColumn(name, F.col(name) + F.col(start)).drop(slice_, start)


def small_ordinal(df: DataFrame, group: list[str], key: str, name: str = "ord") -> DataFrame:
    """Number rows from 0 within groups that one metadata document or calendar bounds."""
    return df.withColumn(
        name, (F.row_number().over(Window.partitionBy(*group).orderBy(key)) - 1).cast("bigint")
    )


def expand_range(
    df: DataFrame,
    count: str,
    name: str,
    keys: list[str],
    block: int = 1 << 14,
) -> DataFrame:
    """One row per number from 0 below ``count``, for each input row.

    A row with a large count is first cut into blocks, and the blocks are dealt to
    all tasks before they are expanded. The partition number is explicit, because
    AQE would merge partitions that are small only until the expansion.
    """
    total = F.col(count).cast("bigint")
    last_block = F.expr(f"(cast(`{count}` as bigint) - 1) div {block}")
    blocks = df.where(total > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block))
    )
    blocks = blocks.repartition(shuffle_width(df.sparkSession), *keys, "_block")
    first = F.col("_block") * block
    last = F.least(first + block, total) - 1
    return blocks.withColumn(name, F.explode(F.sequence(first, last))).drop("_block")
