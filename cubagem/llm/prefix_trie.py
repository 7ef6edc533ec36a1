"""Prefix trie of conversations, found by blocks of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubagem.llm.common import width, written

#: Turns of a block.
BLOCK = 4
#: Blocks, or nodes, of one conversation that are summed by one task before the slices are.
SLICE = 1024
#: A node with more than this part of all branches below it is joined by broadcast; so at most as many are.
HOT = 1000
#: Text of ids that travels as one row where the ids of a node lie in several partitions.
CHUNK = 16 << 10

KEY = ["depth", "x1", "x2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

PLACED = "part int, conv bigint, nth bigint, digest string, n_bytes bigint"
ENDS = "depth bigint, x1 bigint, x2 bigint, ends_sha256 string, part int, seq int, ids string"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv, nth, digest, n_bytes) of turns given as (conv_id, turn, role, text); ``nth`` counts from 1.

    Rows are ranged over the tasks in their order and counted there; a conversation over several tasks goes on
    counting from the totals of the tasks before, one row per task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        F.sha2(text, 256).alias("sha"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = ["conv", "turn", "role", "sha"]
    dealt = rows.repartitionByRange(width(turns.sparkSession), *order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat_ws("\n", "sha", "role"), 256).alias("digest")
    placed = dealt.select(F.spark_partition_id().alias("part"), "conv", F.lit(0).cast("long").alias("nth"), digest, "n_bytes")
    placed = written(placed.mapInArrow(_numbered, PLACED), "turns")
    last = F.max(F.struct("conv", "nth"))
    parts = placed.groupBy("part").agg(F.min("conv").alias("first"), last.alias("last"))
    parts = parts.select("part", "first", "last.conv", F.sum("last.nth").over(Window.partitionBy("last.conv").orderBy("part")).alias("n"))
    # One row per task of the sort above.
    before = Window.orderBy("part")
    follows = F.lag("conv").over(before) == F.col("first")
    offsets = parts.select("part", "first", F.when(follows, F.lag("n").over(before)).otherwise(0).alias("offset"))
    counted = placed.join(F.broadcast(offsets), "part")
    nth = F.col("nth") + F.when(F.col("conv") == F.col("first"), F.col("offset")).otherwise(0)
    return counted.select("conv", nth.alias("nth"), "digest", "n_bytes")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation in sorted rows."""
    current, n = None, 0
    for batch in batches:
        conv = batch.column(1).to_numpy()
        if not len(conv):
            continue
        begins = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        nth = np.arange(1, len(conv) + 1) - np.repeat(begins, np.diff(np.append(begins, len(conv))))
        if conv[0] == current:
            nth[: begins[1] if len(begins) > 1 else len(conv)] += n
        current, n = conv[-1], int(nth[-1])
        yield batch.set_column(2, "nth", pa.array(nth, pa.int64()))


def rebuild(ordered: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, pos, digest, n_bytes): first h turns of conversation c - c % 5, then c's own turns after its first h."""
    length = convs.selectExpr("conv AS base", "least(n, 8) AS n_base")
    shared = convs.withColumn("base", F.expr("conv - conv % 5")).join(length, "base", "left")
    shared = shared.select("conv", F.least(_taken("conv"), F.coalesce("n_base", F.lit(0))).alias("shared"))
    own = ordered.where(F.col("nth") > _taken("conv")).join(shared, "conv")
    own = own.select("conv", (F.col("nth") - _taken("conv") + F.col("shared")).alias("pos"), "digest", "n_bytes")
    first = ordered.where("nth <= 8 AND conv % 5 = 0").selectExpr(
        "conv AS base", "explode(transform(sequence(-4, 4), d -> try_add(conv, CAST(d AS BIGINT)))) AS conv", "nth AS pos", "digest", "n_bytes"
    )
    first = first.where(F.expr("conv - conv % 5 = base") & (F.col("pos") <= _taken("conv")))
    return own.union(first.join(convs, "conv", "left_semi").select("conv", "pos", "digest", "n_bytes"))


def _taken(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % 9


def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks of consecutive turns with keys of the prefixes before and after them.

    A key is the exclusive or of 64-bit hashes of (position, digest), twice, so that the keys of a long
    conversation are summed up by slices of its blocks.
    """
    hashed = rows.select(
        "conv",
        F.expr(f"(pos - 1) div {BLOCK}").alias("k"),
        F.expr(f"(pos - 1) div {BLOCK * SLICE}").alias("slice"),
        F.struct(
            "pos",
            F.xxhash64(F.lit(1), "pos", "digest").alias("x1"),
            F.xxhash64(F.lit(2), "pos", "digest").alias("x2"),
            "n_bytes",
        ).alias("turn"),
    )
    blocks = hashed.groupBy("conv", "slice", "k").agg(
        F.sort_array(F.collect_list("turn")).alias("turns"), *(F.bit_xor(f"turn.x{i}").alias(f"x{i}") for i in (1, 2))
    )
    return _running(blocks, "conv", "k", {"x1": "before1", "x2": "before2"}, F.bit_xor, F.lit(0).cast("long")).selectExpr(
        "conv", "k", "turns", "before1", "before2", "before1 ^ x1 AS after1", "before2 ^ x2 AS after2"
    )


def _running(rows: DataFrame, key: str, order: str, columns: dict[str, str], total, zero: Column) -> DataFrame:
    """Totals of all rows of the key that come before each, by slices first; ``columns`` names them."""
    slices = rows.groupBy(key, "slice").agg(*(total(c).alias(c) for c in columns))
    earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(key, "slice", *(F.coalesce(total(c).over(earlier), zero).alias(f"{c}_slice") for c in columns))
    inside = Window.partitionBy(key, "slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    plus = (lambda a, b: a.bitwiseXOR(b)) if total is F.bit_xor else (lambda a, b: a + b)
    found = rows.select("*", *(F.coalesce(total(c).over(inside), zero).alias(f"{c}_inside") for c in columns))
    found = found.join(slices, [key, "slice"])
    return found.select(*rows.columns, *(plus(F.col(f"{c}_slice"), F.col(f"{c}_inside")).alias(n) for c, n in columns.items()))


def nodes_of(blocks: DataFrame, measures: dict[str, tuple]) -> DataFrame:
    """Nodes below the root with aggregates over their conversations: {name: (aggregate, column)}.

    Equal blocks after equal prefixes are one variant. A variant without siblings is a chain, whose nodes have
    its conversations. Only where variants are siblings are their turns grouped one by one.
    """
    at, after = ["k", "before1", "before2"], ["after1", "after2"]
    first = measures.items()
    variants = blocks.groupBy(*at, *after).agg(*(f(c).alias(n) for n, (f, c) in first), F.first("turns").alias("turns"))
    alone = variants.groupBy(*at).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in after)).where("n = 1")
    variants = written(variants.join(alone.drop("n").withColumn("alone", F.lit(True)), [*at, *after], "left"), "variants")

    def turns(rows: DataFrame) -> DataFrame:
        # At most as many steps as a block has turns.
        xor = "aggregate(slice(turns, 1, i{0}), before{1}, (key, turn) -> key ^ turn.x{1})"
        node = ", ".join(
            [f"k * {BLOCK} + i + 1 AS depth", f"{xor.format(' + 1', 1)} AS x1", f"{xor.format(' + 1', 2)} AS x2"]
            + [f"{xor.format('', 1)} AS p1", f"{xor.format('', 2)} AS p2", "t.n_bytes AS n_bytes"]
        )
        listed = rows.select(F.expr(f"explode(transform(turns, (t, i) -> struct({node})))").alias("node"), *measures)
        return listed.select("node.*", *measures)

    merged = {n: F.sum if f in (F.count, F.sum) else f for n, (f, _) in first}
    refined = turns(variants.where("alone IS NULL")).groupBy(*KEY).agg(
        *(F.first(c).alias(c) for c in ("p1", "p2", "n_bytes")), *(f(n).alias(n) for n, f in merged.items())
    )
    return turns(variants.where("alone")).unionByName(refined)


def build_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; ``turns`` are rows (conv_id, turn, role, text).

    Turns are ordered by turn (null first); ties by role, then by the SHA-256 of the text; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without conv_id take no part, as a node is named by a
    conversation. An empty table gives no nodes. Other columns are ignored. Every conversation c is rebuilt first,
    see ``rebuild``; c % 5 has the sign of c.

    Returned: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Counts come from two groupings of blocks. As conversations only part, the nodes whose smallest member is c are one
    piece at the end of c's path. So a subtree's total is the sum of its members' own pieces, less
    what the smallest member owns above, and nothing goes up the trie step by step.
    """
    ordered = ordered_turns(turns)
    convs = written(ordered.groupBy("conv").agg(F.max("nth").alias("n")), "conversations")
    blocks = written(blocks_of(rebuild(ordered, convs)), "blocks")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.selectExpr("0L AS depth", "0L AS x1", "0L AS x2", "0L AS p1", "0L AS p2", "0L AS n_bytes", "conv", "n_convs")
    members = nodes_of(blocks, {"conv": (F.min, "conv"), "n_convs": (F.count, "conv")})
    nodes = written(root.unionByName(members), "nodes")

    saved = F.expr("(n_convs - 1) * n_bytes")
    nodes = nodes.withColumn("saved", saved).withColumn("slice", F.expr(f"depth div {SLICE}"))
    owners = nodes.groupBy("conv").agg(F.min("depth").alias("top"), F.max("depth").alias("end"), F.sum("saved").alias("owned"))
    nodes = _running(nodes, "conv", "depth", {"saved": "above"}, F.sum, F.lit(0).cast("long")).join(owners, "conv")
    nodes = written(nodes.drop("slice", "saved", "owned"), "owned")

    branches = nodes.where("depth = top AND depth > 0").selectExpr("depth - 1 AS depth", "p1 AS x1", "p2 AS x2", "conv")
    counts = branches.groupBy(*KEY).agg(F.count("*").alias("n_branches"))
    nodes = written(nodes.join(counts, KEY, "left").na.fill(0, ["n_branches"]), "branched")

    leaf = F.max(F.expr("CAST(depth = end AND n_branches = 0 AS BIGINT)")).alias("leaf")
    pieces = nodes.groupBy("conv").agg(leaf, F.sum(saved).alias("owned")).where("leaf > 0 OR owned > 0")
    below = nodes_of(blocks.join(pieces, "conv"), {"n_leaves": (F.sum, "leaf"), "under": (F.sum, "owned")})
    whole = pieces.agg(F.sum("leaf").alias("n_leaves"), F.sum("owned").alias("under"))
    whole = whole.selectExpr("0L AS depth", "0L AS x1", "0L AS x2", "n_leaves", "under")
    below = whole.unionByName(below.select(*KEY, "n_leaves", "under"))

    named = nodes.join(below, KEY).join(_ends(convs, blocks), KEY, "left").join(_parents(nodes), "conv", "left")
    return named.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("top"), F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        (F.col("n_branches") + (F.col("depth") < F.col("end")).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("under") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """(conv, parent): the smallest member of the node from which each conversation's own piece branches off.

    The few nodes with very many branches are broadcast: at most ``HOT`` of them can have so many.
    """
    above = nodes.where("n_branches > 0").select(*KEY, F.col("conv").alias("parent"), "n_branches")
    total = above.agg(F.sum("n_branches").alias("n")).first()["n"] or 0
    many = F.col("n_branches") * HOT > total
    branches = nodes.where("depth = top AND depth > 0").selectExpr("depth - 1 AS depth", "p1 AS x1", "p2 AS x2", "conv")
    found = branches.join(F.broadcast(above.where(many).drop("n_branches")), KEY, "left")
    rest = found.where("parent IS NULL").drop("parent").join(above.where(~many).drop("n_branches"), KEY)
    return found.where("parent IS NOT NULL").select("conv", "parent").union(rest.select("conv", "parent"))


def _ends(convs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): the digest of the ids of all conversations that end at a node.

    Sorted ids are ranged over the tasks. A task hashes what it holds whole; the first and last node of
    each, which may go on elsewhere, and very long lists travel as text and are hashed in order, piece by piece: a
    SHA-256 has no other way than that one task reads a node's ids, but it holds none of them.
    """
    last = blocks.groupBy("conv").agg(F.max(F.struct("k", F.size("turns").alias("size"), "after1", "after2")).alias("last"))
    reached = last.select("conv", F.expr(f"last.k * {BLOCK} + last.size AS depth"), F.col("last.after1").alias("x1"), F.col("last.after2").alias("x2"))
    turnless = convs.join(last, "conv", "left_anti").selectExpr("conv", "0L AS depth", "0L AS x1", "0L AS x2")
    ends = reached.union(turnless)
    dealt = ends.repartitionByRange(width(convs.sparkSession), *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    hashed = dealt.select(*KEY, "conv", F.spark_partition_id().alias("part")).mapInArrow(_id_lists, ENDS)
    hashed = written(hashed, "ends")
    split = hashed.where("ends_sha256 IS NULL").repartition(*KEY).sortWithinPartitions(*KEY, "part", "seq")
    joined = split.mapInArrow(_joined_lists, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    return hashed.where("ends_sha256 IS NOT NULL").select(*KEY, "ends_sha256").union(joined)


def _id_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the id lists that lie within the task for sure; texts of the others."""
    key, ids, size, seq, inner, part, out = None, [], 0, 0, False, 0, []

    def text():
        return (*key, None, part, seq, ",".join(ids))

    for batch in batches:
        for *own, conv, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # noqa: B007
            if own != key:
                if key is not None:
                    whole = inner and seq == 0
                    out.append((*key, hashlib.sha256(",".join(ids).encode()).hexdigest(), part, 0, None) if whole else text())
                    inner = True
                key, ids, size, seq = own, [], 0, 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
            if size >= CHUNK:
                out.append(text())
                ids, size, seq = [], 0, seq + 1
        yield from _batches(out, _ENDS_ARROW)
        out = []
    if key is not None and ids:
        yield from _batches([text()], _ENDS_ARROW)


def _joined_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the texts of each node, in order."""
    key, digest, out = None, None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (0, 1, 2, 6)]
        for *own, ids in zip(*columns, strict=True):
            if own != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest, joint = own, hashlib.sha256(), ""
            if ids:
                digest.update((joint + ids).encode())
                joint = ","
        yield from _batches(out, _JOINED_ARROW)
        out = []
    if key is not None:
        yield from _batches([(*key, digest.hexdigest())], _JOINED_ARROW)


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_JOINED_ARROW = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])
_ENDS_ARROW = pa.schema([*_JOINED_ARROW, pa.field("part", pa.int32()), pa.field("seq", pa.int32()), pa.field("ids", pa.string())])
