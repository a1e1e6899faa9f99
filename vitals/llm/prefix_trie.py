"""The prefix trie of conversations: which first turns they share, and what sharing them would save.

A prefix is known by a 128-bit digest: the exclusive or, over its turns, of hashes of (place, role, text),
so a prefix and its parent differ by one turn's hash and running digests can be cut into chunks. Prefixes
are counted in a count-min sketch, of which tasks make parts that are merged stripe by stripe. Its estimate
is never too low: where it says one, a single conversation has the prefix, and so all deeper ones; these
tails are emitted where they are. Only prefixes that may be shared are shuffled and grouped exactly. The
sketch has four rows of at most ``MOST_CELLS`` counters, as a bitmap 2 MB; beyond some millions of prefixes
its estimates rise, more prefixes take the exact way, and the result is the same.

Sums over subtrees need no walk over the trie. A node belongs to its smallest member, which has all of the
node's ancestors among its own prefixes, and a conversation's own nodes are the last of its path. So the
saving below a node is that of its owner's nodes from there on, plus all that the other members own; leaves
are counted alike. Each is one grouping of the possibly shared prefixes.

A conversation may hold a third of all turns: turns are numbered within range partitions and per
conversation across them, and all that runs along a conversation is cut into chunks of ``CHUNK`` turns. A
prefix may be shared by a third of all conversations: groupings combine on the map side; parents with more than
1/1,024 of all children, so 1,024 at most, are broadcast to these; the ids that end in a node are hashed in order
from pieces of up to 4,096, which range partitions prepare, so no task holds a node's list.

Rows without conversation id belong to no conversation. Turns are ordered by number, null first; turns of equal
number by role, then by a hash of role and text; rows alike in all are turns of their own. Null roles and texts are
empty, whatever their length texts are hashed whole. An empty table has no nodes, not even a root. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .exchange import pack, unpack

CHUNK = 10_000
#: Counters in a row of the sketch at most; rows; counters in a stripe.
MOST_CELLS, ROWS, STRIPE = 1 << 22, 4, 1 << 16
PIECE = 4_096
HEAVY = 1_024


def number_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, place, a, b, chars): turns numbered from 1, a digest of role and text, code points of the text."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
        F.length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "a", "b", "tie"]
    dealt = stored(
        turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "conversation-turns"
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = dealt.groupBy("conv", "part").count().withColumn("begin", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    placed = dealt.withColumn("within", within).join(begun.drop("count"), ["conv", "part"])
    return stored(placed.select("conv", (F.col("begin") + F.col("within")).alias("place"), "a", "b", "chars"), "numbered-turns")


def share_heads(turns: DataFrame, every: int, most: int, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another: (turns, ids), ids with those left without turns.

    The first h turns of conversation c give way to the first h of c - c % every (fewer if it has fewer, none
    if it is absent), where h = crc32(decimal c) % (most + 1).
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    first = turns.filter((F.col("conv") % every == 0) & (F.col("place") <= most))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "a", "b", "chars"))).alias("head"))
    ids = turns.groupBy("conv").agg(F.max("place").alias("n"))
    planned = (
        ids.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % every).join(heads, "base", "left")
        .withColumn("head", F.coalesce(F.expr("slice(head, 1, int(h))"), F.expr("cast(array() AS array<struct<place:bigint,a:bigint,b:bigint,chars:bigint>>)")))
    )
    planned = stored(planned.select("conv", "n", "h", "head"), "conversation-heads")
    chunks = planned.select("conv", "h", F.size("head").alias("m"), F.explode(F.sequence(F.lit(0), F.expr("(n - 1) div " + str(chunk)))).alias("chunk"))
    own = (
        turns.withColumn("chunk", F.expr(f"(place - 1) div {chunk}")).join(chunks, ["conv", "chunk"])
        .filter("place > h").select("conv", (F.col("m") + F.col("place") - F.col("h")).alias("place"), "a", "b", "chars")
    )
    given = planned.select("conv", F.explode("head").alias("t")).select("conv", "t.*")
    return stored(own.unionByName(given), "rebuilt-turns"), planned.select("conv")


# --- the sketch ------------------------------------------------------------------------------------


def _cells(x: np.ndarray, y: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Of each prefix its counter in every row of the sketch; the digest's halves give all of them."""
    x, y = x.view(np.uint64), y.view(np.uint64) | np.uint64(1)
    for row in range(ROWS):
        yield (((x + np.uint64(row) * y) >> np.uint64(20)) % np.uint64(width)).astype(np.int64) + row * width


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _counters(prefixes: DataFrame, width: int) -> DataFrame:
    """(stripe, part, counts) of each task's prefixes; counts stop at two."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ROWS * width, np.uint8)
        for batch in batches:
            for cells in _cells(*_numbers(batch, "x", "y"), width):
                cell, n = np.unique(cells, return_counts=True)
                counts[cell] = np.minimum(counts[cell] + np.minimum(n, 2), 2)
        for stripe in range(0, len(counts), STRIPE):
            part = counts[stripe : stripe + STRIPE]
            if part.any():
                yield _stripe(stripe // STRIPE, part)

    return prefixes.select("x", "y").mapInArrow(work, "stripe int, counts binary").withColumn("part", F.spark_partition_id() % 32)


def _stripe(number: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pack(counts)])], names=["stripe", "counts"])


def _merged(counters: DataFrame, *keys: str) -> DataFrame:
    """Counters of equal keys added up, one after the other."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                counts = unpack(row["counts"], np.uint8)
                if key == last:
                    held = np.minimum(held + counts, 2)
                    continue
                if last is not None:
                    yield _stripe(last[0], held)
                last, held = key, counts
        if last is not None:
            yield _stripe(last[0], held)

    return counters.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, "stripe int, counts binary")


def screened(prefixes: DataFrame, width: int) -> DataFrame:
    """The prefixes with ``alone`` and ``parent_alone``: the sketch proves that one conversation has them."""
    spark = prefixes.sparkSession
    crowded = np.zeros(ROWS * width, bool)
    for row in _merged(_merged(_counters(prefixes, width), "stripe", "part"), "stripe").collect():
        counts = unpack(bytes(row.counts), np.uint8)
        crowded[row.stripe * STRIPE : row.stripe * STRIPE + len(counts)] = counts > 1
    shared = spark.sparkContext.broadcast(np.packbits(crowded))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def alone(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            proven = np.zeros(len(x), bool)
            for cells in _cells(x, y, width):
                proven |= (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 0
            return proven

        for batch in batches:
            x, y, px, py, depth = _numbers(batch, "x", "y", "px", "py", "depth")
            flags = [alone(x, y), alone(px, py) & (depth > 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, flags)], names=[*batch.schema.names, "alone", "parent_alone"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return prefixes.mapInArrow(work, f"{kinds}, alone boolean, parent_alone boolean")


# --- the trie --------------------------------------------------------------------------------------


def _prefixes(turns: DataFrame, chunk: int) -> DataFrame:
    """(conv, depth, x, y, px, py, chars, last): every prefix of every conversation, and its parent's digest."""
    items = turns.select(
        "conv", F.col("place").alias("depth"), F.expr(f"(place - 1) div {chunk}").alias("chunk"), "chars",
        F.xxhash64("place", "a", "b").alias("ix"), F.xxhash64("b", "place", "a").alias("iy"),
    )
    along = Window.partitionBy("conv").orderBy("chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    chunks = items.groupBy("conv", "chunk").agg(F.bit_xor("ix").alias("cx"), F.bit_xor("iy").alias("cy"), F.max("depth").alias("most"))
    chunks = chunks.select(
        "conv", "chunk", F.coalesce(F.bit_xor("cx").over(earlier), F.lit(0)).alias("bx"),
        F.coalesce(F.bit_xor("cy").over(earlier), F.lit(0)).alias("by"),
        F.max("most").over(Window.partitionBy("conv")).alias("most"),
    )
    upto = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = items.withColumn("sx", F.bit_xor("ix").over(upto)).withColumn("sy", F.bit_xor("iy").over(upto))
    x, y = F.col("sx").bitwiseXOR(F.col("bx")), F.col("sy").bitwiseXOR(F.col("by"))
    return run.join(chunks, ["conv", "chunk"]).select(
        "conv", "depth", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("ix")).alias("px"),
        y.bitwiseXOR(F.col("iy")).alias("py"), "chars", (F.col("depth") == F.col("most")).alias("last"),
    )


def _ends_hash(ends: DataFrame) -> DataFrame:
    """(x, y, depth, ends_sha256) of (x, y, depth, conv): hash of each node's ids, ascending, comma-joined."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, depth, conv = _numbers(batch, "x", "y", "depth", "conv")
            new = np.diff(x, prepend=0) != 0
            new |= np.diff(y, prepend=0) != 0
            new[:1] = True
            first = np.flatnonzero(new)
            first = np.unique(np.concatenate([first, *[np.arange(a, z, PIECE) for a, z in zip(first, [*first[1:], len(x)])]]))
            texts = [",".join(map(str, conv[a:z].tolist())) for a, z in zip(first, [*first[1:], len(x)])]
            yield pa.RecordBatch.from_arrays([pa.array(v[first]) for v in (x, y, depth, conv)] + [pa.array(texts, pa.string())], names=["x", "y", "depth", "conv", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def row() -> pa.RecordBatch:
            values = [*last, state.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["x", "y", "depth", "ends_sha256"])

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["x"], r["y"], r["depth"])
                if key == last:
                    state.update(b",")
                else:
                    if last is not None:
                        yield row()
                    last, state = key, hashlib.sha256()
                state.update(r["ids"].encode())
        if last is not None:
            yield row()

    node = "x bigint, y bigint, depth bigint"
    order = ["x", "y", "conv"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, f"{node}, conv bigint, ids string")
    return pieces.repartition("x", "y").sortWithinPartitions(*order).mapInArrow(hashed, f"{node}, ends_sha256 string")


def _with_parents(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """The children with ``parent_conv_id``, null where the parent is none of the nodes."""
    total = nodes.agg(F.sum("n_children")).first()[0] or 0
    parents = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("parent_conv_id"), "n_children")
    least = max(1, -(-total // HEAVY))
    heavy = parents.filter(F.col("n_children") >= least).drop("n_children")
    told = children.join(F.broadcast(heavy), ["px", "py"], "left")
    rest = told.filter("parent_conv_id IS NULL").drop("parent_conv_id")
    light = parents.filter(F.col("n_children") < least).drop("n_children")
    return told.filter("parent_conv_id IS NOT NULL").unionByName(rest.join(light, ["px", "py"], "left"))


def trie(turns: DataFrame, ids: DataFrame, chunk: int = CHUNK, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node, from turns (conv, place, a, b, chars) and the distinct ids of all conversations.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    count, root_conv = ids.agg(F.count("conv"), F.min("conv")).first()
    prefixes = stored(_prefixes(turns, chunk), "prefixes")
    width = min(most_cells, 1 << max(10, (2 * prefixes.count()).bit_length()))
    known = stored(screened(prefixes, width), "screened-prefixes")
    shared, tails = known.filter("NOT alone"), known.filter("alone")

    grouped = shared.groupBy("x", "y", "depth").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("px").alias("px"), F.max("py").alias("py"), F.max("chars").alias("chars")
    )
    grouped = stored(grouped, "shared-prefixes")
    tops = tails.filter("NOT parent_alone")
    edges = grouped.select("px", "py", "depth").unionByName(tops.select("px", "py", "depth"))
    children = edges.groupBy(F.col("px").alias("x"), F.col("py").alias("y"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    root_children = children.filter("depth = 0").agg(F.sum("n_children")).first()[0] or 0
    nodes = grouped.join(children, ["x", "y", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = stored(nodes, "shared-nodes")

    # What each conversation owns: the first depth, the deepest (its end), the weight, and whether it ends in a leaf.
    owned = nodes.select("conv", "depth", "weight", (F.col("n_children") == 0).alias("leaf"))
    owned = owned.unionByName(tails.filter("last").select("conv", "depth", F.lit(0).cast("bigint").alias("weight"), F.lit(True).alias("leaf")))
    owners = stored(
        owned.groupBy("conv").agg(F.min("depth").alias("first"), F.max("depth").alias("end"), F.sum("weight").alias("owned"), F.max("leaf").alias("leaf")),
        "owners",
    )
    chunk_of = F.expr(f"(depth - 1) div {chunk}")
    spread = owners.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(end - 1) div {chunk}"))))
    below = (
        shared.select("conv", "depth", "x", "y", chunk_of.alias("chunk")).join(spread, ["conv", "chunk"])
        .groupBy("x", "y", "depth")
        .agg(F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"), F.sum(F.when(F.col("depth") < F.col("first"), F.col("owned")).otherwise(0)).alias("others"))
    )
    cut = nodes.withColumn("chunk", chunk_of)
    later = Window.partitionBy("conv").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    after = cut.groupBy("conv", "chunk").agg(F.sum("weight").alias("w")).select("conv", "chunk", F.coalesce(F.sum("w").over(later), F.lit(0)).alias("after"))
    onward = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    weighed = cut.withColumn("own", F.sum("weight").over(onward)).join(after, ["conv", "chunk"])

    turnless = ids.join(prefixes.filter("depth = 1").select("conv"), "conv", "left_anti")
    zero = F.lit(0).cast("bigint")
    ends = shared.filter("last").select("x", "y", "depth", "conv").unionByName(
        turnless.select(zero.alias("x"), zero.alias("y"), zero.alias("depth"), "conv")
    )
    ends = stored(_ends_hash(ends), "node-ends")

    no_ends = F.sha2(F.lit(""), 256)
    exact = weighed.join(below, ["x", "y", "depth"], "left").join(ends, ["x", "y", "depth"], "left").select(
        "conv", "depth", "px", "py", F.lit(False).alias("parent_alone"), "n_convs", "n_children",
        F.coalesce("n_leaves", zero).alias("n_leaves"),
        (F.col("own") + F.col("after") + F.coalesce("others", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", no_ends).alias("ends_sha256"),
    )
    local = tails.select(
        "conv", "depth", "px", "py", "parent_alone", F.lit(1).cast("bigint").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(no_ends).alias("ends_sha256"),
    )
    # The parent of a tail's further nodes is the tail itself; so is one that is not among the grouped nodes.
    joined = exact.unionByName(local.filter("NOT parent_alone"))
    joined = _with_parents(joined.filter("depth > 1"), nodes).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv"))
    top = exact.unionByName(local).filter("depth = 1").withColumn("parent_conv_id", F.lit(root_conv).cast("bigint"))
    tail = local.filter("parent_alone").withColumn("parent_conv_id", F.col("conv"))

    leaves, saved = owners.agg(F.sum(F.col("leaf").cast("bigint")), F.sum("owned")).first()
    root_ends = ends.filter("depth = 0").select("ends_sha256").first()
    root = spark.range(1 if count else 0).select(
        F.lit(root_conv).cast("bigint").alias("conv"), zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(count).cast("bigint").alias("n_convs"), F.lit(root_children).cast("bigint").alias("n_children"),
        F.lit(leaves or 1).cast("bigint").alias("n_leaves"), F.lit(saved or 0).cast("bigint").alias("saved_tokens"),
        F.lit(root_ends[0]).alias("ends_sha256") if root_ends else no_ends.alias("ends_sha256"),
    )
    parts = [f.select(*root.columns) for f in (joined, top, tail)]
    return root.unionByName(parts[0]).unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("conv", "conv_id")

