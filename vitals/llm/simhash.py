"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it. Fingerprints
that differ in at most ``radius`` bits are linked, and the links' connected components are the groups.

Distinct fingerprints are dealt into tiles by the population counts of their four 16-bit parts. Two
fingerprints within the radius have counts whose differences add up to the radius at most, so tiles
whose counts differ more are skipped; all other pairs of tiles are compared whole, by exclusive or and
bit counts in numpy. A tile holds about ``TILE`` fingerprints at most; full counts have several. Each
comparison returns a spanning forest of its links, so a group of n fingerprints gives some n rows, not
n squared, and no link between different fingerprints is lost. Components grow by alternating
star contractions whose rounds are tables in the shared folder.

Null and empty texts, and texts without words, have fingerprint zero, which links like any other. Rows
with equal texts share a fingerprint and a component; ties cannot arise, as a component is named by its
smallest key. A null key joins its component but never names one; a component without keys has a null
name. An empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import digested, one_of_each, row_digest, stored

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 4096
_PARTS = 4
_BASE = 32
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    # Where each word begins; a shingle ends one space before a later word begins.
    begins = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    ends = begins[min(shingle, len(words)) :]
    hash64 = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for start in range(0, len(ends), 1 << 16):
        stop = start + (1 << 16)
        hashes = np.array(
            [hash64(joined[b : e - 1], SEED) for b, e in zip(begins[start:stop], ends[start:stop])], dtype="<u8"
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    majority = (2 * votes > len(ends)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, row: Column | None = None
) -> DataFrame:
    """(id, fp) of each row, and ``row`` where it is given; the fingerprint as a signed 64-bit integer."""
    slim = documents.select(
        F.col(key).alias("id"), F.col(text).alias("text"), *([] if row is None else [row.alias("row")])
    )
    carried = [f for f in slim.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried) + ", fp bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                prints = [fingerprint(t or "", shingle) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], pa.array(prints, pa.int64())],
                    names=[*(f.name for f in carried), "fp"],
                )

    return slim.mapInArrow(work, schema)


def _forest(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels of the components after the links (a, b) are added; a label is the smallest index."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while not np.array_equal(up := labels[labels], labels):
            labels = up
    return labels


def compare(own: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``own`` and between ``own`` and ``others``."""
    everything = np.concatenate([own, others])
    labels = np.arange(len(everything))
    for row in range(0, len(own), 64):
        mine = own[row : row + 64, None]
        # A fingerprint of the own tile is compared with the later ones.
        for column in range(row, len(everything), 1 << 14):
            near = np.bitwise_count(mine ^ everything[None, column : column + (1 << 14)]) <= radius
            a, b = np.nonzero(near)
            labels = _forest(len(everything), a + row, b + column, labels)
    linked = np.nonzero(labels != np.arange(len(labels)))[0]
    return everything[linked], everything[labels[linked]]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fp`` within the radius."""
    part = lambda i: F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF))
    code = sum((part(i).cast("int") * _BASE**i for i in range(_PARTS)), F.lit(0))
    coded = prints.select("fp", code.alias("code"))
    # At most 17 ** 4 = 83,521 rows: the possible population counts.
    directory = stored(
        coded.groupBy("code").agg(F.ceil(F.count("*") / tile).cast("int").alias("subs")), "simhash-tiles"
    )
    tiles = (
        coded.join(F.broadcast(directory), "code")
        .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
        .groupBy("code", "sub")
        .agg(F.collect_list("fp").alias("fps"))
    )
    # Each pair of tiles meets once: a tile goes to those whose counts are equal or later in order.
    steps = [
        sum(d * _BASE**i for i, d in enumerate(ds))
        for ds in itertools.product(range(-radius, radius + 1), repeat=_PARTS)
        if sum(map(abs, ds)) <= radius and (ds == (0,) * _PARTS or next(d for d in reversed(ds) if d) > 0)
    ]
    near = F.broadcast(directory.select(F.col("code").alias("to"), F.col("subs").alias("to_subs")))
    sent = (
        tiles.select("code", "sub", "fps", F.explode(F.transform(F.lit(steps), lambda s: F.col("code") + s)).alias("to"))
        .join(near, "to")
        .select("code", "sub", "fps", "to", F.explode(F.sequence(F.lit(0), F.col("to_subs") - 1)).alias("to_sub"))
        .filter("code <> to OR sub <= to_sub")
    )
    # The own tile meets its visitors in several groups, each with a copy of the own tile, so that a
    # group holds some 40 tiles however many there are.
    groups = 4 * (directory.agg(F.max("subs")).first()[0] or 1)
    visit = F.pmod(F.xxhash64("code", "sub"), F.lit(groups))
    is_own = (F.col("code") == F.col("to")) & (F.col("sub") == F.col("to_sub"))
    dealt = sent.select(
        "to", "to_sub", is_own.alias("own"), "fps",
        F.explode(F.when(is_own, F.sequence(F.lit(0), F.lit(groups - 1))).otherwise(F.array(visit.cast("int")))).alias("visit"),
    )

    def meet(table: pa.Table) -> pa.Table:
        own, others = [], []
        for mine, fps in zip(table.column("own").to_pylist(), table.column("fps").combine_chunks(), strict=True):
            (own if mine else others).append(fps.values.to_numpy(zero_copy_only=False))
        join = lambda parts: np.concatenate(parts).view(np.uint64) if parts else np.empty(0, np.uint64)
        a, b = compare(join(own), join(others), radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.groupBy("to", "to_sub", "visit").applyInArrow(meet, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), the root being its component's smallest node.

    Alternates two contractions: a node's larger neighbours are linked to its smallest neighbour, then
    its smaller ones are. The number of rounds grows with the logarithm of the longest chain.
    """
    either = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current, mark = stored(edges.filter("a <> b").distinct(), "components"), None
    while True:
        both = either(current)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stored(
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct(),
            "components",
        )
        downward = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = downward.groupBy("a").agg(F.min("b").alias("m"))
        linked = downward.join(least, "a")
        current = stored(
            linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct(),
            "components",
        )
        row = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(row)


def rooted(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, first, root) of the distinct fingerprints of (id, fp): the smallest key, and the component's root."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id, n_linked (other fingerprints of the component)."""
    prints = stored(fingerprints(documents, key, text, shingle), "simhash-prints")
    member = rooted(prints, radius)
    whole = member.groupBy("root").agg(F.min("first").alias("component_id"), (F.count("*") - 1).alias("n_linked"))
    named = stored(member.join(whole, "root").select("fp", "component_id", "n_linked"), "simhash-components")
    return prints.join(named, "fp").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_linked"
    )


def keep_first(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One document of each group, that with the smallest key, with all columns; a null key is the largest.

    Of rows that share the smallest key one stays, the first by a digest of the row. Decisions are joined back
    by that digest, so a key that other groups have too does no harm.
    """
    row = row_digest(documents)
    prints = stored(fingerprints(documents, key, text, shingle, row), "simhash-prints")
    member = stored(rooted(prints, radius).select("fp", "root"), "simhash-components")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = prints.groupBy("fp").agg(F.min(order).alias("least")).join(member, "fp")
    kept = stored(first.groupBy("root").agg(F.min("least")["row"].alias("kept")), "simhash-kept")
    keepers = member.join(kept, "root").select("fp", "kept")
    found = prints.join(keepers, "fp")
    dropped = stored(found.filter(F.col("row") != F.col("kept")).select("row").distinct(), "simhash-dropped")
    repeated = stored(prints.groupBy("row").count().filter("count > 1").select("row"), "simhash-repeated")
    left = digested(documents, row).join(dropped, "row", "left_anti")
    return one_of_each(left, repeated).select("doc.*")
