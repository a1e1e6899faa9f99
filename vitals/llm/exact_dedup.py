"""Exact de-duplication with a split for heavy hitters.

Texts are equal when they are identical after every run of white space is replaced by one space; a
null text counts as empty, so null and empty texts form one group, and a group of blank texts another.
Of equal texts the row with the smallest key stays; of rows that repeat a key, one of them. Null keys
come last: such a row stays only where no row of its group has a key, and its group then has a null
``keep_id``. An empty table gives an empty result; columns other than key and text are not read.

A Misra-Gries summary of bounded size finds the digests that may be frequent. Exact counts verify
them; the winners (at most ``slots`` rows) are broadcast, and their copies are decided on the map
side. All other digests, each with fewer than one row in ``slots``, take an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, stored, without

#: Counters of a summary; bounds the broadcast table to as many rows of about 100 bytes.
SLOTS = 1024


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", " ")
    return documents.select(F.col(key).alias("id"), F.unhex(F.sha2(normal, 256)).alias("digest"))


def _cut(counters: dict[bytes, int], slots: int) -> dict[bytes, int]:
    """Lower all counters by the one that has no slot, and keep what is left."""
    if len(counters) <= slots:
        return counters
    counts = np.fromiter(counters.values(), np.int64, len(counters))
    lowered = int(np.partition(counts, len(counts) - slots - 1)[len(counts) - slots - 1])
    return {k: n - lowered for k, n in counters.items() if n > lowered}


def _summaries(slots: int):
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counters[digest] = counters.get(digest, 0) + n
            counters = _cut(counters, slots)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(counters.keys(), pa.binary()), "n": pa.array(counters.values(), pa.int64())}
        )

    return summarize


def heavy_hitters(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Digests held by more than one row in ``slots + 1``, with exact size and first row.

    The summaries of all partitions add up to one; what the sum has beyond the slots is cut from it,
    which keeps the guarantee of a single summary. At most ``slots`` candidates reach the driver.
    """
    spark = rows.sparkSession
    summed = (
        rows.select("digest").mapInArrow(_summaries(slots), "digest binary, n bigint")
        .groupBy("digest").agg(F.sum("n").alias("n"))
    )
    top = summed.orderBy(F.desc("n"), "digest").limit(slots + 1).collect()
    kept = _cut({bytes(r["digest"]): r["n"] for r in top}, slots)
    candidates = spark.createDataFrame([(bytearray(d),) for d in kept], "digest binary")
    total = rows.count()
    exact = (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(_first_row().alias("first"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") * (slots + 1) > total)
    )
    return stored(exact, "heavy-digests")


def _first_row():
    # Null keys last; the row number settles rows that repeat a key.
    return F.min(F.struct(F.col("id").isNull(), "id", "row"))


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per row of ``documents``: key, keep_id, group_size, kept, text_sha256."""
    rows = stored(digests(documents, key, text).withColumn("row", F.monotonically_increasing_id()), "digests")
    winners = heavy_hitters(rows, slots)
    frequent = rows.join(F.broadcast(winners), "digest")
    others = Window.partitionBy("digest")
    rare = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("first", _first_row().over(others))
        .withColumn("group_size", F.count("*").over(others))
    )
    return frequent.unionByName(rare).select(
        F.col("id").alias(key),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """The documents that stay, with all their columns."""
    decided = stored(classes(documents, key, text, slots), "exact-classes")
    by_key = (
        decided.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("rows"), F.count_if("kept").alias("rows_kept"))
    )
    dropped = stored(by_key.filter("rows_kept = 0").select(key), "exact-dropped")
    left = without(documents, dropped, key)
    # A key that stays in one row and goes in another repeats; its rows are told apart by text.
    mixed = stored(by_key.filter("rows_kept > 0 AND rows > rows_kept").select(key), "exact-mixed")
    nameless = decided.filter(F.col(key).isNull())
    if mixed.isEmpty() and nameless.isEmpty():
        return left
    told = F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", " "), 256))
    marked = left.select(F.struct(*[f"`{c}`" for c in left.columns]).alias("doc"), F.col(key).alias("id"), told.alias("digest"))
    twice = marked.join(mixed.select(F.col(key).alias("id")), "id", "left_semi").unionByName(
        marked.filter("id IS NULL").select("id", "doc", "digest")
    )
    stay = decided.filter("kept").select(F.col(key).alias("id"), F.unhex("text_sha256").alias("digest"))
    one = (
        twice.withColumn("n", F.row_number().over(Window.partitionBy("id", "digest").orderBy(F.xxhash64("doc"))))
        .filter("n = 1")
        .alias("t")
        .join(stay.alias("s"), F.expr("t.id <=> s.id AND t.digest = s.digest"), "left_semi")
    )
    rest = marked.filter("id IS NOT NULL").join(mixed.select(F.col(key).alias("id")), "id", "left_anti")
    return rest.select("doc.*").unionByName(one.select("doc.*"))
