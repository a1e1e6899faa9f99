"""Chunks of whole texts, and questions that chunks ask all others about 64-bit keys.

A chunk is one row with many texts, compressed. ``ask`` turns each chunk into sorted, distinct keys with
columns of small numbers; the keys go, packed, to buckets by their leading bits; a bucket is sorted and
answered as a whole, one bucket at a time; every chunk gets its answers back in the order of its keys. A
key that is in every chunk reaches its bucket once per chunk, however often the chunk holds it, so no
bucket grows with the frequency of a key. The number of buckets grows with the input.

Chunks lie in files in the shared folder, bucketed by chunk, so that joining the answers to them does not move
the texts. There is a file, and a task of each step, for every ``TASK_BYTES`` of text, up to the most buckets that
Spark takes; a task holds one chunk at a time, whatever its share. What a chunk asks depends on its row only; a lost
task asks the same again.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, utf8

#: Bytes of text in a chunk, and of text per bucket.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20
#: Bytes of text per file of chunks.
TASK_BYTES = 16 << 20


@functools.cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def pack(array: np.ndarray) -> bytes:
    """An array by planes of its bytes, compressed: small numbers and small differences take little room."""
    raw = np.ascontiguousarray(array)
    planes = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T
    return len(raw).to_bytes(4, "little") + _codec().compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    n, kind = int.from_bytes(data[:4], "little"), np.dtype(dtype)
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(_codec().decompress(data[4:], n * kind.itemsize, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences."""
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(data: bytes, dtype: str) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)


class Chunk:
    """The texts of a chunk: ``data`` holds their bytes one after the other, ``offsets`` where they begin."""

    def __init__(self, number: int, keys: list, data: np.ndarray, offsets: np.ndarray):
        self.number, self.keys, self.data, self.offsets = number, keys, data, offsets

    @classmethod
    def of(cls, row: dict) -> Chunk:
        sizes = np.array(row["sizes"], np.int64)
        raw = _codec().decompress(row["texts"], int(sizes.sum()), asbytes=True) if sizes.sum() else b""
        return cls(row["chunk"], row["keys"], np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(sizes)]))


def chunk_texts(
    documents: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """The chunks (chunk, keys, sizes, texts) in bucketed files in the shared folder; null texts are empty."""
    spark = documents.sparkSession
    slim = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, sizes, parts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def chunk() -> pa.RecordBatch:
            raw = b"".join(parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([keys], pa.list_(batch.column(0).type)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([_codec().compress(raw, asbytes=True) if raw else b""], pa.binary()),
                ],
                names=["chunk", "keys", "sizes", "texts"],
            )

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            names, row = batch.column(0).to_pylist(), 0
            while row < len(names):
                stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes - held, "right")) - 1)
                keys += names[row:stop]
                sizes += np.diff(offsets[row : stop + 1]).tolist()
                parts.append(data[offsets[row] : offsets[stop]].tobytes())
                held += int(offsets[stop] - offsets[row])
                row = stop
                if held >= chunk_bytes or row < len(names):
                    yield chunk()
                    number, keys, sizes, parts, held = number + 1, [], [], [], 0
        if keys:
            yield chunk()

    schema = f"chunk bigint, keys array<{kind}>, sizes array<bigint>, texts binary"
    buckets = task_count(spark, slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0, task_bytes)
    # Spark reads files as bucketed only by way of a table; its name is dropped, the files stay.
    table = f"chunks_{uuid.uuid4().hex}"
    (
        slim.mapInArrow(work, schema).repartition(buckets, "chunk").write.bucketBy(buckets, "chunk").sortBy("chunk")
        .option("path", new_path(spark, "chunks")).option("compression", "none").saveAsTable(table)
    )
    chunks = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return chunks


def task_count(spark: SparkSession, text_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """At least one for each core, as little text is no reason to leave cores idle."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-text_bytes // task_bytes)))


def bucket_count(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x))).first()[0] or 0
    return max(1, -(-total // bucket_bytes))


def over_chunks(chunks: DataFrame, work: Callable[..., Iterator[dict]], schema: str, answers: Sequence[DataFrame] = ()) -> DataFrame:
    """``work(chunk, *answers)`` of every chunk, with the packed answers to what it asked, by bucket.

    ``work`` yields rows as dicts of the schema's columns.
    """
    frame = chunks
    for i, answer in enumerate(answers):
        own = answer.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias(f"answers{i}"))
        frame = frame.join(own, "chunk", "left")
    names = [c.strip().split(" ")[0] for c in schema.replace("array<", "array_").split(",")]
    n_answers = len(answers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                given = [{a["bucket"]: a["answer"] for a in row[f"answers{k}"] or ()} for k in range(n_answers)]
                made = list(work(Chunk.of(row), *given))
                if made:
                    yield pa.RecordBatch.from_pylist([{n: m[n] for n in names} for m in made], schema=_arrow(schema))

    return frame.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.strip().split(" ") for c in schema.split(","))])


def split(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The runs of ascending 64-bit keys that go to each bucket, by leading bits."""
    of = bucket_of(keys, buckets)
    starts = np.nonzero(np.diff(of, prepend=-1))[0]
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        yield int(of[a]), slice(a, b)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)).astype(np.int64) * buckets) >> 24


def answered(asked: DataFrame, columns: dict[str, str], answer: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]) -> DataFrame:
    """(chunk, bucket, answer) for asked rows (chunk, bucket, and packed columns; ``key`` is ascending).

    ``answer`` gets the columns of a bucket, one chunk after the other, and the chunk of each entry (as
    an index), and returns an array with one answer per entry.
    """

    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = {c: [(unpack_sorted if c == "key" else unpack)(r[c], kind) for r in rows] for c, kind in columns.items()}
        sizes = [len(p) for p in parts["key"]]
        whole = {c: np.concatenate(p) for c, p in parts.items()}
        reply = answer(whole, np.repeat(np.arange(len(rows)), sizes))
        ends = np.cumsum(sizes).tolist()
        return pa.table(
            {
                "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
                "answer": pa.array([pack(reply[e - n : e]) for e, n in zip(ends, sizes)], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(work, "chunk bigint, bucket int, answer binary")
