"""What the corpus operators share: tables in the shared folder and text columns as byte arrays."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that separates words in every contract of this package.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


@functools.cache
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="vitals-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by the cluster in spark.checkpoint.dir.

    A scratch folder replaces it only where there are no other machines (local mode, as in tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _scratch()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again, so its lineage ends there."""
    spark = frame.sparkSession
    path = new_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one text after the other, and where each begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts that hold about ``size`` bytes, or one longer text."""
    data, offsets = utf8(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def without(documents: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The documents whose key is not in the stored table of dropped keys; a null key is in no table.

    Spark broadcasts the table where its size on disk is below the session's threshold.
    """
    kept = documents.join(dropped.select(key), key, "left_anti")
    return kept.select(*[f"`{c}`" for c in documents.columns])


def digest(*columns: Column) -> Column:
    """128 bits of the columns' values, null told from any value: rows that have it in common are alike."""
    values = [*columns, *[c.isNull() for c in columns]]
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))


def row_digest(documents: DataFrame) -> Column:
    return digest(*[documents[f"`{c}`"] for c in documents.columns])


def digested(documents: DataFrame, row: Column) -> DataFrame:
    """(row, doc): a digest of each document, and its columns."""
    return documents.select(row.alias("row"), F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("doc"))


def one_of_each(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows (row, doc), of those whose digest is in the stored table of repeated ones one each."""
    if repeated.isEmpty():
        return rows
    first = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    one = rows.join(repeated, "row", "left_semi").withColumn("n", first).filter("n = 1").drop("n")
    return rows.join(repeated, "row", "left_anti").unionByName(one)
