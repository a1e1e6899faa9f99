"""Streaming sources and sinks. The broker connector is one option among file formats.

The Kafka format needs its connector jar on the cluster; with the file formats every stream below
runs anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE, SILVER, TRANSPORT
from ..session import checkpoint_for, configure
from .files import path_exists
from .lake import BATCH

UNTIL_CAUGHT_UP = {"availableNow": True}


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    group: str | None = None,
    **options: str,
) -> DataFrame:
    """Key and JSON text of a topic. Alert consumers start from ``latest``, ingestion from ``earliest``."""
    reader = (
        configure(spark)
        .readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    # Pace a backlog with ``maxOffsetsPerTrigger`` among the options.
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("json")
    )


def text_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """JSON texts, one per line of the files arriving in a folder."""
    lines = configure(spark).readStream.options(**options).text(path)
    return lines.withColumnRenamed("value", "json")


def _json_stream(spark: SparkSession, path: str, schema: StructType, options: Mapping) -> DataFrame:
    rows = configure(spark).readStream.schema(schema).options(**options).json(path)
    return rows.select(schema.fieldNames())


def transport_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return _json_stream(spark, path, TRANSPORT, options)


#: Vacuum deletes batches that a stream has taken, even if they were written again since.
_MAY_BE_GONE = {"ignoreMissingFiles": "true"}


def bronze_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Bronze rows as they are added, with the batch they were added in."""
    schema = StructType([*BRONZE.fields, StructField(BATCH, StringType())])
    return _json_stream(spark, path, schema, _MAY_BE_GONE | options)


def silver_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Silver rows as they are added, with the batch they were added in."""
    schema = StructType([*SILVER.fields, StructField(BATCH, StringType())])
    rows = configure(spark).readStream.schema(schema).options(**(_MAY_BE_GONE | options)).parquet(path)
    return rows.select(schema.fieldNames())


def topic_records(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """Events of a topic as transport records; partition and offset stand for shard and sequence number.

    The connector is absent here, so this source is untested.
    """
    reader = configure(spark).readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    rows = reader.option("subscribe", topic).option("startingOffsets", starting).options(**options).load()
    offset = F.format_string("%d%019d", F.col("partition") + 1, "offset")
    return rows.select(
        F.concat_ws(":", F.col("partition").cast("string"), offset).alias("eventID"),
        F.base64("value").alias("data"),
        offset.alias("sequenceNumber"),
        F.col("key").cast("string").alias("partitionKey"),
        (F.unix_micros("timestamp") / 1_000_000).alias("approximateArrivalTimestamp"),
    )


def start(
    frame: DataFrame,
    name: str,
    sink_format: str,
    checkpoint_root: str,
    path: str | None = None,
    trigger: Mapping[str, object] = UNTIL_CAUGHT_UP,
    **options: str,
) -> StreamingQuery:
    """Append a stream to a sink of its own, such as a topic or a folder that no other job writes."""
    target = path or f"{sink_format} {sorted(options.items())}"
    writer = (
        frame.writeStream.queryName(name)
        .format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_for(checkpoint_root, name, target))
        .options(**options)
        .trigger(**trigger)
    )
    return writer.start(path) if path else writer.start()


def start_numbered(
    frame: DataFrame,
    name: str,
    write: Callable[[DataFrame, int], None],
    checkpoint_root: str,
    path: str,
    trigger: Mapping[str, object] = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Like ``start_batches``, for a ``write`` that names what it writes to ``path`` by the batch's number.

    Numbers mean something together with the checkpoint only. Where it is lost they would start again and
    replace the batches of before, so the stream does not start.
    """
    spark = frame.sparkSession
    if not path_exists(spark, checkpoint_for(checkpoint_root, name, path)) and path_exists(spark, path):
        raise ValueError(f"{path} has batches of a checkpoint that is lost; restore it, or move the table away")
    return start_batches(frame, name, write, checkpoint_root, path, trigger)


def start_batches(
    frame: DataFrame,
    name: str,
    write: Callable[[DataFrame, int], None],
    checkpoint_root: str,
    target: str,
    trigger: Mapping[str, object] = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Hand each micro-batch to ``write``, which must replace what an earlier attempt wrote."""
    return (
        frame.writeStream.queryName(name)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_for(checkpoint_root, name, target))
        .trigger(**trigger)
        .start()
    )
