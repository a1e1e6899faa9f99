"""Reading and event streams derived from the given ``events`` table, one scan each.

Non-integer values are binary fractions, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hour_partition, utc_text
from ..session import configure
from .files import is_folder


def _events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events, in a stream with at most one file in a micro-batch, so that it is paced by files."""
    path = f"{sf_dir}/events.parquet"
    table = configure(spark).read.parquet(path)
    if not stream:
        return table
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
    if is_folder(spark, path):
        return reader.parquet(path)
    # A stream follows a folder; of this one, only the table's file.
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def readings(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Six-field readings."""
    return _events(spark, sf_dir, stream).select(
        F.format_string("device_%03d", "user_id").alias("device_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.floor("value").cast("int").alias("bpm"),
        F.get_json_object("props", "$.k").cast("int").alias("steps"),
        F.expr("CAST(48 AS DOUBLE) + CAST(event_id % 64 AS DOUBLE) / CAST(64 AS DOUBLE)").alias("lat"),
        F.expr("CAST(2 AS DOUBLE) + CAST(event_id % 32 AS DOUBLE) / CAST(32 AS DOUBLE)").alias("lng"),
    )


def reading_messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The readings as JSON messages. Error events are garbled, incomplete or mistyped."""
    return _events(spark, sf_dir, stream).select(
        F.expr(
            """CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN concat('{"device_id":', event_id, ' oops')
            ELSE concat('{"device_id":"', format_string('device_%03d', user_id),
              '","timestamp":', unix_seconds(CAST(ts AS TIMESTAMP)),
              ',"bpm":', CASE WHEN event_type = 'error' AND event_id % 4 = 1
                THEN concat('"', CAST(floor(value) AS INT), '"') ELSE CAST(CAST(floor(value) AS INT) AS STRING) END,
              ',"steps":', get_json_object(props, '$.k'),
              ',"lat":48.', lpad(CAST(event_id % 64 * 15625 AS STRING), 6, '0'),
              CASE WHEN event_type = 'error' AND event_id % 4 = 2 THEN ''
                ELSE concat(',"lng":2.', lpad(CAST(event_id % 32 * 31250 AS STRING), 6, '0')) END, '}') END"""
        ).alias("json")
    )


def raw_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Seven-field events in their stream envelope.

    Error events are corrupted in one of five ways, every 50th event is delivered twice, every
    7th arrives three hours late.
    """
    # The given table is one file of one row group: dealt out while narrow, payloads are built and read by all tasks.
    base = _events(spark, sf_dir, stream).repartition("event_id").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr("event_type = 'error'").alias("bad"),
        F.expr("event_id % 5").alias("kind"),
        F.format_string("watch-%04d", "user_id").alias("dev"),
        F.expr("30 + CAST(floor(value) AS INT) % 221").alias("hr"),
        F.expr("CAST(get_json_object(props, '$.k') AS INT)").alias("k"),
        F.expr("100000 - CAST(event_id % 160 AS INT) * 125").alias("milli"),
        F.expr("event_id % 101").alias("bat"),
        F.expr("CASE WHEN event_id % 50 = 0 THEN array(0L, 1000000000L) ELSE array(0L) END").alias("copies"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN INTERVAL 3 HOURS ELSE INTERVAL 2 SECONDS END").alias("delay"),
    )
    payload = F.expr(
        """CASE WHEN bad AND kind = 4 THEN concat('<binary ', event_id)
        ELSE concat('{"event_id":"evt-', event_id, '","device_id":"', dev, '","timestamp":"',
          CASE WHEN bad AND kind = 2 THEN 'half past nine' ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") END,
          '","heart_rate":', CASE WHEN bad AND kind = 1 THEN 999 ELSE hr END,
          ',"steps":', CASE WHEN bad AND kind = 3 THEN -k - 1 ELSE k END,
          ',"spo2":', milli DIV 1000, '.', lpad(CAST(milli % 1000 AS STRING), 3, '0'),
          CASE WHEN bad AND kind = 0 THEN '' ELSE concat(',"battery":', bat) END, '}') END"""
    )
    return (
        base.select("event_id", "dev", "ts", "delay", "copies", payload.alias("payload"))
        .withColumn("copy", F.explode("copies"))
        .select(
            "payload",
            F.col("dev").alias("partition_key"),
            F.expr("concat('881', lpad(CAST(event_id + copy AS STRING), 53, '0'))").alias("sequence_number"),
            F.lit("shard-0001").alias("shard_id"),
            F.expr("ts + delay + CASE WHEN copy > 0 THEN INTERVAL 1 MINUTE ELSE INTERVAL 0 MINUTES END").alias(
                "arrival_ts"
            ),
        )
    )


def transport_records(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events as the stream transport hands them over: base64 data, arrival as epoch seconds."""
    return raw_events(spark, sf_dir, stream).select(
        F.concat_ws(":", "shard_id", "sequence_number").alias("eventID"),
        F.base64(F.col("payload").cast("binary")).alias("data"),
        F.col("sequence_number").alias("sequenceNumber"),
        F.col("partition_key").alias("partitionKey"),
        (F.unix_micros("arrival_ts") / 1_000_000).alias("approximateArrivalTimestamp"),
    )


def timestamp_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in every notation: ISO with Z, zone-less, with offset, epoch s and ms, and none."""
    return _events(spark, sf_dir).select(
        "event_id",
        F.expr(
            """concat('{"timestamp":', CASE event_id % 7
              WHEN 0 THEN date_format(ts, "'\\"'yyyy-MM-dd'T'HH:mm:ss.SSS'Z\\"'")
              WHEN 1 THEN date_format(ts, "'\\"'yyyy-MM-dd HH:mm:ss'\\"'")
              WHEN 2 THEN date_format(ts + INTERVAL 90 MINUTES, "'\\"'yyyy-MM-dd'T'HH:mm:ss'+01:30\\"'")
              WHEN 3 THEN date_format(ts, "'\\"'yyyyMMdd'T'HHmmss'\\"'")
              WHEN 4 THEN CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)
              WHEN 5 THEN CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING)
              ELSE '"half past nine"' END, '}')"""
        ).alias("payload"),
    )


def bronze(raw: DataFrame) -> DataFrame:
    """Raw events as bronze rows, partition columns included."""
    arrival: Column = F.col("arrival_ts")
    return raw.select(
        "payload", "partition_key", "sequence_number", "shard_id", utc_text(arrival).alias("arrival_time"),
        *[c.alias(n) for n, c in hour_partition(arrival).items()],
    )


def processed_at() -> Column:
    """When a raw event was processed: half a second to 98 seconds after its arrival."""
    number = F.substring("sequence_number", -9, 9).cast("bigint")
    return F.timestamp_micros(F.unix_micros("arrival_ts") + (number % 40 * 2500 + 500) * 1000)
