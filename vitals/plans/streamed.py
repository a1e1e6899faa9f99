"""Streaming jobs run over the given tables until caught up; the queries return what they wrote.

Output and checkpoints go below the cluster's checkpoint folder, into a new folder for each run.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hour_partition
from ..operators import alerts, enrich, monitor, quality
from ..schemas import ALARM_STATES, BRONZE, METRICS, MINUTES, PARTITIONS, QUARANTINE, SILVER
from ..session import configure, scratch_root
from ..sources import compaction, derived, lake, streams
from ..sources.lake import Lake
from ..sources.manifest import sets_path
from ..streaming import aggregates, ingest
from . import jobs
from .fixed import ALARMS_UNTIL, DELIVERIES, PROCESSED, processed_at


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(configure(spark))}/queries/{name}-{uuid.uuid4().hex}"


def _written_by(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end into Parquet files and read them."""
    folder = new_folder(stream.sparkSession, name)
    streams.start(stream, name, "parquet", folder, f"{folder}/out").awaitTermination()
    return lake.read_table(stream.sparkSession, f"{folder}/out", stream.schema)


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    messages = derived.reading_messages(spark, sf, stream=True)
    return _written_by(alerts.critical_alerts(messages), "stream-alerts")


def stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold kept up to date by streams, however events are dealt into micro-batches."""
    tables = Lake(new_folder(spark, "stream-gold"))
    _routed(spark, sf, tables)
    silver = streams.silver_stream(spark, tables.silver)
    aggregates.refresh_touched_hours(silver, tables, PROCESSED).awaitTermination()
    return lake.read_gold(spark, tables)


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of all minutes, open ones marked, however records are dealt into files and these into micro-batches."""
    classified = quality.classify(derived.raw_events(spark, sf, stream=True))
    timed = classified.withColumn("processed_ts", derived.processed_at())
    tables = Lake(new_folder(spark, "stream-metrics"))
    aggregates.keep_minutes(timed, tables).awaitTermination()
    return lake.read_table(spark, tables.minutes, MINUTES).drop("last_processed", *PARTITIONS)


def stream_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Emitted, late and open events per hour of gold that is emitted once, over three deliveries.

    What arrived in one stretch of days is added to silver, and a stream takes it, before the next comes.
    """
    tables = Lake(new_folder(spark, "stream-late"))
    classified = quality.classify(derived.raw_events(spark, sf))
    delivery = sum((F.col("arrival_ts") >= F.lit(day).cast("timestamp")).cast("int") for day in DELIVERIES)
    named = classified.withColumn(lake.BATCH, F.format_string("delivery-%d", delivery))
    silver = enrich.to_silver(named, processed_at(), keep=[lake.BATCH])
    path = f"{tables.root}/all"
    silver.write.partitionBy(lake.BATCH).parquet(path)
    for n in range(len(DELIVERIES) + 1):
        delivered = lake.read_table(spark, path, lake.with_batch(SILVER)).where(F.col(lake.BATCH) == f"delivery-{n}")
        lake.write_batches(delivered, tables.silver, "parquet")
        aggregates.emit_closed_hours(streams.silver_stream(spark, tables.silver), tables, PROCESSED).awaitTermination()
    return aggregates.late_report(spark, tables)


def _metrics(spark: SparkSession, sf: str, folder: str, batches: int) -> DataFrame:
    """Metrics of all events as jobs store them, in batches that deal out every minute's records among them."""
    also = [(F.substring("sequence_number", -9, 9).cast("int") % batches).alias("n")]
    measured = monitor.measured(quality.classify(derived.raw_events(spark, sf)), derived.processed_at(), also=also)
    measured.write.parquet(f"{folder}/measured")
    measured = spark.read.schema(measured.schema).parquet(f"{folder}/measured")
    hours = hour_partition(F.col("minute").cast("timestamp"))
    parts = [
        monitor.metrics_per_minute(measured.where(F.col("n") == n)).withColumns(hours).withColumn(lake.BATCH, F.lit(f"part-{n}"))
        for n in range(batches)
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def stored_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics with exact percentiles per minute, merged from what several batches stored."""
    tables = Lake(new_folder(spark, "stored-metrics"))
    lake.write_batches(_metrics(spark, sf, tables.root, 2), tables.metrics, "parquet")
    return monitor.merged_metrics(lake.read_table(spark, tables.metrics, METRICS))


def alarm_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """States and changes of both alarms, written in two runs: the second continues where the first ended."""
    tables = Lake(new_folder(spark, "alarm-refresh"))
    metrics = _metrics(spark, sf, tables.root, 1)
    metrics.write.parquet(f"{tables.root}/all")
    stored = spark.read.schema(metrics.schema).parquet(f"{tables.root}/all")
    for part in (stored.where(F.col("dt") <= ALARMS_UNTIL), stored.where(F.col("dt") > ALARMS_UNTIL)):
        lake.write_batches(part, tables.metrics, "parquet")
        jobs.refresh_alarms(spark, tables)
    return lake.read_table(spark, tables.alarms, ALARM_STATES).drop(*PARTITIONS)


def compacted_events(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze after compaction: each record once, though every hour's batches became one set."""
    tables = Lake(new_folder(spark, "compacted"))
    bronze = derived.bronze(derived.raw_events(spark, sf))
    late = F.col("sequence_number").substr(-1, 1).isin("0", "5")
    lake.write_batches(bronze.withColumn(lake.BATCH, F.when(late, "b").otherwise("a")), tables.bronze, "json")
    compaction.compact(spark, tables.bronze, BRONZE, "json", min_batches=1)
    compaction.vacuum(spark, tables, tables.bronze)
    files = F.col("_metadata.file_path")
    rows = spark.read.schema(BRONZE).json(sets_path(tables.bronze)).select("*", files.alias("file"))
    one = rows.groupBy(*PARTITIONS).agg(F.count_distinct("file").alias("files"))
    return lake.read_bronze(spark, tables).join(one, PARTITIONS).select(*PARTITIONS, "sequence_number", "payload", "files")


def _readings_lake(messages: DataFrame, name: str) -> Lake:
    """A stream of reading messages in bronze."""
    tables = Lake(new_folder(messages.sparkSession, name))
    ingest.readings_to_bronze(messages, tables).awaitTermination()
    return tables


def _reading_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived.readings(spark, sf, stream=True)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def stored_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The readings' bronze table, as its stream wrote it."""
    tables = _readings_lake(derived.reading_messages(spark, sf, stream=True), "readings")
    return lake.read_readings(spark, tables.readings_bronze, "json")


def stored_reading_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The dashboard's frame from gold stored by day, through bronze and silver."""
    tables = _readings_lake(_reading_texts(spark, sf), "reading-gold")
    jobs.advance_readings(spark, tables)
    return lake.load_dashboard(spark, tables.readings_gold_days)


def stored_answers(spark: SparkSession, sf: str) -> DataFrame:
    """The four answers from their files."""
    tables = _readings_lake(_reading_texts(spark, sf), "answers")
    jobs.bronze_to_silver(spark, tables)
    jobs.answer_questions(spark, tables)
    return lake.load_answers(spark, tables.answers)


def _routed(spark: SparkSession, sf: str, tables: Lake) -> None:
    """All records in bronze, silver and quarantine, by one stream each."""
    ingest.events_to_bronze(derived.transport_records(spark, sf, stream=True), tables).awaitTermination()
    bronze = streams.bronze_stream(spark, tables.bronze)
    for query in (
        ingest.bronze_to_silver(bronze, tables, processed_at()),
        ingest.bronze_to_quarantine(bronze, tables),
    ):
        query.awaitTermination()


def stream_route(spark: SparkSession, sf: str) -> DataFrame:
    """What the three tables hold after their streams: every record, by table, hour and content."""
    tables = Lake(new_folder(spark, "stream-route"))
    _routed(spark, sf, tables)
    contents = [
        lake.read_table(spark, path, schema, file_format).select(
            F.lit(layer).alias("layer"), *PARTITIONS, F.col(sequence).alias("sequence_number"), content.alias("content")
        )
        for layer, path, schema, file_format, sequence, content in (
            ("bronze", tables.bronze, BRONZE, "json", "sequence_number", F.col("payload")),
            (
                "silver", tables.silver, SILVER, "parquet", "kinesis_sequence_number",
                F.concat_ws("|", "event_id", "device_id", "heart_rate", "steps", "battery", "heart_rate_zone"),
            ),
            ("quarantine", tables.quarantine, QUARANTINE, "json", "sequence_number", F.array_join("errors", "; ")),
        )
    ]
    return contents[0].unionByName(contents[1]).unionByName(contents[2])
