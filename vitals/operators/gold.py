"""Hourly gold tables of both variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import bucket_start, stream_order, to_stored
from ..functions.health import half_even
from ..schemas import GOLD_COLUMNS, READING_GOLD

HOUR, DAY = 3600, 86400


# --- six-field readings -------------------------------------------------------------------------


def _hour_text(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd HH")


def _day_text(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd")


def bpm_per_hour(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("device_id", bucket_start(F.col("timestamp"), HOUR).alias("_hour"))
        .agg(
            F.avg("bpm").alias("avg_bpm"),
            F.max("bpm").alias("max_bpm"),
            F.min("bpm").alias("min_bpm"),
        )
        .select("device_id", _hour_text(F.col("_hour")).alias("hour"), "avg_bpm", "max_bpm", "min_bpm")
    )


def steps_per_device_day(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("device_id", bucket_start(F.col("timestamp"), DAY).alias("_day"))
        .agg(F.sum("steps").alias("total_steps"))
        .select("device_id", _day_text(F.col("_day")).alias("day"), "total_steps")
    )


def reading_gold(readings: DataFrame) -> DataFrame:
    """Device x hour heart rates, each row carrying the device's steps of that day.

    Each hour belongs to exactly one day, so the daily sum is a window over the hourly sums: the
    readings are scanned and shuffled once, and only hourly rows move a second time.
    """
    hourly = readings.groupBy(
        "device_id", bucket_start(F.col("timestamp"), HOUR).alias("_hour")
    ).agg(
        F.avg("bpm").alias("avg_bpm"),
        F.max("bpm").alias("max_bpm"),
        F.min("bpm").alias("min_bpm"),
        F.sum("steps").alias("_steps"),
    )
    day = Window.partitionBy("device_id", bucket_start(F.col("_hour"), DAY))
    return (
        hourly.withColumn("total_steps", F.sum("_steps").over(day))
        .withColumn("hour", _hour_text(F.col("_hour")))
        .select(READING_GOLD.fieldNames())
    )


# --- seven-field events -------------------------------------------------------------------------


def dedupe_events(silver: DataFrame) -> DataFrame:
    """Keep the first delivery of each event id within its hour partition.

    Ranking by ``row_number() = 1`` lets Spark keep one row per key on the map side already, so an
    event delivered millions of times does not meet in one task. A hash leads the keys because
    sorting compares eight bytes of the first key first, and ids or days often begin alike.
    """
    order = Window.partitionBy(F.xxhash64("event_id"), "event_id", "dt", "hour").orderBy(
        *stream_order(F.col("kinesis_sequence_number"))
    )
    return silver.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def hourly_metrics(
    events: DataFrame, keys: Sequence[str | Column] = ("device_id", "dt", "hour")
) -> DataFrame:
    """Per-group metrics of already distinct events; order-independent, so partial sums combine."""
    # Time and level in one number, which a hash aggregate keeps in its buffer: of the events at the
    # latest instant the highest level counts. Levels are percent, so seven bits hold them.
    latest = F.unix_micros(F.col("event_time").cast("timestamp")) * 128 + F.col("battery")
    return events.groupBy(*keys).agg(
        F.count("event_id").alias("event_count"),
        half_even(F.avg("heart_rate"), 2).alias("avg_heart_rate"),
        F.min("heart_rate").alias("min_heart_rate"),
        F.max("heart_rate").alias("max_heart_rate"),
        F.count_if("is_abnormal_hr").alias("abnormal_hr_count"),
        F.sum("steps").alias("total_steps"),
        half_even(F.avg("spo2"), 2).alias("avg_spo2"),
        F.min("spo2").alias("min_spo2"),
        F.max(latest).bitwiseAND(127).cast("int").alias("last_battery"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )


def gold_hourly(silver: DataFrame, aggregated_at: Column) -> DataFrame:
    return (
        hourly_metrics(dedupe_events(silver))
        .withColumn("aggregated_at", to_stored(aggregated_at))
        .select(GOLD_COLUMNS)
    )


def union_versions(*parts: DataFrame) -> DataFrame:
    """Concatenate tables written by different versions; columns a version lacks become null."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged
