"""Valid events to silver rows, and the abnormal-event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import hour_partition, stream_order, to_stored, utc_text
from ..functions.health import (
    DEFAULT_THRESHOLDS,
    LOW_BATTERY,
    Thresholds,
    heart_rate_zone,
    is_abnormal,
    spo2_status,
)
from ..schemas import SILVER_COLUMNS
from .quality import accepted


def latency_ms(processed_at: Column, event_time: Column) -> Column:
    micros = F.unix_micros(processed_at) - F.unix_micros(event_time)
    return F.greatest(F.lit(0).cast("bigint"), F.floor(micros / 1000))


def enrich(
    valid: DataFrame, processed_at: Column, limits: Thresholds = DEFAULT_THRESHOLDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Silver rows of valid events, with columns to ``keep``; ``processed_at`` is a TIMESTAMP column or literal."""
    event_time, heart_rate = F.col("event_time"), F.col("heart_rate")
    return valid.select(
        "event_id",
        "device_id",
        to_stored(event_time).alias("event_time"),
        "heart_rate",
        "steps",
        "spo2",
        "battery",
        heart_rate_zone(heart_rate, limits).alias("heart_rate_zone"),
        is_abnormal(heart_rate, limits).alias("is_abnormal_hr"),
        spo2_status(F.col("spo2")).alias("spo2_status"),
        (F.col("battery") < LOW_BATTERY).alias("battery_low"),
        to_stored(F.col("arrival_ts")).alias("arrival_time"),
        to_stored(processed_at).alias("processed_at"),
        latency_ms(processed_at, event_time).alias("end_to_end_latency_ms"),
        F.col("sequence_number").alias("kinesis_sequence_number"),
        *[c.alias(n) for n, c in hour_partition(event_time).items()],
        *keep,
    ).select(*SILVER_COLUMNS, *keep)


def to_silver(
    classified: DataFrame, processed_at: Column, limits: Thresholds = DEFAULT_THRESHOLDS, keep: Sequence[str] = ()
) -> DataFrame:
    return enrich(accepted(classified), processed_at, limits, keep)


def abnormal_event_log(silver: DataFrame) -> DataFrame:
    """One JSON line per abnormal event, newest first.

    A global sort reads its input twice, first to find the ranges. The few abnormal rows are shuffled
    once beforehand, so that it is they that are read twice and not silver.
    """
    line = F.to_json(
        F.struct(
            F.lit("WARN").alias("level"),
            F.lit("ABNORMAL_HEART_RATE").alias("type"),
            "device_id",
            "heart_rate",
            "zone",
            utc_text(F.col("event_time").cast("timestamp")).alias("event_time"),
        )
    )
    abnormal = silver.where("is_abnormal_hr").select(
        "event_time",
        "device_id",
        "heart_rate",
        F.col("heart_rate_zone").alias("zone"),
        "event_id",
        "kinesis_sequence_number",
    )
    newest = abnormal.hint("rebalance").orderBy(
        F.desc("event_time"), "event_id", *stream_order(F.col("kinesis_sequence_number"))
    )
    return newest.select("event_time", "device_id", "heart_rate", "zone", line.alias("line"))
