"""Reports over silver, gold, bronze and quarantine, and the dashboard's frames.

``as_of`` is the report day as 'yyyy-MM-dd'. It is a literal compared with the partition column, so
only the days asked for are read.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import stream_order


def _day_before(as_of: str) -> str:
    return (date.fromisoformat(as_of) - timedelta(days=1)).isoformat()


def _on(as_of: str) -> Column:
    return F.col("dt") == as_of


def _last_24_hours(as_of: str) -> Column:
    return F.col("dt") >= _day_before(as_of)


def latest_events(silver: DataFrame, as_of: str, n: int = 20) -> DataFrame:
    newest = silver.where(_on(as_of)).orderBy(
        F.desc("event_time"), "event_id", *stream_order(F.col("kinesis_sequence_number"))
    )
    return newest.select(
        "event_time", "device_id", "heart_rate", "heart_rate_zone", "steps", "spo2", "spo2_status",
        "battery", "end_to_end_latency_ms",
    ).limit(n)


def hourly_device_metrics(gold: DataFrame, as_of: str, n: int = 100) -> DataFrame:
    recent = gold.where(_last_24_hours(as_of))
    return (
        recent.select(
            "dt", "hour", "device_id", "event_count", "avg_heart_rate", "min_heart_rate",
            "max_heart_rate", "abnormal_hr_count", "total_steps", "avg_spo2", "last_battery",
        )
        .orderBy(F.desc("dt"), F.desc("hour"), "device_id")
        .limit(n)
    )


def abnormal_heart_rate(silver: DataFrame, as_of: str, n: int = 50) -> DataFrame:
    newest = silver.where(_last_24_hours(as_of) & F.col("is_abnormal_hr")).orderBy(
        F.desc("event_time"), "event_id", *stream_order(F.col("kinesis_sequence_number"))
    )
    return newest.select(
        "event_time", "device_id", "heart_rate", "heart_rate_zone", "spo2", "spo2_status"
    ).limit(n)


def device_leaderboard(gold: DataFrame, as_of: str) -> DataFrame:
    weighted = F.sum(F.col("avg_heart_rate") * F.col("event_count")) / F.sum("event_count")
    return (
        gold.where(_on(as_of))
        .groupBy("device_id")
        .agg(
            F.sum("total_steps").alias("steps_today"),
            F.round(weighted, 1).alias("avg_heart_rate"),
            F.max("max_heart_rate").alias("peak_heart_rate"),
            F.sum("abnormal_hr_count").alias("abnormal_events"),
            F.min("min_spo2").alias("lowest_spo2"),
        )
        .orderBy(F.desc("steps_today"), "device_id")
    )


def data_quality(bronze: DataFrame, quarantine: DataFrame, as_of: str) -> DataFrame:
    """Received and rejected records per hour, with the distinct reasons.

    Rejections are counted per combination of reasons first; there are few, so the lists merged per
    hour stay small however many records were rejected.
    """
    received = (
        bronze.where(_on(as_of)).groupBy("dt", "hour").agg(F.count("*").alias("received"))
    )
    per_combination = (
        quarantine.where(_on(as_of)).groupBy("dt", "hour", "errors").agg(F.count("*").alias("n"))
    )
    reasons = F.array_sort(F.array_distinct(F.flatten(F.collect_set("errors"))))
    rejected = per_combination.groupBy("dt", "hour").agg(
        F.sum("n").alias("rejected"), F.array_join(reasons, "; ").alias("reasons")
    )
    count = F.coalesce("rejected", F.lit(0))
    return (
        received.join(rejected, ["dt", "hour"], "left")
        .select(
            "dt",
            "hour",
            "received",
            count.alias("rejected"),
            F.round(F.lit(100.0) * count / F.col("received"), 2).alias("rejected_pct"),
            "reasons",
        )
        .orderBy(F.desc("hour"))
    )


def needs_attention(silver: DataFrame, as_of: str) -> DataFrame:
    """Devices whose latest event of the day shows a low battery or low blood oxygen."""
    length, digits = stream_order(F.col("kinesis_sequence_number"))
    latest_first = Window.partitionBy(F.xxhash64("device_id"), "device_id").orderBy(
        F.desc("event_time"), length.desc(), digits.desc()
    )
    latest = (
        silver.where(_on(as_of)).withColumn("_rank", F.row_number().over(latest_first)).where("_rank = 1")
    )
    return (
        latest.where(F.col("battery_low") | (F.col("spo2_status") != "normal"))
        .select("device_id", "event_time", "battery", "battery_low", "spo2", "spo2_status")
        .orderBy("battery", "device_id")
    )


# --- dashboard, over the gold table of readings ---------------------------------------------------


def with_calendar(gold: DataFrame) -> DataFrame:
    return gold.withColumns(
        {
            "day": F.substring("hour", 1, 10),
            "datetime": F.to_timestamp_ntz("hour", F.lit("yyyy-MM-dd HH")),
        }
    )


def device_list(gold: DataFrame) -> DataFrame:
    return gold.select("device_id").distinct().orderBy("device_id")


def filter_device(gold: DataFrame, device_id: str | None) -> DataFrame:
    return gold if device_id is None else gold.where(F.col("device_id") == device_id)


def _per_device_day(gold: DataFrame) -> DataFrame:
    """Every hourly row repeats the steps of its day; the earliest row speaks for the day."""
    return gold.groupBy("device_id", "day").agg(
        F.min_by("total_steps", "datetime").alias("total_steps"),
        F.sum("avg_bpm").alias("_bpm"),
        F.count("avg_bpm").alias("_hours"),
        F.max("max_bpm").alias("max_bpm"),
        F.min("min_bpm").alias("min_bpm"),
    )


def kpis(gold: DataFrame) -> DataFrame:
    """One row; the mean is over hourly rows, unweighted. It is rounded as the binary number it is: 75.65 is
    a little more than its digits say, so it becomes 75.7, where rounding the digits gives 75.6."""
    mean = F.sum("_bpm") / F.sum("_hours")
    return _per_device_day(gold).agg(
        F.regexp_replace(F.format_number(mean, 1), ",", "").cast("double").alias("avg_bpm"),
        F.max("max_bpm").alias("max_bpm"),
        F.min("min_bpm").alias("min_bpm"),
        F.sum("total_steps").alias("total_steps"),
    )


def bpm_history(gold: DataFrame) -> DataFrame:
    # The device only breaks ties, so that one busy hour can be split among sorting tasks.
    return gold.orderBy("datetime", "device_id").select("datetime", "avg_bpm", "max_bpm", "min_bpm")


def steps_per_day(gold: DataFrame) -> DataFrame:
    return (
        _per_device_day(gold).groupBy("day").agg(F.sum("total_steps").alias("total_steps")).orderBy("day")
    )
