"""What was written where: batch lineage, run reports, back-fill hours, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import hour_partition, stream_order
from .quality import is_valid

LONGEST_REFRESH = timedelta(days=7)
Hour = tuple[str, str]


def partition_of(instant: datetime) -> Hour:
    """The hour partition of an instant."""
    utc = instant.astimezone(timezone.utc)
    return utc.date().isoformat(), f"{utc.hour:02d}"


def recent_hours(until: datetime, count: int) -> list[Hour]:
    """The hour partition of ``until`` and those before it, latest first; ``count`` of them."""
    if not timedelta(0) < timedelta(hours=count) <= LONGEST_REFRESH:
        raise ValueError(f"a refresh covers 1 to {LONGEST_REFRESH // timedelta(hours=1)} hours, not {count}")
    return [partition_of(until - timedelta(hours=back)) for back in range(count)]


def one_hour(day: str, hour: int | str) -> list[Hour]:
    """The partition of an hour given by date and number."""
    return [partition_of(datetime.combine(date.fromisoformat(day), time(int(hour)), timezone.utc))]


def in_hours(hours: Sequence[Hour]) -> Column:
    """Literal predicate on the partition columns; for lists of known, small length."""
    by_day: dict[str, list[str]] = {}
    for dt, hour in hours:
        by_day.setdefault(dt, []).append(hour)
    predicate = F.lit(False)
    for dt, of_day in by_day.items():
        predicate = predicate | ((F.col("dt") == dt) & F.col("hour").isin(of_day))
    return predicate


def silver_hour(silver: DataFrame, dt: str, hour: str) -> DataFrame:
    return silver.where((F.col("dt") == dt) & (F.col("hour") == hour))


def run_report(gold: DataFrame, hours: Sequence[Hour]) -> DataFrame:
    """Devices and events per requested hour; an hour without gold rows reports zeros."""
    spark = gold.sparkSession
    requested = spark.createDataFrame(list(dict.fromkeys(hours)), "dt STRING, hour STRING")
    done = (
        gold.where(in_hours(hours))
        .groupBy("dt", "hour")
        .agg(F.count("*").alias("devices"), F.sum("event_count").alias("events"))
    )
    return requested.join(done, ["dt", "hour"], "left").select(
        "dt",
        "hour",
        F.coalesce("devices", F.lit(0)).alias("devices"),
        F.coalesce("events", F.lit(0)).alias("events"),
    )


def batch_lineage(classified: DataFrame) -> DataFrame:
    """First and last sequence number and record count per layer and hour partition.

    Every record is in bronze under its arrival hour, and in silver under its event hour or in
    quarantine under its arrival hour.
    """
    arrival, event = hour_partition(F.col("arrival_ts")), hour_partition(F.col("event_time"))
    bronze = F.struct(F.lit("bronze").alias("layer"), *[c.alias(n) for n, c in arrival.items()])
    silver = F.struct(F.lit("silver").alias("layer"), *[c.alias(n) for n, c in event.items()])
    quarantine = F.struct(F.lit("quarantine").alias("layer"), *[c.alias(n) for n, c in arrival.items()])
    written = classified.select(
        "sequence_number",
        F.inline(F.array(bronze, F.when(is_valid(), silver).otherwise(quarantine))),
    )
    order = F.struct(*stream_order(F.col("sequence_number")))
    return written.groupBy("layer", "dt", "hour").agg(
        F.min_by("sequence_number", order).alias("first_sequence"),
        F.max_by("sequence_number", order).alias("last_sequence"),
        F.count("*").alias("records"),
    )


def origin(batch: Column) -> Column:
    """The name under which rows of one bronze partition lie in derived tables: its batch and arrival hour.

    It does not depend on which job derives them or what else that job had at hand, so whatever derives a
    bronze partition again replaces what was derived from it before.
    """
    return F.concat(batch, F.lit("."), "dt", F.lit("T"), "hour")


def retained(table: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Rows of partitions not older than ``days``."""
    cutoff = (datetime.fromisoformat(as_of) - timedelta(days=days)).date().isoformat()
    return table.where(F.col("dt") >= cutoff)
