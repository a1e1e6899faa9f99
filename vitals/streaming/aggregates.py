"""Streaming gold and per-minute metrics.

Gold comes in three forms. ``refresh_touched_hours`` rebuilds whatever hour a batch of silver adds to.
``emit_closed_hours`` writes an hour once, when the watermark has passed it, and keeps what comes later in a
table of late rows, so that emitted, late and open events add up to all. ``windowed_gold`` is the same as a
stateful stream, which tells only how many rows it dropped.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import hour_partition, to_stored
from ..functions.health import DEFAULT_THRESHOLDS, Thresholds, is_abnormal
from ..operators import gold
from ..operators.enrich import latency_ms
from ..operators.monitor import percentiles_of
from ..operators.quality import is_valid
from ..plans.jobs import instant, rebuild_gold
from ..schemas import CLOSING, GOLD, GOLD_COLUMNS, MINUTE_COUNTS, MINUTES, PARTITIONS, SILVER
from ..sources.lake import (
    BATCH,
    Lake,
    batches_in,
    latest_hour,
    note_taken,
    overwrite_hours,
    read_all_batches,
    read_batches,
    read_hours,
    read_table,
    read_taken,
    write_batch,
    write_batches,
    write_named,
)
from ..sources.streams import UNTIL_CAUGHT_UP, start_batches, start_numbered

LATENESS = "1 hour"


def refresh_touched_hours(
    silver: DataFrame,
    lake: Lake,
    aggregated_at: datetime | None = None,
    trigger: Mapping = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Rebuild the gold hours each micro-batch of silver adds to, however late its events are."""

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        taken = batches_in(batch)
        hours = dict.fromkeys(t[:2] for t in taken)
        touched = read_hours(batch.sparkSession, lake.silver, SILVER, list(hours))
        rebuild_gold(touched, lake, aggregated_at or datetime.now(timezone.utc))
        note_taken(batch.sparkSession, lake, "gold", taken)

    return start_batches(silver.select(*PARTITIONS, BATCH), "gold-refresh", rebuild, lake.root, lake.gold, trigger)


def _hour_end(dt: str, hour: str) -> datetime:
    return datetime.fromisoformat(f"{dt}T{hour}:00:00") + timedelta(hours=1)


def emit_closed_hours(
    silver: DataFrame,
    lake: Lake,
    aggregated_at: datetime | None = None,
    lateness: timedelta = timedelta(hours=1),
    trigger: Mapping = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Gold of every hour once the watermark, the latest event less the lateness, has passed its end.

    A partition of silver is late if its hour was closed before the micro-batch that brings it; its rows go
    to the table of late rows instead. Which partitions are on time is noted, so a micro-batch that is
    repeated, or a partition that is written again, is judged as before. An hour whose partitions are
    written again after it was closed is emitted again, from the same partitions.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = batch.groupBy(*PARTITIONS, BATCH).agg(F.max("event_time").alias("last"), F.count("*").alias("n")).collect()
        if not found:
            return
        progress = read_table(spark, lake.closing, CLOSING).where(F.col("batch_id") < batch_id)
        before = progress.agg(F.max("watermark")).first()[0] or datetime.min
        days = F.col("dt").isin(sorted({f.dt for f in found}))
        known = {
            layer: {tuple(r) for r in read_taken(spark, lake, layer).where(days).collect()} for layer in ("late", "on-time")
        }
        judged = {"late": [], "on-time": []}
        for f in sorted(found):
            part = (f.dt, f.hour, f.batch)
            is_late = part in known["late"] or (part not in known["on-time"] and _hour_end(f.dt, f.hour) <= before)
            judged["late" if is_late else "on-time"].append(part)
        for layer, parts in judged.items():
            note_taken(spark, lake, layer, parts)
        if judged["late"]:
            write_batches(read_batches(spark, lake.silver, SILVER, "parquet", judged["late"]), lake.late, "parquet")
        after = max(before, max(f.last for f in found) - lateness)
        again = {p[:2] for p in judged["on-time"] if _hour_end(*p[:2]) <= before}
        waiting = read_taken(spark, lake, "on-time").where(F.col("dt") <= after.date().isoformat())
        if before > datetime.min:
            waiting = waiting.where((F.col("dt") >= before.date().isoformat()) | F.col("dt").isin(sorted({h[0] for h in again})))
        closing = [
            p for p in map(tuple, waiting.collect()) if p[:2] in again or before < _hour_end(*p[:2]) <= after
        ]
        rebuilt = read_batches(spark, lake.silver, SILVER, "parquet", closing).drop(BATCH)
        overwrite_hours(gold.gold_hourly(rebuilt, instant(aggregated_at or datetime.now(timezone.utc))), lake.closed_gold)
        late = set(judged["late"])
        counted = [sum(f.n for f in found if ((f.dt, f.hour, f.batch) in late) == which) for which in (False, True)]
        row = spark.createDataFrame([(batch_id, after, *counted)], CLOSING)
        write_named(row.coalesce(1), lake.closing, f"{batch_id:012d}", "parquet")

    columns = silver.select("event_time", *PARTITIONS, BATCH)
    return start_numbered(columns, "closed-hours", write, lake.root, lake.closing, trigger)


def late_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """Distinct events per hour: emitted in gold, late and in no other partition on time, and still open.

    They add up to the distinct events of silver. Late rows of an event that was on time too are not lost.
    """
    parts = read_taken(spark, lake, "on-time").withColumnRenamed("source", BATCH)
    silver = read_all_batches(spark, lake.silver, SILVER).select("event_id", *PARTITIONS, BATCH)
    on_time = silver.join(parts, [*PARTITIONS, BATCH], "left_semi").select("event_id", *PARTITIONS).distinct()
    late = read_table(spark, lake.late, SILVER).select("event_id", *PARTITIONS).distinct()
    lost = late.join(on_time, ["event_id", *PARTITIONS], "left_anti").groupBy(*PARTITIONS).agg(F.count("*").alias("late_events"))
    emitted = read_table(spark, lake.closed_gold, GOLD).groupBy(*PARTITIONS).agg(F.sum("event_count").alias("emitted"))
    counted = on_time.groupBy(*PARTITIONS).agg(F.count("*").alias("on_time"))
    zero = F.lit(0).cast("bigint")
    joined = counted.join(emitted, PARTITIONS, "full").join(lost, PARTITIONS, "full")
    return joined.select(
        *PARTITIONS, F.coalesce("emitted", zero).alias("emitted"), F.coalesce("late_events", zero).alias("late_events"),
        F.when(F.col("emitted").isNull(), F.coalesce("on_time", zero)).otherwise(zero).alias("open"),
    )


def dropped_rows(query: StreamingQuery) -> int:
    """How many rows the stateful operators of a stream dropped behind the watermark, in the progress it keeps."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


def windowed_gold(silver: DataFrame, aggregated_at: Column, lateness: str = LATENESS) -> DataFrame:
    """Gold as an append-mode stream: an hour is emitted once the watermark has passed it.

    Events later than the watermark are dropped; ``dropped_rows`` counts them, ``emit_closed_hours`` keeps them.
    An id counts once per hour, as in the batch table, so the hour is part of the de-duplication key.
    """
    events = silver.withColumn("event_time", F.col("event_time").cast("timestamp"))
    distinct = events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
        ["event_id", *PARTITIONS]
    )
    hourly = gold.hourly_metrics(distinct, (F.window("event_time", "1 hour"), "device_id"))
    partitions = hour_partition(F.col("window.start"))
    return hourly.withColumns(
        {
            **partitions,
            "first_event_time": F.col("first_event_time").cast("timestamp_ntz"),
            "last_event_time": F.col("last_event_time").cast("timestamp_ntz"),
            "aggregated_at": to_stored(aggregated_at),
        }
    ).select(GOLD_COLUMNS)


def _outcome(processed_at: str, limits: Thresholds) -> tuple[Column, Column, Column, Column]:
    """Whether a record is valid and its heart rate abnormal, its latency if valid, and its lag."""
    valid, processed = is_valid(), F.col(processed_at)
    return (
        valid,
        valid & is_abnormal(F.col("heart_rate"), limits),
        F.when(valid, latency_ms(processed, F.col("event_time"))),
        F.floor((F.unix_micros(processed) - F.unix_micros("arrival_ts")) / 1000),
    )


def metric_counts(
    classified: DataFrame, processed_at: str = "processed_ts", limits: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """The counts of ``windowed_metrics`` for one batch, and when the last record of each was processed."""
    valid, abnormal, latency, lag = _outcome(processed_at, limits)
    minute = F.date_trunc("minute", F.col(processed_at)).cast("timestamp_ntz")
    return classified.groupBy(
        minute.alias("minute"), valid.alias("is_valid"), abnormal.alias("is_abnormal_hr"), latency.alias("latency_ms")
    ).agg(
        F.count("*").alias("n"), F.max(lag).alias("lag_ms"),
        F.max(processed_at).cast("timestamp_ntz").alias("last_processed"),
    )


def keep_minutes(
    classified: DataFrame,
    lake: Lake,
    processed_at: str = "processed_ts",
    lateness: timedelta = timedelta(minutes=1),
    limits: Thresholds = DEFAULT_THRESHOLDS,
    trigger: Mapping = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """A table of all minutes, open ones included, replaced in place as records come; drops none.

    Each micro-batch adds its counts as a batch of its own. The hours that it has records of, and those that
    had open minutes, are then made anew from the counts of all batches. A minute is closed when it ended
    ``lateness`` before the latest record was processed; what comes later still counts in it. A micro-batch that
    is repeated replaces its counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = metric_counts(batch, processed_at, limits)
        counts = counts.withColumns(hour_partition(F.col("minute").cast("timestamp")))
        write_batch(counts, lake.minute_counts, f"{batch_id:012d}", "parquet")
        added = read_all_batches(spark, lake.minute_counts, MINUTE_COUNTS).where(F.col(BATCH) == f"{batch_id:012d}")
        found = added.groupBy(*PARTITIONS).agg(F.max("last_processed").alias("last")).collect()
        if not found:
            return
        hours = {(f.dt, f.hour) for f in found}
        latest = max(f.last for f in found)
        newest = latest_hour(spark, lake.minutes)
        if newest:
            before = read_hours(spark, lake.minutes, MINUTES, [newest]).agg(F.max("last_processed")).first()[0]
            latest = max(latest, before)
            # Minutes were open from here on.
            moment = before - lateness - timedelta(minutes=1)
            while moment <= before + timedelta(hours=1):
                hours.add((moment.date().isoformat(), f"{moment.hour:02d}"))
                moment += timedelta(hours=1)
        all_counts = read_hours(spark, lake.minute_counts, MINUTE_COUNTS, sorted(hours))
        minutes = minute_metrics(all_counts).withColumns(hour_partition(F.col("minute").cast("timestamp")))
        closed = F.col("minute") + F.expr("INTERVAL 1 MINUTE") + F.lit(lateness) <= F.lit(latest)
        overwrite_hours(minutes.withColumn("is_closed", closed).select(MINUTES.fieldNames()), lake.minutes)

    return start_numbered(classified, "minutes", write, lake.root, lake.minute_counts, trigger)


def windowed_metrics(
    classified: DataFrame,
    processed_at: str = "processed_ts",
    lateness: str = "1 minute",
    limits: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """How often each outcome and latency occurred per minute of processing, with the worst lag, as a stream.

    Records processed before the watermark are dropped; ``keep_minutes`` has no such limit.
    ``minute_metrics`` makes a row per minute of what it wrote, with exact percentiles.
    """
    valid, abnormal, latency, lag = _outcome(processed_at, limits)
    return (
        classified.withWatermark(processed_at, lateness)
        .groupBy(
            F.window(processed_at, "1 minute"), valid.alias("is_valid"), abnormal.alias("is_abnormal_hr"),
            latency.alias("latency_ms"),
        )
        .agg(F.count("*").alias("n"), F.max(lag).alias("lag_ms"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("minute"),
            "is_valid", "is_abnormal_hr", "latency_ms", "n", "lag_ms",
        )
    )


def minute_metrics(counts: DataFrame) -> DataFrame:
    """Counts, exact latency percentiles and worst lag per minute, from the counts of any number of batches."""
    percentiles = percentiles_of(counts.where("is_valid").groupBy("minute", "latency_ms").agg(F.sum("n").alias("n")))
    counted = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    totals = counts.groupBy("minute").agg(
        counted(F.col("is_valid")).alias("valid_events"),
        counted(~F.col("is_valid")).alias("invalid_events"),
        counted(F.col("is_abnormal_hr")).alias("abnormal_heart_rate"),
        F.max("lag_ms").alias("max_lag_ms"),
        *[F.max(c).alias(c) for c in counts.columns if c == "last_processed"],
    )
    return totals.join(percentiles, "minute", "left")
