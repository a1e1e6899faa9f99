"""Batch jobs over the lake."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clock import hour_partition, to_stored
from ..functions.health import DEFAULT_THRESHOLDS, Thresholds
from ..operators import analysis, enrich, gold, lineage, monitor, quality, readings
from ..schemas import ALARM_STATES, BRONZE, GOLD, METRICS, QUARANTINE, READING, SILVER
from ..session import size_shuffles
from ..sources import compaction
from ..sources import lake as tables
from ..sources.lake import Lake
from ..sources.manifest import sets_path


_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(moment: datetime) -> Column:
    return F.timestamp_micros(F.lit((moment - _EPOCH) // timedelta(microseconds=1)).cast("bigint"))


def _counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of running the plan a second time."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


# --- readings -------------------------------------------------------------------------------------


def bronze_to_silver(spark: SparkSession, lake: Lake, silver_format: str = "parquet") -> int:
    bronze = tables.read_readings(spark, lake.readings_bronze, "json")
    clean, seen = _counted(readings.clean_readings(bronze), "silver")
    clean.write.mode("overwrite").format(silver_format).save(lake.readings_silver)
    return seen.get["rows"]


def silver_to_gold(spark: SparkSession, lake: Lake, silver_format: str = "parquet") -> int:
    silver = tables.read_readings(spark, lake.readings_silver, silver_format)
    rows, seen = _counted(gold.reading_gold(silver), "gold")
    rows.write.mode("overwrite").parquet(lake.readings_gold)
    return seen.get["rows"]


def advance_readings(spark: SparkSession, lake: Lake) -> list[str]:
    """Take what bronze has more since the last run into silver by day, and rebuild gold of the days it touches.

    The days are returned. Silver names its batches by those of bronze, and what has been taken is noted after it
    is written, so a run that fails is repeated without loss or repetition. The dashboard reads
    ``readings_gold_days`` as it reads the table that ``silver_to_gold`` makes of everything.
    """
    taken = {r.source for r in tables.read_taken(spark, lake, "readings-silver").collect()}
    new = [b for (b,) in tables.folders_below(spark, lake.readings_bronze, tables.BATCH) if b not in taken]
    if new:
        schema = tables.with_batch(READING)
        bronze = tables.reader(spark, schema, "json").option("basePath", lake.readings_bronze)
        rows = bronze.load([f"{lake.readings_bronze}/{tables.BATCH}={b}" for b in new]).select(schema.fieldNames())
        day = hour_partition(F.timestamp_seconds("timestamp"))["dt"]
        silver = readings.clean_readings(rows).withColumn("dt", day).hint("rebalance", "dt", tables.BATCH)
        tables.write_partitions(silver, lake.readings_days, "parquet", "dt", tables.BATCH)
        tables.note_taken(spark, lake, "readings-silver", [("all", "all", b) for b in new])
    known = {(r.dt, r.source) for r in tables.read_taken(spark, lake, "readings-gold").collect()}
    added = [p for p in tables.folders_below(spark, lake.readings_days, "dt", tables.BATCH) if p not in known]
    days = sorted({dt for dt, _ in added})
    if days:
        schema = StructType([*READING.fields, StructField("dt", StringType())])
        of_days = tables.read_table(spark, lake.readings_days, schema).where(F.col("dt").isin(days)).drop("dt")
        gold_rows = gold.reading_gold(of_days).withColumn("dt", F.substring("hour", 1, 10)).hint("rebalance", "dt")
        tables.write_partitions(gold_rows, lake.readings_gold_days, "parquet", "dt")
        tables.note_taken(spark, lake, "readings-gold", [(dt, "all", b) for dt, b in added])
    return days


def answer_questions(spark: SparkSession, lake: Lake, silver_format: str = "parquet") -> None:
    silver = tables.read_readings(spark, lake.readings_silver, silver_format)
    analysis.answers(silver).write.mode("overwrite").json(lake.answers)


# --- events ---------------------------------------------------------------------------------------


def route_batch(
    records: DataFrame,
    lake: Lake,
    batch: str | None = None,
    processed_at: datetime | None = None,
    limits: Thresholds = DEFAULT_THRESHOLDS,
) -> dict[str, int]:
    """Write a batch of transport records to bronze, and to silver or quarantine, and its metrics.

    Payloads are parsed once: the classified batch is kept for the writes, on disk where memory does not
    suffice. A batch is named by its content unless a name is given; a repeated batch replaces what its
    first attempt wrote.
    """
    processed = instant(processed_at or datetime.now(timezone.utc))
    classified = quality.classify(quality.with_arrival(quality.to_envelope(records))).persist()
    try:
        counts = quality.route_counts(classified, limits).first().asDict()
        if counts["received"]:
            batch = batch or tables.batch_name(classified, "sequence_number")
            bronze = classified.select(*quality.ENVELOPE_COLUMNS, *quality.PARTITIONS)
            # Derived rows lie where the streams that derive them from bronze put them.
            named = classified.withColumn(tables.BATCH, lineage.origin(F.lit(batch)))
            silver = enrich.to_silver(named.drop(*quality.PARTITIONS), processed, limits, [tables.BATCH])
            metrics = monitor.metrics_per_minute(monitor.measured(classified, processed, limits))
            tables.write_batch(bronze, lake.bronze, batch, "json")
            tables.write_batches(quality.rejected(named, [tables.BATCH]), lake.quarantine, "json")
            tables.write_batches(silver, lake.silver, "parquet")
            hour = hour_partition(F.col("minute").cast("timestamp"))
            tables.write_batch(metrics.withColumns(hour), lake.metrics, batch, "parquet")
        return {name: counts[name] for name in ("valid", "invalid", "abnormal")}
    finally:
        classified.unpersist()


def refresh_alarms(spark: SparkSession, lake: Lake) -> DataFrame:
    """States of both alarms in every minute, continued from the last hour written before.

    Of the stored metrics the hours from there on are read, and these hours of states replaced: the last one
    may have been incomplete. What an alarm looks back on is read from the states of the hours before it. Returns
    the changes (alarm, minute, from_state, to_state) in the hours written, as a frame.
    """
    newest = tables.latest_hour(spark, lake.alarms)
    stored = tables.read_table(spark, lake.metrics, METRICS)
    carried = tables.read_hours(spark, lake.alarms, ALARM_STATES, [])
    start = None
    if newest:
        stored = stored.where(_not_before(newest))
        begin = datetime.fromisoformat(f"{newest[0]}T{newest[1]}:00:00")
        # The hour in which alarms began has no minutes before the first.
        start = tables.read_hours(spark, lake.alarms, ALARM_STATES, [newest]).agg(F.min("minute")).first()[0]
        back = begin - timedelta(minutes=monitor.LAG_PERIODS)
        hours = [(t.date().isoformat(), f"{t.hour:02d}") for t in (back, begin - timedelta(hours=1))]
        carried = tables.read_hours(spark, lake.alarms, ALARM_STATES, hours).where(F.col("minute") >= F.lit(back).cast("timestamp_ntz"))
    minutes = stored.groupBy("minute").agg(
        F.sum("abnormal_heart_rate").alias("abnormal_heart_rate"), F.max("max_lag_ms").alias("max_lag_ms")
    )
    states = monitor.continued(minutes, carried, start).withColumns(hour_partition(F.col("minute").cast("timestamp")))
    tables.overwrite_hours(states.select(ALARM_STATES.fieldNames()), lake.alarms)
    return alarm_changes(spark, lake, newest)


def _not_before(hour: lineage.Hour) -> Column:
    return (F.col("dt") > hour[0]) | ((F.col("dt") == hour[0]) & (F.col("hour") >= hour[1]))


def alarm_changes(spark: SparkSession, lake: Lake, since: lineage.Hour | None = None) -> DataFrame:
    """When alarms changed their state, of all stored minutes or from an hour on."""
    states = tables.read_table(spark, lake.alarms, ALARM_STATES).where("changed_from IS NOT NULL")
    states = states if since is None else states.where(_not_before(since))
    return states.select("alarm", "minute", F.col("changed_from").alias("from_state"), F.col("state").alias("to_state"))


def rebuild_gold(silver: DataFrame, lake: Lake, aggregated_at: datetime) -> None:
    """Aggregate the given silver hours and replace their gold partitions."""
    tables.overwrite_hours(gold.gold_hourly(silver, instant(aggregated_at)), lake.gold)


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    now: datetime | None = None,
    hours_back: int = 2,
    dt: str | None = None,
    hour: int | str | None = None,
) -> list[dict]:
    """Rebuild the requested gold hours in one job, and report devices and events per hour."""
    now = now or datetime.now(timezone.utc)
    hours: Sequence[lineage.Hour] = (
        lineage.recent_hours(now, hours_back) if dt is None or hour is None else lineage.one_hour(dt, hour)
    )
    size_shuffles(spark, tables.bytes_of_hours(spark, lake.silver, hours))
    rebuild_gold(tables.read_hours(spark, lake.silver, SILVER, hours), lake, now)
    # An hour without silver rows writes nothing, so older gold of that hour is not this run's.
    written = tables.read_hours(spark, lake.gold, GOLD, hours).where(
        F.col("aggregated_at") == to_stored(instant(now))
    )
    report = lineage.run_report(written, hours)
    return [row.asDict() for row in report.orderBy(F.desc("dt"), F.desc("hour")).collect()]


def _event_tables(lake: Lake) -> dict[str, tuple]:
    """The tables to which batches are added: path, schema, format, the layers derived from them, and those that
    read batches again: an hour of gold that is emitted once needs its batches until it is."""
    return {
        "bronze": (lake.bronze, BRONZE, "json", ("silver", "quarantine"), ()),
        "silver": (lake.silver, SILVER, "parquet", ("gold",), ("on-time", "late")),
        "quarantine": (lake.quarantine, QUARANTINE, "json", (), ()),
        "metrics": (lake.metrics, METRICS, "parquet", (), ()),
    }


def compact(spark: SparkSession, lake: Lake, min_batches: int = 2) -> dict[str, int]:
    """Bring the batches of every hour into one set of files; how many hours were, by table."""
    return {
        name: len(compaction.compact(spark, path, schema, file_format, min_batches))
        for name, (path, schema, file_format, *_) in _event_tables(lake).items()
    }


def vacuum(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Delete replaced batches that the streams of all derived layers have taken; how many, by table.

    In a lake without such a stream, as when one job routes events to all tables, its layer takes nothing and
    the batches stay until they expire.
    """
    return {
        name: len(compaction.vacuum(spark, lake, path, consumers, rereaders))
        for name, (path, _, _, consumers, rereaders) in _event_tables(lake).items()
    }


def expire(spark: SparkSession, lake: Lake, today: datetime, days: int = 30) -> dict[str, list[str]]:
    """Drop partitions older than the retention from the event tables and their metrics."""
    cutoff = (today - timedelta(days=days)).date().isoformat()
    paths = {
        "bronze": lake.bronze, "silver": lake.silver, "quarantine": lake.quarantine, "gold": lake.gold,
        "metrics": lake.metrics,
    }
    derived = (lake.late, lake.closed_gold, lake.minute_counts, lake.minutes, lake.alarms)
    noted = map(lake.taken, ("silver", "quarantine", "gold", "on-time", "late"))
    for path in (*map(sets_path, paths.values()), *derived, *noted):
        tables.expire_partitions(spark, path, cutoff)
    return {name: tables.expire_partitions(spark, path, cutoff) for name, path in paths.items()}
