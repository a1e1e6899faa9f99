"""Per-minute metrics of the processing itself, and alarms on them.

A *timed* frame has one row per received record: ``minute`` (when it was processed),
``arrival_minute`` and ``lag_ms``; no payload is read for it. A *measured* frame adds the outcome:
``is_valid``, ``is_abnormal_hr`` and ``latency_ms`` (null if rejected). Alarms read one row per minute.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.health import DEFAULT_THRESHOLDS, Thresholds, is_abnormal
from .enrich import latency_ms
from .quality import is_valid

LAG_THRESHOLD_MS = 60_000
LAG_PERIODS = 3
ALARM, OK = "ALARM", "OK"
ALARMS = ("abnormal_heart_rate", "lagging")


def _minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def _timing(processed_at: Column) -> list[Column]:
    lag = F.floor((F.unix_micros(processed_at) - F.unix_micros("arrival_ts")) / 1000)
    return [
        _minute(processed_at).alias("minute"),
        _minute(F.col("arrival_ts")).alias("arrival_minute"),
        lag.alias("lag_ms"),
    ]


def timed(records: DataFrame, processed_at: Column) -> DataFrame:
    return records.select(*_timing(processed_at))


def measured(
    classified: DataFrame, processed_at: Column, limits: Thresholds = DEFAULT_THRESHOLDS, also: Sequence[Column] = ()
) -> DataFrame:
    valid = is_valid()
    return classified.select(
        *also,
        *_timing(processed_at),
        valid.alias("is_valid"),
        (valid & is_abnormal(F.col("heart_rate"), limits)).alias("is_abnormal_hr"),
        F.when(valid, latency_ms(processed_at, F.col("event_time"))).alias("latency_ms"),
    )


def _latency_counts(records: DataFrame) -> DataFrame:
    """How often each outcome and latency occurred in each minute; latencies are whole milliseconds."""
    return records.groupBy("minute", "is_valid", "is_abnormal_hr", "latency_ms").agg(
        F.count("*").alias("n"), F.max("lag_ms").alias("lag_ms")
    )


def metrics_per_minute(records: DataFrame) -> DataFrame:
    """Counts and worst lag per minute, and its latencies as ascending (latency_ms, n), all in one pass."""
    counted = lambda column: F.coalesce(F.sum(F.when(F.col(column), F.col("n"))), F.lit(0))
    pair = F.when(F.col("is_valid"), F.struct("latency_ms", "n"))
    return (
        _latency_counts(records)
        # Valid and abnormal records of one latency are one entry.
        .groupBy("minute", "is_valid", "latency_ms")
        .agg(counted("is_abnormal_hr").alias("abnormal"), F.sum("n").alias("n"), F.max("lag_ms").alias("lag_ms"))
        .groupBy("minute")
        .agg(
            counted("is_valid").alias("valid_events"),
            F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("n"))), F.lit(0)).alias("invalid_events"),
            F.sum("abnormal").alias("abnormal_heart_rate"),
            F.max("lag_ms").alias("max_lag_ms"),
            F.array_sort(F.collect_list(pair)).alias("latencies"),
        )
    )


def latency_percentiles(records: DataFrame) -> DataFrame:
    """p50 and p99 per minute, exact: the least latency that so many percent of the values do not exceed."""
    return percentiles_of(records.where("is_valid").groupBy("minute", "latency_ms").agg(F.count("*").alias("n")))


def percentiles_of(counts: DataFrame) -> DataFrame:
    """The same from (minute, latency_ms, n), one row per minute and latency."""
    upwards = Window.partitionBy("minute").orderBy("latency_ms")
    ranked = counts.withColumn("below", F.sum("n").over(upwards)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("minute"))
    )
    least = lambda percent: F.min(F.when(F.col("below") * 100 >= F.col("total") * percent, F.col("latency_ms")))
    return ranked.groupBy("minute").agg(least(50).alias("p50_ms"), least(99).alias("p99_ms"))


def merged_metrics(stored: DataFrame) -> DataFrame:
    """One row per minute from the stored metrics of any number of batches, with exact percentiles.

    The latencies of a batch are stored as (latency_ms, n); those of all batches are added up by latency
    before a minute's meet, so a minute's percentiles are those of its records, not of its batches.
    """
    latencies = stored.select("minute", F.inline("latencies")).groupBy("minute", "latency_ms").agg(F.sum("n").alias("n"))
    sums = ("valid_events", "invalid_events", "abnormal_heart_rate")
    totals = stored.groupBy("minute").agg(*[F.sum(c).alias(c) for c in sums], F.max("max_lag_ms").alias("max_lag_ms"))
    return totals.join(percentiles_of(latencies), "minute", "left")


def throughput_per_minute(records: DataFrame) -> DataFrame:
    """Records in by arrival minute, records processed and worst lag by processing minute."""
    nothing = F.lit(None).cast("bigint")
    sides = records.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("arrival_minute").alias("minute"),
                    F.lit(1).alias("arrived"), F.lit(0).alias("done"), nothing.alias("lag_ms"),
                ),
                F.struct(
                    F.col("minute"), F.lit(0).alias("arrived"), F.lit(1).alias("done"), F.col("lag_ms")
                ),
            )
        )
    )
    return sides.groupBy("minute").agg(
        F.sum("arrived").alias("records_in"),
        F.sum("done").alias("records_processed"),
        F.max("lag_ms").alias("max_lag_ms"),
    )


# --- alarms ----------------------------------------------------------------------------------------


def minutes_of(records: DataFrame) -> DataFrame:
    """What the alarms look at, from measured records: abnormal heart rates and worst lag per minute.

    Stored metrics have the same columns.
    """
    return records.groupBy("minute").agg(
        F.count_if("is_abnormal_hr").alias("abnormal_heart_rate"), F.max("lag_ms").alias("max_lag_ms")
    )


def lags_of(records: DataFrame) -> DataFrame:
    """The worst lag per minute, from timed records."""
    return records.groupBy("minute").agg(F.max("lag_ms").alias("max_lag_ms"))


def minute_spine(minutes: DataFrame) -> DataFrame:
    """Every minute from the first to the last one seen. The days are dealt out before their minutes are made."""
    bounds = minutes.agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(
        "first", "last",
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"), F.expr("INTERVAL 1 DAY"))).alias("d"),
    )
    start = F.col("d").cast("timestamp_ntz")
    stop = start + F.expr("INTERVAL 1439 MINUTES")
    each = days.repartition("d").select(
        "first", "last", F.explode(F.sequence(start, stop, F.expr("INTERVAL 1 MINUTE"))).alias("minute")
    )
    return each.where(F.col("minute").between(F.col("first"), F.col("last"))).select("minute")


def alarm_states(spine: DataFrame, breaches: DataFrame, periods: int) -> DataFrame:
    """State of each minute: ALARM when it and the ``periods - 1`` minutes before it all breach.

    Both frames have a ``minute`` column, so stored metrics serve as well as records.
    A breaching minute votes for itself and its successors. Counting votes needs no ordered pass
    over all minutes; a minute without data gets too few votes and stays OK.
    """
    votes = breaches.select(
        F.inline(
            F.array(
                *[
                    F.struct((F.col("minute") + F.expr(f"INTERVAL {i} MINUTES")).alias("minute"))
                    for i in range(periods)
                ]
            )
        )
    )
    counted = votes.groupBy("minute").agg(F.count("*").alias("breaches"))
    return (
        spine.join(counted, "minute", "left").select(
            "minute",
            F.coalesce("breaches", F.lit(0)).alias("breaches"),
            F.when(F.col("breaches") >= periods, ALARM).otherwise(OK).alias("state"),
        )
    )


def alarm_abnormal_hr(minutes: DataFrame, threshold: int = 1) -> DataFrame:
    """ALARM in each minute with at least ``threshold`` abnormal heart rates."""
    breaches = minutes.where(F.col("abnormal_heart_rate") >= threshold).select("minute")
    return alarm_states(minute_spine(minutes), breaches, periods=1)


def alarm_lagging(
    minutes: DataFrame, threshold_ms: int = LAG_THRESHOLD_MS, periods: int = LAG_PERIODS
) -> DataFrame:
    """ALARM when the worst lag exceeded the threshold in that many consecutive minutes."""
    breaches = minutes.where(F.col("max_lag_ms") > threshold_ms).select("minute")
    return alarm_states(minute_spine(minutes), breaches, periods)


def continued(minutes: DataFrame, carried: DataFrame, start: datetime | None) -> DataFrame:
    """(alarm, minute, breached, breaches, state, changed_from) of both alarms, from ``start`` on.

    ``carried`` has the same columns for the minutes before, of which as many count as an alarm looks back;
    ``minutes`` are those from the start on, and should be stored, as they are read for each alarm. Without a
    start they begin with the first minute. ``changed_from`` is the state before a change, else null.
    """
    spark = minutes.sparkSession
    each = minutes.select("minute")
    if start is not None:
        each = each.unionByName(spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("minute")))
    spine = minute_spine(each)
    rules = (
        (F.col("abnormal_heart_rate") >= 1, 1),
        (F.col("max_lag_ms") > LAG_THRESHOLD_MS, LAG_PERIODS),
    )
    found = []
    for name, (breach, periods) in zip(ALARMS, rules, strict=True):
        before = carried.where(F.col("alarm") == name)
        breached = minutes.where(breach).select("minute")
        states = alarm_states(spine, breached.unionByName(before.where("breached").select("minute")), periods)
        told = states.select("minute", "state").unionByName(before.select("minute", "state"))
        changes = alarm_transitions(told).select("minute", F.col("from_state").alias("changed_from"))
        marked = states.join(breached.withColumn("breached", F.lit(True)), "minute", "left")
        found.append(
            marked.join(changes, "minute", "left").select(
                F.lit(name).alias("alarm"), "minute", F.coalesce("breached", F.lit(False)).alias("breached"),
                "breaches", "state", "changed_from",
            )
        )
    return found[0].unionByName(found[1])


def alarm_transitions(states: DataFrame) -> DataFrame:
    """Minutes in which the state changed, in either direction; before the first minute it was OK.

    Each ALARM minute also tells its successor, so neighbours meet in a grouping by minute.
    """
    next_minute = F.col("minute") + F.expr("INTERVAL 1 MINUTE")
    alarmed = F.col("state") == ALARM
    told = states.select(
        F.inline(
            F.when(
                alarmed,
                F.array(
                    F.struct(F.col("minute"), F.lit(True).alias("now"), F.lit(False).alias("before")),
                    F.struct(next_minute.alias("minute"), F.lit(None).cast("boolean").alias("now"),
                             F.lit(True).alias("before")),
                ),
            ).otherwise(
                F.array(F.struct(F.col("minute"), F.lit(False).alias("now"), F.lit(False).alias("before")))
            )
        )
    )
    merged = told.groupBy("minute").agg(F.max("now").alias("now"), F.max("before").alias("before"))
    return merged.where(F.col("now") != F.col("before")).select(
        "minute",
        F.when(F.col("before"), ALARM).otherwise(OK).alias("from_state"),
        F.when(F.col("now"), ALARM).otherwise(OK).alias("to_state"),
    )
