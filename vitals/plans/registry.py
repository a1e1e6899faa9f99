"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hour_partition, to_stored
from ..functions.health import heart_rate_zone, spo2_status
from ..operators import alerts, analysis, enrich, gold, lineage, monitor, quality, readings, serving
from ..sources import derived
from ..sources.lake import read_table
from .fixed import (
    AS_OF,
    CUSTOM_THRESHOLDS,
    NOW,
    ONE_DEVICE,
    ONE_HOUR,
    RETENTION_DAYS,
    VERSION_CHANGE,
    processed_at,
)
from . import daily, streamed
from .streamed import new_folder, stream_alerts, stream_gold, stream_metrics, stream_route

Query = Callable[[SparkSession, str], DataFrame]

def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(derived.raw_events(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.to_silver(_classified(spark, sf), processed_at())


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_hourly(_silver(spark, sf), processed_at())


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return readings.clean_readings(derived.readings(spark, sf))


def _dashboard(spark: SparkSession, sf: str) -> DataFrame:
    return serving.with_calendar(gold.reading_gold(_clean(spark, sf)))


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.measured(_classified(spark, sf), derived.processed_at())


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.timed(derived.raw_events(spark, sf), derived.processed_at())


def _written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that what reads it several times computes it once."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return read_table(rows.sparkSession, path, rows.schema)


def _minutes(spark: SparkSession, sf: str) -> DataFrame:
    return _written(monitor.minutes_of(_measured(spark, sf)), "minutes")


# --- reading messages -----------------------------------------------------------------------------


def parse_readings(spark: SparkSession, sf: str) -> DataFrame:
    return readings.parse_readings(derived.reading_messages(spark, sf))


def malformed_readings(spark: SparkSession, sf: str) -> DataFrame:
    return readings.malformed_readings(derived.reading_messages(spark, sf))


def bronze_lenient_parse(spark: SparkSession, sf: str) -> DataFrame:
    return readings.lenient_readings(derived.reading_messages(spark, sf))


def critical_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.critical_alerts(derived.reading_messages(spark, sf))


def alert_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.notifications(alerts.critical_readings(derived.readings(spark, sf)))


def clean_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf)


# --- reading gold and dashboard -------------------------------------------------------------------


def bpm_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    return gold.bpm_per_hour(_clean(spark, sf))


def steps_per_device_day(spark: SparkSession, sf: str) -> DataFrame:
    return gold.steps_per_device_day(_clean(spark, sf))


def local_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.reading_gold(_clean(spark, sf))


def gold_with_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _dashboard(spark, sf)


def device_list(spark: SparkSession, sf: str) -> DataFrame:
    return serving.device_list(_dashboard(spark, sf))


def device_filter(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filter_device(_dashboard(spark, sf), ONE_DEVICE)


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return serving.kpis(_dashboard(spark, sf))


def bpm_history(spark: SparkSession, sf: str) -> DataFrame:
    return serving.bpm_history(_dashboard(spark, sf))


def steps_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return serving.steps_per_day(_dashboard(spark, sf))


# --- questions ------------------------------------------------------------------------------------


def alerts_per_device(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.alerts_per_device(_clean(spark, sf))


def bpm_by_hour_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.bpm_by_hour_of_day(_clean(spark, sf))


def steps_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.steps_leaderboard(_clean(spark, sf))


def weekday_vs_weekend(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.weekday_vs_weekend(_clean(spark, sf))


def device_most_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.device_most_alerts(_clean(spark, sf))


def peak_hour(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.peak_hour(_clean(spark, sf))


def most_active_device(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.most_active_device(_clean(spark, sf))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.answers(_clean(spark, sf))


# --- events: transport, validation, enrichment ----------------------------------------------------


def decode_payload(spark: SparkSession, sf: str) -> DataFrame:
    envelope = quality.to_envelope(derived.transport_records(spark, sf))
    return envelope.select("payload", "sequence_number")


def bronze_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return quality.to_envelope(derived.transport_records(spark, sf))


def hour_partitions(spark: SparkSession, sf: str) -> DataFrame:
    raw = derived.raw_events(spark, sf)
    parts = hour_partition(F.col("arrival_ts"))
    return raw.select("sequence_number", *[c.alias(n) for n, c in parts.items()])


def parse_event_time(spark: SparkSession, sf: str) -> DataFrame:
    timed = quality.parse_event_time(derived.timestamp_payloads(spark, sf))
    return timed.select("event_id", to_stored(F.col("event_time")).alias("event_time"))


def validate_events(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select(
        "sequence_number",
        quality.is_valid().alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
    )


def quarantine_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reason_counts(_classified(spark, sf))


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.route_counts(_classified(spark, sf))


def custom_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    classified = quality.accepted(_classified(spark, sf))
    zone = heart_rate_zone(F.col("heart_rate"), CUSTOM_THRESHOLDS)
    return classified.groupBy(zone.alias("heart_rate_zone")).agg(F.count("*").alias("events"))


def heart_rate_zones(spark: SparkSession, sf: str) -> DataFrame:
    valid = quality.accepted(_classified(spark, sf))
    return valid.select(
        "sequence_number", "heart_rate", heart_rate_zone(F.col("heart_rate")).alias("heart_rate_zone")
    )


def spo2_statuses(spark: SparkSession, sf: str) -> DataFrame:
    valid = quality.accepted(_classified(spark, sf))
    return valid.select("sequence_number", "spo2", spo2_status(F.col("spo2")).alias("spo2_status"))


def enrich_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf)


def abnormal_event_log(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.abnormal_event_log(_silver(spark, sf))


# --- lake -----------------------------------------------------------------------------------------


def silver_hour_scan(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.silver_hour(daily.silver(spark, sf), *ONE_HOUR)


def union_silver_versions(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf)
    older = silver.where(F.col("dt") < VERSION_CHANGE).drop("spo2_status", "heart_rate_zone")
    newer = silver.where(F.col("dt") >= VERSION_CHANGE)
    return gold.union_versions(older, newer).select(
        "event_id", "kinesis_sequence_number", "heart_rate_zone", "spo2_status", "battery_low", "dt"
    )


def batch_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.batch_lineage(_classified(spark, sf))


def hours_to_process(spark: SparkSession, sf: str) -> DataFrame:
    hours = lineage.recent_hours(NOW, 168)
    selected = daily.silver(spark, sf).where(lineage.in_hours(hours))
    return selected.groupBy("dt", "hour").agg(F.count("*").alias("events"))


def gold_run_report(spark: SparkSession, sf: str) -> DataFrame:
    hours = lineage.recent_hours(NOW, 168)
    return lineage.run_report(daily.gold_hours(spark, sf), hours)


def retained_partitions(spark: SparkSession, sf: str) -> DataFrame:
    kept = lineage.retained(daily.silver(spark, sf), AS_OF, RETENTION_DAYS)
    return kept.groupBy("dt", "hour").agg(F.count("*").alias("events"))


# --- event gold and reports -----------------------------------------------------------------------


def dedupe_events(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dedupe_events(_silver(spark, sf)).select(
        "dt", "hour", "event_id", "device_id", "event_time", "kinesis_sequence_number"
    )


def gold_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf)


def latest_events(spark: SparkSession, sf: str) -> DataFrame:
    return serving.latest_events(daily.silver(spark, sf), AS_OF)


def hourly_device_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return serving.hourly_device_metrics(daily.gold_hours(spark, sf), AS_OF)


def abnormal_heart_rate(spark: SparkSession, sf: str) -> DataFrame:
    return serving.abnormal_heart_rate(daily.silver(spark, sf), AS_OF)


def device_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return serving.device_leaderboard(daily.gold_hours(spark, sf), AS_OF)


def data_quality(spark: SparkSession, sf: str) -> DataFrame:
    return serving.data_quality(daily.bronze(spark, sf), daily.quarantine(spark, sf), AS_OF)


def needs_attention(spark: SparkSession, sf: str) -> DataFrame:
    return serving.needs_attention(daily.silver(spark, sf), AS_OF)


# --- processing metrics and alarms ----------------------------------------------------------------


def metrics_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    metrics = monitor.metrics_per_minute(_measured(spark, sf))
    each = F.transform("latencies", lambda x: F.concat_ws("x", x["latency_ms"], x["n"]))
    return metrics.withColumn("latencies", F.nullif(F.array_join(each, ","), F.lit("")))


def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.latency_percentiles(_measured(spark, sf))


def throughput_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.throughput_per_minute(_timed(spark, sf))


def alarm_abnormal_hr(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.alarm_abnormal_hr(_minutes(spark, sf)).select("minute", "state")


def alarm_lagging(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.alarm_lagging(_written(monitor.lags_of(_timed(spark, sf)), "lags"))


def alarm_transitions(spark: SparkSession, sf: str) -> DataFrame:
    minutes = _minutes(spark, sf)
    changes = [
        monitor.alarm_transitions(states).withColumn("alarm", F.lit(name))
        for name, states in zip(
            monitor.ALARMS, (monitor.alarm_abnormal_hr(minutes), monitor.alarm_lagging(minutes)), strict=True
        )
    ]
    return changes[0].unionByName(changes[1])


QUERIES: dict[str, Query] = {
    "gold_hourly": gold_hourly,
    "decode_payload": decode_payload,
    "bronze_envelope": bronze_envelope,
    "hour_partitions": hour_partitions,
    "parse_readings": parse_readings,
    "malformed_readings": malformed_readings,
    "bronze_lenient_parse": bronze_lenient_parse,
    "critical_alerts": critical_alerts,
    "alert_notifications": alert_notifications,
    "clean_silver": clean_silver,
    "parse_event_time": parse_event_time,
    "validate_events": validate_events,
    "quarantine_reasons": quarantine_reasons,
    "route_counts": route_counts,
    "custom_thresholds": custom_thresholds,
    "heart_rate_zone": heart_rate_zones,
    "spo2_status": spo2_statuses,
    "enrich_silver": enrich_silver,
    "abnormal_event_log": abnormal_event_log,
    "silver_hour_scan": silver_hour_scan,
    "union_silver_versions": union_silver_versions,
    "batch_lineage": batch_lineage,
    "hours_to_process": hours_to_process,
    "gold_run_report": gold_run_report,
    "retained_partitions": retained_partitions,
    "dedupe_events": dedupe_events,
    "bpm_per_hour": bpm_per_hour,
    "steps_per_device_day": steps_per_device_day,
    "local_gold": local_gold,
    "gold_with_calendar": gold_with_calendar,
    "device_list": device_list,
    "device_filter": device_filter,
    "kpis": kpis,
    "bpm_history": bpm_history,
    "steps_per_day": steps_per_day,
    "alerts_per_device": alerts_per_device,
    "bpm_by_hour_of_day": bpm_by_hour_of_day,
    "steps_leaderboard": steps_leaderboard,
    "weekday_vs_weekend": weekday_vs_weekend,
    "device_most_alerts": device_most_alerts,
    "peak_hour": peak_hour,
    "most_active_device": most_active_device,
    "answers": answers,
    "latest_events": latest_events,
    "hourly_device_metrics": hourly_device_metrics,
    "abnormal_heart_rate": abnormal_heart_rate,
    "device_leaderboard": device_leaderboard,
    "data_quality": data_quality,
    "needs_attention": needs_attention,
    "metrics_per_minute": metrics_per_minute,
    "latency_percentiles": latency_percentiles,
    "throughput_per_minute": throughput_per_minute,
    "alarm_abnormal_hr": alarm_abnormal_hr,
    "alarm_lagging": alarm_lagging,
    "alarm_transitions": alarm_transitions,
    "stream_alerts": stream_alerts,
    "stream_gold": stream_gold,
    "stream_metrics": stream_metrics,
    "stream_route": stream_route,
    "stream_late_events": streamed.stream_late_events,
    "stored_metrics": streamed.stored_metrics,
    "alarm_refresh": streamed.alarm_refresh,
    "compacted_events": streamed.compacted_events,
    "stored_readings": streamed.stored_readings,
    "stored_reading_gold": streamed.stored_reading_gold,
    "stored_answers": streamed.stored_answers,
}
