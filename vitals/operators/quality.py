"""Envelope, validation with accumulated reasons, and routing of seven-field events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import from_seconds, hour_partition, utc_text, with_instant
from ..functions.documents import (
    bigint_of,
    decode_transport,
    double_of,
    is_number_type,
    json_type,
    materialize,
    text_of,
    with_document,
)
from ..functions.health import DEFAULT_THRESHOLDS, Thresholds, is_abnormal
from ..schemas import ENVELOPE_COLUMNS, PARTITIONS

EVENT_FIELDS = ["event_id", "device_id", "timestamp", "heart_rate", "steps", "spo2", "battery"]
NORMALIZED = ["event_id", "device_id", "event_time", "heart_rate", "steps", "spo2", "battery"]

# Rejection reasons, in the order they are reported.
NOT_JSON = "payload is not valid JSON"
NOT_OBJECT = "payload is not a JSON object"
BAD_EVENT_ID = "event_id missing or not a string"
BAD_DEVICE_ID = "device_id missing or invalid"
BAD_TIMESTAMP = "timestamp missing or unparseable"
TIMESTAMP_RANGE = "timestamp out of accepted range"
BAD_HEART_RATE = "heart_rate must be an integer in [20, 250]"
BAD_STEPS = "steps must be an integer in [0, 10000]"
BAD_SPO2 = "spo2 must be a number in [50, 100]"
BAD_BATTERY = "battery must be an integer in [0, 100]"

# Device names, earliest event, tolerated clock skew. One final newline is tolerated.
DEVICE_ID = r"^[A-Za-z0-9_.:-]{1,64}\n?\z"
EARLIEST_EVENT = "2020-01-01T00:00:00Z"
FUTURE_SKEW = "INTERVAL 5 MINUTES"


def to_envelope(records: DataFrame) -> DataFrame:
    """Transport records to bronze rows; ``arrival_time`` is text, partitions follow the arrival."""
    arrival = records.withColumn("_arrival", from_seconds(F.col("approximateArrivalTimestamp")))
    return arrival.select(
        decode_transport(F.col("data")).alias("payload"),
        F.col("partitionKey").alias("partition_key"),
        F.col("sequenceNumber").alias("sequence_number"),
        F.split_part(F.coalesce("eventID", F.lit("")), F.lit(":"), F.lit(1)).alias("shard_id"),
        utc_text(F.col("_arrival")).alias("arrival_time"),
        *[c.alias(n) for n, c in hour_partition(F.col("_arrival")).items()],
    )


def with_arrival(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the arrival instant as a TIMESTAMP ``arrival_ts``."""
    return bronze.withColumn("arrival_ts", F.col("arrival_time").try_cast("timestamp"))


def _reason(ok: Column, message: Column | str) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(ok, F.lit(False)), empty).otherwise(F.array(message))


def _integer_in(name: str, low: int, high: int) -> Column:
    return (F.col(f"_type_{name}") == "BIGINT") & F.col(f"_{name}").between(low, high)


def classify(records: DataFrame) -> DataFrame:
    """Validate ``payload`` against ``arrival_ts``: adds the normalized fields and ``errors``.

    The event is valid when ``errors`` is empty; otherwise it lists every reason, in order.
    """
    keep = records.columns
    typed = with_document(records, "payload", EVENT_FIELDS).withColumns(
        {f"_type_{name}": json_type(F.col(f"document.{name}")) for name in EVENT_FIELDS}
    )
    kind = {name: F.col(f"_type_{name}") for name in EVENT_FIELDS}
    doc = {name: F.col(f"document.{name}") for name in EVENT_FIELDS}
    valued = typed.withColumns(
        {
            "_event_id": F.when(kind["event_id"] == "STRING", text_of(doc["event_id"])),
            "_device_id": F.when(kind["device_id"] == "STRING", text_of(doc["device_id"])),
            **{
                f"_{name}": F.when(kind[name] == "BIGINT", bigint_of(doc[name]))
                for name in ("heart_rate", "steps", "battery")
            },
            "_spo2": F.when(is_number_type(kind["spo2"]), double_of(doc["spo2"])),
        }
    )
    valued = with_instant(valued, doc["timestamp"], kind["timestamp"], "_event_time")
    event_time = F.col("_event_time")
    in_range = (event_time >= F.lit(EARLIEST_EVENT).cast("timestamp")) & (
        event_time <= F.col("arrival_ts") + F.expr(FUTURE_SKEW)
    )
    field_errors = F.concat(
        _reason(F.length("_event_id") > 0, BAD_EVENT_ID),
        _reason(F.col("_device_id").rlike(DEVICE_ID), BAD_DEVICE_ID),
        _reason(in_range, F.when(event_time.isNull(), BAD_TIMESTAMP).otherwise(TIMESTAMP_RANGE)),
        _reason(_integer_in("heart_rate", 20, 250), BAD_HEART_RATE),
        _reason(_integer_in("steps", 0, 10_000), BAD_STEPS),
        _reason(F.col("_spo2").between(50, 100), BAD_SPO2),
        _reason(_integer_in("battery", 0, 100), BAD_BATTERY),
    )
    errors = (
        F.when(~F.col("is_json"), F.array(F.lit(NOT_JSON)))
        .when(F.col("document").isNull(), F.array(F.lit(NOT_OBJECT)))
        .otherwise(field_errors)
    )
    checked = valued.select(
        *keep,
        errors.alias("errors"),
        F.col("_event_id").alias("event_id"),
        F.col("_device_id").alias("device_id"),
        event_time.alias("event_time"),
        # Values beyond 32 bits were refused above; they must not fail the cast.
        *[F.col(f"_{n}").try_cast("int").alias(n) for n in ("heart_rate", "steps")],
        F.col("_spo2").alias("spo2"),
        F.col("_battery").try_cast("int").alias("battery"),
    )
    return materialize(checked, keep, ["errors", *NORMALIZED])


def parse_event_time(records: DataFrame, text: str = "payload") -> DataFrame:
    """Add ``event_time`` read from the document's ``timestamp``; null when it names no instant."""
    typed = with_document(records, text, ["timestamp"]).withColumn(
        "_type", json_type(F.col("document.timestamp"))
    )
    timed = with_instant(typed, F.col("document.timestamp"), F.col("_type"), "event_time")
    return timed.withColumn("event_time", F.when(F.col("is_json"), F.col("event_time"))).drop(
        "is_json", "document", "_type"
    )


def is_valid() -> Column:
    return F.size("errors") == 0


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(is_valid())


def rejected(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Quarantine rows: the envelope as received, with the reasons, and columns to ``keep``."""
    envelope = [c for c in [*ENVELOPE_COLUMNS, *PARTITIONS] if c in classified.columns]
    columns = [c for c in envelope if c not in PARTITIONS] + ["errors"]
    return classified.where(~is_valid()).select(*columns, *[c for c in PARTITIONS if c in envelope], *keep)


def route_counts(classified: DataFrame, limits: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    abnormal = is_valid() & is_abnormal(F.col("heart_rate"), limits)
    return classified.agg(
        F.count("*").alias("received"),
        F.count_if(is_valid()).alias("valid"),
        F.count_if(~is_valid()).alias("invalid"),
        F.count_if(abnormal).alias("abnormal"),
    )


def reason_counts(classified: DataFrame) -> DataFrame:
    return (
        classified.where(~is_valid())
        .select(F.explode("errors").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rejected"))
    )
