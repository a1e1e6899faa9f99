"""Declared schemas. Readers always get one, so ``dt``/``hour`` stay strings ('03' keeps its zero)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, INT, BIGINT, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOLEAN, TIMESTAMP = BooleanType(), TimestampNTZType()  # stored timestamps are zone-less UTC


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_PARTITION = {"dt": STRING, "hour": STRING}
PARTITIONS = list(_PARTITION)

READING = _schema(device_id=STRING, timestamp=BIGINT, bpm=INT, steps=INT, lat=DOUBLE, lng=DOUBLE)

READING_GOLD = _schema(
    device_id=STRING, hour=STRING, avg_bpm=DOUBLE, max_bpm=INT, min_bpm=INT, total_steps=BIGINT
)

ANSWER = _schema(question=STRING, answer=STRING)

# A record as the stream transport hands it over.
TRANSPORT = _schema(
    eventID=STRING,
    data=STRING,
    sequenceNumber=STRING,
    partitionKey=STRING,
    approximateArrivalTimestamp=DOUBLE,
)

_ENVELOPE = {
    "payload": STRING,
    "partition_key": STRING,
    "sequence_number": STRING,
    "shard_id": STRING,
    "arrival_time": STRING,
}
BRONZE = _schema(**_ENVELOPE, **_PARTITION)
QUARANTINE = _schema(**_ENVELOPE, errors=ArrayType(STRING), **_PARTITION)

SILVER = _schema(
    event_id=STRING,
    device_id=STRING,
    event_time=TIMESTAMP,
    heart_rate=INT,
    steps=INT,
    spo2=DOUBLE,
    battery=INT,
    heart_rate_zone=STRING,
    is_abnormal_hr=BOOLEAN,
    spo2_status=STRING,
    battery_low=BOOLEAN,
    arrival_time=TIMESTAMP,
    processed_at=TIMESTAMP,
    end_to_end_latency_ms=BIGINT,
    kinesis_sequence_number=STRING,
    **_PARTITION,
)

GOLD = _schema(
    device_id=STRING,
    event_count=BIGINT,
    avg_heart_rate=DOUBLE,
    min_heart_rate=INT,
    max_heart_rate=INT,
    abnormal_hr_count=BIGINT,
    total_steps=BIGINT,
    avg_spo2=DOUBLE,
    min_spo2=DOUBLE,
    last_battery=INT,
    first_event_time=TIMESTAMP,
    last_event_time=TIMESTAMP,
    aggregated_at=TIMESTAMP,
    **_PARTITION,
)

# Metrics of one batch; a minute may be in several.
METRICS = _schema(
    minute=TIMESTAMP,
    valid_events=BIGINT,
    invalid_events=BIGINT,
    abnormal_heart_rate=BIGINT,
    max_lag_ms=BIGINT,
    latencies=ArrayType(_schema(latency_ms=BIGINT, n=BIGINT)),
    **_PARTITION,
)

# How often each outcome and latency occurred per minute in one micro-batch.
MINUTE_COUNTS = _schema(
    minute=TIMESTAMP,
    is_valid=BOOLEAN,
    is_abnormal_hr=BOOLEAN,
    latency_ms=BIGINT,
    n=BIGINT,
    lag_ms=BIGINT,
    last_processed=TIMESTAMP,
    **_PARTITION,
)

# A minute as it stands, over all micro-batches.
MINUTES = _schema(
    minute=TIMESTAMP,
    valid_events=BIGINT,
    invalid_events=BIGINT,
    abnormal_heart_rate=BIGINT,
    max_lag_ms=BIGINT,
    p50_ms=BIGINT,
    p99_ms=BIGINT,
    last_processed=TIMESTAMP,
    is_closed=BOOLEAN,
    **_PARTITION,
)

# Both alarms in every minute, and the state before a change.
ALARM_STATES = _schema(
    alarm=STRING,
    minute=TIMESTAMP,
    breached=BOOLEAN,
    breaches=BIGINT,
    state=STRING,
    changed_from=STRING,
    **_PARTITION,
)

# The watermark after each micro-batch, and how many rows of it were on time and late.
CLOSING = _schema(batch_id=BIGINT, watermark=TIMESTAMP, on_time=BIGINT, late=BIGINT)

ENVELOPE_COLUMNS = list(_ENVELOPE)
SILVER_COLUMNS = SILVER.fieldNames()
GOLD_COLUMNS = GOLD.fieldNames()
