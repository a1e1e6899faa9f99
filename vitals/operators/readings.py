"""Six-field readings: strict and lenient parsing, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.documents import (
    bigint_of,
    double_of,
    is_number_type,
    json_type,
    materialize,
    text_of,
    with_document,
)
from ..schemas import READING

_COLUMNS = READING.fieldNames()


def _int32(value: Column) -> Column:
    number = bigint_of(value)
    return F.when(number.between(-(2**31), 2**31 - 1), number).cast("int")


def with_reading(messages: DataFrame, text: str = "json") -> DataFrame:
    """Add the six fields and ``is_reading``: one JSON object, every field present and well typed."""
    typed = with_document(messages, text, _COLUMNS)
    typed = typed.withColumns(
        {f"_type_{name}": json_type(F.col(f"document.{name}")) for name in _COLUMNS}
    )

    doc = {name: F.col(f"document.{name}") for name in _COLUMNS}
    kind = {name: F.col(f"_type_{name}") for name in _COLUMNS}
    values = {
        "device_id": F.when(kind["device_id"] == "STRING", text_of(doc["device_id"])),
        "timestamp": F.when(kind["timestamp"] == "BIGINT", bigint_of(doc["timestamp"])),
        "bpm": F.when(kind["bpm"] == "BIGINT", _int32(doc["bpm"])),
        "steps": F.when(kind["steps"] == "BIGINT", _int32(doc["steps"])),
        "lat": F.when(is_number_type(kind["lat"]), double_of(doc["lat"])),
        "lng": F.when(is_number_type(kind["lng"]), double_of(doc["lng"])),
    }
    complete = F.col("is_json")
    for name in _COLUMNS:
        complete = complete & F.col(name).isNotNull()
    parsed = typed.select(*messages.columns, "is_json", *[v.alias(n) for n, v in values.items()])
    parsed = parsed.withColumn("is_reading", complete)
    return materialize(parsed, messages.columns, [*_COLUMNS, "is_reading"])


def parse_readings(messages: DataFrame, text: str = "json") -> DataFrame:
    return with_reading(messages, text).where("is_reading").select(_COLUMNS)


def malformed_readings(messages: DataFrame, text: str = "json") -> DataFrame:
    return with_reading(messages, text).where(~F.col("is_reading")).select(*messages.columns)


def lenient_readings(messages: DataFrame, text: str = "json") -> DataFrame:
    """Every message becomes a row; what cannot be read becomes null."""
    return messages.select(F.from_json(text, READING).alias("data")).select("data.*")


def clean_readings(readings: DataFrame) -> DataFrame:
    return readings.where(
        F.col("device_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & (F.col("bpm") > 0)
        & (F.col("bpm") < 300)
        & (F.col("steps") >= 0)
        & F.col("lat").isNotNull()
        & F.col("lng").isNotNull()
    )
