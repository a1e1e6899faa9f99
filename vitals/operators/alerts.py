"""Critical heart-rate alerts on reading messages, and their notification texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.health import CRITICAL_BPM
from .readings import with_reading

# Notification subject and body.
SUBJECT = "[%s] ALERTE BPM critique — device %s"
BODY = (
    "ALERTE CARDIAQUE DÉTECTÉE\n"
    "\n"
    "Device ID  : %s\n"
    "BPM        : %d\n"
    "Horodatage : %s\n"
    "Position   : lat=%s, lng=%s\n"
    "\n"
    "Action immédiate requise."
)


def critical_readings(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("bpm") < CRITICAL_BPM)


def critical_alerts(messages: DataFrame, text: str = "json") -> DataFrame:
    """Messages to publish: the device as key, the message text unchanged as value."""
    parsed = with_reading(messages, text).where("is_reading")
    return critical_readings(parsed).select(F.col("device_id").alias("key"), F.col(text).alias("value"))


def notifications(readings: DataFrame, sender: str = "vitals") -> DataFrame:
    """Subject and body per reading; ``sender`` is the tag in front of the subject."""
    sent_at = F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return readings.select(
        "device_id",
        "timestamp",
        F.format_string(SUBJECT, F.lit(sender), "device_id").alias("subject"),
        F.format_string(
            BODY, "device_id", "bpm", sent_at, F.col("lat").cast("string"), F.col("lng").cast("string")
        ).alias("body"),
    )
