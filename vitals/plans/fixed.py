"""Parameters of the registered queries. Nothing reads the clock."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.health import Thresholds

AS_OF = "2024-01-30"  # the report day
PROCESSED_AT = "2024-02-01 00:00:00"
PROCESSED = datetime.fromisoformat(PROCESSED_AT).replace(tzinfo=timezone.utc)
NOW = datetime(2024, 1, 30, 23, 10, tzinfo=timezone.utc)
ONE_HOUR = ("2024-01-15", "12")
ONE_DEVICE = "device_007"
RETENTION_DAYS = 10
VERSION_CHANGE = "2024-01-15"
DELIVERIES = ("2024-01-11", "2024-01-21")  # the first days of later deliveries
ALARMS_UNTIL = "2024-01-20"  # the last day of the first of two runs
CUSTOM_THRESHOLDS = Thresholds(low=50, high=150)


def processed_at() -> Column:
    return F.lit(PROCESSED_AT).cast("timestamp")
