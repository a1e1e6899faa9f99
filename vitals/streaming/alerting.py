"""Streams of critical-heart-rate alerts. A replayed micro-batch may repeat an alert, none is lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts, readings
from ..sources.lake import Lake
from ..sources.streams import UNTIL_CAUGHT_UP, start


def publish_alerts(
    messages: DataFrame,
    lake: Lake,
    path: str | None = None,
    sink_format: str = "json",
    trigger: Mapping = UNTIL_CAUGHT_UP,
    **options: str,
) -> StreamingQuery:
    """Republish critical messages unchanged, keyed by device, to files or a topic."""
    critical = alerts.critical_alerts(messages)
    return start(critical, "critical-alerts", sink_format, lake.root, path, trigger, **options)


def report_malformed(
    messages: DataFrame, lake: Lake, path: str, trigger: Mapping = UNTIL_CAUGHT_UP
) -> StreamingQuery:
    """Messages the alert stream skips, kept as they came."""
    malformed = readings.malformed_readings(messages).select("json")
    return start(malformed, "malformed-messages", "json", lake.root, path, trigger)


def render_notifications(
    alert_messages: DataFrame, lake: Lake, path: str, sender: str = "vitals", trigger: Mapping = UNTIL_CAUGHT_UP
) -> StreamingQuery:
    """Subject and body of the notification for each alert message."""
    rendered = alerts.notifications(readings.parse_readings(alert_messages), sender)
    return start(rendered, "alert-notifications", "json", lake.root, path, trigger)
