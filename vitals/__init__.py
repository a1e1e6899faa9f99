"""Wearable health telemetry on Spark: bronze, silver, quarantine and gold tables."""
