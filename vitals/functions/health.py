"""Physiological classes and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

CRITICAL_BPM = 40  # local readings: alert strictly below
LOW_BATTERY = 15


@dataclass(frozen=True)
class Thresholds:
    """Heart rates outside [low, high] are abnormal."""

    low: int = 40
    high: int = 180

    def __post_init__(self) -> None:
        if self.high <= 100:
            raise ValueError("the high heart-rate threshold must be above 100")


DEFAULT_THRESHOLDS = Thresholds()


def heart_rate_zone(heart_rate: Column, limits: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return (
        F.when(heart_rate < limits.low, "bradycardia")
        .when(heart_rate > limits.high, "tachycardia")
        .when(heart_rate < 100, "resting")
        .when(heart_rate < 130, "light")
        .when(heart_rate < 160, "moderate")
        .otherwise("vigorous")
    )


def is_abnormal(heart_rate: Column, limits: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return (heart_rate < limits.low) | (heart_rate > limits.high)


def spo2_status(spo2: Column) -> Column:
    return F.when(spo2 < 90, "critical").when(spo2 < 95, "low").otherwise("normal")


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour, in binary floating point."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale
