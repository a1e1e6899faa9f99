"""The four questions asked of the cleaned readings, as one-row (question, answer) frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.health import CRITICAL_BPM

# Question texts.
Q_PERIOD = "Y a-t-il plus d'alertes critiques (BPM < 40) en semaine ou le week-end ?"
Q_DEVICE = "Quel appareil déclenche le plus d'alertes critiques (BPM < 40) ?"
Q_HOUR = "À quelle heure de la journée le BPM moyen est-il le plus élevé ?"
Q_STEPS = "Quel appareil (porteur) a marché le plus de pas ?"

# Answer texts.
A_WEEKDAY = "Il y a davantage en semaine (%d contre %d le week-end)."
A_WEEKEND = "Il y a davantage le week-end (%d contre %d en semaine)."
A_EVEN = "Il y a autant en semaine qu'en week-end (%d chacun)."
A_DEVICE = "C'est %s avec %d alerte(s)."
A_NO_DEVICE = "C'est aucun (pas d'alerte critique enregistrée)."
A_HOUR = "C'est à %02dh (BPM moyen : %.1f)."
A_NO_HOUR = "C'est à indéterminée (pas de données)."
A_STEPS = "C'est %s avec %d pas."
A_NO_STEPS = "C'est indéterminé (pas de données)."


def _moment() -> Column:
    return F.timestamp_seconds("timestamp")


def _on_weekend() -> Column:
    return F.dayofweek(_moment()).isin(1, 7)


def _is_critical() -> Column:
    return F.col("bpm") < CRITICAL_BPM


def _period_answer(weekday: Column, weekend: Column) -> Column:
    return (
        F.when(weekday > weekend, F.format_string(A_WEEKDAY, weekday, weekend))
        .when(weekend > weekday, F.format_string(A_WEEKEND, weekend, weekday))
        .otherwise(F.format_string(A_EVEN, weekday))
    )


def _or_else(key: Column, answer: Column, fallback: str) -> Column:
    return F.when(key.isNotNull(), answer).otherwise(F.lit(fallback))


def _device_answer(device: Column, alerts: Column) -> Column:
    return _or_else(device, F.format_string(A_DEVICE, device, alerts), A_NO_DEVICE)


def _hour_answer(hour: Column, avg_bpm: Column) -> Column:
    return _or_else(hour, F.format_string(A_HOUR, hour, avg_bpm), A_NO_HOUR)


def _steps_answer(device: Column, steps: Column) -> Column:
    return _or_else(device, F.format_string(A_STEPS, device, steps), A_NO_STEPS)


def _answer_row(top: DataFrame, question: str, answer: Column) -> DataFrame:
    """One row even when ``top`` (at most one row) is empty."""
    first = top.agg(*[F.first(c).alias(c) for c in top.columns])
    return first.select(F.lit(question).alias("question"), answer.alias("answer"))


def alert_periods(readings: DataFrame) -> DataFrame:
    critical = readings.where(_is_critical())
    return critical.agg(
        F.count_if(~_on_weekend()).alias("weekday"), F.count_if(_on_weekend()).alias("weekend")
    )


def alerts_per_device(readings: DataFrame) -> DataFrame:
    return readings.where(_is_critical()).groupBy("device_id").agg(F.count("*").alias("alerts"))


def bpm_by_hour_of_day(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.hour(_moment()).alias("hour_of_day")).agg(
        F.avg("bpm").alias("avg_bpm")
    )


def steps_leaderboard(readings: DataFrame) -> DataFrame:
    """Highest value of each device's cumulative step counter."""
    return readings.groupBy("device_id").agg(F.max("steps").alias("total_steps"))


def weekday_vs_weekend(readings: DataFrame) -> DataFrame:
    return alert_periods(readings).select(
        F.lit(Q_PERIOD).alias("question"),
        _period_answer(F.col("weekday"), F.col("weekend")).alias("answer"),
    )


def device_most_alerts(readings: DataFrame) -> DataFrame:
    top = alerts_per_device(readings).orderBy(F.desc("alerts"), "device_id").limit(1)
    return _answer_row(top, Q_DEVICE, _device_answer(F.col("device_id"), F.col("alerts")))


def peak_hour(readings: DataFrame) -> DataFrame:
    top = bpm_by_hour_of_day(readings).orderBy(F.desc("avg_bpm"), "hour_of_day").limit(1)
    return _answer_row(top, Q_HOUR, _hour_answer(F.col("hour_of_day"), F.col("avg_bpm")))


def most_active_device(readings: DataFrame) -> DataFrame:
    top = steps_leaderboard(readings).orderBy(F.desc("total_steps"), "device_id").limit(1)
    return _answer_row(top, Q_STEPS, _steps_answer(F.col("device_id"), F.col("total_steps")))


def answers(readings: DataFrame) -> DataFrame:
    """All four answers from one scan.

    Readings are reduced to (device, hour of day, weekend) first; each of these small rows then
    feeds its device's and its hour's totals, and the four winners are picked from the totals.
    """
    cells = readings.groupBy(
        "device_id", F.hour(_moment()).alias("hour"), _on_weekend().alias("weekend")
    ).agg(
        F.count_if(_is_critical()).alias("alerts"),
        F.sum("bpm").alias("bpm"),
        F.count("bpm").alias("n"),
        F.max("steps").alias("steps"),
    )
    alerts, weekend = F.col("alerts"), F.col("weekend")
    totals = (
        cells.select(
            "weekend",
            "alerts",
            "bpm",
            "n",
            "steps",
            F.inline(
                F.array(
                    F.struct(F.col("device_id"), F.lit(None).cast("int").alias("hour")),
                    F.struct(F.lit(None).cast("string").alias("device_id"), F.col("hour")),
                )
            ),
        )
        .groupBy("device_id", "hour")
        .agg(
            F.sum("alerts").alias("alerts"),
            F.sum(F.when(weekend, 0).otherwise(alerts)).alias("weekday_alerts"),
            F.sum(F.when(weekend, alerts).otherwise(0)).alias("weekend_alerts"),
            (F.sum("bpm") / F.sum("n")).alias("avg_bpm"),
            F.max("steps").alias("steps"),
        )
    )
    device, hour = F.col("device_id"), F.col("hour")
    winners = totals.agg(
        F.coalesce(F.sum(F.when(hour.isNotNull(), F.col("weekday_alerts"))), F.lit(0)).alias("weekday"),
        F.coalesce(F.sum(F.when(hour.isNotNull(), F.col("weekend_alerts"))), F.lit(0)).alias("weekend"),
        F.min_by(
            F.struct("device_id", "alerts"),
            F.when(device.isNotNull() & (alerts > 0), F.struct(-alerts, device)),
        ).alias("alerting"),
        F.min_by(
            F.struct("hour", "avg_bpm"), F.when(hour.isNotNull(), F.struct(-F.col("avg_bpm"), hour))
        ).alias("peak"),
        F.min_by(
            F.struct("device_id", "steps"),
            F.when(device.isNotNull(), F.struct(-F.col("steps"), device)),
        ).alias("active"),
    )

    def answered(question: str, answer: Column) -> Column:
        return F.struct(F.lit(question).alias("question"), answer.alias("answer"))

    return winners.select(
        F.inline(
            F.array(
                answered(Q_PERIOD, _period_answer(F.col("weekday"), F.col("weekend"))),
                answered(Q_DEVICE, _device_answer(F.col("alerting.device_id"), F.col("alerting.alerts"))),
                answered(Q_HOUR, _hour_answer(F.col("peak.hour"), F.col("peak.avg_bpm"))),
                answered(Q_STEPS, _steps_answer(F.col("active.device_id"), F.col("active.steps"))),
            )
        )
    )
