"""Hourly gold, the reports over it, and which hours a refresh covers."""

from datetime import datetime, timedelta, timezone

import pytest
from events import DAY, FIRST_SEQUENCE, LATER, event, records
from pyspark.sql import functions as F

from vitals.operators import enrich, gold, lineage, quality, serving
from vitals.schemas import SILVER

EVENING = datetime(2031, 5, 6, 21, 40, tzinfo=timezone.utc)


def computed_at():
    return F.lit(f"{DAY} 21:40:00").cast("timestamp")


def silver_of(spark, messages, first=FIRST_SEQUENCE):
    envelope = quality.with_arrival(quality.to_envelope(records(spark, messages, EVENING, first)))
    return enrich.to_silver(quality.classify(envelope.drop("dt", "hour")), computed_at())


def message(device, clock, **changes):
    """A message of one device at a time of the day; its id follows from both."""
    return event(event_id=f"{device}@{clock}", device_id=device, timestamp=f"{DAY}T{clock}Z", **changes)


@pytest.fixture(scope="module")
def evening(spark):
    """Two devices in the hour from 20 and one of them also in the hour before."""
    return silver_of(
        spark,
        [
            message("ring", "20:15:00", heart_rate=200, steps=40, spo2=90.5, battery=33),
            message("ring", "20:45:30", heart_rate=101, steps=2, spo2=99.0, battery=32),
            message("ring", "19:59:59.999", heart_rate=64, steps=8, spo2=93.0, battery=34),
            message("clip", "20:00:00", heart_rate=38, steps=0, spo2=88.0, battery=12),
            message("clip", "20:30:00", heart_rate=39, steps=1, spo2=96.0, battery=11),
            message("clip", "20:20:00", heart_rate=41, steps=5, spo2=96.5, battery=10),
        ],
    )


def hourly(rows):
    found = gold.gold_hourly(rows, computed_at()).collect()
    return {(r.device_id, r.hour): r for r in found}


def test_metrics_of_an_hour(evening):
    rows = hourly(evening)
    assert set(rows) == {("ring", "19"), ("ring", "20"), ("clip", "20")}
    clip = rows["clip", "20"].asDict()
    assert clip == {
        "device_id": "clip", "event_count": 3, "avg_heart_rate": 39.33, "min_heart_rate": 38, "max_heart_rate": 41,
        "abnormal_hr_count": 2, "total_steps": 6, "avg_spo2": 93.5, "min_spo2": 88.0, "last_battery": 11,
        "first_event_time": datetime(2031, 5, 6, 20), "last_event_time": datetime(2031, 5, 6, 20, 30),
        "aggregated_at": datetime(2031, 5, 6, 21, 40), "dt": DAY, "hour": "20",
    }
    assert (rows["ring", "20"].avg_heart_rate, rows["ring", "20"].abnormal_hr_count) == (150.5, 1)


def test_redelivery_changes_nothing(spark, evening):
    again = silver_of(spark, [message("clip", "20:30:00", heart_rate=150, battery=99)], first=LATER)
    both = evening.unionByName(again)
    assert both.count() == evening.count() + 1
    assert hourly(both) == hourly(evening)


def test_sequence_numbers_are_compared_as_numbers(spark):
    short = silver_of(spark, [message("ring", "20:00:00", heart_rate=70)], first=99)
    long = silver_of(spark, [message("ring", "20:00:00", heart_rate=71)], first=100)
    kept = gold.dedupe_events(long.unionByName(short)).collect()
    assert [(r.heart_rate, r.kinesis_sequence_number) for r in kept] == [(70, "99")]


def test_an_id_counts_in_every_hour_it_is_in(spark):
    same_id = [event(event_id="twin", timestamp=f"{DAY}T{h}:30:00Z") for h in ("18", "19", "20")]
    assert {hour for _, hour in hourly(silver_of(spark, same_id))} == {"18", "19", "20"}


def test_highest_level_of_the_latest_instant(spark):
    levels = {"a": 7, "b": 9, "c": 8}
    rows = [event(event_id=i, timestamp=f"{DAY}T20:10:00Z", battery=b) for i, b in levels.items()]
    early = event(event_id="d", timestamp=f"{DAY}T20:09:59.999Z", battery=100)
    assert [r.last_battery for r in hourly(silver_of(spark, [early, *rows])).values()] == [9]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_gold_aggregates_by_hash_after_ranking_on_the_map_side(evening):
    plan = plan_of(gold.gold_hourly(evening, computed_at()))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "row_number(), 1, Partial" in plan


def test_recent_hours():
    assert lineage.recent_hours(EVENING, 3) == [(DAY, "21"), (DAY, "20"), (DAY, "19")]
    # Local clocks ahead of UTC: the first hours of their day are the last of the day before.
    ahead = datetime(2031, 1, 1, 2, 5, tzinfo=timezone(timedelta(hours=5, minutes=30)))
    assert lineage.recent_hours(ahead, 1) == [("2030-12-31", "20")]
    week = lineage.recent_hours(EVENING, 7 * 24)
    assert len(set(week)) == 168 and week[-1] == ("2031-04-29", "22")


@pytest.mark.parametrize("count", [-1, 0, 7 * 24 + 1])
def test_a_refresh_is_bounded(count):
    with pytest.raises(ValueError, match="hours"):
        lineage.recent_hours(EVENING, count)


def test_one_hour():
    assert lineage.one_hour("2031-02-28", "7") == [("2031-02-28", "07")]
    for day, hour in (("2031-02-29", 1), ("2031-02-28", 24), ("2031-02-28", "noon"), ("28.2.2031", 1)):
        with pytest.raises(ValueError):
            lineage.one_hour(day, hour)


def test_run_report_lists_hours_without_rows(evening):
    report = lineage.run_report(gold.gold_hourly(evening, computed_at()), lineage.recent_hours(EVENING, 3))
    assert {(r.hour, r.devices, r.events) for r in report.collect()} == {("21", 0, 0), ("20", 2, 5), ("19", 1, 1)}


def test_data_quality(spark):
    sent = [event(event_id=f"q{i}") for i in range(5)] + [event(spo2=20, steps=-4), event(spo2=20), "<xml/>"]
    bronze = quality.to_envelope(records(spark, sent, EVENING))
    refused = quality.rejected(quality.classify(quality.with_arrival(bronze)))
    (row,) = serving.data_quality(bronze, refused, DAY).collect()
    assert (row.hour, row.received, row.rejected, row.rejected_pct) == ("21", 8, 3, 37.5)
    assert set(row.reasons.split("; ")) == {quality.BAD_SPO2, quality.BAD_STEPS, quality.NOT_JSON}
    (fine,) = serving.data_quality(bronze, refused.limit(0), DAY).collect()
    assert (fine.received, fine.rejected, fine.rejected_pct, fine.reasons) == (8, 0, 0.0, None)
    assert serving.data_quality(bronze, refused, "2031-05-07").isEmpty()


def test_reports_of_the_day(evening):
    needy = serving.needs_attention(evening, DAY).collect()
    assert [(r.device_id, r.battery, r.spo2_status) for r in needy] == [("clip", 11, "normal")]
    newest = serving.latest_events(evening, DAY, n=3).collect()
    assert [(r.device_id, r.event_time.minute) for r in newest] == [("ring", 45), ("clip", 30), ("clip", 20)]
    abnormal = serving.abnormal_heart_rate(evening, "2031-05-07").collect()
    assert [r.heart_rate for r in abnormal] == [39, 200, 38]
    assert serving.abnormal_heart_rate(evening, "2031-05-08").isEmpty()
    board = serving.device_leaderboard(gold.gold_hourly(evening, computed_at()), DAY).collect()
    assert [(r.device_id, r.steps_today, r.avg_heart_rate, r.peak_heart_rate) for r in board] == [
        ("ring", 50, 121.7, 200), ("clip", 6, 39.3, 41),
    ]


def test_reports_keep_few_rows_per_task(evening):
    assert "TakeOrderedAndProject" in plan_of(serving.latest_events(evening, DAY))
    assert "row_number(), 1, Partial" in plan_of(serving.needs_attention(evening, DAY))


def test_versions_without_a_column_are_filled(evening):
    merged = gold.union_versions(evening.drop("spo2_status", "battery_low"), evening)
    assert set(merged.columns) == set(SILVER.names)
    assert merged.filter("spo2_status IS NULL AND battery_low IS NULL").count() == evening.count()


def test_retention_includes_its_first_day(spark):
    days = spark.createDataFrame([(f"2031-05-{d:02d}",) for d in (1, 2, 3, 30)], "dt STRING")
    assert {r.dt for r in lineage.retained(days, "2031-06-01", 30).collect()} == {
        "2031-05-02", "2031-05-03", "2031-05-30",
    }
