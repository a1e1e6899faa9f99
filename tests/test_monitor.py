from datetime import datetime, timedelta

from events import event, records
from pyspark.sql import functions as F

from vitals.operators import monitor, quality

START = datetime(2031, 5, 6, 14, 0)
SCHEMA = (
    "minute TIMESTAMP_NTZ, arrival_minute TIMESTAMP_NTZ, is_valid BOOLEAN, is_abnormal_hr BOOLEAN,"
    " latency_ms BIGINT, lag_ms BIGINT"
)


def at(minute):
    return START + timedelta(minutes=minute)


def rows(spark, items):
    """(minute, abnormal, lag) triples."""
    return spark.createDataFrame(
        [(at(m), at(m), True, abnormal, 100, lag) for m, abnormal, lag in items], SCHEMA
    )


def minutes(spark, items):
    return monitor.minutes_of(rows(spark, items))


def alarmed(states):
    return [int((r.minute - START).total_seconds() // 60) for r in states.collect() if r.state == monitor.ALARM]


def test_lagging_needs_consecutive_minutes(spark):
    late, fine = 60_001, 60_000
    data = minutes(spark, [(0, False, late), (1, False, late), (2, False, fine), (3, False, late), (4, False, late),
                        (4, False, 1), (5, False, late), (6, False, late), (8, False, late), (9, False, late)])
    states = monitor.alarm_lagging(data)
    assert states.count() == 10  # minute 7 has no data and is listed as OK
    assert sorted(alarmed(states)) == [5, 6]
    changes = sorted(
        (int((r.minute - START).total_seconds() // 60), r.from_state, r.to_state)
        for r in monitor.alarm_transitions(states).collect()
    )
    assert changes == [(5, "OK", "ALARM"), (7, "ALARM", "OK")]


def test_abnormal_alarm_and_its_transitions(spark):
    data = minutes(spark, [(0, True, 0), (1, False, 0), (3, True, 0), (4, True, 0)])
    states = monitor.alarm_abnormal_hr(data)
    assert sorted(alarmed(states)) == [0, 3, 4]
    changes = {(int((r.minute - START).total_seconds() // 60), r.to_state)
               for r in monitor.alarm_transitions(states).collect()}
    # An alarm in the last minute has no later minute to clear in.
    assert changes == {(0, "ALARM"), (1, "OK"), (3, "ALARM")}


def test_spine_crosses_midnight(spark):
    data = minutes(spark, [(0, False, 0), (60 * 24 + 5, False, 0)])
    spine = monitor.minute_spine(data)
    assert spine.count() == spine.distinct().count() == 60 * 24 + 6
    assert monitor.minute_spine(data.where("false")).count() == 0


def test_no_alarm_plan_sorts_all_minutes_in_one_task(spark):
    states = monitor.alarm_lagging(minutes(spark, [(0, False, 0)]))
    for frame in (states, monitor.alarm_transitions(states)):
        assert "Window" not in frame._jdf.queryExecution().executedPlan().toString()


def test_busy_minute_is_counted_whole(spark):
    busy = spark.range(20_000).selectExpr(
        f"TIMESTAMP_NTZ '{at(0)}' AS minute", f"TIMESTAMP_NTZ '{at(0)}' AS arrival_minute", "id % 5 < 4 AS is_valid",
        "id % 10 = 0 AS is_abnormal_hr", "IF(id % 5 < 4, id % 1000, NULL) AS latency_ms", "id AS lag_ms",
    ).repartition(7)
    (row,) = monitor.metrics_per_minute(busy).collect()
    assert (row.valid_events, row.invalid_events, row.abnormal_heart_rate, row.max_lag_ms) == (16_000, 4_000, 2_000, 19_999)
    assert [tuple(x) for x in row.latencies] == [(i, 20) for i in range(1000) if i % 5 < 4]
    (both,) = monitor.latency_percentiles(busy).collect()
    ordered = sorted(i for i in range(1000) if i % 5 < 4 for _ in range(20))
    assert (both.p50_ms, both.p99_ms) == (ordered[8_000 - 1], ordered[15_840 - 1])
    (none,) = monitor.metrics_per_minute(busy.where("NOT is_valid")).collect()
    assert (none.valid_events, none.latencies) == (0, [])


def test_percentiles_and_throughput(spark):
    data = spark.createDataFrame(
        [(at(1), at(0), True, False, i + 1, i) for i in range(200)], SCHEMA
    )
    percentiles = monitor.latency_percentiles(data).first()
    assert (percentiles.p50_ms, percentiles.p99_ms) == (100, 198)
    by_minute = {r.minute: tuple(r)[1:] for r in monitor.throughput_per_minute(data).collect()}
    assert by_minute == {at(0): (200, 0, None), at(1): (0, 200, 199)}


def test_measured_frame(spark):
    classified = quality.classify(
        quality.with_arrival(quality.to_envelope(records(spark, [event(heart_rate=30), "junk"])))
    )
    processed = F.lit("2031-05-06 14:31:30").cast("timestamp")
    good, bad = monitor.measured(classified, processed).orderBy(F.desc("is_valid")).collect()
    assert (good.minute, good.arrival_minute) == (at(31), at(30))
    assert (good.is_valid, good.is_abnormal_hr, good.latency_ms, good.lag_ms) == (True, True, 202_750, 90_000)
    assert (bad.is_valid, bad.is_abnormal_hr, bad.latency_ms, bad.lag_ms) == (False, False, None, 90_000)
