import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

from events import LATER, event, records
from test_readings import GOOD, MONDAY

from vitals.operators import lineage, monitor, quality
from vitals.plans import jobs
from vitals.schemas import ALARM_STATES, GOLD, METRICS, READING, SILVER
from vitals.sources import lake as tables
from vitals.sources.lake import Lake

NOW = datetime(2031, 5, 6, 14, 50, tzinfo=timezone.utc)


def data_files(path):
    return sorted(p for p in Path(path).rglob("part-*") if not p.name.endswith(".crc"))


def test_batch_is_routed_to_three_tables(spark, tmp_path):
    lake = Lake(str(tmp_path))
    payloads = [event(), event(event_id="2", heart_rate=35), event(event_id="3", heart_rate=999), "<binary \x01"]
    processed = datetime(2031, 5, 6, 14, 30, 2, tzinfo=timezone.utc)
    result = jobs.route_batch(records(spark, payloads), lake, "b1", processed)
    assert result == {"valid": 2, "invalid": 2, "abnormal": 1}
    bronze = tables.read_bronze(spark, lake).orderBy("sequence_number").collect()
    assert len(bronze) == 4
    assert bronze[3].payload == "<binary \x01"
    assert {(r.dt, r.hour) for r in bronze} == {("2031-05-06", "14")}
    rejected = tables.read_quarantine(spark, lake).orderBy("sequence_number").collect()
    assert [r.errors for r in rejected] == [[quality.BAD_HEART_RATE], [quality.NOT_JSON]]
    silver = tables.read_silver(spark, lake)
    assert silver.schema == SILVER
    rows = silver.orderBy("kinesis_sequence_number").collect()
    assert [r.heart_rate_zone for r in rows] == ["resting", "bradycardia"]
    assert rows[0].end_to_end_latency_ms == 114_750


def test_retried_batch_replaces_itself(spark, tmp_path):
    lake = Lake(str(tmp_path))
    first, second = records(spark, [event(), "junk"]), records(spark, [event(event_id="x")], first=LATER)
    for batch, name in ((first, "1"), (second, "2"), (first, "1")):
        jobs.route_batch(batch, lake, name, NOW)
    assert tables.read_bronze(spark, lake).count() == 3
    assert tables.read_silver(spark, lake).count() == 2
    assert tables.read_quarantine(spark, lake).count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert jobs.route_batch(records(spark, [event()]).where("false"), lake, "1") == {
        "valid": 0, "invalid": 0, "abnormal": 0,
    }
    assert not (tmp_path / "lake").exists()


def late(hour, i, **changes):
    return event(event_id=f"e{i}", timestamp=f"2031-05-06T{hour:02d}:{i:02d}:00Z", **changes)


def test_gold_refresh_is_idempotent_and_touches_only_its_hours(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert jobs.refresh_gold(spark, lake, NOW) == [
        {"dt": "2031-05-06", "hour": "14", "devices": 0, "events": 0},
        {"dt": "2031-05-06", "hour": "13", "devices": 0, "events": 0},
    ]
    assert data_files(lake.gold) == []  # an empty hour writes nothing

    jobs.route_batch(records(spark, [late(14, 1), late(12, 2)], NOW), lake, "1", NOW)
    assert jobs.refresh_gold(spark, lake, NOW, dt="2031-05-06", hour=12)[0]["events"] == 1
    before = data_files(f"{lake.gold}/dt=2031-05-06/hour=12")
    assert jobs.refresh_gold(spark, lake, NOW, hours_back=1)[0]["events"] == 1
    jobs.route_batch(records(spark, [late(14, 3), late(14, 1)], NOW, first=LATER), lake, "2", NOW)
    assert jobs.refresh_gold(spark, lake, NOW, hours_back=1) == [
        {"dt": "2031-05-06", "hour": "14", "devices": 1, "events": 2}
    ]
    assert len(data_files(f"{lake.gold}/dt=2031-05-06/hour=14")) == 1
    assert data_files(f"{lake.gold}/dt=2031-05-06/hour=12") == before
    gold = tables.read_gold(spark, lake)
    assert gold.schema == GOLD
    assert gold.count() == 2


def test_gold_events_equal_distinct_silver_events(spark, tmp_path):
    lake = Lake(str(tmp_path))
    jobs.route_batch(records(spark, [late(h, i % 50) for h in (11, 12) for i in range(60)], NOW), lake, "1", NOW)
    report = jobs.refresh_gold(spark, lake, NOW, hours_back=24)
    distinct = tables.read_silver(spark, lake).select("dt", "hour", "event_id").distinct().count()
    assert sum(r["events"] for r in report) == distinct == 100
    assert len(report) == 24


def test_partition_filters_prune(spark, tmp_path):
    lake = Lake(str(tmp_path))
    jobs.route_batch(records(spark, [late(13, 1), late(3, 2)], NOW), lake, "1", NOW)
    hour = lineage.silver_hour(tables.read_silver(spark, lake), "2031-05-06", "03")
    plan = hour._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "dt#" in filters and "hour#" in filters and "cast" not in filters
    assert [r.hour for r in hour.collect()] == ["03"]
    narrow = tables.read_silver(spark, lake).select("device_id", "battery")
    assert "struct<device_id:string,battery:int>" in narrow._jdf.queryExecution().executedPlan().toString()


def test_hours_are_read_without_listing_the_others(spark, tmp_path):
    lake = Lake(str(tmp_path))
    jobs.route_batch(records(spark, [late(h, h) for h in (3, 4, 5, 13)], NOW), lake, "1", NOW)
    hours = [("2031-05-06", "03"), ("2031-05-06", "05"), ("2031-05-06", "05"), ("2031-05-01", "00")]
    some = tables.read_hours(spark, lake.silver, SILVER, hours)
    assert some.schema == SILVER
    assert sorted(r.hour for r in some.collect()) == ["03", "05"]
    assert {Path(f).parts[-3] for f in some.inputFiles()} == {"hour=03", "hour=05"}
    assert tables.read_hours(spark, lake.silver, SILVER, []).count() == 0
    touched = spark.createDataFrame(hours, "dt STRING, hour STRING")
    found = tables.read_touched(spark, lake.silver, SILVER, touched)
    assert sorted(r.hour for r in found.collect()) == ["03", "05"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "LeftSemi" in plan and "2031-05-06" in filters and "2031-05-01" in filters
    assert tables.read_touched(spark, lake.silver, SILVER, touched.where("false")).count() == 0


def test_missing_columns_and_missing_tables(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert tables.read_silver(spark, lake).count() == 0
    jobs.route_batch(records(spark, [late(14, 1)], NOW), lake, "new", NOW)
    older = tables.read_silver(spark, lake).drop("battery_low")
    older.write.mode("append").partitionBy("dt", "hour").parquet(str(tmp_path / "mixed"))
    tables.read_silver(spark, lake).write.mode("append").partitionBy("dt", "hour").parquet(str(tmp_path / "mixed"))
    merged = tables.read_table(spark, str(tmp_path / "mixed"), SILVER)
    assert sorted(str(r.battery_low) for r in merged.collect()) == ["False", "None"]


def test_views_and_malformed_lines(spark, tmp_path):
    lake = Lake(str(tmp_path))
    jobs.route_batch(records(spark, [late(3, 1), "junk"], NOW), lake, "1", NOW)
    jobs.refresh_gold(spark, lake, NOW, hours_back=24)
    broken = Path(f"{lake.bronze}/dt=2031-05-06/hour=14/batch=zz")
    broken.mkdir(parents=True)
    (broken / "part-broken.json").write_text("{ not json\n")
    assert tables.register_views(spark, lake) == [
        "bronze_events", "silver_events", "quarantine_events", "gold_device_hourly",
    ]
    assert spark.sql("SELECT count(*) FROM bronze_events").first()[0] == 2
    assert spark.sql("SELECT hour FROM silver_events WHERE hour = '03'").count() == 1
    assert spark.sql("SELECT errors[0] FROM quarantine_events").first()[0] == quality.NOT_JSON
    assert spark.sql("SELECT event_count FROM gold_device_hourly").first()[0] == 1
    assert dict(spark.table("silver_events").dtypes)["dt"] == "string"


def test_expired_days_are_deleted(spark, tmp_path):
    lake = Lake(str(tmp_path))
    jobs.route_batch(records(spark, [event()]), lake, "1", NOW)
    old = datetime(2031, 3, 1, 12, tzinfo=timezone.utc)
    jobs.route_batch(
        records(spark, [event(timestamp="2031-03-01T11:59:00Z")], old, first=7), lake, "2", old
    )
    removed = jobs.expire(spark, lake, NOW)
    assert removed == {
        "bronze": ["2031-03-01"], "silver": ["2031-03-01"], "quarantine": [], "gold": [], "metrics": ["2031-03-01"],
    }
    assert tables.read_silver(spark, lake).count() == 1
    assert jobs.expire(spark, lake, NOW + timedelta(days=1))["silver"] == []


def test_reading_jobs_end_to_end(spark, tmp_path):
    lake = Lake(str(tmp_path))
    Path(lake.readings_bronze).mkdir(parents=True)
    lines = [GOOD, GOOD.replace('"bpm":35', '"bpm":0'), GOOD.replace("1925000000", str(MONDAY)), "{}"]
    (Path(lake.readings_bronze) / "part-0.json").write_text("\n".join(lines) + "\n")
    assert jobs.bronze_to_silver(spark, lake) == 2
    assert jobs.silver_to_gold(spark, lake) == 2
    jobs.answer_questions(spark, lake)
    assert jobs.silver_to_gold(spark, lake) == 2  # does not remove the answers
    answers = tables.load_answers(spark, lake.answers).collect()
    assert len(answers) == 4
    assert answers[1].answer == "C'est chest-strap avec 2 alerte(s)."
    board = tables.load_dashboard(spark, lake.readings_gold)
    assert board.count() == 2
    assert {"day", "datetime"} <= set(board.columns)


def test_readings_advance_by_the_days_they_touch(spark, tmp_path):
    lake, day = Lake(str(tmp_path)), 86_400
    at = lambda t, bpm=70, device="a": (device, MONDAY + t, bpm, 10, 48.0, 2.0)
    batches = [
        [at(0), at(60, 80), at(day), at(day + 3600, 90, "b"), at(0, bpm=0)],  # the last one is not clean
        [at(day + 7200, 50)],
        [at(3 * day), at(3 * day + 1, 71)],
    ]

    def add(number):
        rows = spark.createDataFrame(batches[number], READING)
        tables.write_named(rows, lake.readings_bronze, f"{number:012d}", "json")

    add(0)
    first = jobs.advance_readings(spark, lake)
    assert len(first) == 2
    files = data_files(lake.readings_gold_days)
    add(1)
    assert jobs.advance_readings(spark, lake) == first[1:]
    # One day is written anew, the other is left as it was.
    kept = [f for f in data_files(lake.readings_gold_days) if f in files]
    assert kept == [f for f in files if f"dt={first[0]}" in str(f)] and len(kept) == 1
    assert jobs.advance_readings(spark, lake) == []
    add(2)
    assert len(jobs.advance_readings(spark, lake)) == 1
    add(1)  # written again, as after a crash: it has been taken
    assert jobs.advance_readings(spark, lake) == []
    jobs.bronze_to_silver(spark, lake)
    jobs.silver_to_gold(spark, lake)
    of = lambda path: sorted(map(str, tables.load_dashboard(spark, path).collect()))
    assert of(lake.readings_gold_days) == of(lake.readings_gold) and len(of(lake.readings_gold)) == 5
    pruned = tables.read_table(spark, lake.readings_days, READING).count()
    assert pruned == 7


def test_files_of_answers_name_both_fields(spark, tmp_path):
    assert tables.load_answers(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "a.json").write_text(json.dumps({"question": "q", "answer": "a"}) + "\n")
    (tmp_path / "answers" / "b.json").write_text(json.dumps({"other": 1}) + "\n")
    (tmp_path / "answers" / "c.json").write_text('{"question": "r", "answer": null}\n{"question": "s"}\n{ broken\n')
    found = tables.load_answers(spark, str(tmp_path / "answers")).collect()
    assert sorted((r.question, str(r.answer)) for r in found) == [("q", "a"), ("r", "None"), ("s", "None")]
    assert tables.load_dashboard(spark, str(tmp_path / "none")).count() == 0


def test_batches_are_named_by_their_content(spark):
    rows = records(spark, [event(), "junk"])
    name = tables.batch_name(rows, "sequenceNumber")
    assert name == tables.batch_name(rows.repartition(3), "sequenceNumber")
    assert name != tables.batch_name(rows.limit(1), "sequenceNumber")
    assert tables.batch_name(rows.where("false"), "sequenceNumber") is None


def test_metrics_and_alarms_of_routed_batches(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for minute, rate in ((30, 30), (31, 70), (33, 30)):
        sent = [event(event_id=f"{minute}-{i}", heart_rate=rate) for i in range(3)]
        at = datetime(2031, 5, 6, 14, minute, tzinfo=timezone.utc)
        # A batch delivered again replaces its metrics too.
        for _ in range(2):
            jobs.route_batch(records(spark, sent, at, first=minute * 100), lake, None, at)
    changes = jobs.refresh_alarms(spark, lake).orderBy("minute").collect()
    assert [(c.alarm, c.minute.minute, c.to_state) for c in changes] == [
        ("abnormal_heart_rate", 30, "ALARM"), ("abnormal_heart_rate", 31, "OK"), ("abnormal_heart_rate", 33, "ALARM"),
    ]
    states = spark.read.parquet(lake.alarms)
    assert states.where("alarm = 'lagging'").count() == 4 and states.where("alarm = 'lagging' AND state = 'ALARM'").count() == 0
    stored = tables.read_table(spark, lake.metrics, METRICS)
    assert {(r.minute.minute, r.valid_events) for r in stored.collect()} == {(30, 3), (31, 3), (33, 3)}


def minute_of_lag(spark, lake, hour, minute, lag, name):
    """Stored metrics of one minute."""
    at = datetime(2031, 5, 6, hour, minute)
    row = (at, 1, 0, 0, lag, [(lag, 1)], "2031-05-06", f"{hour:02d}")
    tables.write_batch(spark.createDataFrame([row], METRICS), lake.metrics, name, "parquet")


def test_alarms_continue_from_the_last_hour(spark, tmp_path):
    """Three lagging minutes in a row over the turn of an hour, stored in three runs; then all at once."""
    lake, whole = Lake(str(tmp_path / "steps")), Lake(str(tmp_path / "whole"))
    lags = {(13, 50): 90_000, (14, 57): 1, (14, 58): 70_000, (14, 59): 70_000, (15, 0): 70_000, (15, 1): 70_000, (15, 4): 5, (17, 0): 5}
    runs = [[(13, 50), (14, 57), (14, 58)], [(14, 59), (15, 0)], [(15, 1), (15, 4)], [(17, 0)]]
    for i, minutes in enumerate(runs):
        for hour, minute in minutes:
            for each in (lake, whole):
                minute_of_lag(spark, each, hour, minute, lags[hour, minute], f"b{minute}")
        before = data_files(lake.alarms)
        jobs.refresh_alarms(spark, lake)
        if i == 2:
            # Hours before the last one are neither read nor written.
            assert [f for f in data_files(lake.alarms) if "hour=15" not in str(f)] == [f for f in before if "hour=15" not in str(f)]
    jobs.refresh_alarms(spark, whole)
    read = lambda k: sorted(map(str, tables.read_table(spark, k.alarms, ALARM_STATES).collect()))
    assert read(lake) == read(whole) and len(read(lake)) == 2 * (3 * 60 + 11)
    changes = jobs.alarm_changes(spark, lake).orderBy("minute").collect()
    assert [(f"{c.minute:%H:%M}", c.from_state, c.to_state) for c in changes] == [("15:00", "OK", "ALARM"), ("15:02", "ALARM", "OK")]


def test_percentiles_of_stored_metrics_are_those_of_the_records(spark, tmp_path):
    lake = Lake(str(tmp_path))
    at = datetime(2031, 5, 6, 14, 30, tzinfo=timezone.utc)
    classified = []
    for b in range(4):
        sent = [event(event_id=f"{b}-{i}", timestamp=f"2031-05-06T14:2{(i * b) % 9}:{i:02d}Z") for i in range(11 + b)] + ["junk"] * b
        jobs.route_batch(records(spark, sent, at, first=1000 * b + 1), lake, None, at)
        classified.append(quality.classify(quality.with_arrival(quality.to_envelope(records(spark, sent, at, first=1000 * b + 1)))))
    rows = classified[0]
    for more in classified[1:]:
        rows = rows.unionByName(more)
    stored = tables.read_table(spark, lake.metrics, METRICS)
    assert stored.count() == 4
    merged = monitor.merged_metrics(stored)
    exact = monitor.latency_percentiles(monitor.measured(rows, jobs.instant(at)))
    assert merged.select("minute", "p50_ms", "p99_ms").collect() == exact.collect()
    assert merged.select("valid_events", "invalid_events").collect() == [(11 + 12 + 13 + 14, 6)]
