import json
import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from events import FIRST_SEQUENCE, LATER, as_json_lines, event, record, records
from pyspark.sql import functions as F
from test_readings import GOOD, MESSAGES

from vitals.operators import enrich, gold, quality
from vitals.plans import jobs, streamed
from vitals.plans.check_sql import CHECK_SQL
from vitals.schemas import CLOSING, MINUTES, SILVER
from vitals.session import checkpoint_for
from vitals.sources import derived, streams
from vitals.sources import lake as tables
from vitals.sources.lake import Lake
from vitals.streaming import aggregates, alerting, ingest

NOW = datetime(2031, 5, 6, 14, 50, tzinfo=timezone.utc)
def processed_now():
    return F.lit("2031-05-06 14:50:00").cast("timestamp")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


_clock = iter(range(1, 10_000))


def drop_file(folder, name, text):
    """File sources order by modification time; give each file its own second."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    target = folder / name
    target.write_text(text)
    stamp = 1_700_000_000 + next(_clock)
    os.utime(target, (stamp, stamp))


def arrive(folder, name, payloads, first, arrival=NOW):
    drop_file(folder, name, as_json_lines([record(p, first + i, arrival) for i, p in enumerate(payloads)]))


def test_checkpoints_lie_below_the_lake():
    one, other = checkpoint_for("/lake/", "s", "/lake/a"), checkpoint_for("/lake", "s", "/lake/b")
    assert one != other and one.startswith("/lake/_checkpoints/s-")
    assert one == checkpoint_for("/lake", "s", "/lake/a")


def test_readings_to_bronze_is_lenient_and_incremental(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    drop_file(inbox, "1.txt", "\n".join(MESSAGES[:3]) + "\n")
    finish(ingest.readings_to_bronze(streams.text_messages(spark, inbox), lake))
    assert tables.read_readings(spark, lake.readings_bronze, "json").count() == 3
    drop_file(inbox, "2.txt", GOOD + "\n")
    finish(ingest.readings_to_bronze(streams.text_messages(spark, inbox), lake))
    rows = tables.read_readings(spark, lake.readings_bronze, "json").collect()
    assert len(rows) == 4
    assert sum(r.device_id is None for r in rows) == 1


def test_alert_streams(spark, tmp_path):
    inbox = str(tmp_path / "in")
    texts = [GOOD, GOOD.replace("35", "72"), "oops"]
    drop_file(inbox, "1.txt", "\n".join(texts) + "\n")
    lake = Lake(str(tmp_path / "lake"))
    finish(alerting.publish_alerts(streams.text_messages(spark, inbox), lake, str(tmp_path / "alerts")))
    finish(alerting.report_malformed(streams.text_messages(spark, inbox), lake, str(tmp_path / "bad")))
    published = spark.read.schema("key STRING, value STRING").json(str(tmp_path / "alerts")).collect()
    assert [(r.key, r.value) for r in published] == [("chest-strap", GOOD)]
    assert [r.json for r in spark.read.schema("json STRING").json(str(tmp_path / "bad")).collect()] == ["oops"]

    alerts = spark.readStream.schema("key STRING, value STRING").json(str(tmp_path / "alerts"))
    sent = alerting.render_notifications(alerts.select(F.col("value").alias("json")), lake, str(tmp_path / "mail"))
    finish(sent)
    files = Path(tmp_path / "mail").glob("part-*")
    mail = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert [m["subject"] for m in mail] == ["[vitals] ALERTE BPM critique — device chest-strap"]


def test_three_way_routing_through_bronze(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    payloads = [event(), event(event_id="late", timestamp="2031-05-06T13:00:00Z"), event(heart_rate=1), "junk"]

    def run():
        finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
        bronze = streams.bronze_stream(spark, lake.bronze)
        finish(ingest.bronze_to_silver(bronze, lake, processed_now()))
        finish(ingest.bronze_to_quarantine(streams.bronze_stream(spark, lake.bronze), lake))

    arrive(inbox, "1.json", payloads, FIRST_SEQUENCE)
    run()
    arrive(inbox, "2.json", payloads[:1], LATER)
    run()
    run()  # nothing new: nothing is written twice
    counts = [t(spark, lake).count() for t in (tables.read_bronze, tables.read_silver, tables.read_quarantine)]
    assert counts == [5, 3, 2]
    assert {r.hour for r in tables.read_silver(spark, lake).collect()} == {"13", "14"}
    rejected = tables.read_quarantine(spark, lake).orderBy("sequence_number").collect()
    assert [r.errors for r in rejected] == [[quality.BAD_HEART_RATE], [quality.NOT_JSON]]
    assert {r.hour for r in rejected} == {"14"}


def test_routing_each_payload_once(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    arrive(inbox, "1.json", [event(), "junk"], FIRST_SEQUENCE)
    finish(ingest.route_events(streams.transport_records(spark, inbox), lake, NOW))
    arrive(inbox, "2.json", [event(event_id="2")], LATER)
    finish(ingest.route_events(streams.transport_records(spark, inbox), lake, NOW))
    counts = [t(spark, lake).count() for t in (tables.read_bronze, tables.read_silver, tables.read_quarantine)]
    assert counts == [3, 2, 1]
    finish(aggregates.refresh_touched_hours(streams.silver_stream(spark, lake.silver), lake, NOW))
    assert [r.event_count for r in tables.read_gold(spark, lake).collect()] == [2]


def beat(i, hour, minute, device="watch-a", day="2031-05-06", **changes):
    stamp = f"{day}T{hour:02d}:{minute:02d}:00Z"
    return event(event_id=f"e{i}", device_id=device, timestamp=stamp, **changes)


def gold_rows(frame):
    return sorted(tuple(r) for r in frame.drop("aggregated_at").collect())


def test_touched_hours_are_rebuilt_however_late(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")

    def run():
        finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
        finish(ingest.bronze_to_silver(streams.bronze_stream(spark, lake.bronze), lake, processed_now()))
        finish(aggregates.refresh_touched_hours(streams.silver_stream(spark, lake.silver), lake, NOW))

    arrive(inbox, "1.json", [beat(1, 14, 1), beat(2, 13, 1)], FIRST_SEQUENCE)
    run()
    untouched = sorted(Path(f"{lake.gold}/dt=2031-05-06/hour=14").glob("*.parquet"))
    arrive(inbox, "2.json", [beat(3, 13, 2), beat(2, 13, 1), beat(4, 2, 0, day="2031-04-29")], LATER)
    run()
    counts = {(r.dt, r.hour): r.event_count for r in tables.read_gold(spark, lake).collect()}
    assert counts == {("2031-05-06", "14"): 1, ("2031-05-06", "13"): 2, ("2031-04-29", "02"): 1}
    assert sorted(Path(f"{lake.gold}/dt=2031-05-06/hour=14").glob("*.parquet")) == untouched
    full = gold.gold_hourly(tables.read_silver(spark, lake), processed_now())
    assert gold_rows(tables.read_gold(spark, lake)) == gold_rows(full)


def test_windowed_gold_equals_batch_gold_without_late_rows(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    inbox = str(tmp_path / "in")
    batches = [
        [beat(1, 10, 5, battery=70), beat(2, 10, 50, heart_rate=30), beat(1, 10, 5, battery=70)],
        [beat(3, 11, 10), beat(1, 11, 20, "watch-b"), beat(4, 11, 30, spo2=90)],
        [beat(5, 12, 1), beat(6, 13, 30)],
    ]
    for i, batch in enumerate(batches):
        arrive(inbox, f"{i}.json", batch, FIRST_SEQUENCE + 100 * i, NOW + timedelta(hours=i))
        finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
        finish(ingest.bronze_to_silver(streams.bronze_stream(spark, lake.bronze), lake, processed_now()))
    silver = streams.silver_stream(spark, lake.silver, maxFilesPerTrigger="1")
    hourly = aggregates.windowed_gold(silver, processed_now())
    finish(streams.start(hourly, "gold-windows", "parquet", lake.root, str(tmp_path / "gold")))
    streamed = tables.read_table(spark, str(tmp_path / "gold"), tables.GOLD)
    # The watermark stands at 12:30: hours 10 and 11 are final, 12 and 13 are still open.
    batch = gold.gold_hourly(tables.read_silver(spark, lake), processed_now()).where("hour < '12'")
    assert gold_rows(streamed) == gold_rows(batch)
    assert {r.hour for r in streamed.collect()} == {"10", "11"}


def test_windowed_metrics(spark, tmp_path):
    inbox = str(tmp_path / "in")
    first = datetime(2031, 5, 6, 14, 30, 5, tzinfo=timezone.utc)
    arrive(inbox, "1.json", [event(heart_rate=30), event(), "junk"], FIRST_SEQUENCE, first)
    arrive(inbox, "2.json", [event()], LATER, first + timedelta(minutes=10))
    records = streams.transport_records(spark, inbox, maxFilesPerTrigger="1")
    classified = quality.classify(
        quality.with_arrival(quality.to_envelope(records)).withColumn(
            "processed_ts", F.col("arrival_ts") + F.expr("INTERVAL 1 SECOND")
        )
    )
    query = streams.start(
        aggregates.windowed_metrics(classified), "metrics", "parquet", str(tmp_path), str(tmp_path / "metrics")
    )
    finish(query)
    rows = aggregates.minute_metrics(spark.read.parquet(str(tmp_path / "metrics"))).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.minute == datetime(2031, 5, 6, 14, 30)
    assert (row.valid_events, row.invalid_events, row.abnormal_heart_rate) == (2, 1, 1)
    assert (row.p50_ms, row.max_lag_ms) == (118_750, 1000)


def events_out_of_order(sf_dir, folder, files=5):
    """The given events as a folder of files, in the order of time but dealt out in another order."""
    events = pq.read_table(f"{sf_dir}/events.parquet").sort_by("ts")
    size = -(-events.num_rows // files)
    target = Path(folder) / "events.parquet"
    target.mkdir(parents=True)
    for i in (3, 0, 4, 1, 2)[:files]:
        pq.write_table(events.slice(i * size, size), target / f"{i}.parquet")
        stamp = 1_700_000_000 + next(_clock)
        os.utime(target / f"{i}.parquet", (stamp, stamp))
    return str(folder)


def test_stream_metrics_lose_no_record_of_late_files(spark, sf_dir, tmp_path):
    """All minutes, the last ones open, from files out of the order of time."""
    folder = events_out_of_order(sf_dir, tmp_path / "sf")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    relation = duck.sql(CHECK_SQL["stream_metrics"])
    found = streamed.stream_metrics(spark, folder)
    assert sorted(map(tuple, found.select(relation.columns).collect())) == sorted(relation.fetchall())
    sums = found.agg(F.sum("valid_events") + F.sum("invalid_events"), F.count_if(~F.col("is_closed"))).first()
    assert sums[0] == derived.raw_events(spark, sf_dir).count() and sums[1] > 0
    duck.close()


def timed_events(spark, inbox, **options):
    records = streams.transport_records(spark, inbox, **options)
    classified = quality.classify(quality.with_arrival(quality.to_envelope(records)))
    return classified.withColumn("processed_ts", F.col("arrival_ts") + F.expr("INTERVAL 1 SECOND"))


def minutes_of(spark, lake):
    rows = tables.read_table(spark, lake.minutes, MINUTES).orderBy("minute").collect()
    return [(f"{r.minute:%H:%M}", r.valid_events, r.invalid_events, r.is_closed) for r in rows]


def test_minutes_are_replaced_in_place(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    at = lambda hour, minute: datetime(2031, 5, 6, hour, minute, 5, tzinfo=timezone.utc)

    def run():
        finish(aggregates.keep_minutes(timed_events(spark, inbox), lake))
        return minutes_of(spark, lake)

    arrive(inbox, "1.json", [event(), "junk"], FIRST_SEQUENCE, at(14, 58))
    assert run() == [("14:58", 1, 1, False)]
    # The next hour closes a minute of the hour before; its own is open.
    arrive(inbox, "2.json", [event()], LATER, at(15, 1))
    assert run() == [("14:58", 1, 1, True), ("15:01", 1, 0, False)]
    # A record of a closed minute still counts, and the minute stays closed.
    arrive(inbox, "3.json", [event(event_id="late")], LATER + 10, at(14, 58))
    assert run() == [("14:58", 2, 1, True), ("15:01", 1, 0, False)]
    arrive(inbox, "4.json", [event(event_id="on")], LATER + 20, at(15, 3))
    assert run() == [("14:58", 2, 1, True), ("15:01", 1, 0, True), ("15:03", 1, 0, False)]
    # The last micro-batch once more, as after a crash before it was committed.
    for commits in Path(lake.root).glob("_checkpoints/minutes-*/commits"):
        newest = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
        (commits / str(newest)).unlink()
        (commits / f".{newest}.crc").unlink(missing_ok=True)
    assert run() == [("14:58", 2, 1, True), ("15:01", 1, 0, True), ("15:03", 1, 0, False)]


def silver_part(spark, lake, batch, payloads, first):
    classified = quality.classify(quality.with_arrival(quality.to_envelope(records(spark, payloads, NOW, first=first))))
    silver = enrich.to_silver(classified.withColumn("batch", F.lit(batch)), processed_now(), keep=["batch"])
    tables.write_batches(silver, lake.silver, "parquet")


def report(spark, lake):
    return {(r.dt[-2:], r.hour): (r.emitted, r.late_events, r.open) for r in aggregates.late_report(spark, lake).collect()}


def test_late_events_are_kept_and_counted(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def run():
        finish(aggregates.emit_closed_hours(streams.silver_stream(spark, lake.silver), lake, NOW))

    silver_part(spark, lake, "a", [beat(1, 10, 5), beat(2, 10, 50), beat(1, 10, 5), beat(3, 11, 10)], FIRST_SEQUENCE)
    run()
    assert report(spark, lake) == {("06", "10"): (0, 0, 2), ("06", "11"): (0, 0, 1)}
    # The watermark passes hours 10 and 11; an hour late is in time.
    silver_part(spark, lake, "b", [beat(4, 13, 30), beat(5, 11, 40)], FIRST_SEQUENCE + 10)
    run()
    assert report(spark, lake) == {("06", "10"): (2, 0, 0), ("06", "11"): (2, 0, 0), ("06", "13"): (0, 0, 1)}
    # Late: a new event, and one that gold has already; the day before was never open.
    silver_part(spark, lake, "c", [beat(6, 10, 20), beat(2, 10, 50), beat(7, 9, 0, day="2031-05-05"), beat(8, 13, 31)], FIRST_SEQUENCE + 20)
    run()
    expected = {("05", "09"): (0, 1, 0), ("06", "10"): (2, 1, 0), ("06", "11"): (2, 0, 0), ("06", "13"): (0, 0, 2)}
    assert report(spark, lake) == expected
    assert tables.read_table(spark, lake.late, SILVER).count() == 3
    before = gold_rows(tables.read_table(spark, lake.closed_gold, tables.GOLD))
    # Partitions written again are judged as before.
    silver_part(spark, lake, "c", [beat(6, 10, 20), beat(2, 10, 50), beat(7, 9, 0, day="2031-05-05"), beat(8, 13, 31)], FIRST_SEQUENCE + 20)
    silver_part(spark, lake, "a", [beat(1, 10, 5), beat(2, 10, 50), beat(1, 10, 5), beat(3, 11, 10)], FIRST_SEQUENCE)
    run()
    assert report(spark, lake) == expected and tables.read_table(spark, lake.late, SILVER).count() == 3
    assert gold_rows(tables.read_table(spark, lake.closed_gold, tables.GOLD)) == before
    distinct = tables.read_silver(spark, lake).select("event_id", "dt", "hour").distinct().count()
    assert sum(map(sum, expected.values())) == distinct
    progress = tables.read_table(spark, lake.closing, CLOSING)
    assert progress.agg(F.sum("on_time"), F.sum("late")).first()[:] == (7 + 5, 3 + 3)


def test_compaction_leaves_batches_that_closed_hours_need(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def run():
        silver = streams.silver_stream(spark, lake.silver)
        finish(aggregates.refresh_touched_hours(silver, lake, NOW))
        finish(aggregates.emit_closed_hours(silver, lake, NOW))

    silver_part(spark, lake, "a", [beat(1, 10, 5)], FIRST_SEQUENCE)
    silver_part(spark, lake, "b", [beat(2, 10, 6)], FIRST_SEQUENCE + 10)
    run()
    assert jobs.compact(spark, lake)["silver"] == 1 and jobs.vacuum(spark, lake)["silver"] == 0
    silver_part(spark, lake, "c", [beat(3, 13, 0)], FIRST_SEQUENCE + 20)
    run()
    assert report(spark, lake) == {("06", "10"): (2, 0, 0), ("06", "13"): (0, 0, 1)}
    assert {(r.hour, r.event_count) for r in tables.read_gold(spark, lake).collect()} == {("10", 2), ("13", 1)}


def test_windowed_gold_counts_what_it_drops(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    batches = [[beat(1, 7, 5), beat(2, 7, 50)], [beat(3, 10, 30)], [beat(4, 7, 20), beat(5, 10, 40)], [beat(6, 14, 1)]]
    query = None
    for i, batch in enumerate(batches):
        silver_part(spark, lake, f"b{i}", batch, FIRST_SEQUENCE + 10 * i)
        silver = streams.silver_stream(spark, lake.silver)
        query = finish(streams.start(aggregates.windowed_gold(silver, processed_now()), "gold-windows", "parquet", lake.root, str(tmp_path / "gold")))
        if i == 2:
            assert aggregates.dropped_rows(query) == 1
    emitted = tables.read_table(spark, str(tmp_path / "gold"), tables.GOLD)
    assert {(r.hour, r.event_count) for r in emitted.collect()} == {("07", 2), ("10", 2)}


def shuffled_files(inbox, n=6):
    """The same events in files that arrive out of order of time."""
    for i in (3, 0, 5, 1, 4, 2)[:n]:
        arrive(inbox, f"{i}.json", [beat(10 * i + k, (5 * i + k) % 24, k, day="2031-05-05") for k in range(8)], FIRST_SEQUENCE + 100 * i)


def test_gold_does_not_depend_on_batches(spark, tmp_path):
    results = []
    for pace in ({"maxFilesPerTrigger": "1"}, {}):
        lake, inbox = Lake(str(tmp_path / f"lake{len(pace)}")), str(tmp_path / f"in{len(pace)}")
        shuffled_files(inbox)
        finish(ingest.events_to_bronze(streams.transport_records(spark, inbox, **pace), lake))
        finish(ingest.bronze_to_silver(streams.bronze_stream(spark, lake.bronze, **pace), lake, processed_now()))
        finish(aggregates.refresh_touched_hours(streams.silver_stream(spark, lake.silver, **pace), lake, NOW))
        results.append(gold_rows(tables.read_gold(spark, lake)))
        assert results[-1] == gold_rows(gold.gold_hourly(tables.read_silver(spark, lake), processed_now()))
    assert results[0] == results[1] and sum(r[1] for r in results[0]) == 48


def route_all(spark, lake, inbox):
    finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
    finish(ingest.bronze_to_silver(streams.bronze_stream(spark, lake.bronze), lake, processed_now()))
    finish(ingest.bronze_to_quarantine(streams.bronze_stream(spark, lake.bronze), lake))


def test_restart_in_a_new_process_loses_and_repeats_nothing(spark, tmp_path):
    """Nothing of the first run is kept but the lake: a new process finds its checkpoints there."""
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    for i in range(3):
        arrive(inbox, f"{i}.json", [event(event_id=f"{i}-{k}") for k in range(10)], FIRST_SEQUENCE + 10 * i)
        route_all(spark.newSession(), Lake(str(tmp_path / "lake")), inbox)
    bronze, silver = tables.read_bronze(spark, lake), tables.read_silver(spark, lake)
    assert bronze.count() == bronze.select("sequence_number").distinct().count() == 30
    assert silver.count() == silver.select("event_id").distinct().count() == 30


def test_tables_written_by_streams_can_be_expired(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    old = datetime(2031, 3, 1, 12, tzinfo=timezone.utc)
    arrive(inbox, "1.json", [event(timestamp="2031-03-01T11:59:00Z"), "junk"], FIRST_SEQUENCE, old)
    arrive(inbox, "2.json", [event(), "junk"], LATER)
    route_all(spark, lake, inbox)
    removed = jobs.expire(spark, lake, NOW)
    assert [removed[t] for t in ("bronze", "silver", "quarantine")] == [["2031-03-01"]] * 3
    counts = [t(spark, lake).groupBy("hour").count().collect() for t in (tables.read_bronze, tables.read_silver, tables.read_quarantine)]
    assert [[r["count"] for r in rows] for rows in counts] == [[2], [1], [1]]


def test_two_jobs_share_a_table(spark, tmp_path):
    lake, inbox, other = Lake(str(tmp_path / "lake")), str(tmp_path / "in"), str(tmp_path / "other")
    arrive(inbox, "1.json", [event(event_id=f"a{k}") for k in range(20)], FIRST_SEQUENCE)
    arrive(other, "1.json", [event(event_id=f"b{k}") for k in range(10)], LATER)
    finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
    finish(ingest.route_events(streams.transport_records(spark, other), lake, NOW))
    assert tables.read_bronze(spark, lake).select("sequence_number").distinct().count() == 30
    # The same records in a batch of another job replace themselves.
    finish(ingest.route_events(streams.transport_records(spark, inbox), Lake(str(tmp_path / "lake") + "/"), NOW))
    assert tables.read_bronze(spark, lake).count() == 30


def test_broker_source_options(spark):
    """The connector is not on this class path; asking for it must say so, not fail otherwise."""
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_messages(spark, "localhost:9092", "readings", "latest", group="alert-detector")
