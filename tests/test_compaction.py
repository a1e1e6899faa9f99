"""Replays of bronze batches, lost checkpoints, and compaction under running streams."""

import shutil
from pathlib import Path

import pytest
from events import FIRST_SEQUENCE, event, records
from pyspark.sql import functions as F
from test_lake_and_jobs import data_files
from test_streaming import NOW, arrive, beat, drop_file, finish, gold_rows, processed_now
from test_readings import MESSAGES

from vitals.operators import gold, quality
from vitals.plans import jobs
from vitals.schemas import BRONZE, SILVER
from vitals.sources import compaction, manifest, streams
from vitals.sources import lake as tables
from vitals.sources.lake import Lake
from vitals.streaming import aggregates, ingest

FORMS = (tables.read_bronze, tables.read_silver, tables.read_quarantine)


def counts(spark, lake):
    return [read(spark, lake).count() for read in FORMS]


def derive(spark, lake, **pace):
    finish(ingest.bronze_to_silver(streams.bronze_stream(spark, lake.bronze, **pace), lake, processed_now()))
    finish(ingest.bronze_to_quarantine(streams.bronze_stream(spark, lake.bronze, **pace), lake))


def add_bronze(spark, lake, payloads, first, name=None):
    envelope = quality.to_envelope(records(spark, payloads, NOW, first=first))
    tables.write_batch(envelope, lake.bronze, name or tables.batch_name(envelope, "sequence_number"), "json")


def partition_filters(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters")[1:]]


def two_batches():
    late = [beat(i, 13, i) for i in range(3)]
    return [event(), *late, event(heart_rate=1), "junk"], [event(event_id="x"), beat(9, 14, 1), "more junk", event(steps=-1)]


@pytest.mark.parametrize("which", [0, 1])
def test_replay_of_one_bronze_batch_changes_no_count(spark, tmp_path, which):
    """Both batches are taken by one micro-batch; then one of them is written again, as after a crash."""
    lake, batches = Lake(str(tmp_path / "lake")), two_batches()
    for i, payloads in enumerate(batches):
        add_bronze(spark, lake, payloads, FIRST_SEQUENCE + 100 * i)
    derive(spark, lake)
    before, files = counts(spark, lake), set(data_files(lake.bronze))
    assert before == [10, 6, 4]
    add_bronze(spark, lake, batches[which], FIRST_SEQUENCE + 100 * which)
    assert set(data_files(lake.bronze)) != files
    derive(spark, lake)
    assert counts(spark, lake) == before
    assert tables.read_taken(spark, lake, "silver").count() == 2


def test_lost_checkpoints_and_other_paces_change_no_count(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for i, payloads in enumerate(two_batches()):
        add_bronze(spark, lake, payloads, FIRST_SEQUENCE + 100 * i)
    derive(spark, lake)
    before = [sorted(map(str, read(spark, lake).collect())) for read in FORMS]
    shutil.rmtree(f"{lake.root}/_checkpoints")
    derive(spark, lake, maxFilesPerTrigger="1")
    assert [sorted(map(str, read(spark, lake).collect())) for read in FORMS] == before


def test_a_partition_split_over_micro_batches_is_whole(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    arrive(inbox, "1.json", [event(event_id=f"{k}") for k in range(40)], FIRST_SEQUENCE)
    finish(ingest.events_to_bronze(streams.transport_records(spark, inbox), lake))
    (only,) = data_files(lake.bronze)
    lines = only.read_text().splitlines(keepends=True)
    for i in range(4):  # what a batch looks like whose hour was too large for one file
        (only.parent / f"part-split-{i}.json").write_text("".join(lines[i::4]))
    only.unlink()
    derive(spark, lake, maxFilesPerTrigger="1")
    assert counts(spark, lake) == [40, 40, 0]


def test_one_job_and_streams_put_rows_in_the_same_place(spark, tmp_path):
    lake, payloads = Lake(str(tmp_path / "lake")), two_batches()[0]
    jobs.route_batch(records(spark, payloads, NOW), lake, None, NOW)
    before = counts(spark, lake)
    derive(spark, lake)
    assert counts(spark, lake) == before == [6, 4, 2]


def test_readings_are_not_overwritten_without_their_checkpoint(spark, tmp_path):
    lake, inbox = Lake(str(tmp_path / "lake")), str(tmp_path / "in")
    drop_file(inbox, "1.txt", "\n".join(MESSAGES[:3]) + "\n")
    finish(ingest.readings_to_bronze(streams.text_messages(spark, inbox), lake))
    shutil.rmtree(f"{lake.root}/_checkpoints")
    other = str(tmp_path / "other")
    drop_file(other, "2.txt", MESSAGES[0] + "\n")
    with pytest.raises(ValueError, match="checkpoint that is lost"):
        ingest.readings_to_bronze(streams.text_messages(spark, other), lake)
    assert tables.read_readings(spark, lake.readings_bronze, "json").count() == 3


def test_a_hundred_batches_become_one_set_under_running_streams(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    sent = [quality.to_envelope(records(spark, [beat(i, 13 + i % 2, i % 50), "junk"], NOW, first=FIRST_SEQUENCE + 10 * i)) for i in range(100)]
    named = [rows.withColumn("batch", F.lit(f"b{i:03d}")) for i, rows in enumerate(sent)]

    def add(some):
        rows = some[0]
        for more in some[1:]:
            rows = rows.unionByName(more)
        tables.write_batches(rows, lake.bronze, "json")

    def refresh():
        silver = streams.silver_stream(spark, lake.silver)
        finish(aggregates.refresh_touched_hours(silver, lake, NOW))

    add(named[:60])
    derive(spark, lake)
    refresh()
    add(named[60:])  # the streams have yet to take these
    before = sorted(map(str, tables.read_bronze(spark, lake).collect()))
    assert len(before) == 200
    assert jobs.compact(spark, lake) == {"bronze": 1, "silver": 2, "quarantine": 1, "metrics": 0}
    assert sorted(map(str, tables.read_bronze(spark, lake).collect())) == before
    assert len(data_files(manifest.sets_path(lake.bronze))) == 1
    assert len(data_files(manifest.sets_path(lake.silver))) == 2
    # The replaced folders are left out while planning.
    assert any("NOT concat_ws" in f for f in partition_filters(tables.read_bronze(spark, lake)))

    # What no stream has taken yet stays, and reaches them.
    assert jobs.vacuum(spark, lake)["bronze"] == 60
    derive(spark, lake)
    refresh()
    assert counts(spark, lake) == [200, 100, 100]
    assert sorted(r.event_count for r in tables.read_gold(spark, lake).collect()) == [50, 50]
    assert gold_rows(tables.read_gold(spark, lake)) == gold_rows(gold.gold_hourly(tables.read_silver(spark, lake), processed_now()))

    # A replaced batch written again, taken again, and a new one beside the set.
    add(named[98:])
    add([quality.to_envelope(records(spark, [beat(500, 13, 5)], NOW, first=7)).withColumn("batch", F.lit("new"))])
    derive(spark, lake)
    refresh()
    assert counts(spark, lake) == [201, 101, 100]
    assert jobs.compact(spark, lake)["bronze"] == 1
    # Of the hundred, the first sixty are gone; two of the others were written again.
    assert jobs.vacuum(spark, lake)["bronze"] == 41
    assert counts(spark, lake) == [201, 101, 100] and data_files(lake.bronze) == []
    assert len(data_files(manifest.sets_path(lake.bronze))) == 1
    hour = tables.read_hours(spark, lake.silver, SILVER, [("2031-05-06", "13")])
    assert hour.count() == 51 and hour.schema == SILVER
    assert jobs.compact(spark, lake) == {"bronze": 0, "silver": 0, "quarantine": 0, "metrics": 0}


def test_sets_keep_partition_pruning(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for i in range(2):
        jobs.route_batch(records(spark, [beat(2 * i, 13, 1), beat(2 * i + 1, 3, 2)], NOW, first=FIRST_SEQUENCE + 10 * i), lake, None, NOW)
    jobs.compact(spark, lake)
    hour = tables.read_silver(spark, lake).where("dt = '2031-05-06' AND hour = '03'")
    assert hour.count() == 2
    filters = partition_filters(hour)
    assert len(filters) == 2 and all("isnotnull(hour#" in f and "concat_ws" in f for f in filters)


def test_only_one_of_two_compactions_is_published(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for i in range(2):
        add_bronze(spark, lake, [event(event_id=str(i))], FIRST_SEQUENCE + i)
    stale = manifest.read_manifest(spark, lake.bronze)
    assert compaction.compact(spark, lake.bronze, BRONZE, "json") == [("2031-05-06", "14")]
    stale.version += 1
    with pytest.raises(Exception, match="(?i)exist"):
        manifest.publish(spark, lake.bronze, stale)
    assert tables.read_bronze(spark, lake).count() == 2
    assert jobs.expire(spark, lake, NOW.replace(year=2032))["bronze"] == ["2031-05-06"]
    assert tables.read_bronze(spark, lake).count() == 0 and not list(Path(lake.root).rglob("part-*.json"))


