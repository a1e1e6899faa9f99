"""The event tables by name in another session."""

from events import FIRST_SEQUENCE, records
from test_compaction import partition_filters
from test_streaming import NOW, beat

from vitals.plans import jobs
from vitals.sources import catalog
from vitals.sources import lake as tables
from vitals.sources.lake import Lake

NAMES = ("bronze_events", "silver_events", "quarantine_events", "gold_device_hourly")


def test_another_session_reads_tables_by_name(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    spark.sql("CREATE DATABASE IF NOT EXISTS shared")
    route = lambda i, payloads: jobs.route_batch(records(spark, payloads, NOW, first=FIRST_SEQUENCE + 10 * i), lake, None, NOW)
    route(0, [beat(1, 13, 1), beat(2, 14, 1), "junk"])
    jobs.refresh_gold(spark, lake, NOW)
    assert catalog.publish(spark, lake, "shared") == {
        "bronze_events": (1, 0), "silver_events": (2, 0), "quarantine_events": (1, 0), "gold_device_hourly": (2, 0),
    }
    other = spark.newSession()
    counts = lambda: [other.table(f"shared.{n}").count() for n in NAMES]
    assert counts() == [3, 2, 1, 2]
    route(1, [beat(3, 13, 2), "more"])
    assert counts() == [3, 2, 1, 2]  # not yet published
    assert catalog.publish(spark, lake, "shared")["silver_events"] == (1, 0)
    assert counts() == [5, 3, 2, 2]
    jobs.compact(spark, lake)
    assert catalog.publish(spark, lake, "shared")["silver_events"] == (1, 2)
    assert counts() == [5, 3, 2, 2]
    hour = other.sql("SELECT event_id, batch FROM shared.silver_events WHERE dt = '2031-05-06' AND hour = '13'")
    assert sorted(r.event_id for r in hour.collect()) == ["e1", "e3"]
    assert {r.batch[:4] for r in hour.collect()} == {"set-"}
    assert "isnotnull(hour#" in partition_filters(hour)[0] and len(hour.inputFiles()) == 1
    assert catalog.publish(spark, lake, "shared")["silver_events"] == (0, 0)
    jobs.expire(spark, lake, NOW.replace(year=2032))
    assert catalog.publish(spark, lake, "shared")["bronze_events"][0] == 0
    assert counts() == [0, 0, 0, 0]
    for name in NAMES:
        spark.sql(f"DROP TABLE shared.{name}")
    assert tables.path_exists(spark, lake.root)
