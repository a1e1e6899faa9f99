"""What every registered plan must and must not contain."""

import pytest

from __spark_entry__ import entry
from vitals.plans.registry import QUERIES
from vitals.session import RUNTIME_CONF

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "FlatMapGroups"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan(spark, sf_dir, key):
    plan = plan_of(QUERIES[key](spark, sf_dir))
    assert [word for word in FORBIDDEN if word in plan] == []
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        # Only what was reduced on every task before may be brought together in one.
        if "Exchange SinglePartition" in above:
            assert "partial_" in below or "Limit" in below, (above, below)


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["bpm_by_hour_of_day"](spark, sf_dir))
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "event_type" not in schema
    timing = plan_of(QUERIES["throughput_per_minute"](spark, sf_dir))
    assert "parseJson" not in timing and "props" not in timing


REPORTS = (
    "silver_hour_scan", "latest_events", "hourly_device_metrics", "abnormal_heart_rate", "device_leaderboard", "data_quality",
    "needs_attention", "gold_run_report", "hours_to_process", "retained_partitions",
)


@pytest.mark.parametrize("key", REPORTS)
def test_reports_read_the_days_they_show(spark, sf_dir, key):
    """Every scan prunes days while planning and parses nothing."""
    frame = QUERIES[key](spark, sf_dir)
    plan = plan_of(frame)
    assert "parseJson" not in plan
    scans = plan.split("PartitionFilters: [")[1:]
    assert scans and all(scan.split("]")[0].count("dt#") > 0 for scan in scans)


def test_entry_is_the_flagship(spark):
    frame = entry(spark)
    assert "last_battery" in frame.columns
    assert frame.count() > 0


def test_results_do_not_depend_on_the_session_zone(spark, sf_dir):
    expected = {tuple(r) for r in QUERIES["gold_hourly"](spark, sf_dir).collect()}
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert {tuple(r) for r in QUERIES["gold_hourly"](other, sf_dir).collect()} == expected


def test_generated_methods_are_small_enough_to_be_compiled(spark, sf_dir, monkeypatch):
    """The JVM never compiles a method of more than 8000 bytes; it would be interpreted per row."""
    monkeypatch.setitem(RUNTIME_CONF, "spark.sql.adaptive.enabled", "false")
    plain = spark.newSession()
    debug = plain._jvm.org.apache.spark.sql.execution.debug.__getattr__("package")
    for key in ("validate_events", "gold_hourly", "metrics_per_minute", "parse_readings", "answers"):
        plan = QUERIES[key](plain, sf_dir)._jdf.queryExecution().executedPlan()
        stages = debug.codegenStringSeq(plan).iterator()
        sizes = []
        while stages.hasNext():
            sizes.append(stages.next()._3().maxMethodCodeSize())
        assert sizes and max(sizes) < 8000, (key, sizes)
