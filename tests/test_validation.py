import json
from datetime import datetime, timezone

import pytest
from events import ARRIVAL, event, records
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitals.functions.clock import parse_epoch, utc_text, with_iso_instant
from vitals.functions.documents import with_document
from vitals.functions.health import Thresholds, half_even, heart_rate_zone, spo2_status
from vitals.operators import enrich, quality

OUT_OF_RANGE = "timestamp out of accepted range"
UNPARSEABLE = "timestamp missing or unparseable"


def classify(spark, payloads):
    classified = quality.classify(quality.with_arrival(quality.to_envelope(records(spark, payloads))))
    return classified.orderBy("sequence_number").collect()


CASES = [
    ("valid", event(), []),
    ("heart rate too high", event(heart_rate=777), [quality.BAD_HEART_RATE]),
    ("heart rate as text", event(heart_rate="66"), [quality.BAD_HEART_RATE]),
    ("heart rate as boolean", event(heart_rate=False), [quality.BAD_HEART_RATE]),
    ("heart rate as decimal", event(heart_rate=66.0), [quality.BAD_HEART_RATE]),
    ("heart rate beyond 32 bits", event(heart_rate=2**40), [quality.BAD_HEART_RATE]),
    ("heart rate beyond 64 bits", event(heart_rate=2**70), [quality.BAD_HEART_RATE]),
    ("heart rate at its bounds", event(heart_rate=20), []),
    ("heart rate at its upper bound", event(heart_rate=250), []),
    ("heart rate below", event(heart_rate=19), [quality.BAD_HEART_RATE]),
    ("steps negative", event(steps=-40), [quality.BAD_STEPS]),
    ("steps at most", event(steps=10_000), []),
    ("steps too many", event(steps=10_001), [quality.BAD_STEPS]),
    ("spo2 above", event(spo2=100.5), [quality.BAD_SPO2]),
    ("spo2 integer", event(spo2=50), []),
    ("spo2 as text", event(spo2="98"), [quality.BAD_SPO2]),
    ("spo2 not a number", event(spo2=float("nan")), [quality.BAD_SPO2]),
    ("spo2 infinite", event(spo2=float("-inf")), [quality.BAD_SPO2]),
    ("not a number in another field", event(extra=float("nan")), []),
    ("the words inside a text", event(extra='NaN "Infinity" \\'), []),
    ("battery above", event(battery=1000), [quality.BAD_BATTERY]),
    ("battery missing", event(battery=...), [quality.BAD_BATTERY]),
    ("device empty", event(device_id=""), [quality.BAD_DEVICE_ID]),
    ("device with spaces", event(device_id="left arm"), [quality.BAD_DEVICE_ID]),
    ("device too long", event(device_id="x" * 65), [quality.BAD_DEVICE_ID]),
    ("device longest", event(device_id="x" * 64), []),
    ("device final newline", event(device_id="band-7\n"), []),
    ("device two newlines", event(device_id="band-7\n\n"), [quality.BAD_DEVICE_ID]),
    ("device as number", event(device_id=5), [quality.BAD_DEVICE_ID]),
    ("event id null", event(event_id=None), [quality.BAD_EVENT_ID]),
    ("event id number", event(event_id=5), [quality.BAD_EVENT_ID]),
    ("event id empty", event(event_id=""), [quality.BAD_EVENT_ID]),
    ("timestamp words", event(timestamp="half past nine"), [UNPARSEABLE]),
    ("timestamp special word", event(timestamp="now"), [UNPARSEABLE]),
    ("timestamp year only", event(timestamp="2026"), [UNPARSEABLE]),
    ("timestamp boolean", event(timestamp=True), [UNPARSEABLE]),
    ("timestamp null", event(timestamp=None), [UNPARSEABLE]),
    ("timestamp no such day", event(timestamp="2026-02-30T00:00:00Z"), [UNPARSEABLE]),
    ("timestamp huge", event(timestamp=1e300), [UNPARSEABLE]),
    ("timestamp in the future", event(timestamp="2031-05-07T00:00:00Z"), [OUT_OF_RANGE]),
    ("timestamp within the skew", event(timestamp="2031-05-06T14:35:00Z"), []),
    ("timestamp just beyond the skew", event(timestamp="2031-05-06T14:35:00.001Z"), [OUT_OF_RANGE]),
    ("timestamp too old", event(timestamp="2014-07-08T09:10:11Z"), [OUT_OF_RANGE]),
    ("timestamp negative", event(timestamp=-5), [OUT_OF_RANGE]),
    ("epoch seconds", event(timestamp=1935842400), []),
    ("epoch milliseconds", event(timestamp=1935842400000), []),
    ("epoch as decimal", event(timestamp=1935842400.25), []),
    (
        "several reasons, in order",
        event(battery=-1, event_id=None, steps=True, timestamp="x"),
        [quality.BAD_EVENT_ID, UNPARSEABLE, quality.BAD_STEPS, quality.BAD_BATTERY],
    ),
    (
        "everything missing",
        {},
        [
            quality.BAD_EVENT_ID, quality.BAD_DEVICE_ID, UNPARSEABLE, quality.BAD_HEART_RATE,
            quality.BAD_STEPS, quality.BAD_SPO2, quality.BAD_BATTERY,
        ],
    ),
    ("array", [0, "x"], [quality.NOT_OBJECT]),
    ("null", "null", [quality.NOT_OBJECT]),
    ("text value", '"x"', [quality.NOT_OBJECT]),
    ("a bare not-a-number", "NaN", [quality.NOT_OBJECT]),
    ("garbage", "<binary \x01", [quality.NOT_JSON]),
    ("empty", "", [quality.NOT_JSON]),
    ("trailing text", json.dumps(event()) + " trailing", [quality.NOT_JSON]),
    ("two documents", json.dumps(event()) * 2, [quality.NOT_JSON]),
    ("closing the frame", json.dumps(event()) + "]", [quality.NOT_JSON]),
    ("two elements", json.dumps(event()) + "," + json.dumps(event()), [quality.NOT_JSON]),
    ("single quotes", str(event()), [quality.NOT_JSON]),
    ("surrounding blanks", f" \n{json.dumps(event())}\t", []),
    ("repeated key, last wins", json.dumps(event())[:-1] + ', "heart_rate": 777}', [quality.BAD_HEART_RATE]),
    ("invalid UTF-8 in a text", b'{"event_id":"\xff"}', None),
]


def test_reasons(spark):
    rows = classify(spark, [payload for _, payload, _ in CASES])
    wrong = [
        (name, row.errors, expected)
        for (name, _, expected), row in zip(CASES, rows)
        if expected is not None and row.errors != expected
    ]
    assert wrong == []


def test_long_hostile_text_is_processed_whole(spark):
    """The pattern replacing bare NaN must not recurse on long texts."""
    long_text = '"' + "\\n" * 200_000 + '"'
    payloads = [event(extra="x" * 300_000), "[" + long_text + ", NaN]", "NaN " * 100_000]
    rows = classify(spark, payloads)
    assert [r.errors for r in rows] == [[], [quality.NOT_OBJECT], [quality.NOT_JSON]]


TEXTS = st.one_of(
    st.recursive(
        st.none() | st.booleans() | st.integers(-(2**60), 2**60) | st.text(max_size=8),
        lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
        max_leaves=6,
    ).map(json.dumps),
    st.text(alphabet='{}[]",:0123456789.eE-+ntrufalsNaIiy \\', max_size=12),
)


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(TEXTS, min_size=40, max_size=80))
def test_json_strictness_agrees_with_python(spark, texts):
    def strict(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    got = with_document(frame, "t", ["a"]).orderBy("i").collect()
    assert [(t, r.is_json) for t, r in zip(texts, got)] == [(t, strict(t)) for t in texts]


ISO = [
    "2031-05-06", "20260927", "2026-W39-7", "2026W397", "2026-W39", "2026W39", "2026-W53-1", "2026-W54-1",
    "2031-05-06T14", "2031-05-06T1430", "2031-05-06 14:30", "2031-05-06T14:30:59", "2031-05-06x14:30:59.5",
    "2031-05-06T14:30:59,123456789", "20260927T143059.25", "20260927T143059+0530", "2031-05-06T14:30:59Z",
    "2031-05-06T14:30:59-08", "2031-05-06T14:30:59+23:30", "2031-05-06T14:30:59+24:00",
    "2031-05-06T14:30:59+05:30:15.5", "2026-02-30T00:00:00", "2031-05-06T24:00:00", "2031-05-06T14:60:00",
    "2031-05-06T14:30:60", "2026-9-27", "2026-0927", "now", "14:30", "", "2031-05-06T14:30:59 ",
    "0000-01-01T00:00:00", "0001-01-01T00:00:00", "9999-12-31T23:59:59.999999", "2031-05-06T14:30:59z",
]


def test_iso_forms_agree_with_python(spark):
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def python_micros(text):
        try:
            moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        delta = moment - epoch
        return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds

    frame = spark.createDataFrame([(t,) for t in ISO], "t STRING")
    rows = with_iso_instant(frame, "t", "x").select("t", F.unix_micros("x").alias("m")).collect()
    assert {r.t: r.m for r in rows} == {t: python_micros(t) for t in ISO}


@pytest.mark.parametrize(
    "number, micros",
    [
        (1935842400.0, 1935842400000000),
        (1935842400000.0, 1935842400000000),
        (1935842399500.0, 1935842399500000),
        (1e11, 100000000000000000),
        (1.5, 1500000),
        (-0.5, -500000),
        (2.6e14, None),
        (-1e11, None),
    ],
)
def test_epoch_numbers(spark, number, micros):
    frame = spark.createDataFrame([(number,)], "n DOUBLE")
    assert frame.select(F.unix_micros(parse_epoch(F.col("n")))).first()[0] == micros


def test_zones_and_statuses(spark):
    zones = {
        30: "bradycardia", 39: "bradycardia", 40: "resting", 99: "resting", 100: "light", 129: "light",
        130: "moderate", 159: "moderate", 160: "vigorous", 180: "vigorous", 181: "tachycardia",
    }
    frame = spark.createDataFrame([(k,) for k in zones], "hr INT")
    assert {r[0]: r[1] for r in frame.select("hr", heart_rate_zone(F.col("hr"))).collect()} == zones
    statuses = {99.0: "normal", 95.0: "normal", 94.9: "low", 90.0: "low", 89.9: "critical"}
    frame = spark.createDataFrame([(k,) for k in statuses], "s DOUBLE")
    assert {r[0]: r[1] for r in frame.select("s", spo2_status(F.col("s"))).collect()} == statuses


def test_high_threshold_must_exceed_100():
    assert Thresholds(low=50, high=101).high == 101
    with pytest.raises(ValueError):
        Thresholds(high=100)


def test_half_even_rounding(spark):
    values = {0.125: 0.12, 0.375: 0.38, 58.333333333333336: 58.33, 2.5: 2.5}
    frame = spark.createDataFrame([(k,) for k in values], "x DOUBLE")
    assert {r[0]: r[1] for r in frame.select("x", half_even(F.col("x"), 2)).collect()} == values


def test_envelope(spark):
    rows = quality.to_envelope(records(spark, [event(), b"\xff\xfe"])).orderBy("sequence_number").collect()
    assert json.loads(rows[0].payload) == event()
    assert rows[1].payload == "��"
    assert rows[0].shard_id == "shard-a"
    assert (rows[0].arrival_time, rows[0].dt, rows[0].hour) == ("2031-05-06T14:30:00+00:00", "2031-05-06", "14")


def test_utc_text_shows_a_fraction_only_when_there_is_one(spark):
    frame = spark.sql("SELECT timestamp'2026-01-02 03:04:05' a, timestamp'2026-01-02 03:04:05.12' b")
    assert tuple(frame.select(utc_text(F.col("a")), utc_text(F.col("b"))).first()) == (
        "2026-01-02T03:04:05+00:00",
        "2026-01-02T03:04:05.120000+00:00",
    )


def test_enriched_row(spark):
    classified = quality.classify(
        quality.with_arrival(quality.to_envelope(records(spark, [event(), event(heart_rate=31, battery=9)])))
    )
    processed = F.lit("2031-05-06 14:30:10").cast("timestamp")
    first, second = enrich.to_silver(classified, processed).orderBy("kinesis_sequence_number").collect()
    assert first.end_to_end_latency_ms == 122_750
    assert (first.dt, first.hour) == ("2031-05-06", "14")
    assert (first.heart_rate_zone, first.is_abnormal_hr, first.battery_low) == ("resting", False, False)
    assert (second.heart_rate_zone, second.is_abnormal_hr, second.battery_low) == ("bradycardia", True, True)
    assert first.event_time == datetime(2031, 5, 6, 14, 28, 7, 250000)
    early = enrich.to_silver(classified, F.lit("2031-05-06 14:00:00").cast("timestamp"))
    assert {r.end_to_end_latency_ms for r in early.collect()} == {0}
    log = enrich.abnormal_event_log(enrich.to_silver(classified, processed)).collect()
    assert [json.loads(r.line) for r in log] == [
        {
            "level": "WARN", "type": "ABNORMAL_HEART_RATE", "device_id": "band-7", "heart_rate": 31,
            "zone": "bradycardia", "event_time": "2031-05-06T14:28:07.250000+00:00",
        }
    ]


def test_late_event_is_filed_under_its_own_hour(spark):
    late = records(spark, [event(timestamp="2031-05-06T11:20:30Z")])
    envelope = quality.to_envelope(late)
    silver = enrich.to_silver(
        quality.classify(quality.with_arrival(envelope).drop("dt", "hour")), F.lit(ARRIVAL).cast("timestamp")
    )
    assert (envelope.first().hour, silver.first().hour) == ("14", "11")


def test_payload_is_parsed_once(spark):
    """Filters on the result must not repeat the parsing."""
    classified = quality.classify(quality.with_arrival(quality.to_envelope(records(spark, [event()]))))
    for frame in (quality.accepted(classified), quality.rejected(classified), quality.route_counts(classified)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1
        assert "Python" not in plan
