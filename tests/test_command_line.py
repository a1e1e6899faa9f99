import json

import pytest
from events import FIRST_SEQUENCE, as_json_lines, event, record
from test_readings import GOOD

from vitals.__main__ import main
from vitals.sources import lake as tables
from vitals.sources.lake import Lake


def test_readings_from_files_to_answers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text(GOOD + "\n")
    lake = ["--lake", str(tmp_path / "lake")]
    main(["readings-ingest", *lake, "--input", str(tmp_path / "in")], spark)
    assert main(["readings-silver", *lake], spark) == 1
    assert main(["readings-gold", *lake], spark) == 1
    main(["readings-answers", *lake], spark)
    assert tables.load_answers(spark, Lake(str(tmp_path / "lake")).answers).count() == 4
    main(["alerts", *lake, "--input", str(tmp_path / "in"), "--output", str(tmp_path / "alerts")], spark)
    lines = [line for f in (tmp_path / "alerts").glob("part-*") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"key": "chest-strap", "value": GOOD}]


def test_events_from_files_to_gold(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    rows = [record(event(), FIRST_SEQUENCE), record("junk", FIRST_SEQUENCE + 1)]
    (tmp_path / "in" / "1.json").write_text(as_json_lines(rows))
    lake = ["--lake", str(tmp_path / "lake")]
    main(["events-bronze", *lake, "--input", str(tmp_path / "in")], spark)
    main(["events-silver", *lake, "--hr-low", "80", "--max-files", "1"], spark)
    main(["events-quarantine", *lake], spark)
    assert main(["gold-refresh", *lake, "--dt", "2031-05-06", "--hour", "14"], spark) == [
        {"dt": "2031-05-06", "hour": "14", "devices": 1, "events": 1}
    ]
    main(["sql", *lake, "--sql", "SELECT device_id, abnormal_hr_count FROM gold_device_hourly", "--rows", "5"], spark)
    assert "band-7" in capsys.readouterr().out


def test_sql_returns_all_rows_or_as_many_as_asked_for(spark, tmp_path):
    lake = ["--lake", str(tmp_path / "lake")]
    with pytest.raises(ValueError, match="rows"):
        main(["sql", *lake, "--sql", "SELECT 1"], spark)
    main(["sql", *lake, "--sql", "SELECT * FROM range(50)", "--output", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_unknown_job_and_bad_threshold(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["nonsense", "--lake", str(tmp_path)], spark)
    with pytest.raises(ValueError):
        main(["events-silver", "--lake", str(tmp_path), "--hr-high", "100"], spark)
