import json
from datetime import date, datetime, timedelta

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from vintage.feeds import ACTIVITY, DEATHS
from vintage.functions.columns import new_run_id, safe_int, surrogate_key, to_period
from vintage.operators.filters import last_period, newer_than
from vintage.plans.feed_run import ingest
from vintage.sources.landing import normalize, payload_field, read_landing

STAMP = "2026-09-08T06:00:00+00:00"


def land(folder, layout, *files):
    folder.mkdir(parents=True, exist_ok=True)
    for i, records in enumerate(files):
        text = json.dumps(records) if layout == "pages" else "\n".join(json.dumps(r) for r in records)
        (folder / f"{i}.json").write_text(text)
    return str(folder)


def death(week="2026-09-05T00:00:00.000", **fields):
    return {"week_ending_date": week, "state": "Ohio", "covid_19_deaths": "15", **fields}


def rows(spark, tmp_path, *records, layout="lines", feed=DEATHS):
    path = land(tmp_path / "landing", layout, list(records))
    return normalize(read_landing(spark, path, layout), feed, "run_x", STAMP)


@pytest.mark.parametrize("layout", ["lines", "pages"])
def test_record_becomes_typed_row(spark, tmp_path, layout):
    got = rows(spark, tmp_path, death(total_deaths="900", unknown="kept"), death(state="Iowa", covid_19_deaths=""), layout=layout)
    assert tuples(got.drop("raw_payload")) == [
        ("run_x", date(2026, 9, 5), datetime(2026, 9, 8, 6), "Iowa", None, None, None, None, None),
        ("run_x", date(2026, 9, 5), datetime(2026, 9, 8, 6), "Ohio", 15, 900, None, None, None),
    ]
    assert {r[0] for r in got.select(payload_field("unknown")).collect()} == {"kept", None}


def test_pages_and_lines_read_alike(spark, tmp_path):
    files = [[death(state=f"s{i}{j}") for j in range(4)] for i in range(3)]
    read = [read_landing(spark, land(tmp_path / x, x, *files), x) for x in ("lines", "pages")]
    a, b = (tuples(normalize(r, DEATHS, "r", STAMP), "state") for r in read)
    assert a == b and len(a) == 12


def test_activity_names(spark, tmp_path):
    got = rows(spark, tmp_path, {"week_end": "2026-09-05T00:00:00", "geography": "Ohio", "label": "Low"}, feed=ACTIVITY)
    assert tuples(got, "snapshot_date", "state", "activity_level") == [(date(2026, 9, 5), "Ohio", "Low")]


@pytest.mark.parametrize(
    "text, expected", [(None, None), ("", None), ("0", 0), (" 15 ", 15), ("-3", -3), ("12.0", "fails"), ("x", "fails"), ("1_000", "fails")]
)
def test_safe_int(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    if expected == "fails":
        with pytest.raises(Exception, match="not a valid bigint"):
            df.select(safe_int("v")).collect()
        assert df.select(safe_int("v", strict=False)).first()[0] is None
    else:
        assert df.select(safe_int("v")).first()[0] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", [None, "", "soon", "2026-13-01"])
def test_bad_period_fails_whatever_the_ansi_mode(spark, ansi, text):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(text,)], "v string")
        with pytest.raises(Exception, match="not a valid date"):
            df.select(to_period("v")).collect()
        assert df.select(to_period("v", strict=False)).first()[0] is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("record", [{"state": "Ohio"}, death(week=None), death(covid_19_deaths="many")])
def test_bad_record_fails_the_batch(spark, tmp_path, record):
    with pytest.raises(Exception, match="not a valid"):
        rows(spark, tmp_path, death(), record).collect()


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"state": "Ohio"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_landing(spark, str(tmp_path)).collect()


def test_period_equal_to_the_mark_is_not_new(spark, tmp_path):
    path = land(tmp_path / "l", "lines", [death(), death("2026-09-12T00:00:00.000"), death("2026-08-29")])
    records = read_landing(spark, path)
    mark = date(2026, 9, 5)
    assert tuples(ingest(records, DEATHS, mark, "r", STAMP), "snapshot_date") == [(date(2026, 9, 12),)]
    assert ingest(records, DEATHS, mark, "r", STAMP, lookback_days=1).count() == 2
    assert ingest(records, DEATHS, None, "r", STAMP).count() == 3


def test_old_periods_are_not_parsed(spark, tmp_path):
    path = land(tmp_path / "l", "lines", [death(covid_19_deaths="many"), death("2026-09-12")])
    assert ingest(read_landing(spark, path), DEATHS, date(2026, 9, 5), "r", STAMP).collect()[0]["covid_19_deaths"] == 15


def test_mark_watches_the_sentinel(spark):
    df = spark.createDataFrame(
        [("United States", date(2026, 9, 5)), ("Ohio", date(2026, 9, 12))], "state string, snapshot_date date"
    )
    assert last_period(df, "United States") == date(2026, 9, 5)
    assert last_period(df, None) == date(2026, 9, 12)
    assert last_period(df, "Alabama") is None
    assert newer_than(df, "snapshot_date", date(2026, 9, 12)).isEmpty()


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("", 1)], "s string, n int")
    keys = {r[0] for r in df.select(surrogate_key("s", "n")).collect()}
    assert len(keys) == 3
    assert df.where("s = 'a'").select(surrogate_key("s", "n") == F.md5(F.lit("a-1"))).first()[0]


def test_run_ids():
    first, second = new_run_id(datetime(2026, 9, 8, 6)), new_run_id(datetime(2026, 9, 8, 6))
    assert first.startswith("run_20260908_060000_") and len(first) == 26 and first != second


def test_modified_after_skips_old_files(spark, tmp_path):
    path = land(tmp_path / "l", "lines", [death()])
    assert read_landing(spark, path, modified_after="2000-01-01T00:00:00").count() == 1
    assert read_landing(spark, path, modified_after="2100-01-01T00:00:00").count() == 0


@pytest.mark.parametrize("layout", ["lines", "pages"])
def test_period_folders_up_to_the_mark_are_not_opened(spark, tmp_path, layout):
    weeks = [date(2026, 8, 29), date(2026, 9, 5), date(2026, 9, 12)]
    for week in weeks:
        land(tmp_path / "l" / f"week={week}", layout, [death(f"{week}T00:00:00.000", state=s) for s in ("Ohio", "Iowa")])
    path, mark = str(tmp_path / "l"), date(2026, 9, 5)
    for back in (0, 3, 10):
        after = mark - timedelta(days=back)
        pruned = read_landing(spark, path, layout, period_dir="week", after=after)
        flat = read_landing(spark, path, layout)
        got, plain = (tuples(ingest(r, DEATHS, mark, "r", STAMP, back).drop("raw_payload")) for r in (pruned, flat))
        assert got == plain and len(got) == 2 * sum(w > after for w in weeks)
    (tmp_path / "l" / "week=2026-08-29" / "torn.json").write_text('{"state": ')
    assert read_landing(spark, path, layout, period_dir="week", after=mark).count() == 2
    with pytest.raises(Exception, match="MALFORMED"):
        read_landing(spark, path, layout, period_dir="week").collect()
