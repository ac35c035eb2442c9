"""What of a feed that is sent again counts as changed."""

from datetime import date, datetime

import pytest
from helpers import tuples

from vintage.feeds import ACTIVITY, DEATHS
from vintage.operators.upsert import writer_session
from vintage.sources.digests import changed_rows, create_digests, keep_digests

DAY, OTHER = date(2026, 9, 1), date(2026, 9, 8)
SCHEMA = "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, covid_19_deaths bigint, total_deaths bigint"


def rows(spark, run, *found, hour=1):
    """Rows (state, deaths, total, day) of one run."""
    at = datetime(2026, 9, 9, hour)
    padded = [(*f, *(900, DAY)[len(f) - 2 :]) for f in found]
    df = spark.createDataFrame([(run, day, at, s, d, t) for s, d, t, day in padded], SCHEMA)
    more = [c for c in spark.table(RAW[0]).columns if c not in df.columns]
    return df.selectExpr("*", *(f"null as {c}" for c in more))


RAW = [""]


@pytest.fixture
def store(spark, layers):
    RAW[0] = layers.raw_table(DEATHS)
    create_digests(spark, layers)

    def keep(run, *found, hour=1):
        session = writer_session(spark)
        df = rows(session, run, *found, hour=hour)
        df.select(*session.table(RAW[0]).columns).write.mode("overwrite").insertInto(RAW[0])
        spark.catalog.refreshTable(RAW[0])
        return keep_digests(spark, DEATHS, run, layers)

    def changed(*found):
        return tuples(changed_rows(spark, DEATHS, rows(spark, "run_new", *found), layers), "state", "covid_19_deaths")

    return keep, changed


def test_only_other_values_are_changes(spark, store):
    keep, changed = store
    assert keep("run_1", ("a", 1), ("b", 2), (None, 3), ("c", None), ("d", 4)) == 5
    assert changed(("a", 1), ("b", 2), (None, 3), ("c", None), ("d", 4)) == []
    assert changed(("a", 1, None), ("b", 5), (None, 4), ("c", 0), ("new", 1)) == sorted([("a", 1), ("b", 5), (None, 4), ("c", 0), ("new", 1)], key=repr)
    assert changed(("a", 1, 900, OTHER), ("b", 2)) == [("a", 1)]  # another period
    assert changed(("b", 7), ("b", 7), ("b", 2)) == [("b", 7), ("b", 7)]
    assert changed() == []


def test_a_value_that_comes_back_is_a_change(spark, store):
    keep, changed = store
    keep("run_1", ("a", 1), ("b", 1))
    keep("run_2", ("a", 2), hour=2)
    assert changed(("a", 1), ("b", 1)) == [("a", 1)] and changed(("a", 2)) == []


def test_an_older_run_loaded_again_does_not_hide_a_later_one(spark, store):
    keep, changed = store
    keep("run_1", ("a", 1), hour=1)
    keep("run_2", ("a", 2), hour=5)
    keep("run_1", ("a", 9), ("z", 1), hour=3)
    assert changed(("a", 2), ("z", 1)) == [] and changed(("a", 9)) == [("a", 9)]


def test_other_periods_and_feeds_keep_their_digests(spark, layers, store):
    keep, changed = store
    keep("run_1", ("a", 1), ("a", 5, 900, OTHER))
    before = [f for f in spark.table(layers.digests).inputFiles() if str(OTHER) in f]
    keep("run_2", ("a", 2), hour=2)
    assert [f for f in spark.table(layers.digests).inputFiles() if str(OTHER) in f] == before
    assert changed(("a", 5, 900, OTHER), ("a", 2)) == []
    columns = "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, activity_level string"
    other = spark.createDataFrame([("r", DAY, datetime(2026, 9, 9), "a", "Low")], columns)
    assert changed_rows(spark, ACTIVITY, other, layers).count() == 1
