import random
from datetime import date, datetime, timedelta

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from vintage.functions import skew
from vintage.functions.skew import hot_groups, with_versions
from vintage.operators.versions import latest, latest_as_of, revision_history
from vintage.plans.models import as_reported, latest_fact, revisions

SCHEMA = "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, covid_19_deaths bigint"
DAY = date(2026, 9, 1)
NOON = datetime(2026, 9, 8, 12)
KEYS = ("snapshot_date", "state")
VERSION = ("ingested_at", "run_id")


def version(run, value, state="California", hours=0):
    return (f"run_{run}", DAY, NOON + timedelta(hours=hours or run), state, value)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(rows):
    """Revisions by a plain loop over each group."""
    groups = {}
    for row in rows:
        groups.setdefault((row[1], row[3]), []).append(row)
    found = []
    for key, members in groups.items():
        members.sort(key=lambda r: (r[2], r[0], r[4] is None, r[4] or 0))
        for i in range(1, len(members)):
            before, now = members[i - 1][4], members[i][4]
            if before is not None and now is not None and before != now:
                found.append((*key, members[i][2], members[i][0], i + 1, before, now, now - before))
    return sorted(found, key=repr)


def test_null_breaks_the_chain(spark):
    df = frame(spark, [version(1, 10), version(2, None), version(3, 12), version(4, 15)])
    assert tuples(revisions(df, "covid_19_deaths"), "version_number", "previous_value", "current_value", "revision_delta") == [
        (4, 12, 15, 3)
    ]


def test_equal_values_are_no_revision_but_count_as_version(spark):
    df = frame(spark, [version(1, 10), version(2, 10), version(3, 9)])
    assert tuples(revisions(df, "covid_19_deaths"), "version_number", "revision_delta") == [(3, -1)]


@pytest.mark.parametrize("hot_rows", [3, 40, 10**6])
def test_hot_groups_match_brute_force(spark, hot_rows):
    """A third of the rows in one group, another third copies of few rows, nulls in keys and values."""
    rng = random.Random(hot_rows)
    rows = []
    for i in range(300):
        rows.append(version(rng.randrange(90), rng.choice([None, 1, 2, 3]), "hot", rng.randrange(1, 400)))
        rows.append(version(rng.randrange(3), rng.choice([5, None]), None, 1))
        rows.append(version(rng.randrange(50), rng.randrange(4), f"s{rng.randrange(60)}", rng.randrange(1, 50)))
    got = revision_history(frame(spark, rows), KEYS, VERSION, "covid_19_deaths", hot_rows)
    assert tuples(got) == brute_force(rows)


@pytest.mark.parametrize("hot_rows", [20, 100, 10**6])
def test_with_versions_keeps_every_copy(spark, hot_rows):
    rows = [version(i % 7, i % 5, "hot", 1 + i % 31) for i in range(500)] + [version(1, 1, "cold")] * 3
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    got = with_versions(frame(spark, rows), KEYS, (*VERSION, "covid_19_deaths"), "covid_19_deaths", hot_rows)
    assert tuples(got, *columns) == sorted(rows, key=repr)
    plain = with_versions(frame(spark, rows), KEYS, (*VERSION, "covid_19_deaths"), "covid_19_deaths", 10**7)
    assert tuples(got) == tuples(plain)
    assert sorted(r["version_number"] for r in got.where("state = 'hot'").collect()) == list(range(1, 501))


def test_more_hot_groups_than_are_broadcast_are_all_split(spark, monkeypatch):
    monkeypatch.setattr("vintage.functions.skew.BROADCAST_GROUPS", 2)
    rows = [version(i % 7, i % 5, f"s{i % 6}", 1 + i % 31) for i in range(600)]
    assert hot_groups(frame(spark, rows), KEYS, 50).count() == 6
    results = [
        tuples(with_versions(frame(spark, rows), KEYS, (*VERSION, "covid_19_deaths"), "covid_19_deaths", n)) for n in (50, 10**6)
    ]
    assert results[0] == results[1]


def test_hot_groups_are_counted_per_null_safe_key(spark):
    rows = [version(i, i, None) for i in range(5)] + [version(1, 1, "a")]
    hot = hot_groups(frame(spark, rows), KEYS, 4)
    assert tuples(hot) == [(DAY, None, 5)]
    assert hot_groups(frame(spark, rows), KEYS, 5) is None


def test_hot_groups_of_a_large_table_are_found_by_share(spark):
    state = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("state")
    df = spark.range(200_000).select(F.lit(DAY).alias("snapshot_date"), state)
    ((_, name, n),) = tuples(hot_groups(df, KEYS, 20_000))
    assert name == "hot" and 60_000 < n < 73_000


def test_latest_breaks_ties_by_run(spark):
    df = frame(spark, [version(1, 1, hours=5), version(2, 2, hours=5), version(3, 3, None, 4), version(4, 4, None, 3)])
    assert tuples(latest(df, KEYS, VERSION), "run_id", "state") == [("run_2", "California"), ("run_3", None)]


def test_latest_as_of_includes_the_moment_itself(spark):
    df = frame(spark, [version(1, 1), version(2, 2), version(3, 3)])
    at = NOON + timedelta(hours=2)
    assert tuples(latest_as_of(df, KEYS, VERSION, at), "run_id") == [("run_2",)]
    assert tuples(latest_as_of(df, KEYS, VERSION, "2026-09-08 13:59:59"), "run_id") == [("run_1",)]


def test_as_reported_keeps_all_versions_and_keys_nulls_apart_from_empty(spark):
    reported = as_reported(frame(spark, [version(1, 1, None), version(1, 1, "")]))
    assert reported.count() == 2
    assert reported.select("state_key").distinct().count() == 2


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select(
        F.lit("r").alias("run_id"), F.lit(DAY).alias("snapshot_date"), F.lit(NOON).cast("timestamp_ntz").alias("ingested_at"),
        F.col("id").cast("string").alias("state"), F.col("id").alias("covid_19_deaths"),
    )
    text = plan(latest_fact(as_reported(df)))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_revision_history_needs_one_exchange_one_sort_one_window(spark):
    text = plan(revisions(frame(spark, [version(1, 1)]), "covid_19_deaths"))
    assert [text.count(f"{node} [") + text.count(f"{node} hash") for node in ("Exchange", "Sort", "Window")] == [1, 1, 1]


def test_small_hot_groups_are_cut_into_a_bounded_number_of_slices(spark, monkeypatch):
    """A slice is a task: their number must not grow with the rows over a small ``hot_rows``."""
    cut = []
    whole = skew._numbered_in_slices
    monkeypatch.setattr(skew, "SLICES", 12)
    monkeypatch.setattr(skew, "_numbered_in_slices", lambda *args: cut.append(args[4]) or whole(*args))
    rows = [version(i % 7, i % 5, f"s{i % 3}", 1 + i % 31) for i in range(600)]
    args = KEYS, (*VERSION, "covid_19_deaths"), "covid_19_deaths"
    got = with_versions(frame(spark, rows), *args, hot_rows=2)
    assert tuples(got) == tuples(with_versions(frame(spark, rows), *args)) and cut == [12]
    assert skew.slice_count(50 * skew.HOT_ROWS, 2) == 51 and skew.slice_count(10, 5) == 3
