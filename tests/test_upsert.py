import re
from datetime import date, datetime

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from vintage.feeds import ACTIVITY, DEATHS
from vintage.operators.upsert import AmbiguousMatch, merge_rows, outcomes, upsert_table
from vintage.sources.load import EMPTY_LOAD, load_batch

DAY = date(2026, 9, 1)
SCHEMA = (
    "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, covid_19_deaths bigint, "
    "total_deaths bigint, pneumonia_deaths bigint, pneumonia_and_covid_19_deaths bigint, influenza_deaths bigint"
)


def record(run="run_test_001", state="California", deaths=15, day=DAY):
    return (run, day, datetime(2026, 9, 8, 6), state, deaths, 900, 50, 10, 5)


def batch(spark, *rows):
    payload = F.parse_json(F.to_json(F.struct("state", F.col("covid_19_deaths").cast("string"))))
    return spark.createDataFrame(list(rows), SCHEMA).withColumn("raw_payload", payload)


def load(spark, layers, *rows, run="run_test_001"):
    return load_batch(spark, DEATHS, batch(spark, *rows), run, layers)


def stored(spark, layers):
    return tuples(spark.table(layers.raw_table(DEATHS)), "run_id", "state", "covid_19_deaths")


def log(spark, layers):
    return tuples(spark.table(layers.run_log), "stage", "status", "row_count_in", "row_count_out")


def test_counts_and_log(spark, layers):
    assert load(spark, layers, record()) == {"row_count_in": 1, "row_count_out": 1, "status": "success"}
    assert log(spark, layers) == [("extract", "success", 1, 1), ("load", "success", 1, 1)]
    assert spark.table(layers.run_log).where("log_id is null or duration_ms is null or logged_at is null").isEmpty()


def test_payload_round_trips(spark, layers):
    load(spark, layers, record())
    row = spark.table(layers.raw_table(DEATHS)).select(F.variant_get("raw_payload", "$.state", "string")).first()
    assert row[0] == "California"


def test_load_updates_matched_and_inserts_the_rest(spark, layers):
    load(spark, layers, record(), record(state="Texas"))
    load(spark, layers, record(deaths=16), record(state="Ohio"))
    assert stored(spark, layers) == [
        ("run_test_001", "California", 16), ("run_test_001", "Ohio", 15), ("run_test_001", "Texas", 15)
    ]


@pytest.mark.parametrize("other", [record(run="run_2"), record(state="Texas"), record(day=date(2026, 9, 8))])
def test_each_part_of_the_key_tells_rows_apart(spark, layers, other):
    load(spark, layers, record())
    load(spark, layers, other)
    assert len(stored(spark, layers)) == 2


def test_loading_twice_changes_nothing(spark, layers):
    rows = [record(state=s, day=date(2026, 9, d)) for s in ("a", "b", "c") for d in (1, 8)]
    load(spark, layers, *rows)
    once = stored(spark, layers)
    load(spark, layers, *rows)
    assert stored(spark, layers) == once and len(once) == 6


def test_other_runs_keep_their_files(spark, layers):
    load(spark, layers, record(run="run_1"))
    before = [f for f in spark.table(layers.raw_table(DEATHS)).inputFiles()]
    load(spark, layers, record(run="run_2"))
    load(spark, layers, record(run="run_2", deaths=1))
    assert set(before) < set(spark.table(layers.raw_table(DEATHS)).inputFiles())


def test_null_state_never_matches(spark, layers):
    load(spark, layers, record(), record(state=None))
    load(spark, layers, record(), record(state=None))
    assert [r[1] for r in stored(spark, layers)] == ["California", None, None]


def test_duplicates_insert_when_unmatched_and_fail_when_matched(spark, layers):
    load(spark, layers, record(deaths=1), record(deaths=2))
    assert len(stored(spark, layers)) == 2
    with pytest.raises(AmbiguousMatch):
        load(spark, layers, record(deaths=3), record(deaths=4))
    assert [r[2] for r in stored(spark, layers)] == [1, 2]
    assert ("load", "failure", 2, 0) in log(spark, layers)
    load(spark, layers, record(deaths=5))
    assert [r[2] for r in stored(spark, layers)] == [5]


def test_interrupted_load_is_logged_as_failure(spark, layers, monkeypatch):
    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken, pytest.raises(KeyboardInterrupt):
        broken.setattr("vintage.sources.load.upsert_table", stop)
        load(spark, layers, record())
    assert log(spark, layers) == [("extract", "success", 1, 1), ("load", "failure", 1, 0)]
    assert [r[0] for r in spark.table(layers.run_log).where("stage = 'load'").select("error_message").collect()] == ["KeyboardInterrupt"]


def test_empty_batch_touches_nothing(spark, layers):
    assert load(spark, layers) == EMPTY_LOAD
    assert stored(spark, layers) == [] and log(spark, layers) == []


def test_no_staging_table_is_left(spark, layers):
    load(spark, layers, record())
    with pytest.raises(AmbiguousMatch):
        load(spark, layers, record(), record(state="x"), record(state="x"))
        load(spark, layers, record(), record())
    names = [t.name for t in spark.catalog.listTables(layers.raw)]
    assert sorted(names) == sorted([DEATHS.table, ACTIVITY.table])


def test_activity_feed(spark, layers):
    rows = [("r", DAY, datetime(2026, 9, 8, 6), s, "Low") for s in ("a", "b")]
    df = spark.createDataFrame(rows, "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, activity_level string")
    df = df.withColumn("raw_payload", F.lit(None).cast("variant"))
    load_batch(spark, ACTIVITY, df, "r", layers)
    load_batch(spark, ACTIVITY, df.where("state = 'a'").withColumn("activity_level", F.lit("High")), "r", layers)
    assert tuples(spark.table(layers.raw_table(ACTIVITY)), "state", "activity_level") == [("a", "High"), ("b", "Low")]


@pytest.mark.parametrize("hot_rows", [500, 10**6])
@pytest.mark.parametrize("matched", [True, False])
def test_hot_key_merge(spark, hot_rows, matched):
    """A third of the stored rows share one key, another third a null key."""
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id")).alias("state")
    target = spark.range(3000).select(F.lit("r").alias("run_id"), F.lit(DAY).alias("snapshot_date"), key, F.lit("old").alias("v"))
    states = [*range(0, 6000, 2), None] + [-1] * matched
    source = spark.createDataFrame([("r", DAY, s, "new") for s in states], target.schema)
    merged = merge_rows(target, source, hot_rows=hot_rows)
    old = merged.where("v = 'old'")
    assert old.where("state = -1").count() == (0 if matched else 1000)
    assert old.where("state is null").count() == 1000
    assert tuples(old.where("state >= 0"), "state") == sorted(((i,) for i in range(3000) if i % 3 == 1 and i % 2), key=repr)
    assert merged.where("v = 'new'").count() == len(states)


def test_only_touched_partitions_are_read(spark, layers):
    load(spark, layers, record(run="run_1"))
    df = spark.table(layers.raw_table(DEATHS)).where(F.col("run_id").isin(["run_2"]))
    assert re.search(r"PartitionFilters: \[[^]]*run_id#\d+ = run_2", plan(df)) and df.isEmpty()


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_every_row_has_one_outcome(spark, hot_rows):
    """Against a loop over keys: copies on either side, nulls in keys, a key that a third of the rows share."""
    old = [("r", DAY, s, f"old{i}") for i, s in enumerate(["hot"] * 60 + ["a", "b", "b", "c", "d", None, None])]
    new = [("r", DAY, s, f"new{i}") for i, s in enumerate(["hot", "a", "b", "x", "x", "c", "c", None] + [f"n{k}" for k in range(50)])]
    schema = "run_id string, snapshot_date date, state string, v string"
    found = outcomes(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), hot_rows=hot_rows)
    expected = []
    for rows, other, unmet, met in ((old, new, "kept", "replaced"), (new, old, "added", "replacing")):
        for r in rows:
            olds, news = (sum(o[2] == r[2] for o in side) * (r[2] is not None) for side in (old, new))
            other_side = news if rows is old else olds
            expected.append((r[3], "ambiguous" if news > 1 and olds else met if other_side else unmet))
    assert tuples(found, "v", "outcome") == sorted(expected, key=repr)


def test_a_reload_reads_the_target_once_and_shuffles_it_once(spark, layers):
    load(spark, layers, record(), record(state="Texas"))
    target = spark.table(layers.raw_table(DEATHS))
    text = plan(merge_rows(target, target.withColumn("state", F.concat("state", F.lit("x")))))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_upsert_counts_outcomes(spark, layers):
    load(spark, layers, record(), record(state="Texas"), record(state="Utah"), record(state=None))
    table = f"{layers.raw}.batch_of_three"
    batch(spark, record(deaths=1), record(state="Ohio"), record(state=None)).write.saveAsTable(table)
    counts = upsert_table(spark, layers.raw_table(DEATHS), table)
    assert counts == {"kept": 3, "replaced": 1, "replacing": 1, "added": 2}
    assert len(stored(spark, layers)) == 6
