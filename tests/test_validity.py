"""As-of from stored validity: equal to ranking all versions, at any time and after any refresh."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from vintage.feeds import DEATHS
from vintage.operators.upsert import writer_session
from vintage.operators.versions import latest_as_of, valid_at, validity
from vintage.plans import models
from vintage.schemas import PERIOD_KEYS, VERSION

SCHEMA = "run_id string, snapshot_date date, ingested_at timestamp_ntz, state string, covid_19_deaths bigint"
START = datetime(2026, 9, 8)


def versions(seed, n=250):
    rng = random.Random(seed)
    rows = {}
    for i in range(n):
        state = rng.choice(["hot", "hot", "hot", None, "a", "b", "c"])
        row = (f"run_{rng.randrange(40)}", date(2026, 9, rng.randrange(1, 4)), START + timedelta(hours=rng.randrange(60)), state, i)
        rows[row[:4]] = row  # one row a run, period, state and time: otherwise either may be the latest
    return list(rows.values())


@pytest.mark.parametrize("hot_rows", [20, 90, 10**6])
def test_as_of_equals_ranking(spark, hot_rows):
    df = spark.createDataFrame(versions(hot_rows), SCHEMA)
    held = validity(df, PERIOD_KEYS, VERSION, hot_rows).cache()
    assert tuples(held.drop("valid_to")) == tuples(df)
    for hours in (-1, 0, 0.5, 7, 30, 59, 1000):
        t = START + timedelta(hours=hours)
        assert tuples(valid_at(held, VERSION, t), *df.columns) == tuples(latest_as_of(df, PERIOD_KEYS, VERSION, t), *df.columns)
    ends = held.groupBy(*PERIOD_KEYS).agg({"*": "count"}).count()
    assert held.where("valid_to is null").count() == ends


def load(spark, layers, rows):
    session = writer_session(spark)
    table = layers.raw_table(DEATHS)
    columns = [c for c in session.table(table).columns if c not in SCHEMA]
    df = session.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"null as {c}" for c in columns))
    df.select(*session.table(table).columns).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)


def test_refresh_keeps_validity(spark, layers):
    rows = versions(5, 120)
    early, late = [r for r in rows if r[2] < START + timedelta(hours=30)], [r for r in rows if r[2] >= START + timedelta(hours=30)]
    runs = sorted({r[0] for r in late})
    load(spark, layers, [r for r in early if r[0] not in runs])
    models.build_models(spark, layers)
    table = models.build_validity(spark, layers)
    load(spark, layers, [r for r in rows if r[0] in runs])
    models.refresh_models(spark, runs, layers)
    refreshed = tuples(spark.table(table), *sorted(spark.table(table).columns))
    models.build_validity(spark, layers)
    assert refreshed == tuples(spark.table(table), *sorted(spark.table(table).columns)) and len(refreshed) == len(rows)
    reported = spark.table(models.model_names(layers)["fct_cases_as_reported"])
    for hours in (3, 29, 45):
        t = START + timedelta(hours=hours)
        assert tuples(models.as_of(spark, t, layers)) == tuples(latest_as_of(reported, PERIOD_KEYS, VERSION, t), *models.as_of(spark, t, layers).columns)
    # A run that is loaded again with fewer rows gives its intervals back to its neighbours.
    load(spark, layers, [r for r in rows if r[0] == runs[0]][:1])
    models.refresh_models(spark, runs[:1], layers)
    refreshed = tuples(spark.table(table), *sorted(spark.table(table).columns))
    models.build_models(spark, layers)
    assert refreshed == tuples(spark.table(table), *sorted(spark.table(table).columns))


def test_as_of_is_a_pruned_scan(spark, layers):
    load(spark, layers, versions(6, 60))
    models.build_models(spark, layers)
    models.build_validity(spark, layers)
    text = plan(models.as_of(spark, START, layers, (date(2026, 9, 2), date(2026, 9, 2))))
    assert not any(word in text for word in ("Window", "Sort", "Exchange", "Aggregate"))
    assert "PushedFilters: [IsNotNull(ingested_at), LessThanOrEqual(ingested_at" in text and "valid_to" in text.split("PushedFilters")[1]
    assert "2026-09-02" in text.split("PartitionFilters")[1]
    files = models.as_of(spark, START, layers, (date(2026, 9, 2), date(2026, 9, 2))).inputFiles()
    assert files and all("snapshot_date=2026-09-02" in f for f in files)


def test_readers_of_the_dimension_see_old_or_new_rows(spark, layers, monkeypatch):
    load(spark, layers, versions(7, 40))
    names = models.build_models(spark, layers)
    table = names["dim_state"]
    reader = spark.table(table)  # planned before the rebuilds, read after them
    before = tuples(spark.table(table))
    whole = models.dimension
    broken = F.when(F.col("state") == "hot", F.raise_error(F.lit("lost"))).otherwise(F.col("state"))
    with monkeypatch.context() as patched:
        patched.setattr(models, "dimension", lambda *a: whole(*a).withColumn("state", broken))
        with pytest.raises(Exception, match="lost"):
            models.build_models(spark, layers)
    assert tuples(spark.table(table)) == before
    load(spark, layers, [("run_new", date(2026, 9, 1), START, "zz", 1)])
    models.refresh_models(spark, ["run_new"], layers)
    assert len(tuples(spark.table(table))) == len(before) + 1
    assert tuples(reader) == before
    models.build_models(spark, layers)
    assert len(tuples(spark.table(table))) == len(before) + 1
    assert spark.catalog.getTable(table).tableType == "MANAGED"
