from datetime import date

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from vintage.feeds import DEATHS
from vintage.functions.columns import ntz
from vintage.operators import anomaly
from vintage.operators.anomaly import (
    anomalies,
    anomaly_flags,
    current_run,
    group_stats,
    history,
    merged_stats,
    run_stats,
    z_scores,
)
from vintage.operators.upsert import writer_session
from vintage.sources.load import load_batch
from vintage.sources.statistics import forget_runs, history_stats

SCHEMA = "run_id string, snapshot_date date, state string, covid_19_deaths bigint"
DAY = date(2026, 9, 1)
METRIC = "covid_19_deaths"


def frame(spark, past, current):
    rows = [(f"old_{i}", DAY, state, v) for state, values in past.items() for i, v in enumerate(values)]
    rows += [("now", DAY, state, v) for state, values in current.items() for v in values]
    return spark.createDataFrame(rows, SCHEMA)


def found(df, function=anomalies, *extra):
    return function(current_run(df, "now", "state", METRIC), history(df, "now", "state", METRIC), "state", METRIC, *extra)


def test_needs_eight_points(spark):
    df = frame(spark, {"seven": [1, 2, 3, 4, 5, 6, 7], "eight": [1, 2, 3, 4, 5, 6, 7, 8]}, {"seven": [99], "eight": [99]})
    assert tuples(found(df, anomalies, "covid"), "state") == [("eight",)]


def test_null_history_values_are_no_points(spark):
    df = frame(spark, {"a": [1, 2, 3, 4, 5, 6, 7, None]}, {"a": [99]})
    assert found(df, anomalies, "covid").count() == 0


def test_not_scored(spark):
    """Constant history, unseen state, missing value, missing state."""
    df = frame(spark, {"flat": [5] * 9, "a": range(9), None: range(9)}, {"flat": [99], "new": [99], "a": [None], None: [99]})
    assert found(df, z_scores).count() == 0


def test_exactly_three_deviations_is_normal(spark):
    # mean 0, sample deviation 2: four times +2, four times -2 and a 9th value make sum of squares 32 over 8.
    df = frame(spark, {"a": [2, -2] * 4 + [0]}, {"a": [6, -6, 7, -7]})
    got = tuples(found(df, anomalies, "covid"), "observed_value", "expected_range_low", "expected_range_high", "z_score")
    assert got == [(-7.0, -6.0, 6.0, -3.5), (7.0, -6.0, 6.0, 3.5)]


def test_single_point_has_no_deviation(spark):
    stats = group_stats(frame(spark, {"a": [1], "b": [2, 2]}, {}), "state", METRIC)
    assert tuples(stats) == [("a", 1.0, None, 1), ("b", 2.0, 0.0, 2)]


def test_flag_ids_are_stable_and_distinct(spark):
    df = frame(spark, {"a": [2, -2] * 4 + [0]}, {"a": [7, -7]})
    first, again = (tuples(anomaly_flags(found(df, anomalies, "covid"), "2026-09-08 06:00:00")) for _ in range(2))
    assert first == again and len({r[0] for r in first}) == 2


def test_scans_prune_to_runs_and_stats_are_broadcast_after_measuring(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, {"a": range(9), "b": range(9)}, {"a": [50]}).write.partitionBy("run_id").parquet(path)
    df = spark.read.parquet(path)
    found_now = found(df, anomalies, "covid")
    text = plan(found_now)
    assert "(run_id#" in text and "NOT (run_id#" in text and "IsNotNull(covid_19_deaths)" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in plan(found(df, anomalies, "covid"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found_now.collect()
    assert "BroadcastHashJoin" in plan(found_now)


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_hot_state_matches_direct_computation(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(anomaly.with_group_stats, "__defaults__", (hot_rows,))
    df = spark.range(9000).select(
        F.when(F.col("id") % 10 == 0, "now").otherwise("old").alias("run_id"), F.lit(DAY).alias("snapshot_date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("state"),
        ((F.col("id") * 7919) % 101 + F.when(F.col("id") % 900 == 0, 5000).otherwise(0)).alias(METRIC),
    )
    got = found(df, anomalies, "covid").toPandas()
    pdf = df.toPandas()
    stats = pdf[pdf.run_id == "old"].groupby("state")[METRIC].agg(["mean", "std", "count"])
    cur = pdf[pdf.run_id == "now"].join(stats, on="state", how="inner")
    z = (cur[METRIC] - cur["mean"]) / cur["std"]
    want = cur[(cur["count"] >= 8) & (z.abs() > 3)]
    assert len(got) == len(want) > 0
    assert sorted(got.z_score) == pytest.approx(sorted(z[want.index]))


def test_merged_statistics_equal_those_of_all_rows(spark):
    rows = spark.range(400).selectExpr(
        "concat('run ', id % 7, '+%/=') AS run_id", "if(id % 11 = 0, null, concat('s', id % 3)) AS state",
        "case when id % 13 = 0 then double('NaN') when id % 17 = 0 then null else 1e9 + (id * id) % 97 / 8.0 end AS v",
        "0.1D AS flat")
    want = {r["state"]: r for r in group_stats(rows, "state", "v").collect()}
    got = {r["state"]: r for r in merged_stats(run_stats(rows, "state", "v"), "state").collect()}
    assert got.keys() == want.keys()
    for state, r in got.items():
        assert r["n"] == want[state]["n"]
        assert r["mean"] == pytest.approx(want[state]["mean"], rel=1e-12) and r["std"] == pytest.approx(want[state]["std"], rel=1e-6)
    assert {r["std"] for r in merged_stats(run_stats(rows, "state", "flat"), "state").collect()} == {0.0}


def test_a_score_reads_statistics_and_only_runs_without_them(spark, layers):
    def load(run, *values):
        rows = spark.createDataFrame([(run, date(2026, 1, 1 + i), "Ohio", v) for i, v in enumerate(values)], "run_id string, snapshot_date date, state string, covid_19_deaths long")
        others = [F.lit(None).cast(t).alias(c) for c, t in spark.table(layers.raw_table(DEATHS)).dtypes if c not in (*rows.columns, "ingested_at")]
        load_batch(spark, DEATHS, rows.select("*", ntz("2026-09-08T06:00:00+00:00").alias("ingested_at"), *others), run, layers)

    past = lambda run="now": history_stats(writer_session(spark), DEATHS, run, layers)
    stats = lambda: tuples(past(), "state", "n", "mean")
    load("run +1/%", *range(1, 11))
    load("run_2", 21, 22)
    assert stats() == [("Ohio", 12, pytest.approx(98 / 12))]
    # Loaded again, a run replaces its statistics; without any, its rows are read.
    load("run_2", 31, 32)
    assert stats() == [("Ohio", 12, pytest.approx(118 / 12))]
    assert layers.raw not in plan(past())
    forget_runs(spark, DEATHS, ["run +1/%"], layers)
    assert layers.raw in plan(past())
    assert stats() == [("Ohio", 12, pytest.approx(118 / 12))]
    assert tuples(past("run_2"), "n", "mean") == [(10, 5.5)]
