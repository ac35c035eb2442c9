"""A stream judged as it is loaded: what is let through, what is kept out, and batches that are played again."""

import json
from dataclasses import replace

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from vintage.feeds import ACTIVITY, DEATHS
from vintage.operators import rules
from vintage.sources.landing import parse_records
from vintage.sources.ledger import passed_runs
from vintage.streaming import gated

NOW = "2026-09-08T06:00:00"


def death(state="Ohio", week="2026-09-05T00:00:00.000", deaths="15", **fields):
    return {"week_ending_date": week, "state": state, "covid_19_deaths": deaths, "total_deaths": "900", **fields}


def records(spark, *found):
    return parse_records(spark.createDataFrame([(json.dumps(r),) for r in found], "value string"))


@pytest.fixture
def gate(spark, layers):
    gated.create_gate_tables(spark, DEATHS, layers)

    def admit(batch_id, *found, **options):
        return gated.admit(spark, options.pop("feed", DEATHS), records(spark, *found), batch_id, layers, now=NOW, **options)

    return admit


def state_of(spark, layers):
    tables = (layers.raw_table(DEATHS), layers.quarantine(DEATHS), layers.batches, layers.run_log, layers.flags, layers.statistics)
    hidden = ("raw_payload", "duration_ms")
    return [tuples(spark.table(t).drop(*hidden)) for t in tables]


def kept_out(spark, layers):
    return tuples(gated.quarantined(spark, DEATHS, layers).select(F.variant_get("raw_payload", "$.state", "string").alias("state"), F.concat_ws("; ", "reasons").alias("why")))


BAD = [
    death("a"), death("b", deaths="-1"), death("c", deaths="12.0"), death("d", week=None), death("e", week="soon"),
    death("f", deaths="1000"), death("g"), death("g", deaths="16"), death(None), death("h", deaths=""),
]


def test_a_bad_batch_is_split(spark, layers, gate):
    assert gate(0, *BAD) == "partial"
    assert tuples(spark.table(layers.raw_table(DEATHS)), "run_id", "state", "covid_19_deaths") == [
        ("run_covid_0000000000", "a", 15), ("run_covid_0000000000", "h", None)
    ]
    twice, period = "compound_columns_unique(run_id,snapshot_date,state)", "missing snapshot_date; not_be_null(snapshot_date)"
    assert kept_out(spark, layers) == sorted([
        ("b", "be_between(covid_19_deaths)"), ("c", "malformed covid_19_deaths"), ("d", period), ("e", period),
        ("f", "pair_A_greater_than_B(total_deaths,covid_19_deaths)"), ("g", twice), ("g", twice), (None, "not_be_null(state)"),
    ], key=repr)
    entry = spark.table(layers.batches).first()
    assert (entry["row_count_in"], entry["row_count_passed"], entry["row_count_quarantined"]) == (10, 2, 8)
    logged = tuples(spark.table(layers.run_log), "stage", "status", "row_count_in", "row_count_out")
    assert logged == [("anomaly_detection", "success", 2, 0), ("extract", "success", 10, 10), ("load", "success", 10, 2), ("validate", "success", 10, 2)]
    assert passed_runs(spark.table(layers.run_log)).count() == 1


def test_playing_a_batch_again_changes_nothing(spark, layers, gate):
    gate(0, *BAD)
    before = state_of(spark, layers)
    files = spark.table(layers.raw_table(DEATHS)).inputFiles()
    assert gate(0, *BAD[::-1]) == "partial"
    assert state_of(spark, layers) == before and spark.table(layers.raw_table(DEATHS)).inputFiles() == files


@pytest.mark.parametrize("stop_at", ["forget_runs", "keep_runs", "detect_anomalies", "run_log_row", "ntz"])
def test_a_batch_stopped_half_way_counts_once(spark, layers, gate, monkeypatch, stop_at):
    gate(0, death("a"), death("b"))
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(gated, stop_at, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        gate(1, *BAD)
    assert spark.table(layers.batches).count() == 1
    gate(1, *BAD)
    after = state_of(spark, layers)
    assert len(after[0]) == 4 and len(after[1]) == 8 and len(after[3]) == 8
    names = [t.name for t in spark.catalog.listTables(layers.raw)]
    assert sorted(names) == sorted([DEATHS.table, ACTIVITY.table, f"{DEATHS.table}_quarantine"])


def test_other_rows_under_a_counted_number_are_an_error(spark, layers, gate):
    gate(0, death("a"))
    with pytest.raises(gated.OtherBatch):
        gate(0, death("a", deaths="16"))
    assert tuples(spark.table(layers.raw_table(DEATHS)), "covid_19_deaths") == [(15,)]


def test_rejected_empty_and_tolerated(spark, layers, gate):
    assert gate(0) is None and spark.table(layers.batches).isEmpty()
    assert gate(1, death(deaths="-1"), death("x", deaths="y")) == "rejected"
    failed = spark.table(layers.run_log).where("status = 'failure'").select("stage").collect()
    assert [r[0] for r in failed] == ["validate"] and spark.table(layers.raw_table(DEATHS)).isEmpty()
    assert passed_runs(spark.table(layers.run_log)).isEmpty()
    mostly = (rules.be_between("covid_19_deaths", min_value=0, mostly=0.5),)
    assert gate(2, death("a", deaths="-1"), death("b"), rules=mostly) == "passed"
    assert gate(3, death("a", deaths="-1"), death("b", deaths="-1"), death("c"), rules=mostly) == "partial"
    assert gate(4, death("a"), death("b"), feed=replace(DEATHS, metric=None)) == "passed"


def test_stream_flags_outliers_of_a_batch(spark, layers, tmp_path):
    folder, history = tmp_path / "landing", [death(week=f"2026-01-{d:02d}T00", deaths=str(10 + d % 3)) for d in range(1, 13)]
    folder.mkdir()
    for i, found in enumerate((history, [death(deaths="500"), death("Iowa")], [death("Utah", deaths="z")])):
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, found)))
        gated.gated_ingest(spark, DEATHS, str(folder), str(tmp_path / "checkpoint"), layers, now=NOW)
    assert tuples(spark.table(layers.flags), "run_id", "state", "observed_value") == [("run_covid_0000000001", "Ohio", 500.0)]
    assert tuples(spark.table(layers.batches), "batch_id", "status") == [(0, "passed"), (1, "passed"), (2, "rejected")]


@pytest.mark.parametrize("hot_rows", [300, 10**6])
def test_judged_marks_every_member_of_a_repeated_key(spark, hot_rows):
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id"))
    df = spark.range(1500).select("id", key.alias("k"), F.lit(None).cast("string").alias("void"))
    checks = (rules.not_be_null("k"), rules.compound_columns_unique("k", "void"))
    found = {r["id"]: r["broken"] for r in rules.judged(df, checks, hot_rows).collect()}
    assert len(found) == 1500
    assert all(found[i] == {0: [1], 1: [], 2: [0]}[i % 3] for i in range(1500))
