from dataclasses import replace
from datetime import date

import pytest
from helpers import tuples
from pyspark.sql import functions as F
from test_ingest import death, land

from vintage.feeds import ACTIVITY, DEATHS
from vintage.operators.rules import ValidationFailed
from vintage.plans import feed_run, models
from vintage.plans.feed_run import run_feed, run_feeds, score_run
from vintage.plans.models import (
    MARTS,
    MODEL_TESTS,
    STAGING,
    VIEWS,
    build_models,
    latest_fact,
    refresh_models,
    relation_name,
    run_model_tests,
)
from vintage.schemas import create_tables
from vintage.sources.ledger import failure_alerts, only_passed
from vintage.streaming.ingest import stream_ingest

WEEKS = [f"2026-{m:02d}-{d:02d}T00:00:00.000" for m in (5, 6, 7, 8) for d in (3, 10, 17)]


def feed_week(week, value=10, state="United States", **fields):
    return death(week, state=state, covid_19_deaths=str(value), total_deaths="1000", **fields)


def backfill():
    return [feed_week(w, 10 + i % 3) for i, w in enumerate(WEEKS)] + [feed_week(w, i % 2, "Ohio") for i, w in enumerate(WEEKS)]


def stages(spark, layers):
    return [tuple(r) for r in spark.table(layers.run_log).orderBy("logged_at").select("run_id", "stage", "status", "row_count_in", "row_count_out").collect()]


def test_weekly_runs(spark, layers, tmp_path):
    first = run_feed(spark, DEATHS, land(tmp_path / "in" / "1", "lines", backfill()), layers, run_id="run_1")
    assert first["mark"] is None and first["load"]["row_count_out"] == 24
    land(tmp_path / "in" / "2", "lines", [feed_week("2026-09-05T00:00:00.000", 99), feed_week("2026-09-05T00:00:00.000", 1, "Ohio")])
    second = run_feed(spark, DEATHS, str(tmp_path / "in"), layers, run_id="run_2")
    assert second["mark"] == date(2026, 8, 17) and second["load"]["row_count_out"] == 2
    assert second["validated"] == {"run_2": 2} and second["anomalies_found"] == {"run_2": 1}
    third = run_feed(spark, DEATHS, str(tmp_path / "in"), layers, run_id="run_3")
    assert third["run_id"] is None and third["load"]["row_count_in"] == 0 and third["validated"] == {}
    assert stages(spark, layers) == [
        ("run_1", "extract", "success", 24, 24), ("run_1", "load", "success", 24, 24),
        ("run_1", "validate", "success", 24, 24), ("run_1", "anomaly_detection", "success", 24, 0),
        ("run_2", "extract", "success", 2, 2), ("run_2", "load", "success", 2, 2),
        ("run_2", "validate", "success", 2, 2), ("run_2", "anomaly_detection", "success", 2, 1),
    ]
    flag = spark.table(layers.flags).first()
    assert (flag["run_id"], flag["source"], flag["state"], flag["metric_name"], flag["observed_value"]) == (
        "run_2", "covid", "United States", "covid_19_deaths", 99.0)
    assert score_run(spark, DEATHS, "run_2", layers) == 1
    assert tuples(spark.table(layers.flags), "flag_id") == [(flag["flag_id"],)]
    # Corrected under the same run id, the value is normal again and the flag goes.
    corrected = land(tmp_path / "fix", "lines", [feed_week("2026-09-05T00:00:00.000", 11)])
    run_feed(spark, DEATHS, corrected, layers, run_id="run_2", lookback_days=30)
    assert score_run(spark, DEATHS, "run_2", layers) == 0 and spark.table(layers.flags).isEmpty()


def test_a_reloaded_run_is_judged_again(spark, layers, tmp_path):
    good = land(tmp_path / "good", "lines", [feed_week("2026-09-05", 5)])
    run_feed(spark, DEATHS, good, layers, run_id="run_1")
    raw = spark.table(layers.raw_table(DEATHS))
    assert only_passed(raw, spark.table(layers.run_log)).count() == 1
    bad = land(tmp_path / "bad", "lines", [feed_week("2026-09-05", -7)])
    with pytest.raises(ValidationFailed):
        run_feed(spark, DEATHS, bad, layers, run_id="run_1", lookback_days=30)
    raw = spark.table(layers.raw_table(DEATHS))
    assert stages(spark, layers)[-1][:3] == ("run_1", "validate", "failure") or ("run_1", "validate", "failure") in [r[:3] for r in stages(spark, layers)]
    assert raw.count() == 1 and only_passed(raw, spark.table(layers.run_log)).count() == 0


def test_failed_validation_stops_and_is_not_retried(spark, layers, tmp_path):
    path = land(tmp_path / "in", "pages", [feed_week("2026-09-05"), feed_week("2026-09-05", -1, "Ohio"), feed_week("2026-09-05", -1, "Ohio")])
    with pytest.raises(ValidationFailed) as stop:
        run_feed(spark, DEATHS, path, layers, "pages", run_id="run_1")
    assert {f["rule"] for f in stop.value.failures} == {"be_between", "compound_columns_unique"}
    assert stages(spark, layers)[-1] == ("run_1", "validate", "failure", 3, 0)
    # The rejected rows stay in raw; models may leave them out.
    raw = spark.table(layers.raw_table(DEATHS))
    assert raw.count() == 3 and only_passed(raw, spark.table(layers.run_log)).count() == 0
    assert run_feed(spark, DEATHS, path, layers, "pages")["validated"] == {}
    text = failure_alerts(spark.table(layers.run_log)).first()["text"]
    assert text.splitlines()[:4] == [
        ":rotating_light: *Pipeline Failure*", "*Pipeline:* covid_deaths_pipeline", "*Stage:* validate", "*Run ID:* run_1"]


def test_violations_are_sampled(spark, layers, tmp_path):
    path = land(tmp_path / "in", "lines", [feed_week("2026-09-05", -i, f"s{i}") for i in range(1, 31)])
    with pytest.raises(ValidationFailed):
        run_feed(spark, DEATHS, path, layers, run_id="run_1")
    result = feed_run.validate_run(spark, DEATHS, "run_1", layers)
    assert (result["success"], result["row_count"], result["failed_expectations"]) == (False, 30, 1)
    (detail,) = result["failure_details"]
    assert detail["unexpected_count"] == 30 and len(detail["partial_unexpected_list"]) == 20
    assert feed_run.validate_run(spark, DEATHS, "no such run", layers)["success"]


def test_interrupted_run_is_finished_by_the_next(spark, layers, tmp_path, monkeypatch):
    path = land(tmp_path / "in", "lines", backfill())

    def run_broken(step, error, run_id):
        def stop(*args):
            raise error

        with monkeypatch.context() as broken, pytest.raises(type(error)):
            broken.setattr(feed_run, step, stop)
            run_feed(spark, DEATHS, path, layers, run_id=run_id)

    run_broken("check_run", KeyboardInterrupt(), "run_1")
    run_broken("detect_anomalies", RuntimeError("lost"), "run_2")
    again = run_feed(spark, DEATHS, path, layers, run_id="run_3")
    assert again["run_id"] is None and again["validated"] == {} and again["anomalies_found"] == {"run_1": 0}
    assert [s[:3] for s in stages(spark, layers)] == [
        ("run_1", "extract", "success"), ("run_1", "load", "success"), ("run_1", "validate", "success"),
        ("run_1", "anomaly_detection", "failure"), ("run_1", "anomaly_detection", "success"),
    ]


def test_failed_extraction_is_logged(spark, layers, tmp_path):
    path = land(tmp_path / "in", "lines", [feed_week("2026-09-05"), {"state": "no week"}])
    with pytest.raises(Exception, match="not a valid date"):
        run_feed(spark, DEATHS, path, layers, run_id="run_1")
    assert stages(spark, layers) == [("run_1", "extract", "failure", 0, 0)]
    assert "not a valid date" in failure_alerts(spark.table(layers.run_log)).first()["text"]


def test_feeds_run_side_by_side_without_stopping_each_other(spark, layers, tmp_path):
    deaths = land(tmp_path / "d", "lines", backfill())
    levels = [{"week_end": "2026-09-05", "geography": s, "label": v} for s, v in (("Alabama", "Low"), ("Ohio", "Purple"))]
    activity = land(tmp_path / "a", "lines", levels)
    good, bad = run_feeds(spark, {DEATHS: deaths, ACTIVITY: activity}, layers)
    assert good["load"]["row_count_out"] == 24 and isinstance(bad, ValidationFailed)
    assert spark.table(layers.raw_table(DEATHS)).count() == 24 and spark.table(layers.raw_table(ACTIVITY)).count() == 2


def test_stream_loads_each_file_once(spark, layers, tmp_path):
    path, checkpoint = land(tmp_path / "in", "lines", backfill()), str(tmp_path / "checkpoint")
    stream_ingest(spark, DEATHS, path, checkpoint, layers)
    stream_ingest(spark, DEATHS, path, checkpoint, layers)
    raw = spark.table(layers.raw_table(DEATHS))
    assert tuples(raw.select("run_id").distinct()) == [("run_covid_0000000000",)] and raw.count() == 24
    (tmp_path / "in" / "revised.json").write_text('{"week_ending_date": "2026-05-03", "state": "Ohio", "covid_19_deaths": "77"}')
    stream_ingest(spark, DEATHS, path, checkpoint, layers)
    assert spark.table(layers.raw_table(DEATHS)).count() == 25
    names = build_models(spark, layers)
    assert tuples(spark.table(names["fct_revision_history"]), "state", "previous_value", "current_value") == [("Ohio", 0, 77)]


def test_models(spark, layers, tmp_path):
    sentinel = replace(DEATHS, sentinel=None)
    run_feed(spark, sentinel, land(tmp_path / "1", "lines", backfill()), layers, run_id="run_1")
    activity = [{"week_end": "2026-09-05", "geography": s, "label": "Low"} for s in ("Alabama", "Ohio")]
    run_feed(spark, ACTIVITY, land(tmp_path / "2", "lines", activity), layers, run_id="run_a")
    bad = land(tmp_path / "3", "lines", [feed_week("2026-09-05", -1, "Guam")])
    with pytest.raises(ValidationFailed):
        run_feed(spark, sentinel, bad, layers, run_id="run_2")
    names = build_models(spark, layers)
    assert list(names) == [*STAGING, *MARTS, *VIEWS]
    counts = {m: spark.table(n).count() for m, n in names.items()}
    assert counts == {
        "stg_covid_deaths": 25, "stg_flu_surveillance": 2, "fct_cases_as_reported": 25, "fct_cases_latest": 25,
        "fct_revision_history": 0, "dim_state": 4, "data_freshness_by_state": 3, "pipeline_run_summary": 7,
    }
    tested = run_model_tests({m: spark.table(n) for m, n in names.items()})
    assert tested.count() == len(MODEL_TESTS) == 14 and tested.where("not passed").isEmpty()
    assert spark.catalog.getTable(names["stg_covid_deaths"]).tableType == "VIEW"
    assert spark.catalog.getTable(names["dim_state"]).tableType == "MANAGED"
    passed = build_models(spark, layers, gated=True)
    assert spark.table(passed["fct_cases_latest"]).where("state = 'Guam'").isEmpty()


def test_refresh_equals_full_build(spark, layers, tmp_path):
    sentinel = replace(DEATHS, sentinel=None)
    one_run = lambda name, *records: run_feed(
        spark, sentinel, land(tmp_path / name, "lines", list(records)), layers, run_id=name, lookback_days=400)
    one_run("run_1", *backfill())
    names = build_models(spark, layers)
    one_run("run_2", feed_week(WEEKS[-1], 50), feed_week(WEEKS[-2], 10, "Guam"))
    one_run("run_3", feed_week(WEEKS[-1], 51), feed_week("2026-09-05", 5, "Ohio"))
    contents = lambda: {m: tuples(spark.table(names[m]), *sorted(spark.table(names[m]).columns)) for m in MARTS}
    refresh_models(spark, ["run_2", "run_3"], layers)
    refreshed = contents()
    build_models(spark, layers)
    assert refreshed == contents()
    assert [len(refreshed[m]) for m in MARTS] == [28, 26, 2, 3]
    # The same run again with the old values: its revisions disappear.
    values = {r["state"]: r["covid_19_deaths"] for r in spark.table(layers.raw_table(DEATHS)).where(
        "run_id = 'run_1' and snapshot_date = date'2026-08-17'").collect()}
    one_run("run_2", feed_week(WEEKS[-1], values["United States"]))
    one_run("run_3", feed_week(WEEKS[-1], values["United States"]))
    refresh_models(spark, ["run_2", "run_3"], layers)
    refreshed = contents()
    build_models(spark, layers)
    assert refreshed == contents() and refreshed["fct_revision_history"] == []
    assert [t.name for t in spark.catalog.listTables(layers.marts) if "staging" in t.name] == []


def test_gated_refresh_equals_gated_build(spark, layers, tmp_path):
    sentinel = replace(DEATHS, sentinel=None)
    run_feed(spark, sentinel, land(tmp_path / "1", "lines", backfill()), layers, run_id="run_1")
    guam = [feed_week("2026-09-05", 4, "Guam"), feed_week(WEEKS[-1], 70)]
    run_feed(spark, sentinel, land(tmp_path / "2", "lines", guam), layers, run_id="run_2", lookback_days=400)
    names = build_models(spark, layers)
    contents = lambda: {m: tuples(spark.table(names[m]), *sorted(spark.table(names[m]).columns)) for m in MARTS}
    assert [len(v) for v in contents().values()] == [26, 25, 1, 3]
    with pytest.raises(ValidationFailed):
        run_feed(spark, sentinel, land(tmp_path / "3", "lines", [feed_week("2026-09-05", -4, "Guam")]), layers, run_id="run_2", lookback_days=400)
    refresh_models(spark, ["run_2"], layers, gated=True)
    refreshed = contents()
    build_models(spark, layers, gated=True)
    assert refreshed == contents() and [len(v) for v in refreshed.values()] == [24, 24, 0, 2]


def test_a_failed_build_keeps_the_marts(spark, layers, tmp_path, monkeypatch):
    run_feed(spark, replace(DEATHS, sentinel=None), land(tmp_path / "1", "lines", backfill()), layers, run_id="run_1")
    names = build_models(spark, layers)
    broken = F.when(F.col("state") == "Ohio", F.raise_error(F.lit("lost"))).otherwise(F.col("state"))
    for step in ("as_reported", "latest_fact", "revisions", "dimension"):
        with monkeypatch.context() as patched:
            whole = getattr(models, step)
            patched.setattr(models, step, lambda *a, whole=whole: whole(*a).withColumn("state", broken))
            if step != "revisions":  # no revision, no row to fail on
                with pytest.raises(Exception, match="lost"):
                    build_models(spark, layers)
        assert [spark.table(names[m]).count() for m in MARTS] == [24, 24, 0, 2]
    assert [t.name for t in spark.catalog.listTables(layers.marts) if "staging" in t.name] == []


def test_a_refresh_reads_only_its_periods(spark, layers, tmp_path):
    run_feed(spark, replace(DEATHS, sentinel=None), land(tmp_path / "1", "lines", backfill()), layers, run_id="run_1")
    reported = spark.table(build_models(spark, layers)["fct_cases_as_reported"])
    held = latest_fact(reported.where(F.col("snapshot_date").isin([date(2026, 5, 3)])))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "2026-05-03" in plan


def test_alerts_since_the_last_delivery(spark, layers, tmp_path):
    for name, value in (("run_1", -1), ("run_2", -2)):
        with pytest.raises(ValidationFailed):
            run_feed(spark, DEATHS, land(tmp_path / name, "lines", [feed_week("2026-09-05", value)]), layers, run_id=name, lookback_days=9)
    log = spark.table(layers.run_log)
    first = log.where("status = 'failure'").agg(F.min("logged_at")).first()[0]
    assert tuples(failure_alerts(log), "run_id") == [("run_1",), ("run_2",)]
    assert tuples(failure_alerts(log, first), "run_id") == [("run_2",)]


def test_layers_without_a_name_use_the_current_database(spark, layers, tmp_path):
    before = spark.catalog.currentDatabase()
    bare = replace(layers, marts=None, observability=None)
    spark.catalog.setCurrentDatabase(layers.staging)
    try:
        create_tables(spark, bare)
        run_feed(spark, DEATHS, land(tmp_path / "1", "lines", backfill()), bare, run_id="run_1")
        names = build_models(spark, bare)
        assert names["dim_state"] == f"{layers.staging}.dim_state" and spark.table(names["dim_state"]).count() == 2
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_schema_names_are_used_as_declared():
    assert relation_name(" marts ", "m", "dev") == "marts.m"
    assert relation_name(None, "m", "dev") == "dev.m"
