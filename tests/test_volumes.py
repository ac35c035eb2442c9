"""The log in volumes: nothing lost or twice, whatever runs side by side or stops half way, and files that follow bytes."""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from vintage.operators.upsert import writer_session
from vintage.sources import volumes
from vintage.sources.ledger import append_log, compact_log, run_log_row

NOW = "2026-09-08T06:00:00"


def write(spark, layers, run, pipeline="p", rows=1):
    session = writer_session(spark)
    row = run_log_row(session, run, pipeline, "load", "success", 1, 1, 5, None, NOW)
    append_log(row.crossJoin(session.range(rows)).drop("id") if rows > 1 else row, layers)


def runs(spark, layers):
    volumes.refresh(spark, layers.run_log)
    return Counter((r["pipeline_name"], r["run_id"]) for r in spark.table(layers.run_log).collect())


def files(spark, layers):
    volumes.refresh(spark, layers.run_log)
    return len(spark.table(f"{layers.run_log}_files").inputFiles())


def test_files_follow_bytes_and_not_triggers(spark, layers):
    for i in range(27):
        write(spark, layers, f"run {i}/=+%", "p" if i % 9 else "a pipeline")
        compact_log(spark, layers, fan=3)
        assert files(spark, layers) <= 2 * 2 * 4
    assert runs(spark, layers) == Counter({("p" if i % 9 else "a pipeline", f"run {i}/=+%"): 1 for i in range(27)})
    assert compact_log(spark, layers, fan=3) == 0
    assert spark.table(f"{layers.run_log}_manifest").where("size(replaces) > 0").isEmpty()
    assert spark.table(layers.run_log).columns[:3] == ["log_id", "run_id", "pipeline_name"]


@pytest.mark.parametrize("step", ["_merge", "_enter", "_drop"])
def test_a_compaction_that_stops_anywhere_shows_each_row_once(spark, layers, monkeypatch, step):
    for i in range(4):
        write(spark, layers, f"run_{i}")
    expected = runs(spark, layers)
    whole = getattr(volumes, step)
    for at in range(4):  # stop before or after the n-th call of the step
        calls = []

        def stopping(*args, at=at, calls=calls):
            calls.append(args)
            if len(calls) == at // 2 + 1:
                if at % 2:
                    whole(*args)
                raise RuntimeError("stopped")
            return whole(*args)

        with monkeypatch.context() as patched:
            patched.setattr(volumes, step, stopping)
            try:
                compact_log(spark, layers, fan=4)
            except RuntimeError:
                pass
        assert runs(spark, layers) == expected
        for i in range(3):
            write(spark, layers, f"more_{at}_{i}")
            expected[("p", f"more_{at}_{i}")] += 1
    compact_log(spark, layers, fan=2)
    assert runs(spark, layers) == expected
    assert spark.table(f"{layers.run_log}_manifest").where("size(replaces) > 0").isEmpty()


def test_runs_and_compactions_side_by_side_lose_nothing(spark, layers):
    jobs = [lambda i=i: write(spark, layers, f"run_{i}", rows=1 + i % 3) for i in range(12)]
    jobs[4:4] = jobs[9:9] = [lambda: compact_log(spark, layers, fan=3)] * 2
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda job: job(), jobs))
    expected = Counter({("p", f"run_{i}"): 1 + i % 3 for i in range(12)})
    assert runs(spark, layers) == expected
    compact_log(spark, layers, fan=3)
    assert runs(spark, layers) == expected and files(spark, layers) < 12


def test_one_compaction_at_a_time(spark, layers):
    for i in range(3):
        write(spark, layers, f"run_{i}")
    with volumes._alone(spark, layers.run_log) as first, volumes._alone(spark, layers.run_log) as second:
        assert first and not second
        assert compact_log(spark, layers, fan=2) == 0
    assert compact_log(spark, layers, fan=2) >= 1


def test_a_large_append_is_one_volume_written_by_several_tasks(spark, layers):
    session = writer_session(spark)
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    row = run_log_row(session, "r", "p", "load", "success", 1, 1, 5, None, NOW)
    text = F.concat_ws("", *(F.sha2(F.concat("id", F.lit(str(i))), 256) for i in range(4)))
    rows = session.range(0, 8000, 1, 4).crossJoin(F.broadcast(row)).withColumn("error_message", text).drop("id")
    append_log(rows, layers)
    assert files(spark, layers) > 3
    stored = spark.table(f"{layers.run_log}_files")
    assert stored.select("volume").distinct().count() == 1
    assert spark.table(layers.run_log).select("error_message").distinct().count() == 8000 == stored.count()
    write(spark, layers, "small")
    assert runs(spark, layers) == Counter({("p", "r"): 8000, ("p", "small"): 1})
