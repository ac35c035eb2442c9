"""Run log and anomaly flags: writing them, and what is read from the log."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.columns import ntz, surrogate_key, utc_now
from vintage.operators.filters import for_run
from vintage.operators.upsert import replace_partitions, writer_session
from vintage.schemas import Layers
from vintage.sources import volumes


def run_log_row(
    spark: SparkSession,
    run_id: str,
    pipeline_name: str,
    stage: str,
    status: str,
    row_count_in: int,
    row_count_out: int,
    duration_ms: int,
    error_message: str | None = None,
    logged_at: datetime | str | None = None,
) -> DataFrame:
    text = {"run_id": run_id, "pipeline_name": pipeline_name, "stage": stage, "status": status}
    numbers = {"row_count_in": row_count_in, "row_count_out": row_count_out, "duration_ms": duration_ms}
    row = spark.range(1, numPartitions=1).select(
        *[F.lit(v).alias(k) for k, v in text.items()],
        *[F.lit(v).cast("bigint").alias(k) for k, v in numbers.items()],
        F.lit(error_message).cast("string").alias("error_message"),
        ntz(logged_at or utc_now()).alias("logged_at"),
    )
    return with_log_id(row)


def with_log_id(rows: DataFrame) -> DataFrame:
    """Log rows with an id made of what identifies them, not a random one that a retry would change."""
    log_id = surrogate_key("run_id", "pipeline_name", "stage", "status", "logged_at")
    return rows.select(log_id.alias("log_id"), "*")


def append_log(rows: DataFrame, layers: Layers) -> None:
    """Add rows to the log; ``rows`` must come from a ``writer_session``. Writers do not meet, see ``volumes``."""
    volumes.append(rows, layers.run_log)


def compact_log(spark: SparkSession, layers: Layers = Layers(), fan: int = volumes.FAN) -> int:
    """Merge the log's small files where enough have come together; returns the number of merges."""
    return volumes.compact(spark, layers.run_log, "pipeline_name", fan)


@contextmanager
def logged_stage(spark: SparkSession, layers: Layers, run_id: str, pipeline: str, stage: str) -> Iterator[dict]:
    """Log one stage, also when it raises. The body sets the counts; an empty batch is not logged."""
    counts = {"row_count_in": 0, "row_count_out": 0}
    started = time.monotonic()
    error = None
    try:
        yield counts
    except BaseException as e:
        error = str(e) or type(e).__name__
        counts["row_count_out"] = 0
        raise
    finally:
        if error is not None or counts["row_count_in"]:
            duration_ms = int((time.monotonic() - started) * 1000)
            status = "success" if error is None else "failure"
            session = writer_session(spark)
            row = run_log_row(
                session, run_id, pipeline, stage, status, **counts, duration_ms=duration_ms, error_message=error
            )
            append_log(row, layers)
            volumes.refresh(spark, layers.run_log)


def write_anomaly_flags(flags: DataFrame, run_id: str, layers: Layers) -> int:
    """Replace the flags of one run and return their number; scoring it again does not repeat them.

    ``flags`` must come from a ``writer_session``.
    """
    session = flags.sparkSession
    stored = lambda: for_run(session.table(layers.flags), run_id)
    before = stored().inputFiles()
    replace_partitions(flags, layers.flags)
    session.catalog.refreshTable(layers.flags)
    if before and stored().inputFiles() == before:
        # Nothing is unusual any more: an overwrite without rows leaves the partition alone.
        session.sql(f"ALTER TABLE {layers.flags} DROP IF EXISTS PARTITION (run_id = :run)", args={"run": run_id})
        return 0
    return stored().count()


# --- fixed values: text of a failure alert ---
ALERT_TITLE = ":rotating_light: *Pipeline Failure*"
ALERT_LINES = (
    ("*Pipeline:* ", "pipeline_name"),
    ("*Stage:* ", "stage"),
    ("*Run ID:* ", "run_id"),
    ("*Error:* ", "error_message"),
)


def failure_alerts(log: DataFrame, since: datetime | str | None = None) -> DataFrame:
    """The alert queue: one message per failed stage, ready for whatever delivers it.

    ``since``, the time of the last delivery, leaves out what was logged up to it.
    """
    lines = [F.concat(F.lit(label), F.coalesce(F.col(c), F.lit(""))) for label, c in ALERT_LINES]
    failed = log.where(F.col("status") == "failure")
    if since is not None:
        failed = failed.where(F.col("logged_at") > ntz(since))
    return failed.select(
        "run_id", "pipeline_name", "stage", F.concat_ws("\n", F.lit(ALERT_TITLE), *lines).alias("text")
    )


def _last(log: DataFrame, stage: str) -> DataFrame:
    """Per run the time and status of the last row of a stage."""
    last = F.max(F.struct("logged_at", "status")).alias("last")
    return log.where(F.col("stage") == stage).groupBy("run_id").agg(last).select("run_id", "last.*")


def _last_success(log: DataFrame, stage: str) -> DataFrame:
    done = log.where((F.col("stage") == stage) & (F.col("status") == "success"))
    return done.groupBy("run_id").agg(F.max("logged_at").alias("done_at"))


def passed_runs(log: DataFrame) -> DataFrame:
    """Runs (run_id) whose last validation succeeded and judged what was loaded last."""
    loaded = _last_success(log, "load").withColumnRenamed("run_id", "loaded_run")
    verdicts = _last(log, "validate").where(F.col("status") == "success")
    judged = verdicts.join(loaded, F.col("run_id") == F.col("loaded_run"), "left")
    return judged.where(F.col("done_at").isNull() | (F.col("logged_at") >= F.col("done_at"))).select("run_id")


def only_passed(df: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of runs that passed validation."""
    return df.join(passed_runs(log), "run_id", "left_semi")


def pending_runs(log: DataFrame, pipeline_name: str, done: str, missing: str, retry_failed: bool = False) -> list[str]:
    """Runs whose last success of stage ``done`` is not followed by stage ``missing``.

    The driver may have stopped in between, or the run was loaded again. With ``retry_failed`` a failed
    attempt at ``missing`` does not count. Normally one run.
    """
    mine = log.where(F.col("pipeline_name") == pipeline_name)
    entered = _last_success(mine, missing) if retry_failed else _last(mine, missing).withColumnRenamed("logged_at", "done_at")
    entered = entered.select("run_id", F.col("done_at").alias("entered_at"))
    pending = _last_success(mine, done).join(entered, "run_id", "left").where(
        F.col("entered_at").isNull() | (F.col("entered_at") < F.col("done_at"))
    )
    return [row["run_id"] for row in pending.orderBy("run_id").collect()]
