"""Landed files as a stream that is judged as it is loaded.

Each micro-batch is one run. Its rows are parsed tolerantly and judged inside the batch: what is malformed or
breaks a failed rule goes to the feed's quarantine table with the reasons, the rest to the raw table, the
outliers of what was loaded are flagged, and a row of the batch ledger, written last, makes the batch count.

Every table is written by replacing the partition of the batch's run, so a batch that is played again after a
failure replaces its first attempt, and one that the ledger holds is left alone. The ledger keeps a digest of
the payloads: other rows under the number of a batch that counts (a checkpoint that was lost, say) are an error
and not skipped silently.
"""

from __future__ import annotations

import time
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import ntz, utc_now
from vintage.operators.filters import for_run
from vintage.operators.rules import Rule, judged, validate
from vintage.operators.upsert import overwrite, replace_partitions, writer_session
from vintage.plans.feed_run import detect_anomalies
from vintage.schemas import BATCHES_DDL, QUARANTINE_DDL, REQUIRED, Layers
from vintage.sources import volumes
from vintage.sources.landing import payload_field, stream_landing, string_fields, typed_rows
from vintage.sources.ledger import append_log, compact_log, run_log_row
from vintage.sources.statistics import forget_runs, keep_runs
from vintage.streaming.ingest import batch_run_id

PASSED, PARTIAL, REJECTED = "passed", "partial", "rejected"


class OtherBatch(ValueError):
    """The ledger holds a batch of this number with other rows."""


def create_gate_tables(spark: SparkSession, feed: Feed, layers: Layers = Layers()) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layers.quarantine(feed)} ({QUARANTINE_DDL}) USING parquet PARTITIONED BY (run_id)"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layers.batches} ({BATCHES_DDL}) USING parquet PARTITIONED BY (source, run_id)"
    )


def _malformed(feed: Feed) -> Column:
    """A reason for each field of a record that cannot be read as its type."""
    number = lambda c: c.isNotNull() & (c != "") & c.try_cast("bigint").isNull()
    found = [
        F.when(number(payload_field(field)), F.lit(f"malformed {name}")) for name, field, kind in feed.fields if kind == "bigint"
    ]
    return F.array_compact(F.array(F.lit(None).cast("string"), *found))


def _reasons(feed: Feed, rules: tuple[Rule, ...], failed: list[int]) -> Column:
    """Why a row is not let through: malformed or missing fields, then the failed rules that it breaks."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]
    named = [
        F.when(F.array_contains("broken", i), F.lit(f"{rules[i].name}({','.join(rules[i].columns)})")) for i in failed
    ]
    return F.array_compact(F.concat("malformed", F.array(*missing), F.array(F.lit(None).cast("string"), *named)))


def _digest(staged: DataFrame) -> tuple[int, str]:
    """How many records a batch has, and a digest that does not depend on their order."""
    payload = F.xxhash64(F.to_json("raw_payload")).cast("decimal(38,0)")
    row = staged.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(payload), F.lit(0)).cast("string").alias("digest")).first()
    return row["n"], f"{row['n']}:{row['digest']}"


def _replace(rows: DataFrame, table: str, run_id: str, n: int) -> None:
    """Make ``rows`` the partition of the run; an overwrite without rows would leave an earlier one."""
    if n:
        replace_partitions(rows, table, sort=("snapshot_date",))
    else:
        rows.sparkSession.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_id = :run)", args={"run": run_id})


def admit(
    spark: SparkSession,
    feed: Feed,
    records: DataFrame,
    batch_id: int,
    layers: Layers = Layers(),
    rules: tuple[Rule, ...] | None = None,
    now: datetime | str | None = None,
) -> str | None:
    """Judge and load one micro-batch; returns its status, or None for an empty one.

    ``passed``: all rows let through, ``partial``: some, ``rejected``: none. A rule with ``mostly`` that the
    batch satisfies keeps no row out. ``rules`` are the feed's own by default.
    """
    rules = feed.rules if rules is None else rules
    run_id, now, started = batch_run_id(feed, batch_id), now or utc_now(), time.monotonic()
    staging = f"{layers.raw_table(feed)}_gate_{batch_id}_{utc_now():%Y%m%d%H%M%S%f}"
    try:
        # Parsed once; the digest, the rules and both writes read the staged rows.
        fields = string_fields(records, feed, strict=False)
        rows = typed_rows(fields, feed, run_id, now, strict=False).withColumn("malformed", _malformed(feed))
        rows.write.saveAsTable(staging)
        n, digest = _digest(spark.table(staging))
        if n == 0:
            return None
        known = spark.table(layers.batches).where((F.col("source") == feed.source) & (F.col("run_id") == run_id)).first()
        if known is not None:
            if known["digest"] != digest:
                raise OtherBatch(f"batch {batch_id} of {feed.source} counts with other rows than these")
            return known["status"]
        return _admit(spark, feed, staging, batch_id, run_id, layers, rules, now, started, n, digest)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


def _admit(spark, feed, staging, batch_id, run_id, layers, rules, now, started, n, digest) -> str:
    session = writer_session(spark)
    staged = session.table(staging)
    failed = [r["rule_no"] for r in validate(staged, rules).where(~F.col("success")).orderBy("rule_no").collect()]
    verdicts = f"{staging}_judged"
    try:
        judged(staged, rules).withColumn("reasons", _reasons(feed, rules, failed)).write.saveAsTable(verdicts)
        marked = session.table(verdicts)
        good = marked.where(F.size("reasons") == 0)
        passed = good.count()
        bad = marked.where(F.size("reasons") > 0).select("snapshot_date", "reasons", "raw_payload", "run_id")
        _replace(bad, layers.quarantine(feed), run_id, n - passed)
        if feed.metric:
            forget_runs(spark, feed, [run_id], layers)
        raw = layers.raw_table(feed)
        _replace(good.select(*session.table(raw).columns), raw, run_id, passed)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {verdicts}")
    for table in (raw, layers.quarantine(feed)):
        spark.catalog.refreshTable(table)
    status = PASSED if passed == n else PARTIAL if passed else REJECTED
    stages = {"extract": (n, n), "load": (n, passed), "validate": (n, passed)}
    if feed.metric and passed:
        keep_runs(spark, feed, [run_id], layers)
        stages["anomaly_detection"] = (passed, detect_anomalies(spark, feed, run_id, layers, now))
    took = int((time.monotonic() - started) * 1000)
    error = f"no row of batch {batch_id} was let through" if status == REJECTED else None
    rows = [
        run_log_row(
            session, run_id, feed.pipeline, stage, "failure" if error and stage == "validate" else "success", a, b, took,
            error if stage == "validate" else None, now,
        )
        for stage, (a, b) in stages.items()
    ]
    # One append of all stages, unless an attempt that stopped after it has made it: they are not logged twice.
    logged = session.table(layers.run_log).where((F.col("pipeline_name") == feed.pipeline) & (F.col("run_id") == run_id))
    if logged.where("stage = 'load'").isEmpty():
        append_log(reduce(DataFrame.unionByName, rows), layers)
    entry = session.range(1, numPartitions=1).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(status).alias("status"),
        *(F.lit(v).cast("bigint").alias(c) for c, v in (("row_count_in", n), ("row_count_passed", passed), ("row_count_quarantined", n - passed))),
        F.array(*(F.lit(rules[i].name) for i in failed)).cast("array<string>").alias("failed_rules"),
        F.lit(digest).alias("digest"),
        ntz(now).alias("judged_at"),
        F.lit(feed.source).alias("source"),
        F.lit(run_id).alias("run_id"),
    )
    overwrite(entry, layers.batches)
    spark.catalog.refreshTable(layers.batches)
    volumes.refresh(spark, layers.run_log)
    return status


def gated_ingest(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    checkpoint: str,
    layers: Layers = Layers(),
    layout: str = "lines",
    max_files: int | None = None,
    now: datetime | str | None = None,
    rules: tuple[Rule, ...] | None = None,
):
    """Judge and load all files that arrived since the last call, then stop; returns the finished query."""
    create_gate_tables(spark, feed, layers)

    def load(records: DataFrame, batch_id: int) -> None:
        admit(spark, feed, records, batch_id, layers, rules, now)

    query = (
        stream_landing(spark, landing, layout, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    compact_log(spark, layers)
    return query


def quarantined(spark: SparkSession, feed: Feed, layers: Layers = Layers(), run_id: str | None = None) -> DataFrame:
    """Rows that were kept out, with their reasons; of one run if it is given."""
    rows = spark.table(layers.quarantine(feed))
    return rows if run_id is None else for_run(rows, run_id)
