"""One run of a feed: read what is new, load it, judge it, score it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from vintage.feeds import Feed
from vintage.functions.columns import new_run_id, utc_now
from vintage.operators.anomaly import anomaly_flags, current_run, outliers, scores
from vintage.operators.filters import for_run, last_period, newer_than
from vintage.operators.rules import ValidationFailed, require_success, sample_all, validate
from vintage.operators.upsert import writer_session
from vintage.schemas import Layers
from vintage.sources.digests import changed_rows, create_digests, keep_digests
from vintage.sources.landed import create_landed, enter_files, files_to_read, read_files
from vintage.sources.landing import read_landing, string_fields, typed_rows
from vintage.sources.ledger import compact_log, logged_stage, pending_runs, write_anomaly_flags
from vintage.sources.load import load_batch
from vintage.sources.statistics import history_stats


def ingest(
    records: DataFrame,
    feed: Feed,
    mark: date | None,
    run_id: str | None = None,
    now: datetime | str | None = None,
    lookback_days: int = 0,
) -> DataFrame:
    """Typed rows of the records newer than the mark, stamped with one run id and ingest time."""
    # Filtered first: values of older periods are not parsed and cannot fail the batch.
    fields = newer_than(string_fields(records, feed), "snapshot_date", mark, lookback_days)
    return typed_rows(fields, feed, run_id or new_run_id(), now or utc_now())


def validate_run(spark: SparkSession, feed: Feed, run_id: str, layers: Layers = Layers()) -> dict:
    """Evaluate the feed's rules on one run: verdict, counts, and a sample of each rule's violations."""
    rows = for_run(spark.table(layers.raw_table(feed)), run_id).select(*feed.validated_columns)
    row_count = rows.count()
    if row_count == 0:
        return {"success": True, "row_count": 0, "failed_expectations": 0, "failure_details": [], "results": []}
    # One row per rule.
    results = validate(rows, feed.rules).orderBy("rule_no").collect()
    failed = [row for row in results if not row["success"]]
    details = []
    if failed:
        broken = tuple(feed.rules[row["rule_no"]] for row in failed)
        samples = sample_all(rows, broken, feed.validated_columns).orderBy("rule_no", *feed.validated_columns).collect()
        for i, row in enumerate(failed):
            mine = [{c: v[c] for c in feed.validated_columns} for v in samples if v["rule_no"] == i]
            details.append({**row.asDict(), "partial_unexpected_list": mine})
    return {
        "success": not details,
        "row_count": row_count,
        "failed_expectations": len(details),
        "failure_details": details,
        "results": results,
    }


def detect_anomalies(
    spark: SparkSession, feed: Feed, run_id: str, layers: Layers = Layers(), flagged_at: datetime | str | None = None
) -> int:
    """Score one run against all others and write its flags; returns their number."""
    session = writer_session(spark)
    raw = session.table(layers.raw_table(feed))
    current = current_run(raw, run_id, "state", feed.metric)
    stats = history_stats(session, feed, run_id, layers)
    found = outliers(scores(current, stats, "state", feed.metric), "state", feed.metric, feed.source)
    count = write_anomaly_flags(anomaly_flags(found, flagged_at or utc_now()), run_id, layers)
    spark.catalog.refreshTable(layers.flags)
    return count


def check_run(spark: SparkSession, feed: Feed, run_id: str, layers: Layers = Layers()) -> int:
    """Validate a loaded run and stop if it fails; returns its row count."""
    with logged_stage(spark, layers, run_id, feed.pipeline, "validate") as counts:
        result = validate_run(spark, feed, run_id, layers)
        counts.update(row_count_in=result["row_count"], row_count_out=result["row_count"])
        require_success(result["results"], f"{feed.pipeline} {run_id}")
    return result["row_count"]


def score_run(spark: SparkSession, feed: Feed, run_id: str, layers: Layers = Layers()) -> int:
    """Flag the outliers of a run, which never stops anything; returns their number."""
    with logged_stage(spark, layers, run_id, feed.pipeline, "anomaly_detection") as counts:
        counts["row_count_in"] = for_run(spark.table(layers.raw_table(feed)), run_id).count()
        counts["row_count_out"] = detect_anomalies(spark, feed, run_id, layers)
    return counts["row_count_out"]


def _digest_passed(spark: SparkSession, feed: Feed, layers: Layers) -> None:
    """Keep the digests of runs that passed validation since this was done last."""
    for run_id in pending_runs(spark.table(layers.run_log), feed.pipeline, "validate", "digests", retry_failed=True):
        with logged_stage(spark, layers, run_id, feed.pipeline, "digests") as counts:
            rows = keep_digests(spark, feed, run_id, layers)
            counts.update(row_count_in=rows, row_count_out=rows)


def run_feed(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    layers: Layers = Layers(),
    layout: str = "lines",
    run_id: str | None = None,
    now: datetime | str | None = None,
    lookback_days: int = 0,
    modified_after: str | None = None,
    period_dir: str | None = None,
    changes_only: bool = False,
    known_files: bool = False,
) -> dict:
    """Load what is newer than the high-water mark, validate it, then flag its outliers.

    Where the landing folder has a folder per period, named by ``period_dir``, those up to the mark (less
    ``lookback_days``) are not opened; the rows are the same.

    With ``known_files`` a manifest of the landed files is kept, and files that are known to hold no period after
    the mark (less ``lookback_days``) are not opened. Until the first such run all files are read.

    With ``changes_only`` a record that is read again is loaded only if it differs from the value that the last
    run that passed stored for its period and state, so a feed that is sent in full adds its revisions alone.

    Runs that an interruption left unvalidated or unscored are caught up on. Repeating a run under
    the same ``run_id`` replaces its rows. The result maps run ids to row counts and flag counts.
    """
    run_id = run_id or new_run_id()
    mark = last_period(spark.table(layers.raw_table(feed)), feed.sentinel)
    after = mark and mark - timedelta(days=lookback_days)
    files = None
    if known_files:
        create_landed(spark, layers)
        files = files_to_read(spark, feed, landing, layers, after)
        records = read_files(spark, files, layout)
    else:
        records = read_landing(spark, landing, layout, modified_after, period_dir, after)
    batch = ingest(records, feed, mark, run_id, now, lookback_days)
    if changes_only:
        create_digests(spark, layers)
        _digest_passed(spark, feed, layers)
        batch = changed_rows(spark, feed, batch, layers)
    load = load_batch(spark, feed, batch, run_id, layers)
    if files:
        enter_files(spark, feed, files, layout, layers)
    log = spark.table(layers.run_log)
    checked, failed = {}, []
    for pending in pending_runs(log, feed.pipeline, "load", "validate"):
        try:
            checked[pending] = check_run(spark, feed, pending, layers)
        except ValidationFailed as e:  # an older run must not keep this one from being judged
            failed.append(e)
    if changes_only:
        _digest_passed(spark, feed, layers)
    scored = {}
    if feed.metric:
        log = spark.table(layers.run_log)
        runs = pending_runs(log, feed.pipeline, "validate", "anomaly_detection", retry_failed=True)
        scored = {r: score_run(spark, feed, r, layers) for r in runs}
    compact_log(spark, layers)
    if failed:
        raise ValidationFailed("; ".join(map(str, failed)), [row for e in failed for row in e.failures])
    return {
        "run_id": run_id if load["row_count_in"] else None,
        "mark": mark,
        "load": load,
        "validated": checked,
        "anomalies_found": scored,
    }


def run_feeds(spark: SparkSession, landings: dict[Feed, str], layers: Layers = Layers(), **options) -> list:
    """Run independent feeds side by side; returns each feed's result or the exception it raised."""

    def attempt(item):
        try:
            return run_feed(spark, item[0], item[1], layers, **options)
        except Exception as e:  # one feed's failure must not stop the other
            return e

    with ThreadPoolExecutor(max_workers=len(landings)) as pool:
        return list(pool.map(attempt, landings.items()))
