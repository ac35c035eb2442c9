"""Models from raw tables: staging and observability are views, marts are tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import ACTIVITY, ACTIVITY_LEVELS, DEATHS, Feed
from vintage.functions.columns import surrogate_key, utc_now
from vintage.operators.rules import accepted_failures, null_failures, unique_failures
from vintage.operators.upsert import overwrite, writer_session
from vintage.operators.versions import latest, revision_history, valid_at, validity
from vintage.schemas import PERIOD_KEYS, VERSION, Layers
from vintage.sources.ledger import only_passed, passed_runs

STALE_DAYS = 14

# One definition each for the DataFrame functions and the catalog views below.
_FRESHNESS = """
    SELECT *, days_since_latest_snapshot > {stale_days} AS is_stale
    FROM (
        SELECT {by}, max(snapshot_date) AS latest_snapshot_date, max(ingested_at) AS latest_ingested_at,
               datediff({as_of}, max(snapshot_date)) AS days_since_latest_snapshot
        FROM {fact} GROUP BY {by})
"""
_RUN_SUMMARY = """
    SELECT pipeline_name, stage, total_runs, successful_runs, failed_runs,
           CAST(round(100.0 * successful_runs / total_runs, 1) AS double) AS success_rate_pct,
           avg_duration_ms, max_duration_ms, total_rows_processed, last_run_at
    FROM (
        SELECT pipeline_name, stage, count(1) AS total_runs,
               count_if(status = 'success') AS successful_runs,
               count_if(status = 'failure') AS failed_runs,
               round(avg(duration_ms), 0) AS avg_duration_ms, max(duration_ms) AS max_duration_ms,
               sum(row_count_in) AS total_rows_processed, max(logged_at) AS last_run_at
        FROM {log} GROUP BY pipeline_name, stage)
"""


def staged(raw: DataFrame, feed: Feed) -> DataFrame:
    """The raw table without its payload."""
    return raw.select(*feed.columns)


def as_reported(staging: DataFrame) -> DataFrame:
    """Every version of every value, keyed by state."""
    return staging.select(surrogate_key("state").alias("state_key"), "*")


def latest_fact(reported: DataFrame) -> DataFrame:
    # The key is made again from the few rows that remain, rather than shuffled with all versions.
    rows = reported.drop("state_key")
    # Values only matter where one run reports a period twice; they make the choice repeatable.
    values = [c for c in rows.columns if c not in (*PERIOD_KEYS, *VERSION)]
    kept = latest(rows, PERIOD_KEYS, (*VERSION, *values))
    return kept.select(surrogate_key("state").alias("state_key"), "*")


def revisions(reported: DataFrame, metric: str) -> DataFrame:
    return revision_history(reported, PERIOD_KEYS, VERSION, metric)


def dimension(names: list[DataFrame], column: str, key: str) -> DataFrame:
    """Distinct non-null values of ``column`` over several tables, with a surrogate key.

    One distinct over the union: each task keeps one copy of a value before the only shuffle.
    """
    values = [df.select(column).where(F.col(column).isNotNull()) for df in names]
    merged = reduce(DataFrame.union, values).distinct()
    return merged.select(surrogate_key(column).alias(key), column)


def freshness(fact: DataFrame, by: str = "state", as_of: date | None = None, stale_days: int = STALE_DAYS) -> DataFrame:
    """Newest period per group, its age in days and whether that is too old; stalest first."""
    day = f"DATE'{as_of.isoformat()}'" if as_of else "current_date()"
    text = _FRESHNESS.format(by=by, as_of=day, stale_days=int(stale_days), fact="{fact}")
    return fact.sparkSession.sql(text, fact=fact).orderBy(F.desc("days_since_latest_snapshot"), by)


def run_summary(log: DataFrame) -> DataFrame:
    """Per pipeline and stage: outcomes, success rate, durations, rows. Other statuses only count as runs."""
    return log.sparkSession.sql(_RUN_SUMMARY, log=log).orderBy("pipeline_name", "stage")


# --- fixed values: names of the models ---
STAGING = {"stg_covid_deaths": DEATHS, "stg_flu_surveillance": ACTIVITY}
MARTS = ("fct_cases_as_reported", "fct_cases_latest", "fct_revision_history", "dim_state")
VIEWS = ("data_freshness_by_state", "pipeline_run_summary")


def relation_name(schema: str | None, model: str, default: str) -> str:
    """A declared schema is used as it is; a model without one lands in the default one."""
    return f"{(schema or default).strip()}.{model}"


def model_names(layers: Layers, default: str = "default") -> dict[str, str]:
    """Model name to relation name; a layer without a name lies in the database ``default``."""
    names = {m: relation_name(layers.staging, m, default) for m in STAGING}
    names |= {m: relation_name(layers.marts, m, default) for m in MARTS}
    return names | {m: relation_name(layers.observability, m, default) for m in VIEWS}


def _names(spark: SparkSession, layers: Layers) -> dict[str, str]:
    return model_names(layers, spark.catalog.currentDatabase())


#: Partitions of the as-reported fact: a period is read on its own, a run is replaced on its own.
REPORTED_BY = ("snapshot_date", "run_id")
_PERIOD = ("snapshot_date",)


def _ensure(df: DataFrame, table: str, by: tuple[str, ...] = ()) -> None:
    """An empty table for ``df``, unless there is one with the same columns and partitions."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        stored = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if stored == list(by) and dict(spark.table(table).dtypes) == dict(df.dtypes):
            return
    writer = df.limit(0).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).saveAsTable(table)


def _publish(df: DataFrame, table: str, by: tuple[str, ...], filled: DataFrame, scope: Column | None = None) -> None:
    """Make ``df`` the contents of ``table``, or of its partitions within ``scope``.

    ``filled`` (columns ``by``) holds the partition values that ``df`` has rows for. New files appear when
    their job commits, and partitions left without rows are dropped after that, so a failed job leaves the
    table as it was. ``df`` must come from a ``writer_session``.
    """
    session = df.sparkSession
    stored = session.table(table)
    stored = stored if scope is None else stored.where(scope)
    # Normally none: partitions of periods or runs that no longer count.
    emptied = stored.select(*by).subtract(filled).collect()
    overwrite(df, table)
    if emptied:
        spec = lambda i: ", ".join(f"{c} = :{c}_{i}" for c in by)
        parts = ", ".join(f"PARTITION ({spec(i)})" for i in range(len(emptied)))
        values = {f"{c}_{i}": row[c] for i, row in enumerate(emptied) for c in by}
        session.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}", args=values)


def _by_period(df: DataFrame) -> DataFrame:
    """One file per period, or several of the advisory size, instead of one per task and period."""
    return df.hint("rebalance", *_PERIOD).sortWithinPartitions(*PERIOD_KEYS)


def _publish_reported(deaths: DataFrame, table: str, scope: Column | None = None) -> None:
    # Files of raw are sorted by period, so a task has few of them and no shuffle is needed.
    facts = as_reported(deaths).sortWithinPartitions(*REPORTED_BY, "state")
    _publish(facts, table, REPORTED_BY, deaths.select(*REPORTED_BY).distinct(), scope)


def _publish_modelled(reported: DataFrame, names: dict[str, str], scope: Column | None = None) -> None:
    """The facts that are modelled from the as-reported one, for the periods that ``reported`` is cut to."""
    periods = reported.select(*_PERIOD).distinct()
    _publish(_by_period(latest_fact(reported)), names["fct_cases_latest"], _PERIOD, periods, scope)
    with _staged(revisions(reported, DEATHS.metric), names["fct_revision_history"]) as found:
        _publish(_by_period(found), names["fct_revision_history"], _PERIOD, found.select(*_PERIOD).distinct(), scope)


#: A mart of its own, built on demand and kept up to date afterwards: every version with the time it held.
VALIDITY = "fct_cases_validity"


def validity_name(spark: SparkSession, layers: Layers) -> str:
    return relation_name(layers.marts, VALIDITY, spark.catalog.currentDatabase())


def _publish_validity(reported: DataFrame, table: str, scope: Column | None = None) -> None:
    # Within a period by ingest time: an as-of skips the row groups of later versions.
    held = validity(reported, PERIOD_KEYS, VERSION).hint("rebalance", *_PERIOD).sortWithinPartitions(*_PERIOD, *VERSION)
    _publish(held, table, _PERIOD, reported.select(*_PERIOD).distinct(), scope)


def build_validity(spark: SparkSession, layers: Layers = Layers()) -> str:
    """Build the validity mart from the as-reported fact; ``build_models`` and ``refresh_models`` keep it from then on."""
    table = validity_name(spark, layers)
    reported = writer_session(spark).table(_names(spark, layers)["fct_cases_as_reported"])
    _ensure(validity(reported, PERIOD_KEYS, VERSION), table, _PERIOD)
    _publish_validity(reported, table)
    spark.catalog.refreshTable(table)
    return table


def _keep_validity(spark: SparkSession, reported: DataFrame, layers: Layers, scope: Column | None = None) -> None:
    if spark.catalog.tableExists(table := validity_name(spark, layers)):
        _publish_validity(reported, table, scope)
        spark.catalog.refreshTable(table)


def as_of(
    spark: SparkSession, t: datetime | str, layers: Layers = Layers(), periods: tuple[date, date] | None = None
) -> DataFrame:
    """The latest version known at ``t``, of the periods from the first to the second one if they are given.

    Reads the validity mart: rows are picked by their interval, directories by their period.
    """
    held = spark.table(validity_name(spark, layers))
    if periods is not None:
        held = held.where(F.col("snapshot_date").between(*map(F.lit, periods)))
    return valid_at(held, VERSION, t)


def _publish_dimension(deaths: DataFrame, activity: DataFrame, table: str) -> None:
    _switch(dimension([deaths, activity], "state", "state_key"), table)


def _switch(df: DataFrame, table: str) -> None:
    """Make ``df`` the contents of a table without partitions: written to a place of its own, then one catalog change.

    An overwrite would empty the table first. Here readers see the old or the new rows at any moment, and a
    build that fails has changed nothing. The version before stays for queries that are reading it.
    """
    session = df.sparkSession
    described = session.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    here = described.first()["data_type"].rstrip("/")
    base = here.split(_VERSION)[0]
    there = f"{base}{_VERSION}{utc_now():%Y%m%d%H%M%S%f}"
    df.select(*session.table(table).columns).write.parquet(there)
    session.sql(f"ALTER TABLE {table} SET LOCATION '{there}'")
    jvm = session.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base}{_VERSION}*")):
        if status.getPath().getName() not in (here.rsplit("/", 1)[-1], there.rsplit("/", 1)[-1]):
            fs.delete(status.getPath(), True)


#: Between the location of a table and the time at which its contents were made.
_VERSION = "-version-"


@contextmanager
def _staged(df: DataFrame, table: str) -> Iterator[DataFrame]:
    """``df`` as a table beside ``table`` while the block runs."""
    staging = f"{table}_staging_{utc_now():%Y%m%d%H%M%S%f}"
    try:
        df.write.saveAsTable(staging)
        yield df.sparkSession.table(staging)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {staging}")


def create_views(spark: SparkSession, layers: Layers = Layers()) -> None:
    """The staging views over raw and the observability views over marts and log."""
    names = _names(spark, layers)
    for model, feed in STAGING.items():
        spark.sql(
            f"CREATE OR REPLACE VIEW {names[model]} AS "
            f"SELECT {', '.join(feed.columns)} FROM {layers.raw_table(feed)}"
        )
    if not spark.catalog.tableExists(names["fct_cases_latest"]):
        return
    views = {
        "data_freshness_by_state": _FRESHNESS.format(
            by="state", as_of="current_date()", stale_days=STALE_DAYS, fact=names["fct_cases_latest"]
        ),
        "pipeline_run_summary": _RUN_SUMMARY.format(log=layers.run_log),
    }
    for model, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {names[model]} AS {text}")


def _staging(spark: SparkSession, layers: Layers, gated: bool) -> list[DataFrame]:
    tables = [spark.table(_names(spark, layers)[m]) for m in STAGING]
    return [only_passed(t, spark.table(layers.run_log)) for t in tables] if gated else tables


def build_models(spark: SparkSession, layers: Layers = Layers(), gated: bool = False) -> dict[str, str]:
    """Build every model in dependency order; returns model name to relation name.

    The as-reported fact is written because two models read it, without a shuffle. The other facts
    are partitioned by period, which is what ``refresh_models`` replaces. A build that fails leaves
    the mart at hand as it was. ``gated`` leaves out runs that did not pass validation; the
    default, like the views, takes every run.
    """
    names = _names(spark, layers)
    create_views(spark, layers)
    session = writer_session(spark)
    deaths, activity = _staging(session, layers, gated)
    table = names["fct_cases_as_reported"]
    with _refreshed(spark, names):
        _ensure(as_reported(deaths), table, REPORTED_BY)
        _publish_reported(deaths, table)
        reported = session.table(table)
        _ensure(latest_fact(reported), names["fct_cases_latest"], _PERIOD)
        _ensure(revisions(reported, DEATHS.metric), names["fct_revision_history"], _PERIOD)
        _publish_modelled(reported, names)
        _keep_validity(spark, reported, layers)
        _ensure(dimension([deaths, activity], "state", "state_key"), names["dim_state"])
        _publish_dimension(deaths, activity, names["dim_state"])
    create_views(spark, layers)
    return names


def refresh_models(spark: SparkSession, runs: list[str], layers: Layers = Layers(), gated: bool = False) -> dict[str, str]:
    """Bring built models up to date after ``runs`` were loaded or judged; the result equals a full build.

    Only the partitions of those runs are copied, and only the periods they report, or reported when
    they were modelled last, are modelled again: the cost follows the new data, not the history. The
    dimension alone is made anew where a run may have lost rows.
    """
    names = _names(spark, layers)
    session = writer_session(spark)
    table, mine = names["fct_cases_as_reported"], F.col("run_id").isin(runs)
    staging = _staging(session, layers, gated)
    deaths, activity = (t.where(mine) for t in staging)
    before = session.table(table).where(mine).select(*_PERIOD)
    shrinks = not before.isEmpty() or _may_shrink(session, runs, layers, gated)
    # As many values as the runs have periods.
    periods = [row[0] for row in deaths.select(*_PERIOD).union(before).distinct().collect()]
    held = F.col("snapshot_date").isin([p for p in periods if p is not None])
    held = held | F.col("snapshot_date").isNull() if None in periods else held
    with _refreshed(spark, names):
        _publish_reported(deaths, table, mine)
        _publish_modelled(session.table(table).where(held), names, held)
        _keep_validity(spark, session.table(table).where(held), layers, held)
        if shrinks:
            _publish_dimension(*staging, names["dim_state"])
        else:
            known = session.table(names["dim_state"])
            added = dimension([deaths, activity], "state", "state_key").join(known.select("state"), "state", "left_anti")
            if not added.isEmpty():
                _switch(known.unionByName(added.select(*known.columns)), names["dim_state"])
    return names


@contextmanager
def _refreshed(spark: SparkSession, names: dict[str, str]) -> Iterator[None]:
    """The caller's session sees the marts as they are after the block, also after one that fails."""
    try:
        yield
    finally:
        for model in MARTS:
            if spark.catalog.tableExists(names[model]):
                spark.catalog.refreshTable(names[model])


def _may_shrink(spark: SparkSession, runs: list[str], layers: Layers, gated: bool) -> bool:
    """Whether one of ``runs`` was loaded again or does not count, and so may have lost rows."""
    log = spark.table(layers.run_log).where(F.col("run_id").isin(runs))
    loads = log.where("stage = 'load' AND status = 'success'").groupBy("run_id").count()
    return not loads.where("count > 1").isEmpty() or (gated and passed_runs(log).count() < len(set(runs)))


# --- fixed values: the column tests of the models (model, column, test, accepted values) ---
MODEL_TESTS = (
    ("stg_covid_deaths", "run_id", "not_null", None),
    ("stg_covid_deaths", "snapshot_date", "not_null", None),
    ("stg_covid_deaths", "state", "not_null", None),
    ("stg_flu_surveillance", "run_id", "not_null", None),
    ("stg_flu_surveillance", "snapshot_date", "not_null", None),
    ("stg_flu_surveillance", "state", "not_null", None),
    ("stg_flu_surveillance", "activity_level", "accepted_values", ACTIVITY_LEVELS),
    ("dim_state", "state_key", "unique", None),
    ("dim_state", "state_key", "not_null", None),
    ("fct_cases_as_reported", "run_id", "not_null", None),
    ("fct_cases_latest", "snapshot_date", "not_null", None),
    ("pipeline_run_summary", "pipeline_name", "not_null", None),
    ("data_freshness_by_state", "state", "not_null", None),
    ("data_freshness_by_state", "state", "unique", None),
)


def run_model_tests(models: dict[str, DataFrame], tests: tuple = MODEL_TESTS) -> DataFrame:
    """One row per column test with its number of failures; the null tests of a model share one pass."""
    results = []
    for model in dict.fromkeys(t[0] for t in tests):
        df = models[model]
        mine = [(column, test, values) for name, column, test, values in tests if name == model]
        not_null = [column for column, test, _ in mine if test == "not_null"]
        counted = [null_failures(df, not_null)] if not_null else []
        for column, test, values in mine:
            if test == "unique":
                counted.append(unique_failures(df, column))
            elif test == "accepted_values":
                counted.append(accepted_failures(df, column, values))
        results += [c.select(F.lit(model).alias("model"), "*") for c in counted]
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)
