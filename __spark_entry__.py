"""

``events`` stands in for the feeds. The views below give its rows the shape of a raw table, an
activity table and a run log; they keep every row and inject nulls and rule violations as values.
The same view text runs in Spark and in DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import ACTIVITY, ACTIVITY_LEVELS, DEATHS, Feed
from vintage.functions.columns import lower_columns, ntz
from vintage.functions.skew import with_versions
from vintage.operators import anomaly, filters, paging, rules, upsert, versions
from vintage.plans import feed_run, models
from vintage.schemas import KEYS, PERIOD_KEYS, VERSION, Layers, create_tables
from vintage.session import shared_dir
from vintage.sources import landing, ledger, volumes
from vintage.sources.load import load_batch
from vintage.streaming import gated
from vintage.streaming.ingest import stream_ingest

try:
    import corpus_pipeline
    from vintage.llm import queries as llm
except ImportError as missing:
    # The subpackage, or a library that only it needs, is not there. An error within ``vintage`` is one.
    if (missing.name or "").startswith("vintage") and missing.name != "vintage.llm":
        raise
    llm = None

RUN = "run_9"
AS_OF = "2024-01-15 12:00:00"
CUT = "2024-01-20 12:00:00"
STAMP = "2024-02-01 06:00:00"
FRESH_AS_OF = date(2024, 2, 13)
BACKFILL_TO = date(2024, 1, 20)
METRIC = DEATHS.metric
#: The value of a day when its feed is sent again.
RESENT = "CASE WHEN user_id % 10 = 3 THEN total + 7 ELSE total END"
AS_OF_TIMES = {AS_OF: None, CUT: None, "2024-01-28 00:00:00": (date(2024, 1, 10), BACKFILL_TO)}

# --- views over events ---

REPORTS = """
    SELECT event_id, user_id, 'run_' || cast(event_id % 10 AS string) AS run_id,
           cast(ts AS date) AS snapshot_date, ts AS ingested_at,
           CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS state,
           CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -1
                ELSE cast(floor(value) AS bigint) END AS covid_19_deaths,
           cast(floor(value) AS bigint) + (event_id % 5) - 1 AS total_deaths,
           cast(floor(value / 2) AS bigint) AS pneumonia_deaths,
           CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(floor(value / 4) AS bigint) END
               AS pneumonia_and_covid_19_deaths,
           event_id % 20 AS influenza_deaths
    FROM {events}
"""
ACTIVITY_REPORTS = """
    SELECT event_id, user_id, 'run_' || cast(event_id % 10 AS string) AS run_id,
           cast(ts AS date) AS snapshot_date, ts AS ingested_at,
           CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_type END AS state,
           CASE user_id % 8 WHEN 0 THEN 'Very Low' WHEN 1 THEN 'Low' WHEN 2 THEN 'Moderate'
                WHEN 3 THEN 'High' WHEN 4 THEN 'Very High' WHEN 5 THEN 'Data Unavailable'
                WHEN 6 THEN 'Unknown' END AS activity_level
    FROM {events}
"""
LOGS = """
    SELECT 'run_' || cast(event_id % 10 AS string) AS run_id,
           'p' || cast(user_id % 3 AS string) AS pipeline_name, event_type AS stage,
           CASE WHEN event_id % 11 = 0 THEN 'failure' WHEN event_id % 53 = 0 THEN 'running'
                ELSE 'success' END AS status,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 1000 END AS row_count_in,
           event_id % 1000 AS row_count_out,
           cast(floor(value * 10) AS bigint) AS duration_ms,
           CASE WHEN event_id % 2 = 0 THEN 'error ' || props END AS error_message,
           ts AS logged_at
    FROM {events}
"""
# Source records, all values strings; a null becomes a missing key.
DEATHS_RECORDS = """
    SELECT cast(cast(ts AS date) AS string) || 'T00:00:00.000' AS week_ending_date,
           event_type AS state,
           CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL
                ELSE cast(cast(floor(value) AS bigint) AS string) END AS covid_19_deaths,
           ' ' || cast(cast(floor(value) AS bigint) + event_id % 5 AS string) || ' ' AS total_deaths,
           '0' AS pneumonia_deaths,
           cast(event_id % 20 AS string) AS influenza_deaths,
           cast(event_id AS string) AS unlisted_key
    FROM {events}
"""
ACTIVITY_RECORDS = """
    SELECT cast(cast(ts AS date) AS string) || 'T00:00:00.000' AS week_end,
           event_type AS geography,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'Low' END AS label,
           cast(event_id AS string) AS unlisted_key
    FROM {events}
"""
# A fifth of the rows stands three times.
COPIES = """
    SELECT snapshot_date, state, run_id, ingested_at, covid_19_deaths
    FROM {reports} AS r JOIN (SELECT 0 AS copy UNION ALL SELECT 1 UNION ALL SELECT 2) AS c ON copy = 0 OR event_id % 5 = 0
"""
WITH_NAN = """
    SELECT run_id, snapshot_date, state,
           CASE WHEN event_id % 13 = 0 THEN cast('NaN' AS double) ELSE cast(covid_19_deaths AS double) / 4 END AS value
    FROM {reports}
"""
# One value per (day, user): unique keys, so these records pass the uniqueness rule.
DAILY = """
    SELECT cast(ts AS date) AS day, user_id, count(*) AS n, cast(sum(floor(value)) AS bigint) AS total
    FROM {events} GROUP BY cast(ts AS date), user_id
"""

# Source records of which the later ones are faulty here and there. ``fault`` tells how, but is not landed.
FAULTY = """
    SELECT day, fault, CASE WHEN fault <> 0 THEN cast(day AS string) || 'T00:00:00.000' END AS week_ending_date,
           CASE WHEN fault = 1 THEN NULL WHEN fault IN (5, 6, 7) THEN 'twice' ELSE 'u' || cast(user_id AS string) END AS state,
           CASE WHEN fault = 2 THEN 'x' WHEN fault = 3 THEN '-5' ELSE cast(total AS string) END AS covid_19_deaths,
           CASE WHEN fault = 4 THEN '0' ELSE cast(total + n AS string) END AS total_deaths
    FROM (SELECT *, CASE WHEN day > DATE '{cut}' THEN (user_id * 31 + extract(DAY FROM day)) % 41 ELSE 40 END AS fault FROM ({daily}))
""".replace("{cut}", BACKFILL_TO.isoformat()).replace("{daily}", DAILY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, events=_table(spark, sf_dir, "events"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, REPORTS)


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ACTIVITY_REPORTS)


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LOGS)


def _reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.as_reported(models.staged(_reports(spark, sf_dir), DEATHS))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _layers(spark: SparkSession) -> Layers:
    """Fresh databases for one query, in the shared folder."""
    tag = uuid.uuid4().hex[:12]
    layers = Layers.prefixed(f"v{tag}_")
    create_tables(spark, layers, f"{shared_dir(spark)}/warehouse-{tag}")
    return layers


def _land(spark: SparkSession, *parts: DataFrame) -> str:
    """Write records as JSON lines, one subfolder per part; returns the landing folder."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex[:12]}"
    for i, records in enumerate(parts):
        records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.text(f"{path}/{i}")
    return path


def _raw_rows(rows: DataFrame, feed: Feed) -> DataFrame:
    return rows.select(*feed.columns, F.lit(None).cast("variant").alias("raw_payload"))


# --- models ---


def latest(spark, sf_dir):
    return models.latest_fact(_reported(spark, sf_dir))


def latest_as_of(spark, sf_dir):
    return versions.latest_as_of(_reported(spark, sf_dir), PERIOD_KEYS, VERSION, AS_OF)


def revision_history(spark, sf_dir):
    return models.revisions(_reported(spark, sf_dir), METRIC).withColumn(
        "version_number", F.col("version_number").cast("int")
    )


def dim_state(spark, sf_dir):
    nations = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("state"))
    types = _table(spark, sf_dir, "events").select(F.col("event_type").alias("state"))
    return models.dimension([nations, types], "state", "state_key")


def freshness(spark, sf_dir):
    fact = versions.latest(_reports(spark, sf_dir), ("snapshot_date", "user_id"), VERSION)
    return models.freshness(fact, by="user_id", as_of=FRESH_AS_OF)


def run_summary(spark, sf_dir):
    return models.run_summary(_logs(spark, sf_dir))


# --- outliers ---


def state_stats(spark, sf_dir):
    stats = anomaly.group_stats(_reports(spark, sf_dir), "state", METRIC)
    return _rounded(stats, "mean", "std")


def z_scores(spark, sf_dir):
    raw = _reports(spark, sf_dir)
    current = anomaly.current_run(raw, RUN, "state", METRIC)
    scored = anomaly.z_scores(current, anomaly.history(raw, RUN, "state", METRIC), "state", METRIC)
    return _rounded(scored, "mean", "std", "z_score")


def _anomalies(spark, sf_dir):
    raw = _reports(spark, sf_dir)
    current = anomaly.current_run(raw, RUN, "state", METRIC)
    past = anomaly.history(raw, RUN, "state", METRIC)
    return anomaly.anomalies(current, past, "state", METRIC, DEATHS.source)


def anomalies(spark, sf_dir):
    found = _anomalies(spark, sf_dir).drop("snapshot_date")
    return _rounded(found, "expected_range_low", "expected_range_high", "z_score")


def anomaly_flags(spark, sf_dir):
    flags = anomaly.anomaly_flags(_anomalies(spark, sf_dir), STAMP)
    return _rounded(flags, "expected_range_low", "expected_range_high", "z_score")


# --- rules ---


def _validated(df: DataFrame, checks) -> DataFrame:
    return _rounded(rules.validate(df, tuple(checks)), "unexpected_percent")


def rule_not_null(spark, sf_dir):
    return _validated(_reports(spark, sf_dir), [rules.not_be_null("state"), rules.not_be_null("snapshot_date")])


def rule_between(spark, sf_dir):
    checks = [
        rules.be_between("covid_19_deaths", min_value=0),
        rules.be_between("total_deaths", min_value=0),
        rules.be_between("total_deaths", min_value=0, max_value=500, mostly=0.95),
    ]
    return _validated(_reports(spark, sf_dir), checks)


def rule_in_set(spark, sf_dir):
    return _validated(_reports(spark, sf_dir), [rules.be_in_set("state", ("view", "click"))])


def rule_pair_ge(spark, sf_dir):
    check = rules.pair_a_at_least_b("total_deaths", "covid_19_deaths", "either_value_is_missing")
    return _validated(_reports(spark, sf_dir), [check])


def rule_compound_unique(spark, sf_dir):
    daily = _reports(spark, sf_dir).withColumn("day", F.col("snapshot_date"))
    checks = (rules.compound_columns_unique(*KEYS), rules.compound_columns_unique("user_id", "day", "state"))
    return _rounded(rules.validate(daily, checks, by_hash=True), "unexpected_percent")


def validate_deaths(spark, sf_dir):
    return _validated(_reports(spark, sf_dir).select(*DEATHS.validated_columns), DEATHS.rules)


def validate_activity(spark, sf_dir):
    return _validated(_activity(spark, sf_dir).select(*ACTIVITY.validated_columns), ACTIVITY.rules)


def validation_gate(spark, sf_dir):
    judged = [
        rules.verdict(rules.validate(df, feed.rules)).select(F.lit(feed.pipeline).alias("pipeline_name"), "*")
        for feed, df in ((DEATHS, _reports(spark, sf_dir)), (ACTIVITY, _activity(spark, sf_dir)))
    ]
    return judged[0].unionByName(judged[1])


def rule_violations(spark, sf_dir):
    """The first violations of every deaths rule, as the suite reports them."""
    found = rules.sample_all(_reports(spark, sf_dir), DEATHS.rules, ("event_id",))
    return found.select("rule_no", "event_id", *KEYS, "covid_19_deaths", "total_deaths")


def model_tests(spark, sf_dir):
    reported = _reported(spark, sf_dir)
    fact = models.latest_fact(reported)
    built = {
        "stg_covid_deaths": models.staged(_reports(spark, sf_dir), DEATHS),
        "stg_flu_surveillance": models.staged(_activity(spark, sf_dir), ACTIVITY),
        "dim_state": dim_state(spark, sf_dir),
        "fct_cases_as_reported": reported,
        "fct_cases_latest": fact,
        "pipeline_run_summary": run_summary(spark, sf_dir),
        "data_freshness_by_state": models.freshness(fact, as_of=FRESH_AS_OF),
    }
    return models.run_model_tests(built)


# --- ingest ---


def high_water_mark(spark, sf_dir):
    return filters.high_water_mark(_reports(spark, sf_dir), "view")


def incremental(spark, sf_dir):
    """What the feed holds beyond the mark of a store last loaded at CUT."""
    feed = _reports(spark, sf_dir)
    mark = filters.last_period(feed.where(F.col("ingested_at") <= ntz(CUT)), "view")
    return filters.newer_than(feed, "snapshot_date", mark).select("event_id", *KEYS, "covid_19_deaths")


def _ingested(spark, sf_dir, feed: Feed, text: str) -> DataFrame:
    records = landing.read_landing(spark, _land(spark, _view(spark, sf_dir, text)))
    batch = feed_run.ingest(records, feed, None, run_id="run_fixed", now=STAMP)
    return batch.withColumn("unlisted_key", landing.payload_field("unlisted_key", "bigint")).drop("raw_payload")


def ingest_deaths(spark, sf_dir):
    return _ingested(spark, sf_dir, DEATHS, DEATHS_RECORDS)


def ingest_activity(spark, sf_dir):
    return _ingested(spark, sf_dir, ACTIVITY, ACTIVITY_RECORDS)


def payload_extract(spark, sf_dir):
    payload = landing.payload_field
    return (
        _table(spark, sf_dir, "events")
        .select("event_id", F.parse_json("props").alias("raw_payload"))
        .select("event_id", payload("k", "bigint").alias("k"), payload("absent").alias("absent"))
    )


def page_ordered(spark, sf_dir):
    return paging.page(_table(spark, sf_dir, "orders"), ("o_orderdate", "o_orderkey"), paging.PAGE_SIZE, 1)


def page_deep(spark, sf_dir):
    """A page across the end of the null dates, found through many small slices."""
    dated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    keys = _table(spark, sf_dir, "orders").select(dated.alias("o_orderdate"), "o_orderkey", "o_custkey")
    return paging.page(keys, ("o_orderdate", "o_orderkey"), 100, 2, slice_rows=200)


def page_indexed(spark, sf_dir):
    """Several pages of a stored order: the first, one across the end of the null dates, a later and the last one."""
    dated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    rows = _table(spark, sf_dir, "orders").select(dated.alias("o_orderdate"), "o_orderkey", "o_custkey")
    path, order = f"{shared_dir(spark)}/pages-{uuid.uuid4().hex[:12]}", ("o_orderdate", "o_orderkey")
    size, last = 100, (rows.count() - 1) // 100
    paging.build_pages(rows, order, path, slice_rows=400)
    pages = [paging.stored_page(spark, path, order, size, n).withColumn("page", F.lit(n).cast("bigint")) for n in (0, 2, 9, last)]
    return reduce(DataFrame.unionByName, pages)


def versions_all(spark, sf_dir):
    """Every copy of every row is a version, also in groups that are cut into slices."""
    copies = spark.sql(COPIES, reports=_reports(spark, sf_dir))
    order = ("ingested_at", "run_id", METRIC)
    return with_versions(copies, ("snapshot_date", "state"), order, METRIC, hot_rows=50)


def z_scores_double(spark, sf_dir):
    """Scores of a floating metric in which a NaN is a missing value."""
    raw = spark.sql(WITH_NAN, reports=_reports(spark, sf_dir))
    current = anomaly.current_run(raw, RUN, "state", "value")
    scored = anomaly.z_scores(current, anomaly.history(raw, RUN, "state", "value"), "state", "value")
    return _rounded(scored, "mean", "std", "z_score")


def stream_ingested(spark, sf_dir):
    layers = _layers(spark)
    path = _land(spark, _view(spark, sf_dir, DEATHS_RECORDS))
    stream_ingest(spark, DEATHS, path, f"{path}-checkpoint", layers, now=STAMP)
    return spark.table(layers.raw_table(DEATHS)).drop("raw_payload")


def stream_gated(spark, sf_dir):
    """Two micro-batches, the second with faulty rows, then both played again: ledger, quarantine and raw."""
    layers = _layers(spark)
    records = _view(spark, sf_dir, FAULTY)
    landed = [c for c in records.columns if c not in ("day", "fault")]
    late = F.col("day") > F.lit(BACKFILL_TO)
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex[:12]}"
    for i, part in enumerate((records.where(~late), records.where(late))):
        part.select(F.to_json(F.struct(*landed)).alias("value")).write.text(f"{path}/{i}")
        gated.gated_ingest(spark, DEATHS, path, f"{path}-checkpoint", layers, now=STAMP)
    for i in range(2):
        gated.admit(spark, DEATHS, landing.read_landing(spark, f"{path}/{i}"), i, layers, now=CUT)
    null = F.lit(None)
    ledgered = spark.table(layers.batches).select(
        F.lit("ledger").alias("kept_in"), "run_id", F.concat_ws(",", "failed_rules").alias("reasons"), "status",
        null.cast("date").alias("snapshot_date"), null.cast("string").alias("state"), null.cast("bigint").alias("covid_19_deaths"),
        "row_count_in", "row_count_passed", "row_count_quarantined",
    )
    row = lambda kept_in, reasons: (
        F.lit(kept_in).alias("kept_in"), "run_id", reasons.alias("reasons"), null.cast("string").alias("status"), "snapshot_date", "state",
        "covid_19_deaths", *(null.cast("bigint").alias(f"row_count_{c}") for c in ("in", "passed", "quarantined")),
    )
    out = gated.quarantined(spark, DEATHS, layers).withColumns({
        "state": landing.payload_field("state"), "covid_19_deaths": landing.payload_field("covid_19_deaths").try_cast("bigint")
    })
    raw = spark.table(layers.raw_table(DEATHS))
    return ledgered.unionByName(out.select(*row("quarantine", F.concat_ws(",", "reasons")))).unionByName(raw.select(*row("raw", F.lit(""))))


# --- load ---


def _upserted(spark, sf_dir, feed: Feed, rows: DataFrame) -> DataFrame:
    """Load what was known before CUT, then the later values: some replace, some are new."""
    layers = _layers(spark)
    early, late = F.col("ingested_at") < ntz(CUT), F.col("ingested_at") >= ntz(CUT)
    for part, name in ((early, "run_early"), (late, "run_late")):
        batch = versions.latest(rows.where(part), KEYS, ("ingested_at",))
        load_batch(spark, feed, _raw_rows(batch, feed), name, layers)
    return spark.table(layers.raw_table(feed)).select(*feed.columns)


def upsert_deaths(spark, sf_dir):
    return _upserted(spark, sf_dir, DEATHS, _reports(spark, sf_dir))


def upsert_activity(spark, sf_dir):
    return _upserted(spark, sf_dir, ACTIVITY, _activity(spark, sf_dir))


def upsert_outcomes(spark, sf_dir):
    """What an upsert of all later rows makes of each of them and of each row stored before."""
    rows = _reports(spark, sf_dir)
    stored = rows.where((F.col("ingested_at") < ntz(CUT)) & (F.col("event_id") % 3 > 0))
    return upsert.outcomes(stored, rows.where(F.col("ingested_at") >= ntz(CUT))).select("event_id", *KEYS, "outcome")


_LOG_COLUMNS = ("run_id", "pipeline_name", "stage", "status", "row_count_in", "row_count_out")


def run_log_rows(spark, sf_dir):
    layers = _layers(spark)
    load_batch(spark, DEATHS, _raw_rows(_reports(spark, sf_dir), DEATHS), "run_all", layers)
    return spark.table(layers.run_log).select(*_LOG_COLUMNS)


def empty_batch(spark, sf_dir):
    """A re-run right after a full load: nothing is newer, so nothing is written or logged."""
    layers = _layers(spark)
    feed = _reports(spark, sf_dir)
    mark = filters.last_period(feed, None)
    batch = _raw_rows(filters.newer_than(feed, "snapshot_date", mark), DEATHS)
    load = load_batch(spark, DEATHS, batch, "run_again", layers)
    logged = spark.table(layers.run_log).agg(F.count(F.lit(1)).alias("log_rows"))
    return logged.select(*[F.lit(v).alias(k) for k, v in load.items()], "log_rows")


def failure_alerts(spark, sf_dir):
    return ledger.failure_alerts(_logs(spark, sf_dir))


def lowered(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return lower_columns(events.toDF(*[c.upper() for c in events.columns]))


# --- whole runs ---


def _append(rows: DataFrame, feed: Feed, layers: Layers) -> None:
    table = layers.raw_table(feed)
    _raw_rows(rows, feed).select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def refresh_models(spark, sf_dir):
    """Models built on what was known before CUT, then refreshed for the runs that reported since."""
    layers = _layers(spark)
    reports = _reports(spark, sf_dir)
    early, late = F.col("ingested_at") < ntz(CUT), F.col("ingested_at") >= ntz(CUT)
    _append(reports.where(early), DEATHS, layers)
    models.build_models(spark, layers)
    _append(reports.where(late), DEATHS, layers)
    runs = [row[0] for row in reports.where(late).select("run_id").distinct().collect()]
    built = models.refresh_models(spark, runs, layers)
    return spark.table(built["fct_revision_history"])


def as_of_intervals(spark, sf_dir):
    """What was known at several times, from validity kept through a refresh; the last one for a few periods."""
    layers = _layers(spark)
    reports = _reports(spark, sf_dir)
    early = F.col("ingested_at") < ntz(CUT)
    _append(reports.where(early), DEATHS, layers)
    models.build_models(spark, layers)
    models.build_validity(spark, layers)
    _append(reports.where(~early), DEATHS, layers)
    runs = [row[0] for row in reports.where(~early).select("run_id").distinct().collect()]
    models.refresh_models(spark, runs, layers)
    parts = [
        models.as_of(spark, t, layers, periods).select(F.lit(t).alias("as_of"), "state_key", *DEATHS.columns)
        for t, periods in AS_OF_TIMES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def materialize_models(spark, sf_dir):
    layers = _layers(spark)
    _append(_reports(spark, sf_dir), DEATHS, layers)
    _append(_activity(spark, sf_dir), ACTIVITY, layers)
    ledger.append_log(ledger.with_log_id(_logs(upsert.writer_session(spark), sf_dir)), layers)
    volumes.refresh(spark, layers.run_log)
    built = models.build_models(spark, layers)
    layer_of = dict(zip(layers.databases(), ("raw", "staging", "marts", "observability")))
    counts = None
    for model, relation in built.items():
        count = spark.table(relation).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer_of[relation.split(".")[0]]).alias("schema_name"), F.lit(model).alias("model"), "row_count"
        )
        counts = count if counts is None else counts.unionByName(count)
    return counts


def published_marts(spark, sf_dir):
    """The contents of marts and freshness view as written: one build, then a second over it."""
    layers = _layers(spark)
    _append(_reports(spark, sf_dir), DEATHS, layers)
    _append(_activity(spark, sf_dir), ACTIVITY, layers)
    models.build_models(spark, layers)
    built = models.build_models(spark, layers)
    null = F.lit(None)
    run, ingested, value = null.cast("string"), null.cast("timestamp_ntz"), null.cast("bigint")
    key, day = null.cast("string"), null.cast("date")
    columns = {
        "fct_cases_as_reported": ("state_key", "snapshot_date", "run_id", "ingested_at", "covid_19_deaths"),
        "fct_cases_latest": ("state_key", "snapshot_date", "run_id", "ingested_at", "covid_19_deaths"),
        "dim_state": ("state_key", day, run, ingested, value),
        "data_freshness_by_state": (key, "latest_snapshot_date", run, "latest_ingested_at", value),
    }
    parts = [spark.table(built[m]).select(F.lit(m), "state", *c) for m, c in columns.items()]
    names = ("model", "state", "state_key", "snapshot_date", "run_id", "ingested_at", "covid_19_deaths")
    return reduce(DataFrame.union, parts).toDF(*names)


def _daily_log(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.table(layers.run_log).select(*_LOG_COLUMNS)


def _two_deaths_runs(spark, sf_dir) -> Layers:
    """Backfill, then a run over the whole landing folder that loads only the newer days."""
    layers = _layers(spark)
    feed = replace(DEATHS, sentinel=None)
    daily = _view(spark, sf_dir, DAILY)
    state = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("state")
    records = daily.select(
        F.concat(F.col("day").cast("string"), F.lit("T00:00:00.000")).alias("week_ending_date"),
        state,
        F.col("total").cast("string").alias("covid_19_deaths"),
        (F.col("total") + F.col("n")).cast("string").alias("total_deaths"),
    )
    backfill = F.to_date(F.substring("week_ending_date", 1, 10)) <= F.lit(BACKFILL_TO)
    folder = _land(spark, records.where(backfill), records.where(~backfill))
    feed_run.run_feed(spark, feed, f"{folder}/0", layers, run_id="run_backfill", now=CUT)
    feed_run.run_feed(spark, feed, folder, layers, run_id="run_weekly", now=STAMP)
    return layers


def feed_run_deaths(spark, sf_dir):
    return _daily_log(spark, _two_deaths_runs(spark, sf_dir))


def feed_run_flags(spark, sf_dir):
    flags = spark.table(_two_deaths_runs(spark, sf_dir).flags).drop("flagged_at")
    return _rounded(flags, "expected_range_low", "expected_range_high", "z_score")


def _daily_records(spark, sf_dir, total: str, total_deaths: str = "n") -> DataFrame:
    """A record per day and user; ``total`` is the value reported, ``total_deaths`` what is added to it."""
    return _view(spark, sf_dir, DAILY).selectExpr(
        "cast(day AS string) || 'T00:00:00.000' AS week_ending_date",
        "'u' || cast(user_id AS string) AS state",
        f"cast({total} AS string) AS covid_19_deaths",
        f"cast({total} + {total_deaths} AS string) AS total_deaths",
    )


def resent_feed(spark, sf_dir):
    """A feed that is sent in full three times: with every tenth value revised, then as it was the second time."""
    layers = _layers(spark)
    feed = replace(DEATHS, sentinel=None)
    versions_sent = (("run_first", "total", CUT), ("run_again", RESENT, STAMP), ("run_same", RESENT, "2024-02-08 06:00:00"))
    for run_id, total, now in versions_sent:
        folder = _land(spark, _daily_records(spark, sf_dir, total))
        feed_run.run_feed(spark, feed, folder, layers, run_id=run_id, now=now, lookback_days=400, changes_only=True)
    return spark.table(layers.raw_table(feed)).drop("raw_payload")


def known_files(spark, sf_dir):
    """Two runs over one folder, the second of which opens the newer files alone: rows, and what the manifest says."""
    layers = _layers(spark)
    feed = replace(DEATHS, sentinel=None)
    records = _daily_records(spark, sf_dir, "total")
    old = F.to_date(F.substring("week_ending_date", 1, 10)) <= F.lit(BACKFILL_TO)
    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex[:12]}"
    for i, (part, now) in enumerate(((records.where(old), CUT), (records.where(~old), STAMP))):
        part.select(F.to_json(F.struct(*part.columns)).alias("value")).coalesce(1).write.text(f"{folder}/{i}")
        feed_run.run_feed(spark, feed, folder, layers, run_id=f"run_{i}", now=now, known_files=True)
    stored = spark.table(layers.raw_table(feed)).select("run_id", "snapshot_date", "state", "covid_19_deaths")
    held = spark.table(layers.landed).select(
        F.lit("manifest"), "last_period", F.concat(F.lit("from "), F.col("first_period").cast("string")), F.lit(None).cast("bigint")
    )
    return stored.union(held)


def feed_run_reload(spark, sf_dir):
    """A run that fails its rules, loaded again under its name with values that pass: log, then stored rows."""
    layers = _layers(spark)
    feed = replace(DEATHS, sentinel=None)
    for total_deaths, now in (("CASE WHEN user_id % 20 = 3 THEN -1 ELSE n END", CUT), ("n", STAMP)):
        folder = _land(spark, _daily_records(spark, sf_dir, "total", total_deaths))
        try:
            feed_run.run_feed(spark, feed, folder, layers, run_id="run_once", now=now, lookback_days=400)
        except rules.ValidationFailed:
            pass  # the log rows returned below show the stop
    stored = spark.table(layers.raw_table(feed)).agg(
        F.lit("stored"), F.concat(F.lit("at "), F.max("ingested_at").cast("string")), F.count(F.lit(1)), F.count_if(F.col("total_deaths") < F.col("covid_19_deaths")),
    )
    return _daily_log(spark, layers).drop("run_id", "pipeline_name").unionByName(
        stored.toDF("stage", "status", "row_count_in", "row_count_out")
    )


def feed_run_activity(spark, sf_dir):
    """A run whose levels are not all accepted: loaded, then stopped at the gate."""
    layers = _layers(spark)
    feed = replace(ACTIVITY, sentinel=None)
    level = F.get(F.array(*[F.lit(v) for v in (*ACTIVITY_LEVELS, "Unknown")]), (F.col("n") % 7).cast("int"))
    records = _view(spark, sf_dir, DAILY).select(
        F.concat(F.col("day").cast("string"), F.lit("T00:00:00.000")).alias("week_end"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("geography"),
        level.alias("label"),
    )
    try:
        feed_run.run_feed(spark, feed, _land(spark, records), layers, run_id="run_weekly", now=STAMP)
    except rules.ValidationFailed:
        pass  # the log rows returned below show the stop
    return _daily_log(spark, layers)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the latest version of every value."""
    return latest(spark, "/root/testdata/sf0.001")


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Those of the subpackage ``llm``, if it is there."""
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _llm_queries() | core_queries()


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "latest": latest,
        "latest_as_of": latest_as_of,
        "revision_history": revision_history,
        "as_reported": _reported,
        "stg_deaths": lambda spark, sf_dir: models.staged(_reports(spark, sf_dir), DEATHS),
        "stg_activity": lambda spark, sf_dir: models.staged(_activity(spark, sf_dir), ACTIVITY),
        "dim_state": dim_state,
        "freshness": freshness,
        "run_summary": run_summary,
        "state_stats": state_stats,
        "z_scores": z_scores,
        "anomalies": anomalies,
        "anomaly_flags": anomaly_flags,
        "rule_not_null": rule_not_null,
        "rule_between": rule_between,
        "rule_in_set": rule_in_set,
        "rule_pair_ge": rule_pair_ge,
        "rule_compound_unique": rule_compound_unique,
        "validate_deaths": validate_deaths,
        "validate_activity": validate_activity,
        "validation_gate": validation_gate,
        "rule_violations": rule_violations,
        "model_tests": model_tests,
        "high_water_mark": high_water_mark,
        "incremental": incremental,
        "ingest_deaths": ingest_deaths,
        "ingest_activity": ingest_activity,
        "payload_extract": payload_extract,
        "page_ordered": page_ordered,
        "page_deep": page_deep,
        "page_indexed": page_indexed,
        "versions_all": versions_all,
        "z_scores_double": z_scores_double,
        "stream_ingested": stream_ingested,
        "stream_gated": stream_gated,
        "upsert_deaths": upsert_deaths,
        "upsert_activity": upsert_activity,
        "upsert_outcomes": upsert_outcomes,
        "run_log_rows": run_log_rows,
        "empty_batch": empty_batch,
        "failure_alerts": failure_alerts,
        "lower_columns": lowered,
        "materialize_models": materialize_models,
        "published_marts": published_marts,
        "refresh_models": refresh_models,
        "as_of_intervals": as_of_intervals,
        "feed_run_deaths": feed_run_deaths,
        "feed_run_flags": feed_run_flags,
        "feed_run_activity": feed_run_activity,
        "feed_run_reload": feed_run_reload,
        "known_files": known_files,
        "resent_feed": resent_feed,
    }


# --- oracles ---

_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
_DEATHS_COLUMNS = ", ".join(DEATHS.columns)
_ACTIVITY_COLUMNS = ", ".join(ACTIVITY.columns)
_LEVELS = ", ".join(f"'{level}'" for level in ACTIVITY_LEVELS)


def _key(column: str) -> str:
    return f"md5(coalesce(cast({column} AS varchar), '{_NULL_TOKEN}'))"


def _with(body: str, **views: str) -> str:
    """``body`` after the named views; every oracle may use reports, activity, logs and daily."""
    ctes = {"reports": REPORTS, "activity": ACTIVITY_REPORTS, "logs": LOGS, "daily": DAILY, **views}
    listed = ", ".join(f"{name} AS ({text.replace('{events}', 'events')})" for name, text in ctes.items())
    return f"WITH {listed} {body}"


def _latest_sql(source: str, keys: str, columns: str, where: str = "true") -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ingested_at DESC, run_id DESC) AS rk
            FROM {source} WHERE {where}) WHERE rk = 1
    """


def _revisions_sql(number: str) -> str:
    return f"""
        SELECT snapshot_date, state, ingested_at, run_id, cast(version_number AS {number}) AS version_number,
               previous_value, covid_19_deaths AS current_value, covid_19_deaths - previous_value AS revision_delta
        FROM (SELECT *, row_number() OVER w AS version_number, lag(covid_19_deaths) OVER w AS previous_value
              FROM reports WINDOW w AS (PARTITION BY snapshot_date, state ORDER BY ingested_at, run_id))
        WHERE previous_value IS NOT NULL AND covid_19_deaths <> previous_value
    """


def _rule_sql(no: int, rule: str, columns: str, source: str, evaluated: str, unexpected: str, mostly: float = 1.0) -> str:
    return f"""
        SELECT cast({no} AS int) AS rule_no, '{rule}' AS rule, '{columns}' AS "columns",
               e AS evaluated_count, u AS unexpected_count,
               round(100.0 * u / nullif(e, 0), 6) AS unexpected_percent,
               coalesce((e - u) / cast(nullif(e, 0) AS double) >= {mostly}, true) AS success
        FROM (SELECT count(*) FILTER ({evaluated}) AS e, count(*) FILTER (({evaluated}) AND ({unexpected})) AS u
              FROM {source})
    """


def _unique_sql(no: int, source: str, keys: tuple[str, ...]) -> str:
    listed = ", ".join(keys)
    counted = f"""(SELECT {listed}, count(*) OVER (PARTITION BY {listed}) AS n FROM {source})"""
    known = " OR ".join(f"{k} IS NOT NULL" for k in keys)
    return _rule_sql(no, "compound_columns_unique", ",".join(keys), counted, known, "n > 1")


def _not_null_sql(no: int, column: str, source: str) -> str:
    return _rule_sql(no, "not_be_null", column, source, "true", f"{column} IS NULL")


def _min_zero_sql(no: int, column: str) -> str:
    return _rule_sql(no, "be_between", column, "reports", f"{column} IS NOT NULL", f"{column} < 0")


def _pair_sql(no: int) -> str:
    return _rule_sql(
        no, "pair_A_greater_than_B", "total_deaths,covid_19_deaths", "reports",
        "total_deaths IS NOT NULL AND covid_19_deaths IS NOT NULL", "total_deaths < covid_19_deaths",
    )


def _suites() -> tuple[str, str]:
    deaths = [
        _not_null_sql(0, "state", "reports"),
        _not_null_sql(1, "snapshot_date", "reports"),
        _min_zero_sql(2, "covid_19_deaths"),
        _min_zero_sql(3, "total_deaths"),
        _pair_sql(4),
        _unique_sql(5, "reports", KEYS),
    ]
    levels = _rule_sql(
        2, "be_in_set", "activity_level", "activity", "activity_level IS NOT NULL", f"activity_level NOT IN ({_LEVELS})"
    )
    activity = [
        _not_null_sql(0, "state", "activity"),
        _not_null_sql(1, "snapshot_date", "activity"),
        levels,
        _unique_sql(3, "activity", KEYS),
    ]
    return " UNION ALL ".join(deaths), " UNION ALL ".join(activity)


def _violations_sql() -> str:
    repeated = "event_id IN (SELECT event_id FROM (SELECT event_id, count(*) OVER (PARTITION BY run_id, snapshot_date, state) AS n FROM reports) WHERE n > 1)"
    broken = [
        "state IS NULL",
        "snapshot_date IS NULL",
        "covid_19_deaths < 0",
        "total_deaths < 0",
        "total_deaths < covid_19_deaths",
        repeated,
    ]
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT cast({i} AS int) AS rule_no, event_id, run_id, snapshot_date, state,
                   covid_19_deaths, total_deaths
            FROM reports WHERE {condition} ORDER BY event_id LIMIT {rules.SAMPLE_SIZE})"""
        for i, condition in enumerate(broken)
    )


def _published_sql() -> str:
    latest_rows = _latest_sql("reports", "snapshot_date, state", "*")
    row = f"state, {_key('state')} AS state_key, snapshot_date, run_id, ingested_at, covid_19_deaths"
    none = "cast(NULL AS varchar) AS run_id"
    return f"""
        SELECT 'fct_cases_as_reported' AS model, {row} FROM reports
        UNION ALL SELECT 'fct_cases_latest', {row} FROM ({latest_rows})
        UNION ALL SELECT 'dim_state', state, {_key('state')}, NULL, {none}, NULL, NULL
            FROM (SELECT state FROM reports UNION SELECT state FROM activity) WHERE state IS NOT NULL
        UNION ALL SELECT 'data_freshness_by_state', state, NULL, max(snapshot_date), {none}, max(ingested_at), NULL
            FROM ({latest_rows}) GROUP BY state
    """


def _model_tests_sql() -> str:
    latest_rows = _latest_sql("reports", "snapshot_date, state", "*")
    tables = {
        "stg_covid_deaths": "reports",
        "stg_flu_surveillance": "activity",
        "dim_state": f"(SELECT {_key('state')} AS state_key, state FROM ({_DIM_VALUES}))",
        "fct_cases_as_reported": "reports",
        "fct_cases_latest": f"({latest_rows})",
        "pipeline_run_summary": "(SELECT pipeline_name FROM logs GROUP BY pipeline_name, stage)",
        "data_freshness_by_state": f"(SELECT state FROM ({latest_rows}) GROUP BY state)",
    }
    parts = []
    for model, column, test, _ in models.MODEL_TESTS:
        failures = {
            "not_null": f"SELECT count(*) FROM {tables[model]} WHERE {column} IS NULL",
            "unique": f"SELECT count(*) FROM (SELECT {column} FROM {tables[model]} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)",
            "accepted_values": f"SELECT count(DISTINCT {column}) FROM {tables[model]} WHERE {column} NOT IN ({_LEVELS})",
        }[test]
        parts.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, failures, "
            f"failures = 0 AS passed FROM (SELECT ({failures}) AS failures)"
        )
    return " UNION ALL ".join(parts)


_DIM_VALUES = (
    "SELECT n_name AS state FROM nation WHERE n_name IS NOT NULL "
    "UNION SELECT event_type FROM events WHERE event_type IS NOT NULL"
)

_SCORED = f"""
    SELECT c.run_id, c.snapshot_date, c.state, c.covid_19_deaths, s.mean, s.std, s.n,
           (c.covid_19_deaths - s.mean) / nullif(s.std, 0) AS z_score
    FROM (SELECT * FROM reports WHERE run_id = '{RUN}' AND covid_19_deaths IS NOT NULL) c
    JOIN (SELECT state, avg(covid_19_deaths) AS mean, stddev_samp(covid_19_deaths) AS std,
                 count(covid_19_deaths) AS n
          FROM reports WHERE run_id <> '{RUN}' AND state IS NOT NULL GROUP BY state) s USING (state)
    WHERE s.n >= 8 AND s.std <> 0
"""
_FLAGGED = """
    SELECT run_id, 'covid' AS source, snapshot_date, state, 'covid_19_deaths' AS metric_name,
           cast(covid_19_deaths AS double) AS observed_value, round(mean - 3 * std, 6) AS expected_range_low,
           round(mean + 3 * std, 6) AS expected_range_high, round(z_score, 6) AS z_score
    FROM scored WHERE abs(z_score) > 3
"""


_FLAG_ID = """md5(run_id || '-' || source || '-' || state || '-' || metric_name || '-' ||
    cast(snapshot_date AS varchar) || '-' || cast(observed_value AS varchar)) AS flag_id"""


def _gated_sql() -> str:
    run = f"CASE WHEN day > DATE '{BACKFILL_TO.isoformat()}' THEN 'run_covid_0000000001' ELSE 'run_covid_0000000000' END"
    reasons = {
        "malformed covid_19_deaths": "fault = 2",
        "missing snapshot_date": "week_ending_date IS NULL",
        "not_be_null(state)": "state IS NULL",
        "not_be_null(snapshot_date)": "week_ending_date IS NULL",
        "be_between(covid_19_deaths)": "fault = 3",
        "pair_A_greater_than_B(total_deaths,covid_19_deaths)": "fault NOT IN (2, 3) AND cast(total_deaths AS bigint) < try_cast(covid_19_deaths AS bigint)",
        "compound_columns_unique(run_id,snapshot_date,state)": "copies > 1",
    }
    listed = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in reasons.items())
    failed = " || ',' || ".join(
        f"CASE WHEN bool_or({reasons[k]}) THEN '{k[: k.index('(')]}' ELSE '' END" for k in list(reasons)[2:]
    )
    return f"""
        , marked AS (
            SELECT *, concat_ws(',', {listed}) AS reasons FROM (
                SELECT *, {run} AS run_id, cast(substr(week_ending_date, 1, 10) AS date) AS snapshot_date,
                       count(*) OVER (PARTITION BY {run}, week_ending_date, state) AS copies FROM faulty))
        SELECT 'ledger' AS kept_in, run_id, trim(regexp_replace({failed}, ',+', ',', 'g'), ',') AS reasons,
               CASE WHEN bool_and(reasons = '') THEN 'passed' WHEN bool_or(reasons = '') THEN 'partial' ELSE 'rejected' END AS status,
               cast(NULL AS date) AS snapshot_date, cast(NULL AS varchar) AS state, cast(NULL AS bigint) AS covid_19_deaths,
               count(*) AS row_count_in, count(*) FILTER (reasons = '') AS row_count_passed,
               count(*) FILTER (reasons <> '') AS row_count_quarantined
        FROM marked GROUP BY run_id
        UNION ALL
        SELECT CASE WHEN reasons = '' THEN 'raw' ELSE 'quarantine' END, run_id, reasons, NULL, snapshot_date, state,
               try_cast(covid_19_deaths AS bigint), NULL, NULL, NULL
        FROM marked
    """


def _upsert_sql(view: str, columns: str) -> str:
    keys = "run_id, snapshot_date, state"

    def part(condition: str) -> str:
        return _latest_sql(view, keys, columns, condition)

    return _with(
        f"""SELECT * FROM late UNION ALL
        SELECT * FROM early WHERE NOT EXISTS (
            SELECT 1 FROM late WHERE late.run_id = early.run_id
                AND late.snapshot_date = early.snapshot_date AND late.state = early.state)""",
        early=part(f"ingested_at < TIMESTAMP '{CUT}'"),
        late=part(f"ingested_at >= TIMESTAMP '{CUT}'"),
    )


def _ingest_sql(view: str, run_id: str, extra: str) -> str:
    period = "week_ending_date" if "week_ending_date" in view else "week_end"
    return f"""
        SELECT '{run_id}' AS run_id, cast(substr({period}, 1, 10) AS date) AS snapshot_date,
               TIMESTAMP '{STAMP}' AS ingested_at, {extra}
        FROM ({view.replace('{events}', 'events')})
    """


_DEATHS_INGESTED = """state, cast(nullif(covid_19_deaths, '') AS bigint) AS covid_19_deaths,
    cast(trim(total_deaths) AS bigint) AS total_deaths, cast(pneumonia_deaths AS bigint) AS pneumonia_deaths,
    cast(NULL AS bigint) AS pneumonia_and_covid_19_deaths, cast(influenza_deaths AS bigint) AS influenza_deaths"""
_LOAD_LOG = """
    SELECT '{run}' AS run_id, '{pipeline}' AS pipeline_name, s.stage, s.status,
           n AS row_count_in, CASE WHEN s.status = 'success' THEN n ELSE 0 END AS row_count_out
    FROM (SELECT count(*) AS n FROM {source}), (VALUES {stages}) s(stage, status)
    WHERE n > 0
"""


def _load_log(run: str, pipeline: str, source: str, **stages: str) -> str:
    values = ", ".join(f"('{stage}', '{status}')" for stage, status in stages.items())
    return _LOAD_LOG.format(run=run, pipeline=pipeline, source=source, stages=values)


def _daily_scored_sql() -> str:
    cut = BACKFILL_TO.isoformat()
    return f"""
        SELECT 'run_weekly' AS run_id, c.day AS snapshot_date, 'u' || cast(c.user_id AS varchar) AS state,
               c.total AS covid_19_deaths, s.mean, s.std, s.n, (c.total - s.mean) / s.std AS z_score
        FROM daily c
        JOIN (SELECT user_id, avg(total) AS mean, stddev_samp(total) AS std, count(*) AS n
              FROM daily WHERE day <= DATE '{cut}' GROUP BY user_id) s USING (user_id)
        WHERE c.day > DATE '{cut}' AND s.n >= 8 AND s.std <> 0
    """


def _feed_run_deaths_sql() -> str:
    cut = BACKFILL_TO.isoformat()
    ok = {"extract": "success", "load": "success", "validate": "success"}
    detected = """
        SELECT '{run}' AS run_id, 'covid_deaths_pipeline' AS pipeline_name, 'anomaly_detection' AS stage,
               'success' AS status, n AS row_count_in, f AS row_count_out
        FROM (SELECT count(*) AS n FROM {rows}), (SELECT count(*) AS f FROM {flags})
    """
    early, late = f"(SELECT * FROM daily WHERE day <= DATE '{cut}')", f"(SELECT * FROM daily WHERE day > DATE '{cut}')"
    return " UNION ALL ".join(
        [
            _load_log("run_backfill", DEATHS.pipeline, early, **ok),
            detected.format(run="run_backfill", rows=early, flags="(SELECT 1 WHERE false)"),
            _load_log("run_weekly", DEATHS.pipeline, late, **ok),
            detected.format(run="run_weekly", rows=late, flags="flagged"),
        ]
    )


def _materialized_sql() -> str:
    revised = """(SELECT 1 FROM (
        SELECT covid_19_deaths AS cur, lag(covid_19_deaths) OVER (
            PARTITION BY snapshot_date, state ORDER BY ingested_at, run_id) AS prev FROM reports)
        WHERE prev IS NOT NULL AND cur <> prev)"""
    both = "(SELECT state FROM reports WHERE state IS NOT NULL UNION SELECT state FROM activity WHERE state IS NOT NULL)"
    counted = (
        ("staging", "stg_covid_deaths", "reports"),
        ("staging", "stg_flu_surveillance", "activity"),
        ("marts", "fct_cases_as_reported", "reports"),
        ("marts", "fct_cases_latest", "(SELECT DISTINCT snapshot_date, state FROM reports)"),
        ("marts", "fct_revision_history", revised),
        ("marts", "dim_state", both),
        ("observability", "data_freshness_by_state", "(SELECT DISTINCT state FROM reports)"),
        ("observability", "pipeline_run_summary", "(SELECT DISTINCT pipeline_name, stage FROM logs)"),
    )
    return " UNION ALL ".join(
        f"SELECT '{schema}' AS schema_name, '{model}' AS model, count(*) AS row_count FROM {source}"
        for schema, model, source in counted
    )


def oracle_sql() -> dict[str, str]:
    return (llm.oracle_sql() if llm else {}) | core_oracles()


def core_oracles() -> dict[str, str]:
    deaths_suite, activity_suite = _suites()
    fact_columns = f"{_key('state')} AS state_key, {_DEATHS_COLUMNS}"
    return {
        "latest": _with(_latest_sql("reports", "snapshot_date, state", fact_columns)),
        "latest_as_of": _with(
            _latest_sql("reports", "snapshot_date, state", fact_columns, f"ingested_at <= TIMESTAMP '{AS_OF}'")
        ),
        "revision_history": _with(_revisions_sql("int")),
        "as_reported": _with(f"SELECT {fact_columns} FROM reports"),
        "stg_deaths": _with(f"SELECT {_DEATHS_COLUMNS} FROM reports"),
        "stg_activity": _with(f"SELECT {_ACTIVITY_COLUMNS} FROM activity"),
        "dim_state": f"SELECT {_key('state')} AS state_key, state FROM ({_DIM_VALUES})",
        "freshness": f"""
            SELECT user_id, max(cast(ts AS date)) AS latest_snapshot_date, max(ts) AS latest_ingested_at,
                   cast(date_diff('day', max(cast(ts AS date)), DATE '{FRESH_AS_OF}') AS int)
                       AS days_since_latest_snapshot,
                   date_diff('day', max(cast(ts AS date)), DATE '{FRESH_AS_OF}') > 14 AS is_stale
            FROM events GROUP BY user_id""",
        "run_summary": _with("""
            SELECT pipeline_name, stage, count(*) AS total_runs,
                   count(*) FILTER (status = 'success') AS successful_runs,
                   count(*) FILTER (status = 'failure') AS failed_runs,
                   cast(round(100.0 * count(*) FILTER (status = 'success') / count(*), 1) AS double) AS success_rate_pct,
                   round(avg(duration_ms), 0) AS avg_duration_ms, max(duration_ms) AS max_duration_ms,
                   cast(sum(row_count_in) AS bigint) AS total_rows_processed, max(logged_at) AS last_run_at
            FROM logs GROUP BY pipeline_name, stage"""),
        "state_stats": _with("""
            SELECT state, round(avg(covid_19_deaths), 6) AS mean, round(stddev_samp(covid_19_deaths), 6) AS std,
                   count(covid_19_deaths) AS n
            FROM reports WHERE state IS NOT NULL GROUP BY state"""),
        "z_scores": _with(
            "SELECT * REPLACE (round(mean, 6) AS mean, round(std, 6) AS std, round(z_score, 6) AS z_score) FROM scored",
            scored=_SCORED,
        ),
        "anomalies": _with("SELECT * EXCLUDE (snapshot_date) FROM flagged", scored=_SCORED, flagged=_FLAGGED),
        "anomaly_flags": _with(
            f"SELECT {_FLAG_ID}, * EXCLUDE (snapshot_date), TIMESTAMP '{STAMP}' AS flagged_at FROM flagged",
            scored=_SCORED,
            flagged=_FLAGGED,
        ),
        "rule_not_null": _with(
            _not_null_sql(0, "state", "reports") + " UNION ALL " + _not_null_sql(1, "snapshot_date", "reports")
        ),
        "rule_between": _with(
            " UNION ALL ".join([
                _min_zero_sql(0, "covid_19_deaths"),
                _min_zero_sql(1, "total_deaths"),
                _rule_sql(2, "be_between", "total_deaths", "reports", "total_deaths IS NOT NULL",
                          "total_deaths < 0 OR total_deaths > 500", 0.95),
            ])
        ),
        "rule_in_set": _with(
            _rule_sql(0, "be_in_set", "state", "reports", "state IS NOT NULL", "state NOT IN ('view', 'click')")
        ),
        "rule_pair_ge": _with(_pair_sql(0)),
        "rule_compound_unique": _with(
            _unique_sql(0, "reports", KEYS) + " UNION ALL " + _unique_sql(1, "by_day", ("user_id", "day", "state")),
            by_day="SELECT *, snapshot_date AS day FROM reports",
        ),
        "validate_deaths": _with(deaths_suite),
        "validate_activity": _with(activity_suite),
        "validation_gate": _with(" UNION ALL ".join(
            f"SELECT '{feed.pipeline}' AS pipeline_name, bool_and(success) AS success, "
            f"count(*) FILTER (NOT success) AS failed_expectations FROM ({suite})"
            for feed, suite in ((DEATHS, deaths_suite), (ACTIVITY, activity_suite))
        )),
        "rule_violations": _with(_violations_sql()),
        "model_tests": _with(_model_tests_sql()),
        "high_water_mark": _with("SELECT max(snapshot_date) AS last_snapshot_date FROM reports WHERE state = 'view'"),
        "incremental": _with(f"""
            SELECT event_id, run_id, snapshot_date, state, covid_19_deaths FROM reports
            WHERE snapshot_date > (SELECT max(snapshot_date) FROM reports
                                   WHERE state = 'view' AND ingested_at <= TIMESTAMP '{CUT}')"""),
        "ingest_deaths": _ingest_sql(
            DEATHS_RECORDS, "run_fixed", _DEATHS_INGESTED + ", cast(unlisted_key AS bigint) AS unlisted_key"
        ),
        "ingest_activity": _ingest_sql(
            ACTIVITY_RECORDS, "run_fixed",
            "geography AS state, label AS activity_level, cast(unlisted_key AS bigint) AS unlisted_key",
        ),
        "payload_extract": """
            SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k,
                   json_extract_string(props, '$.absent') AS absent FROM events""",
        "page_ordered": f"""
            SELECT * FROM orders ORDER BY o_orderdate, o_orderkey
            LIMIT {paging.PAGE_SIZE} OFFSET {paging.PAGE_SIZE}""",
        "page_deep": """
            SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_orderdate, o_orderkey, o_custkey FROM orders
            ORDER BY 1 NULLS FIRST, 2 LIMIT 100 OFFSET 200""",
        "page_indexed": """
            SELECT page, o_orderdate, o_orderkey, o_custkey FROM (
                SELECT *, (row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) - 1) // 100 AS page, count(*) OVER () AS n
                FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_orderdate, o_orderkey, o_custkey FROM orders))
            WHERE page IN (0, 2, 9, (n - 1) // 100)""",
        "versions_all": _with(
            f"""SELECT *, row_number() OVER w AS version_number, lag(covid_19_deaths) OVER w AS previous_value
                FROM ({COPIES.replace("{reports}", "reports")})
                WINDOW w AS (PARTITION BY snapshot_date, state ORDER BY ingested_at, run_id, covid_19_deaths NULLS LAST)"""
        ),
        "z_scores_double": _with(
            """SELECT c.run_id, c.snapshot_date, c.state, c.value, round(mean, 6) AS mean, round(std, 6) AS std, n,
                      round((c.value - mean) / std, 6) AS z_score
               FROM nans c JOIN (SELECT state, avg(value) AS mean, stddev_samp(value) AS std, count(*) AS n FROM nans
                                 WHERE run_id <> 'run_9' AND NOT isnan(value) GROUP BY state) s ON c.state = s.state
               WHERE c.run_id = 'run_9' AND NOT isnan(c.value) AND n >= 8 AND std <> 0""",
            nans=WITH_NAN.replace("{reports}", "reports"),
        ),
        "stream_ingested": _ingest_sql(DEATHS_RECORDS, "run_covid_0000000000", _DEATHS_INGESTED),
        "stream_gated": _with(_gated_sql().lstrip(), faulty=FAULTY).replace(") , marked", "), marked", 1),
        "upsert_deaths": _upsert_sql("reports", _DEATHS_COLUMNS),
        "upsert_activity": _upsert_sql("activity", _ACTIVITY_COLUMNS),
        "upsert_outcomes": _with(f"""
            SELECT event_id, run_id, snapshot_date, state,
                   CASE WHEN state IS NULL THEN CASE WHEN new THEN 'added' ELSE 'kept' END
                        WHEN news > 1 AND olds > 0 THEN 'ambiguous'
                        WHEN new THEN CASE WHEN olds > 0 THEN 'replacing' ELSE 'added' END
                        WHEN news > 0 THEN 'replaced' ELSE 'kept' END AS outcome
            FROM (SELECT *, count(*) FILTER (new) OVER w AS news, count(*) FILTER (NOT new) OVER w AS olds
                  FROM (SELECT *, ingested_at >= TIMESTAMP '{CUT}' AS new FROM reports) WHERE new OR event_id % 3 > 0
                  WINDOW w AS (PARTITION BY run_id, snapshot_date, state))"""),
        "run_log_rows": _load_log("run_all", DEATHS.pipeline, "events", extract="success", load="success"),
        "empty_batch": _with("""
            SELECT cast(count(*) AS int) AS row_count_in, cast(count(*) AS int) AS row_count_out,
                   'success' AS status, count(*) AS log_rows
            FROM reports WHERE snapshot_date > (SELECT max(snapshot_date) FROM reports)"""),
        "failure_alerts": _with("""
            SELECT run_id, pipeline_name, stage,
                   ':rotating_light: *Pipeline Failure*' || chr(10) || '*Pipeline:* ' || pipeline_name || chr(10) ||
                   '*Stage:* ' || stage || chr(10) || '*Run ID:* ' || run_id || chr(10) ||
                   '*Error:* ' || coalesce(error_message, '') AS text
            FROM logs WHERE status = 'failure'"""),
        "lower_columns": "SELECT * FROM events",
        "materialize_models": _with(_materialized_sql()),
        "published_marts": _with(_published_sql()),
        "refresh_models": _with(_revisions_sql("bigint")),
        "as_of_intervals": _with(" UNION ALL ".join(
            _latest_sql(
                "reports", "snapshot_date, state", f"'{t}' AS as_of, {fact_columns}",
                f"ingested_at <= TIMESTAMP '{t}'" + (f" AND snapshot_date BETWEEN DATE '{p[0]}' AND DATE '{p[1]}'" if p else ""),
            )
            for t, p in AS_OF_TIMES.items()
        )),
        "feed_run_deaths": _with(_feed_run_deaths_sql(), scored=_daily_scored_sql(), flagged=_FLAGGED),
        "feed_run_flags": _with(
            f"SELECT {_FLAG_ID}, * EXCLUDE (snapshot_date) FROM flagged", scored=_daily_scored_sql(), flagged=_FLAGGED
        ),
        "feed_run_activity": _with(_load_log(
            "run_weekly", ACTIVITY.pipeline, "daily", extract="success", load="success", validate="failure"
        )),
        "known_files": _with(f"""
            , parts AS (SELECT *, CASE WHEN day <= DATE '{BACKFILL_TO}' THEN 'run_0' ELSE 'run_1' END AS run_id FROM daily)
            SELECT run_id, day AS snapshot_date, 'u' || cast(user_id AS varchar) AS state, total AS covid_19_deaths FROM parts
            UNION ALL SELECT 'manifest', max(day), 'from ' || cast(min(day) AS varchar), NULL FROM parts GROUP BY run_id"""
        ).replace(") \n            , parts", "), parts", 1),
        # The only run has no history, so nothing is flagged.
        "feed_run_reload": _with(f"""
            SELECT stage, status, n AS row_count_in, CASE WHEN status = 'success' AND stage <> 'anomaly_detection' THEN n ELSE 0 END AS row_count_out
            FROM (SELECT count(*) AS n FROM daily), (VALUES ('extract', 'success'), ('load', 'success'), ('validate', 'failure'),
                ('extract', 'success'), ('load', 'success'), ('validate', 'success'), ('anomaly_detection', 'success')) AS l(stage, status)
            UNION ALL SELECT 'stored', 'at {STAMP}', count(*), 0 FROM daily"""),
        "resent_feed": _with(f"""
            SELECT run_id, day AS snapshot_date, ingested_at, 'u' || cast(user_id AS varchar) AS state, covid_19_deaths,
                   cast(covid_19_deaths + n AS bigint) AS total_deaths, cast(NULL AS bigint) AS pneumonia_deaths,
                   cast(NULL AS bigint) AS pneumonia_and_covid_19_deaths, cast(NULL AS bigint) AS influenza_deaths
            FROM (SELECT *, 'run_first' AS run_id, TIMESTAMP '{CUT}' AS ingested_at, total AS covid_19_deaths FROM daily
                  UNION ALL SELECT *, 'run_again', TIMESTAMP '{STAMP}', {RESENT} FROM daily WHERE {RESENT} <> total)"""),
    }
