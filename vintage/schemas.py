"""Table layouts and the four databases they live in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from vintage.feeds import FEEDS, Feed

# A row of a raw table is one value reported by one run.
KEYS = ("run_id", "snapshot_date", "state")
# Versions of one (snapshot_date, state) are ordered by ingest time; the run id breaks ties.
VERSION = ("ingested_at", "run_id")
PERIOD_KEYS = ("snapshot_date", "state")

RUN_LOG = "pipeline_logs"
RUN_LOG_DDL = (
    "log_id string, run_id string not null, pipeline_name string not null, stage string not null, "
    "status string not null, row_count_in bigint, row_count_out bigint, duration_ms bigint, "
    "error_message string, logged_at timestamp_ntz"
)

FLAGS = "anomaly_flags"
FLAGS_DDL = (
    "flag_id string, run_id string not null, source string not null, state string, "
    "metric_name string, observed_value double, expected_range_low double, "
    "expected_range_high double, z_score double, flagged_at timestamp_ntz"
)

STATISTICS = "metric_statistics"
STATISTICS_DDL = (
    "source string not null, run_id string not null, state string, n bigint, mean double, "
    "squares double, low double, high double"
)

LANDED = "landed_files"
LANDED_DDL = (
    "source string not null, path string, length bigint, modified timestamp_ntz, first_period date, last_period date"
)

DIGESTS = "content_digests"
DIGESTS_DDL = "state string, digest string, ingested_at timestamp_ntz, run_id string, source string, snapshot_date date"

BATCHES = "batch_ledger"
BATCHES_DDL = (
    "batch_id bigint, status string, row_count_in bigint, row_count_passed bigint, row_count_quarantined bigint, "
    "failed_rules array<string>, digest string, judged_at timestamp_ntz, source string, run_id string"
)

#: Rows that a gated stream kept out, as they came, and why.
QUARANTINE_DDL = "snapshot_date date, reasons array<string>, raw_payload variant, run_id string"


def _within(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


@dataclass(frozen=True)
class Layers:
    """Database name of each layer. Names are used as given, never prefixed by the session's.

    A layer without a name (None) lies in the session's current database.
    """

    raw: str | None = "raw"
    staging: str | None = "staging"
    marts: str | None = "marts"
    observability: str | None = "observability"

    @classmethod
    def prefixed(cls, prefix: str) -> Layers:
        return cls(*(prefix + layer for layer in ("raw", "staging", "marts", "observability")))

    def databases(self) -> tuple[str, ...]:
        return tuple(db for db in (self.raw, self.staging, self.marts, self.observability) if db)

    def raw_table(self, feed: Feed) -> str:
        return _within(self.raw, feed.table)

    def quarantine(self, feed: Feed) -> str:
        return _within(self.raw, f"{feed.table}_quarantine")

    @property
    def landed(self) -> str:
        return _within(self.observability, LANDED)

    @property
    def digests(self) -> str:
        return _within(self.observability, DIGESTS)

    @property
    def batches(self) -> str:
        return _within(self.observability, BATCHES)

    @property
    def run_log(self) -> str:
        return _within(self.observability, RUN_LOG)

    @property
    def flags(self) -> str:
        return _within(self.observability, FLAGS)

    @property
    def statistics(self) -> str:
        return _within(self.observability, STATISTICS)


#: Columns of a raw table that no row may leave empty.
REQUIRED = ("run_id", "snapshot_date", "ingested_at")


def raw_ddl(feed: Feed) -> str:
    fields = ", ".join(f"{name} {kind}" for name, _, kind in feed.fields)
    return (
        "run_id string not null, snapshot_date date not null, "
        f"ingested_at timestamp_ntz not null, {fields}, raw_payload variant"
    )


def create_tables(spark: SparkSession, layers: Layers = Layers(), location: str | None = None) -> None:
    """Create databases and tables that do not exist yet.

    Tables are partitioned by run: a run is what a load replaces, what validation reads and what
    detection excludes, and writers of different runs do not get in each other's way. The log is only
    appended to, so it is kept in volumes, by pipeline, which is how it is read.
    """
    from vintage.sources import volumes  # which needs the key columns of this module

    for db in layers.databases():
        where = f" LOCATION '{location}/{db}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
    for feed in FEEDS:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layers.raw_table(feed)} ({raw_ddl(feed)}) "
            "USING parquet PARTITIONED BY (run_id)"
        )
    tables = (
        (layers.flags, FLAGS_DDL, "run_id"),
        (layers.statistics, STATISTICS_DDL, "source, run_id"),
    )
    for table, ddl, by in tables:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet PARTITIONED BY ({by})")
    volumes.create(spark, layers.run_log, RUN_LOG_DDL, "pipeline_name")
