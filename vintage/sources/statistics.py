"""Statistics of a metric kept per run and group, so that scoring a run does not read the history again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import unescaped_partition
from vintage.operators.anomaly import merged_stats, run_stats
from vintage.operators.filters import other_runs
from vintage.operators.upsert import overwrite, writer_session
from vintage.schemas import Layers

_BY = "state"


def _stored(session: SparkSession, feed: Feed, layers: Layers) -> DataFrame:
    return session.table(layers.statistics).where(F.col("source") == F.lit(feed.source))


def forget_runs(spark: SparkSession, feed: Feed, runs: list[str], layers: Layers) -> None:
    """Drop the statistics of runs that are about to be loaded; until they are kept again, raw is read."""
    for run in runs:
        spark.sql(
            f"ALTER TABLE {layers.statistics} DROP IF EXISTS PARTITION (source = :source, run_id = :run)",
            args={"source": feed.source, "run": run},
        )


def keep_runs(spark: SparkSession, feed: Feed, runs: list[str], layers: Layers) -> None:
    """Store the statistics of loaded runs, a row per run and group."""
    session = writer_session(spark)
    raw = session.table(layers.raw_table(feed)).where(F.col("run_id").isin(runs))
    parts = run_stats(raw, _BY, feed.metric).withColumn("source", F.lit(feed.source))
    overwrite(parts.coalesce(1) if len(runs) == 1 else parts, layers.statistics)
    spark.catalog.refreshTable(layers.statistics)


def _runs(session: SparkSession, table: str) -> DataFrame:
    """The runs of a table partitioned by run, from the catalog: no file is opened."""
    return session.sql(f"SHOW PARTITIONS {table}").select(unescaped_partition("partition", "run_id").alias("run_id"))


def history_stats(session: SparkSession, feed: Feed, run_id: str, layers: Layers) -> DataFrame:
    """Per group the mean, deviation and count over all other runs; rows are read of runs without statistics only."""
    raw, stored = session.table(layers.raw_table(feed)), _stored(session, feed, layers)
    # Normally none: runs not loaded by this library, or interrupted on the way.
    missing = _runs(session, layers.raw_table(feed)).join(stored.select("run_id"), "run_id", "left_anti").collect()
    parts = stored.drop("source")
    if missing:
        rows = raw.where(F.col("run_id").isin([row["run_id"] for row in missing]))
        parts = parts.unionByName(run_stats(rows, _BY, feed.metric))
    return merged_stats(other_runs(parts, run_id), _BY)
