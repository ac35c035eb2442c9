"""Digests of the values stored last, so that a feed that is sent again adds only what it revises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import join_on_equal_or_null
from vintage.operators.filters import for_run
from vintage.operators.upsert import overwrite, writer_session
from vintage.operators.versions import latest
from vintage.schemas import DIGESTS_DDL, PERIOD_KEYS, VERSION, Layers


def create_digests(spark: SparkSession, layers: Layers = Layers()) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layers.digests} ({DIGESTS_DDL}) USING parquet PARTITIONED BY (source, snapshot_date)"
    )


def content_digest(feed: Feed) -> Column:
    """A digest of what a record says, nulls included; not of when and by which run it was said."""
    values = [name for name, _, _ in feed.fields if name not in PERIOD_KEYS]
    return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def _stored(session: SparkSession, feed: Feed, periods: DataFrame, layers: Layers) -> DataFrame:
    """Digests of the given periods; the directories of others are not opened."""
    mine = session.table(layers.digests).where(F.col("source") == F.lit(feed.source))
    return mine.join(periods, "snapshot_date", "left_semi")


def changed_rows(spark: SparkSession, feed: Feed, rows: DataFrame, layers: Layers = Layers()) -> DataFrame:
    """The rows that say something else than the value stored last for their period and state, or the first thing.

    Null states equal each other. A record that is missing this time changes nothing, copies of a changed one
    all stay, and a value that comes back after another is a change.
    """
    stored = _stored(spark, feed, rows.select("snapshot_date").distinct(), layers)
    known = stored.select(*PERIOD_KEYS, F.col("digest").alias("_digest"))
    met = join_on_equal_or_null(rows, known, PERIOD_KEYS, "left")
    return met.where(~content_digest(feed).eqNullSafe(F.col("_digest"))).drop("_digest")


def keep_digests(spark: SparkSession, feed: Feed, run_id: str, layers: Layers = Layers()) -> int:
    """Bring the digests of the periods of a run up to date; returns how many records the run has."""
    session = writer_session(spark)
    rows = for_run(session.table(layers.raw_table(feed)), run_id)
    said = rows.select(
        "state", content_digest(feed).alias("digest"), "ingested_at", "run_id", F.lit(feed.source).alias("source"), "snapshot_date"
    )
    both = said.unionByName(_stored(session, feed, said.select("snapshot_date").distinct(), layers))
    # Of the stored and the new value the later one, also when an older run is loaded again.
    last = latest(both, PERIOD_KEYS, (*VERSION, "digest"))
    overwrite(last.hint("rebalance", "snapshot_date"), layers.digests)
    spark.catalog.refreshTable(layers.digests)
    return rows.count()
