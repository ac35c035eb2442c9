"""Loading one batch of a feed into its raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import utc_now
from vintage.operators.upsert import partition_values, upsert_table
from vintage.schemas import KEYS, REQUIRED, Layers
from vintage.sources.ledger import logged_stage
from vintage.sources.statistics import forget_runs, keep_runs

EMPTY_LOAD = {"row_count_in": 0, "row_count_out": 0, "status": "success"}


def _require(rows: DataFrame, columns: tuple[str, ...]) -> None:
    """Raise if a column that the raw table declares NOT NULL holds a null; Parquet tables don't check."""
    nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    if found := {c: n for c, n in nulls.items() if n}:
        raise ValueError(f"nulls in columns that must not be null: {found}")


def load_batch(spark: SparkSession, feed: Feed, batch: DataFrame, run_id: str, layers: Layers = Layers()) -> dict:
    """Stage the batch, upsert it into the raw table, log the outcome.

    The batch is parsed once, into a staging table that the count, the check for ambiguous keys and
    the upsert then read. An empty batch leaves raw table and log untouched.
    """
    staging = f"{layers.raw_table(feed)}_staging_{utc_now():%Y%m%d%H%M%S%f}"
    try:
        with logged_stage(spark, layers, run_id, feed.pipeline, "extract") as counts:
            batch.write.saveAsTable(staging)
            # Counted from the file footers: a counter on the write could count retried tasks twice.
            rows = spark.table(staging).count()
            counts.update(row_count_in=rows, row_count_out=rows)
        if rows == 0:
            return dict(EMPTY_LOAD)
        with logged_stage(spark, layers, run_id, feed.pipeline, "load") as counts:
            counts["row_count_in"] = rows
            _require(spark.table(staging), REQUIRED)
            runs = partition_values(spark.table(staging))
            if feed.metric:
                forget_runs(spark, feed, runs, layers)
            upsert_table(spark, layers.raw_table(feed), staging, KEYS, "run_id", runs)
            if feed.metric:
                keep_runs(spark, feed, runs, layers)
            counts["row_count_out"] = rows
        return {"row_count_in": rows, "row_count_out": rows, "status": "success"}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
