"""Row filters; every comparison is a typed literal, so it reaches the scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newer_than(df: DataFrame, period_col: str, mark: date | None, lookback_days: int = 0) -> DataFrame:
    """Rows of a later period than ``mark``; everything when there is no mark.

    ``lookback_days`` re-reads that many days up to the mark, to pick up revised older periods.
    """
    if mark is None:
        return df
    return df.where(F.col(period_col) > F.lit(mark - timedelta(days=lookback_days)))


def for_run(df: DataFrame, run_id: str) -> DataFrame:
    return df.where(F.col("run_id") == F.lit(run_id))


def other_runs(df: DataFrame, run_id: str) -> DataFrame:
    return df.where(F.col("run_id") != F.lit(run_id))


def high_water_mark(df: DataFrame, sentinel: str | None, period: str = "snapshot_date", state: str = "state") -> DataFrame:
    """One row: the newest period of the sentinel state (of all states without a sentinel)."""
    rows = df if sentinel is None else df.where(F.col(state) == F.lit(sentinel))
    return rows.agg(F.max(period).alias("last_snapshot_date"))


def last_period(df: DataFrame, sentinel: str | None, period: str = "snapshot_date", state: str = "state") -> date | None:
    return high_water_mark(df, sentinel, period, state).first()[0]
