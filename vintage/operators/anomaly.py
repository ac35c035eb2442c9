"""Outliers: how far each new value lies from its group's history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import (
    MIN_HISTORY_POINTS,
    Z_THRESHOLD,
    is_outlier,
    nan_as_null,
    ntz,
    scorable,
    surrogate_key,
    z_score,
)
from vintage.functions.skew import HOT_ROWS, join_groups
from vintage.operators.filters import for_run, other_runs


def current_run(df: DataFrame, run_id: str, by: str, metric: str, period: str = "snapshot_date") -> DataFrame:
    return for_run(df, run_id).select("run_id", period, by, metric)


def history(df: DataFrame, run_id: str, by: str, metric: str) -> DataFrame:
    """Every known value of all other runs."""
    return other_runs(df, run_id).where(F.col(metric).isNotNull()).select(by, metric)


def group_stats(past: DataFrame, by: str, metric: str) -> DataFrame:
    """Mean, sample deviation and count per group; combined before the shuffle, null group left out."""
    return (
        nan_as_null(past, metric)
        .where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.avg(metric).alias("mean"),
            F.stddev_samp(metric).alias("std"),
            F.count(metric).alias("n"),
        )
    )


def run_stats(rows: DataFrame, by: str, metric: str) -> DataFrame:
    """Per run and group what ``merged_stats`` needs: count, mean, squared deviations, extremes."""
    known = nan_as_null(rows, metric).where(F.col(by).isNotNull() & F.col(metric).isNotNull())
    return known.groupBy("run_id", by).agg(
        F.count(metric).alias("n"),
        F.avg(metric).alias("mean"),
        (F.var_pop(metric) * F.count(metric)).alias("squares"),
        F.min(metric).cast("double").alias("low"),
        F.max(metric).cast("double").alias("high"),
    )


def merged_stats(parts: DataFrame, by: str) -> DataFrame:
    """As ``group_stats`` over all the values that ``parts`` (of ``run_stats``) were made of.

    Deviations are taken from the common mean, not from sums of squares that cancel. Equal values have
    a deviation of exactly 0.
    """
    group = Window.partitionBy(by)
    centre = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    apart = F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)
    spread = F.when(F.min("low") == F.max("high"), 0.0).otherwise(F.sqrt(F.sum(apart) / (F.sum("n") - 1)))
    return parts.withColumn("centre", centre).groupBy(by).agg(
        F.max("centre").alias("mean"), F.when(F.sum("n") > 1, spread).alias("std"), F.sum("n").alias("n")
    )


def with_group_stats(current: DataFrame, stats: DataFrame, by: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Current rows with the statistics of their group; rows of unseen groups drop out."""
    return join_groups(current, stats, (by,), "inner", hot_rows=hot_rows)


def z_scores(
    current: DataFrame, past: DataFrame, by: str, metric: str, min_points: int = MIN_HISTORY_POINTS
) -> DataFrame:
    """Score of every current value that has enough varied history."""
    return scores(current, group_stats(past, by, metric), by, metric, min_points)


def scores(
    current: DataFrame, stats: DataFrame, by: str, metric: str, min_points: int = MIN_HISTORY_POINTS
) -> DataFrame:
    """As ``z_scores``, from the statistics of the history."""
    known = nan_as_null(current, metric).where(F.col(metric).isNotNull() & F.col(by).isNotNull())
    scored = with_group_stats(known, stats, by).where(scorable("n", "std", min_points))
    return scored.withColumn("z_score", z_score(metric, "mean", "std"))


def anomalies(
    current: DataFrame,
    past: DataFrame,
    by: str,
    metric: str,
    source: str,
    threshold: float = Z_THRESHOLD,
    min_points: int = MIN_HISTORY_POINTS,
    period: str = "snapshot_date",
) -> DataFrame:
    """Current values more than ``threshold`` deviations from the mean, with the expected range."""
    return outliers(z_scores(current, past, by, metric, min_points), by, metric, source, threshold, period)


def outliers(
    scored: DataFrame, by: str, metric: str, source: str, threshold: float = Z_THRESHOLD, period: str = "snapshot_date"
) -> DataFrame:
    """Scored values beyond ``threshold``."""
    reach = F.lit(threshold) * F.col("std")
    return (
        scored.where(is_outlier("z_score", threshold))
        .select(
            "run_id",
            F.lit(source).alias("source"),
            F.col(period).alias("snapshot_date"),
            F.col(by).alias("state"),
            F.lit(metric).alias("metric_name"),
            F.col(metric).cast("double").alias("observed_value"),
            (F.col("mean") - reach).alias("expected_range_low"),
            (F.col("mean") + reach).alias("expected_range_high"),
            "z_score",
        )
    )


def anomaly_flags(found: DataFrame, flagged_at: datetime | str) -> DataFrame:
    """Ledger rows. The id depends on the flag alone, so a repeated task or run makes the same one."""
    identity = ("run_id", "source", "state", "metric_name", "snapshot_date", "observed_value")
    return found.select(
        surrogate_key(*identity).alias("flag_id"),
        "run_id",
        "source",
        "state",
        "metric_name",
        "observed_value",
        "expected_range_low",
        "expected_range_high",
        "z_score",
        ntz(flagged_at).alias("flagged_at"),
    )
