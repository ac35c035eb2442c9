"""Latest, as-of and revision history of a table that keeps every reported version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import changed, ntz
from vintage.functions.skew import HOT_ROWS, with_versions


def first_per_group(df: DataFrame, keys: tuple[str, ...], order: list) -> DataFrame:
    """First row per group.

    Spark limits each group to one row before the shuffle as well as after it, so a hot group
    sends one row per input partition instead of all of its rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest(df: DataFrame, keys: tuple[str, ...], version_cols: tuple[str, ...]) -> DataFrame:
    """The last row per group in the order of ``version_cols`` (nulls count as largest)."""
    return first_per_group(df, keys, [F.col(c).desc_nulls_first() for c in version_cols])


def latest_as_of(
    df: DataFrame, keys: tuple[str, ...], version_cols: tuple[str, ...], t: datetime | str
) -> DataFrame:
    """The latest version known at ``t``; the first version column is the ingest time."""
    return latest(df.where(F.col(version_cols[0]) <= ntz(t)), keys, version_cols)


def validity(
    df: DataFrame, keys: tuple[str, ...], version_cols: tuple[str, ...], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every version with ``valid_to``, the time at which the next one of its group came; null for the last.

    A version holds from its first version column, the ingest time, until just before ``valid_to``. Of
    versions of one time only the last ever holds.
    """
    numbered = with_versions(df, keys, version_cols, version_cols[0], hot_rows, newest_first=True)
    return numbered.select(*df.columns, F.col("previous_value").alias("valid_to"))


def valid_at(df: DataFrame, version_cols: tuple[str, ...], t: datetime | str) -> DataFrame:
    """``latest_as_of`` from stored validity: two comparisons that reach the scan, no ranking."""
    held = (F.col(version_cols[0]) <= ntz(t)) & (F.col("valid_to").isNull() | (F.col("valid_to") > ntz(t)))
    return df.where(held).drop("valid_to")


def revision_history(
    df: DataFrame,
    keys: tuple[str, ...],
    version_cols: tuple[str, ...],
    metric: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions whose value differs from the version before, with the difference.

    A null breaks the chain: neither the null nor the value after it is a revision. Rows equal in
    ``version_cols`` are ordered by value, so the result does not depend on the input's order.
    """
    rows = df.select(*keys, *version_cols, F.col(metric).alias("current_value"))
    versions = with_versions(rows, keys, (*version_cols, "current_value"), "current_value", hot_rows)
    return versions.where(changed("previous_value", "current_value")).select(
        *keys,
        *version_cols,
        "version_number",
        "previous_value",
        "current_value",
        (F.col("current_value") - F.col("previous_value")).alias("revision_delta"),
    )
