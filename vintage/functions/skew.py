"""Work per group when one group may hold a large share of all rows.

A window or a join puts a whole group into one task. Groups of about ``hot_rows`` rows or more are
listed first. Joins broadcast what concerns such a list as long as it is short; windows cut the listed
groups into slices of the sort order and number slice by slice. Without hot groups, the usual case,
the plan is the plain one. The list only picks the plan: every row is used, the same bag of rows comes
out. (The adaptive planner's own skew join does not split a side that meets the result of a distinct
or a groupBy, which is every use here.)
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import join_on_equal_or_null
from vintage.session import pin

HOT_ROWS = 1_000_000
COUNTED_ROWS = 1_000
#: Longer lists are joined without a broadcast hint.
BROADCAST_GROUPS = 10_000
#: Up to so many slices are cut as small as asked for; beyond, a slice may hold up to HOT_ROWS rows.
SLICES = 200


def hot_groups(df: DataFrame, keys: tuple[str, ...], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Groups of about ``hot_rows`` rows or more with their approximate size ``n``, or None.

    Sizes are estimated from a share of the rows in which a group of that size still shows
    COUNTED_ROWS times, so next to nothing is shuffled; a borderline group may fall on either side.
    """
    share = min(1.0, COUNTED_ROWS / hot_rows)
    seen = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=1)
    sizes = seen.groupBy(*keys).agg((F.count(F.lit(1)) / share).cast("bigint").alias("n"))
    found = pin(sizes.where(F.col("n") > hot_rows))
    return None if found.isEmpty() else found


def slice_count(rows: int, slice_rows: int) -> int:
    """How many slices ``rows`` rows are cut into. A slice is a task, so their number stays small where ``slice_rows`` is."""
    return min(math.ceil(rows / slice_rows) + 1, max(SLICES, math.ceil(rows / HOT_ROWS) + 1))


def is_short(listed: DataFrame) -> bool:
    return listed.count() <= BROADCAST_GROUPS


def split_hot(df: DataFrame, listed: DataFrame, keys: tuple[str, ...], small: bool) -> tuple[DataFrame, DataFrame]:
    """Rows outside and inside the listed groups."""
    cold = join_on_equal_or_null(df, listed, keys, "left_anti", small)
    return cold, join_on_equal_or_null(df, listed, keys, "left_semi", small)


def join_groups(
    df: DataFrame,
    groups: DataFrame,
    keys: tuple[str, ...],
    how: str,
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows with a table of one row per group (inner, left_semi or left_anti).

    Rows of hot groups are not shuffled: the few groups they need are broadcast to them. For the
    rest nothing is forced; the adaptive planner broadcasts ``groups`` if it proves small.
    """

    def join(rows: DataFrame, table: DataFrame, small: bool) -> DataFrame:
        if null_safe:
            return join_on_equal_or_null(rows, table, keys, how, small)
        return rows.join(F.broadcast(table) if small else table, list(keys), how)

    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return join(df, groups, small=False)
    listed, small = hot.select(*keys), is_short(hot)
    cold, big = split_hot(df, listed, keys, small)
    needed = join_on_equal_or_null(groups, listed, keys, "left_semi", small)
    return join(cold, groups, small=False).unionByName(join(big, needed, small))


def with_versions(
    df: DataFrame,
    keys: tuple[str, ...],
    order: tuple[str, ...],
    value: str,
    hot_rows: int = HOT_ROWS,
    newest_first: bool = False,
) -> DataFrame:
    """Add ``version_number`` and ``previous_value`` of ``value`` per group of ``keys``.

    Every copy of a row is a version of its own, in a hot group as in any other. ``newest_first`` numbers
    from the last version, whose number is 1; the previous value is then that of the version after it.
    """
    order = _descending(order) if newest_first else _ascending(order)
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return _numbered(df, keys, order, value)
    small = is_short(hot)
    cold, big = split_hot(df, hot.select(*keys), keys, small)
    slices = slice_count(hot.agg(F.sum("n")).first()[0], hot_rows)
    return _numbered(cold, keys, order, value).unionByName(
        _numbered_in_slices(big, keys, order, value, slices, small and slices <= BROADCAST_GROUPS)
    )


def _ascending(order: tuple[str, ...]) -> list:
    return [F.col(c).asc_nulls_last() for c in order]


def _descending(order: tuple[str, ...]) -> list:
    return [F.col(c).desc_nulls_first() for c in order]


def _numbered(df: DataFrame, keys, order, value) -> DataFrame:
    # Both functions share one specification: one exchange, one sort, one pass.
    versions = Window.partitionBy(*keys).orderBy(*order)
    return df.select(
        "*",
        F.row_number().over(versions).cast("bigint").alias("version_number"),
        F.lag(value).over(versions).alias("previous_value"),
    )


def _numbered_in_slices(df: DataFrame, keys, order, value, slices: int, small: bool) -> DataFrame:
    columns = df.columns
    # A number per copy, so that copies too can fall into several slices. Range bounds are drawn from
    # the data, so the number and the slice of a row must be fixed before they are used.
    rows = pin(df.withColumn("_copy", F.monotonically_increasing_id()))
    in_order = [*order, F.col("_copy")]
    sliced = pin(
        rows.repartitionByRange(slices, *[F.col(k) for k in keys], *in_order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    within = Window.partitionBy("_slice", *keys).orderBy(*in_order)
    local = sliced.select(
        "*", F.row_number().over(within).alias("_position"), F.lag(value).over(within).alias("_previous")
    )
    ends = local.groupBy("_slice", *keys).agg(
        F.max("_position").alias("_rows"), F.max_by(value, "_position").alias("_last")
    )
    # A slice holds whole groups but for its first and last, so slices + hot groups rows.
    earlier = Window.partitionBy(*keys).orderBy("_slice")
    starts = ends.select(
        "_slice",
        *keys,
        F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.lag("_last").over(earlier).alias("_last_before"),
    )
    return join_on_equal_or_null(local, starts, ("_slice", *keys), "inner", small).select(
        *columns,
        (F.coalesce("_before", F.lit(0)) + F.col("_position")).alias("version_number"),
        F.when(F.col("_position") == 1, F.col("_last_before"))
        .otherwise(F.col("_previous"))
        .alias("previous_value"),
    )
