"""Ordered pages of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from vintage.functions.skew import slice_count
from vintage.session import pin

PAGE_SIZE = 5000
SLICE_ROWS = 1_000_000


def page(df: DataFrame, order: tuple[str, ...], size: int, n: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Page ``n`` (from 0) of ``size`` rows. ``order`` must be unique per row; nulls come first.

    The page's first key is located by counting range slices of the keys, and the page is read from
    there, so no task sees more than a slice or a page, however deep the page lies.
    """
    first = _key_at(df.select(*order), order, n * size, slice_rows)
    if first is None:
        return df.limit(0)
    return _from_key(df, order, first, inclusive=True).orderBy(*order).limit(size)


def page_after(df: DataFrame, order: tuple[str, ...], size: int, last: Row | None) -> DataFrame:
    """The page that follows the row ``last``; costs the same however deep it lies."""
    rows = df if last is None else _from_key(df, order, last, inclusive=False)
    return rows.orderBy(*order).limit(size)


def _from_key(df: DataFrame, order: tuple[str, ...], key: Row, inclusive: bool) -> DataFrame:
    literals = [F.lit(key[c]).cast(df.schema[c].dataType) for c in order]
    # Structs compare null-safely, a null being smallest, as in the order.
    here: Column = F.struct(*[F.col(c) for c in order])
    there: Column = F.struct(*[v.alias(c) for v, c in zip(literals, order)])
    rows = df.where(here >= there if inclusive else here > there)
    # The leading column alone repeats the condition in a form the scan can prune on.
    return rows if key[order[0]] is None else rows.where(F.col(order[0]) >= literals[0])


def _sliced(df: DataFrame, order: tuple[str, ...], slice_rows: int) -> DataFrame:
    """``df`` cut into slices of its order, with the number of each row's ``_slice`` and its ``_position`` there, from 0."""
    cut = df.repartitionByRange(slice_count(df.count(), slice_rows), *order).withColumn("_slice", F.spark_partition_id())
    # Ids of the rows of a partition are consecutive; the partition is in the bits above.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut.sortWithinPartitions("_slice", *order).withColumn("_position", position)


def _key_at(keys: DataFrame, order: tuple[str, ...], position: int, slice_rows: int) -> Row | None:
    """The key at ``position`` in the order, found through the row counts of range slices."""
    sliced = pin(_sliced(keys, order, slice_rows))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = sliced.groupBy("_slice").count().withColumn("_upto", F.sum("count").over(upto))
    holding = counts.where(F.col("_upto") > position).orderBy("_slice").first()
    if holding is None:
        return None
    inside = position - (holding["_upto"] - holding["count"])
    # One row, so that no slice is sent to the driver in part.
    return sliced.where((F.col("_slice") == holding["_slice"]) & (F.col("_position") == inside)).select(*order).collect()[0]


def build_pages(df: DataFrame, order: tuple[str, ...], path: str, slice_rows: int = SLICE_ROWS) -> None:
    """Store ``df`` in slices of its order, with an index of how many rows precede each, for ``stored_page``.

    Sorted once, however many pages are read. ``order`` must be unique per row; nulls come first.
    """
    rows = _sliced(df, order, slice_rows)
    rows.write.partitionBy("_slice").parquet(f"{path}/rows")
    # Slices of an empty table have no files to read the columns from.
    rows.drop("_slice").limit(0).write.parquet(f"{path}/columns")
    counts = _stored(df.sparkSession, path).groupBy("_slice").agg(F.count(F.lit(1)).alias("n_rows"))
    # A row per slice.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("before", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/index")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema.add("_slice", IntegerType())
    return spark.read.schema(columns).parquet(f"{path}/rows")


def stored_page(spark: SparkSession, path: str, order: tuple[str, ...], size: int, n: int) -> DataFrame:
    """Page ``n`` (from 0) of ``size`` rows of what ``build_pages`` stored: reads the index and the slices it lies in."""
    first, index = n * size, spark.read.parquet(f"{path}/index")
    holding = index.where((F.col("before") < first + size) & (F.col("before") + F.col("n_rows") > first)).orderBy("_slice").collect()
    if not holding:
        return _stored(spark, path).drop("_slice", "_position").limit(0)
    # As many slices as a page of this size meets, normally one or two.
    rows = _stored(spark, path).where(F.col("_slice").isin([r["_slice"] for r in holding]))
    ends, begins = holding[-1], holding[0]
    # A slice between the two lies in the page as a whole.
    rows = rows.where((F.col("_slice") > begins["_slice"]) | (F.col("_position") >= first - begins["before"]))
    rows = rows.where((F.col("_slice") < ends["_slice"]) | (F.col("_position") < first + size - ends["before"]))
    return rows.drop("_slice", "_position").orderBy(*order).limit(size)
