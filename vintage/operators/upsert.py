"""Keyed upsert into a partitioned table."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vintage.functions.columns import join_on_equal_or_null
from vintage.functions.skew import HOT_ROWS, hot_groups, is_short, split_hot
from vintage.schemas import KEYS


KEPT, REPLACED, REPLACING, ADDED, AMBIGUOUS = "kept", "replaced", "replacing", "added", "ambiguous"
_STOP = "ambiguous match: "


class AmbiguousMatch(ValueError):
    """A stored row is matched by more than one row of the batch."""


def _any_null(keys: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _all_known(keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _counted(rows: DataFrame, keys: tuple[str, ...], hot_rows: int | None) -> DataFrame:
    """``rows`` with the number of new and of stored rows of their key.

    A window counts in one exchange, which also brings the rows of a key together. Keys that more than
    ``hot_rows`` rows share are counted before the shuffle and not brought together (None: there are none).
    """
    sides = {"_news": F.count_if("_new"), "_olds": F.count_if(~F.col("_new"))}
    together = Window.partitionBy(*keys)
    hot = hot_groups(rows, keys, hot_rows) if hot_rows else None
    if hot is None:
        return rows.withColumns({c: count.over(together) for c, count in sides.items()})
    listed, small = hot.select(*keys), is_short(hot)
    cold, big = split_hot(rows, listed, keys, small)
    counts = big.groupBy(*keys).agg(*(count.alias(c) for c, count in sides.items()))
    counts = join_on_equal_or_null(big, counts, keys, "inner", small)
    return cold.withColumns({c: count.over(together) for c, count in sides.items()}).unionByName(counts)


def outcomes(target: DataFrame, source: DataFrame, keys: tuple[str, ...] = KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row of both tables with what the upsert makes of it, in ``outcome``.

    Stored rows are kept or replaced, new ones replace or are added. Both are ambiguous where several new rows
    meet a stored one. A null key matches nothing, so such rows skip the match and are kept or added.
    """
    both = target.withColumn("_new", F.lit(False)).unionByName(source.select(*target.columns).withColumn("_new", F.lit(True)))
    alone = both.where(_any_null(keys)).withColumns({"_news": F.lit(0), "_olds": F.lit(0)})
    # From the file footers; small tables have no key with that many rows to look for.
    large = target.count() + source.count() > hot_rows
    met = _counted(both.where(_all_known(keys)), keys, hot_rows if large else None).unionByName(alone)
    plain = F.when(F.col("_new"), F.when(F.col("_olds") == 0, ADDED).otherwise(REPLACING)).otherwise(
        F.when(F.col("_news") == 0, KEPT).otherwise(REPLACED)
    )
    outcome = F.when((F.col("_news") > 1) & (F.col("_olds") > 0), AMBIGUOUS).otherwise(plain)
    return met.select(*target.columns, outcome.alias("outcome"))


def _unambiguous(met: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows that the table holds afterwards; an ambiguous row fails the job that reads them."""
    key = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    stop = F.raise_error(F.concat(F.lit(f"{_STOP}("), key, F.lit(") is stored and occurs more than once in the batch")))
    stays = F.when(F.col("outcome") == AMBIGUOUS, stop.cast("boolean")).otherwise(F.col("outcome") != REPLACED)
    return met.where(stays).drop("outcome")


def merge_rows(
    target: DataFrame, source: DataFrame, keys: tuple[str, ...] = KEYS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``target`` with matched rows replaced by ``source`` and the rest of ``source`` appended.

    Reading the result fails if a stored row is matched by several new ones.
    """
    return _unambiguous(outcomes(target, source, keys, hot_rows), keys)


def replace_partitions(df: DataFrame, table: str, partition: str = "run_id", sort: tuple[str, ...] = ()) -> None:
    """Overwrite the partitions of ``table`` that ``df`` has rows for; others stay as they are.

    New files appear only when the job commits, so ``df`` may read the table, and a failed job
    leaves it unchanged. ``df`` must come from a ``writer_session``.
    """
    # Rebalancing yields files of the advisory size: many small tasks are merged, a run holding
    # most of the rows is split. Sorted files let a filter on the sort columns skip row groups.
    overwrite(df.hint("rebalance", partition).sortWithinPartitions(partition, *sort), table)


def overwrite(df: DataFrame, table: str) -> None:
    """As ``replace_partitions``, with the files as ``df`` is partitioned."""
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)


def writer_session(spark: SparkSession) -> SparkSession:
    """A session on the same catalog in which an overwrite replaces only the partitions written.

    The mode is a session setting. In a session of its own, two loads on parallel threads cannot
    switch it off for each other. The caller's other settings and current database are carried over.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    # Without adaptive execution, rebalancing would put a whole partition into one task.
    session.conf.set("spark.sql.adaptive.enabled", "true")
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return session


def partition_values(source: DataFrame, partition: str = "run_id") -> list[str]:
    """As many values as a batch has partitions, normally one."""
    return [row[0] for row in source.select(partition).distinct().collect()]


def upsert_table(
    spark: SparkSession,
    table: str,
    source_table: str,
    keys: tuple[str, ...] = KEYS,
    partition: str = "run_id",
    touched: list[str] | None = None,
) -> dict[str, int]:
    """Upsert the rows of ``source_table`` into ``table``, which is partitioned by a key column.

    A batch only matches rows of its own partitions, so only those are read and rewritten, once. Returns the
    number of rows of each outcome. A match that is ambiguous fails the job before anything is written.
    """
    session = writer_session(spark)
    source = session.table(source_table)
    touched = partition_values(source, partition) if touched is None else touched
    target = session.table(table).where(F.col(partition).isin(touched))
    rows = source.select(*target.columns)
    # A new run, the normal case, has nothing stored yet: no partition to read, nothing to match.
    within = tuple(k for k in keys if k != partition)
    if len(touched) == 1 and not target.inputFiles():
        # Written as the scan packs the staged files, about the size of a split each: no shuffle.
        overwrite(rows.sortWithinPartitions(*within), table)
        counts = {ADDED: rows.count()}
    else:
        seen = Observation()
        met = outcomes(target, rows, keys)
        met = met.observe(seen, *(F.count_if(F.col("outcome") == o).alias(o) for o in (KEPT, REPLACED, REPLACING, ADDED)))
        try:
            replace_partitions(_unambiguous(met, keys), table, partition, within)
        except Exception as e:
            if found := re.search(re.escape(_STOP) + r"(\(.*?batch)", str(e)):
                raise AmbiguousMatch(found[1]) from None
            raise
        counts = seen.get
    spark.catalog.refreshTable(table)
    return counts
