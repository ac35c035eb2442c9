"""Tables of small appends, such as logs: many writers, files that follow the bytes and not the writes.

Every append is a volume of its own, a partition that is never changed afterwards, so writers do not meet.
``compact`` merges volumes of like size into larger ones, as soon as there are ``fan`` of them: a row is
rewritten a logarithmic number of times, and a table of n rows keeps about ``fan * log(n)`` files.

A manifest says which volumes count. A merged volume counts once its row is in the manifest, and the same row
names the volumes that it replaces, which stop counting at that moment. The view ``table`` reads what counts, so
a compaction that stops anywhere shows each row exactly once; the next one tidies up after it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.columns import unescaped_partition
from vintage.operators.upsert import overwrite, replace_partitions, writer_session
from vintage.session import shared_dir

FAN = 64
#: A lock of a compaction that stopped is taken over after an hour.
STALE_MS = 3_600_000
_OPEN, _CLOSED = "open-", "closed-"


def _files(table: str) -> str:
    return f"{table}_files"


def _manifest(table: str) -> str:
    return f"{table}_manifest"


def create(spark: SparkSession, table: str, ddl: str, by: str) -> None:
    """The files, their manifest and the view ``table`` over both. ``by`` is the column that is read by."""
    files, manifest = _files(table), _manifest(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {files} ({ddl}, volume string not null) USING parquet PARTITIONED BY ({by}, volume)")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {manifest} (replaces array<string>, n_rows bigint, {by} string, volume string) "
        f"USING parquet PARTITIONED BY ({by}, volume)"
    )
    declared = [part.split()[0] for part in ddl.split(",")]
    replaced = f"(SELECT explode(replaces) AS volume FROM {manifest})"
    spark.sql(f"""
        CREATE VIEW IF NOT EXISTS {table} AS
        SELECT {", ".join(declared)} FROM (
            SELECT * FROM {files} AS f LEFT ANTI JOIN {replaced} AS r ON f.volume = r.volume WHERE startswith(f.volume, '{_OPEN}')
            UNION ALL
            SELECT * FROM {files} AS f
                LEFT SEMI JOIN (SELECT volume FROM {manifest} EXCEPT SELECT volume FROM {replaced}) AS m ON f.volume = m.volume
            WHERE startswith(f.volume, '{_CLOSED}'))
    """)


def refresh(spark: SparkSession, table: str) -> None:
    """Make what other sessions wrote visible to this one."""
    for name in (_files(table), _manifest(table)):
        spark.catalog.refreshTable(name)


def append(rows: DataFrame, table: str) -> None:
    """Add ``rows`` as a volume; they must come from a ``writer_session``."""
    files = _files(table)
    by = [c.name for c in rows.sparkSession.catalog.listColumns(files) if c.isPartition][0]
    # A small append is one file a group, a large one several of the advisory size, each written by a task of its own.
    replace_partitions(rows.withColumn("volume", F.lit(f"{_OPEN}{uuid.uuid4().hex}")), files, by, ("volume",))


def _stored(session: SparkSession, table: str, by: str) -> list[tuple[str, str]]:
    """The partitions of a table as (by, volume), from the catalog: no file is opened."""
    shown = session.sql(f"SHOW PARTITIONS {table}").select(
        unescaped_partition("partition", by).alias("group"), unescaped_partition("partition", "volume").alias("volume")
    )
    return [tuple(r) for r in shown.collect()]


def _drop(session: SparkSession, table: str, by: str, group: str, volumes: list[str]) -> None:
    for volume in volumes:
        session.sql(
            f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = :group, volume = :volume)", args={"group": group, "volume": volume}
        )


def _enter(session: SparkSession, table: str, by: str, group: str, volume: str, n_rows: int, replaces: list[str]) -> None:
    entry = session.range(1, numPartitions=1).select(
        F.array(*map(F.lit, replaces)).cast("array<string>").alias("replaces"),
        F.lit(n_rows).cast("bigint").alias("n_rows"),
        F.lit(group).alias(by),
        F.lit(volume).alias("volume"),
    )
    overwrite(entry, _manifest(table))


def _tidy(session: SparkSession, table: str, by: str) -> None:
    """Remove what entries of the manifest replace, then say in the entries that it is gone."""
    for r in session.table(_manifest(table)).where(F.size("replaces") > 0).collect():
        _drop(session, _manifest(table), by, r[by], [v for v in r["replaces"] if v.startswith(_CLOSED)])
        _drop(session, _files(table), by, r[by], r["replaces"])
        _enter(session, table, by, r[by], r["volume"], r["n_rows"], [])


def _merge(session: SparkSession, table: str, by: str, group: str, volumes: list[str]) -> int:
    rows = session.table(_files(table)).where((F.col(by) == group) & F.col("volume").isin(volumes))
    merged = f"{_CLOSED}{uuid.uuid4().hex}"
    # Files of the advisory size, however many volumes they come from.
    overwrite(rows.withColumn("volume", F.lit(merged)).hint("rebalance"), _files(table))
    session.catalog.refreshTable(_files(table))
    n_rows = session.table(_files(table)).where((F.col(by) == group) & (F.col("volume") == merged)).count()
    _enter(session, table, by, group, merged, n_rows, volumes)
    return n_rows


def compact(spark: SparkSession, table: str, by: str, fan: int = FAN) -> int:
    """Merge volumes wherever ``fan`` of like size have come together; returns how many were written.

    One compaction of a table runs at a time, others return at once; appends go on meanwhile.
    """
    session, written = writer_session(spark), 0
    if len(_stored(session, _files(table), by)) < fan:
        return 0
    with _alone(spark, table) as mine:
        while mine:
            for name in (_files(table), _manifest(table)):
                session.catalog.refreshTable(name)
            _tidy(session, table, by)
            session.catalog.refreshTable(_manifest(table))
            tiers: dict[tuple[str, int], list[str]] = {}
            for group, volume in _stored(session, _files(table), by):
                if volume.startswith(_OPEN):
                    tiers.setdefault((group, 0), []).append(volume)
            for r in session.table(_manifest(table)).collect():
                tiers.setdefault((r[by], int(math.log(max(r["n_rows"], fan), fan))), []).append(r["volume"])
            full = {k: v for k, v in tiers.items() if len(v) >= fan}
            if not full:
                break
            for (group, _), volumes in full.items():
                _merge(session, table, by, group, volumes)
                written += 1
    refresh(spark, table)
    return written


@contextmanager
def _alone(spark: SparkSession, table: str) -> Iterator[bool]:
    """Whether this is the only one to compact the table while the block runs."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/compacting-{table}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path) and jvm.java.lang.System.currentTimeMillis() - fs.getFileStatus(path).getModificationTime() > STALE_MS:
        fs.delete(path, False)
    try:
        mine = fs.createNewFile(path)
    except Exception:  # another compaction made the file in the meantime
        mine = False
    try:
        yield mine
    finally:
        if mine:
            fs.delete(path, False)
