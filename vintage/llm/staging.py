"""Intermediate tables in the shared folder, which outlive a lost executor."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.session import shared_dir

_FOLDERS: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """A new path in the folder of this application, which is deleted when the driver ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_delete, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def stage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read again: lineage is cut and later reads see the same rows.

    The session's codec is taken by default. Snappy holds buffers outside the heap for every column of every
    file until the next collection; ``zstd`` does not, which tells where tasks write many columns.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The given columns (all by default) as one struct, so that working columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in (df.columns if columns is None else columns)))


def inline(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals: strings without quotes, whole numbers, doubles."""
    literal = lambda v: f"'{v}'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else repr(v)
    values = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def _delete(spark: SparkSession, folder: str) -> None:
    # The session may have been stopped before the interpreter ends; then nothing is left to delete with.
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
