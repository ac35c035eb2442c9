"""A manifest of landed files with the periods they hold, so that a read opens only files that can hold newer ones.

An entry is made when a run has loaded what a file held that was new. A file counts as known while its length
and time are those of its entry; one that was written again, or holds a record without a period, is read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import to_period
from vintage.operators.upsert import writer_session
from vintage.schemas import LANDED_DDL, Layers
from vintage.sources import volumes
from vintage.sources.landing import parse_records, payload_field

_FILE = ["path", "length", "modified"]


def create_landed(spark: SparkSession, layers: Layers = Layers()) -> None:
    volumes.create(spark, layers.landed, LANDED_DDL, "source")


def _plain(path: Column) -> Column:
    """A path as the listing of files has it, of one that is written as a URI."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of the files under ``path``; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified"))


def files_to_read(spark: SparkSession, feed: Feed, path: str, layers: Layers, after: date | None) -> list[tuple]:
    """Files that are not known to hold periods up to ``after`` alone, as (path, length, modified)."""
    files = listed(spark, path)
    if after is not None:
        volumes.refresh(spark, layers.landed)
        known = spark.table(layers.landed).where((F.col("source") == feed.source) & (F.col("last_period") <= F.lit(after)))
        files = files.join(known.select(*_FILE), _FILE, "left_anti")
    return [tuple(r) for r in files.orderBy("path").collect()]


def read_files(spark: SparkSession, files: list[tuple], layout: str) -> DataFrame:
    """The records of some files, as ``landing.read_landing`` returns those of a folder."""
    reader = spark.read.option("wholetext", layout == "pages")
    text = reader.text([f[0] for f in files]) if files else spark.createDataFrame([], "value string")
    return parse_records(text, layout)


def enter_files(spark: SparkSession, feed: Feed, files: list[tuple], layout: str, layers: Layers) -> None:
    """Enter files whose new records are loaded: their periods are looked up in the files themselves."""
    if not files:
        return
    session = writer_session(spark)
    reader = session.read.option("wholetext", layout == "pages")
    text = reader.text([f[0] for f in files]).withColumn("path", _plain(F.col("_metadata.file_path")))
    text = text.where(F.trim("value") != "")
    records = text.select("path", F.parse_json("value").alias("record"))
    if layout == "pages":
        records = records.select("path", F.explode(F.col("record").cast("array<variant>")).alias("record"))
    period = to_period(payload_field(feed.period_field, payload="record"), strict=False)
    spans = records.groupBy("path").agg(
        F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count_if(period.isNull()).alias("unknown")
    )
    found = session.createDataFrame(files, "path string, length bigint, modified timestamp_ntz").join(spans, "path", "left")
    # Without a last period, as of a file without records, a file is read again.
    last = F.when(F.col("unknown") == 0, F.col("last_period"))
    entries = found.select(F.lit(feed.source).alias("source"), *_FILE, "first_period", last.alias("last_period"))
    volumes.append(entries, layers.landed)
    volumes.refresh(spark, layers.landed)
    volumes.compact(spark, layers.landed, "source")
