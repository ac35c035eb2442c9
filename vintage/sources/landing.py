"""Landed JSON files to typed rows.

Files are the parallel unit. Two layouts: ``lines`` (one object per line, splittable) and ``pages``
(each file one JSON array as an API returns it, a few thousand records at most).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.feeds import Feed
from vintage.functions.columns import ntz, safe_int, to_period

LAYOUTS = ("lines", "pages")


def _check(layout: str) -> bool:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}: {layout!r}")
    return layout == "pages"


def parse_records(text: DataFrame, layout: str = "lines") -> DataFrame:
    """Column ``raw_payload``: one variant per record, unknown keys kept. Malformed JSON fails."""
    if not _check(layout):
        return text.where(F.trim("value") != "").select(F.parse_json("value").alias("raw_payload"))
    page = F.parse_json("value").cast("array<variant>")
    return text.select(F.explode(page).alias("raw_payload"))


def read_landing(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    modified_after: str | None = None,
    period_dir: str | None = None,
    after: date | None = None,
) -> DataFrame:
    """Records of all files under ``path``; with ``modified_after`` older files are not opened.

    With ``period_dir`` files lie in folders ``<period_dir>=YYYY-MM-DD`` that hold records of this period
    alone, and folders up to ``after`` are not opened. Files of a folder without a period are always read.
    """
    reader = spark.read.option("wholetext", _check(layout))
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if period_dir is None:
        return parse_records(reader.option("recursiveFileLookup", True).text(path), layout)
    files = reader.schema(f"value string, `{period_dir}` date").text(path)
    if after is not None:
        files = files.where(F.col(period_dir).isNull() | (F.col(period_dir) > F.lit(after)))
    return parse_records(files.select("value"), layout)


def stream_landing(spark: SparkSession, path: str, layout: str = "lines", max_files: int | None = None) -> DataFrame:
    """The same records as a stream of newly arrived files."""
    reader = spark.readStream.option("wholetext", _check(layout)).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_records(reader.text(path), layout)


def with_payload(rows: DataFrame) -> DataFrame:
    """Records from a table instead of files: the whole row becomes the payload."""
    return rows.select(F.parse_json(F.to_json(F.struct(*rows.columns))).alias("raw_payload"))


def payload_field(name: str, kind: str = "string", payload: str = "raw_payload"):
    """One field of the payload; null when the key is missing."""
    return F.variant_get(payload, f'$["{name}"]', kind)


def string_fields(records: DataFrame, feed: Feed, strict: bool = True) -> DataFrame:
    """The period as a date, the feed's other fields as strings, and the payload. Missing keys are null."""
    return records.select(
        to_period(payload_field(feed.period_field), strict).alias("snapshot_date"),
        *[payload_field(field).alias(name) for name, field, _ in feed.fields],
        "raw_payload",
    )


def typed_rows(fields: DataFrame, feed: Feed, run_id: str, ingested_at: datetime | str, strict: bool = True) -> DataFrame:
    """Raw rows of one run. Run id and ingest time are literals, equal for every row."""
    typed = {"bigint": lambda c: safe_int(c, strict), "string": F.col}
    return fields.select(
        F.lit(run_id).alias("run_id"),
        "snapshot_date",
        ntz(ingested_at).alias("ingested_at"),
        *[typed[kind](name).alias(name) for name, _, kind in feed.fields],
        "raw_payload",
    )


def normalize(records: DataFrame, feed: Feed, run_id: str, ingested_at: datetime | str, strict: bool = True) -> DataFrame:
    """Typed raw rows of all records."""
    return typed_rows(string_fields(records, feed, strict), feed, run_id, ingested_at, strict)
