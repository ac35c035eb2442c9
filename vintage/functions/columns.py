"""Column expressions used by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
Z_THRESHOLD = 3.0
MIN_HISTORY_POINTS = 8


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_fail(value: Column, text: Column, kind: str) -> Column:
    message = F.concat(F.lit(f"not a valid {kind}: '"), text, F.lit("'"))
    return F.coalesce(value, F.raise_error(message).cast(kind))


def to_period(c: str | Column, strict: bool = True) -> Column:
    """First ten characters as a date.

    Strict: a missing, empty or malformed period fails the batch, whatever the session's ANSI
    setting. Tolerant: it becomes null.
    """
    text = F.substring(F.coalesce(_col(c), F.lit("")), 1, 10)
    day = text.try_cast("date")
    return _or_fail(day, text, "date") if strict else day


def safe_int(c: str | Column, strict: bool = True) -> Column:
    """Integer of a string; missing and empty are null, anything else malformed fails the batch."""
    text = _col(c)
    number = text.try_cast("bigint")
    if not strict:
        return number
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("bigint")).otherwise(
        _or_fail(number, text, "bigint")
    )


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the columns as text; a null counts as a fixed token, so it differs from ''."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def changed(previous: str | Column, current: str | Column) -> Column:
    """A known previous value that the current one differs from; a null current is no change."""
    return _col(previous).isNotNull() & (_col(current) != _col(previous))


def nan_as_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN in the given columns of floating type (all by default) turned into null."""
    floating = [f.name for f in df.schema if f.dataType.typeName() in ("float", "double") and (not columns or f.name in columns)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def z_score(x: str | Column, mean: str | Column, std: str | Column) -> Column:
    """Distance from the mean in standard deviations; null where the spread is 0 or unknown."""
    return (_col(x) - _col(mean)) / F.nullif(_col(std), F.lit(0.0))


def scorable(n: str | Column, std: str | Column, min_points: int = MIN_HISTORY_POINTS) -> Column:
    """Enough history, and a spread to measure against."""
    return (_col(n) >= min_points) & F.coalesce(_col(std) != 0, F.lit(False))


def is_outlier(z: str | Column, threshold: float = Z_THRESHOLD) -> Column:
    return F.abs(_col(z)) > F.lit(threshold)


def percent(part: str | Column, whole: str | Column) -> Column:
    return F.lit(100.0) * _col(part) / F.nullif(_col(whole).cast("double"), F.lit(0.0))


def ntz(moment: datetime | str) -> Column:
    """A zone-free timestamp literal in UTC, independent of the session's time zone."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def unescaped_partition(shown: str | Column, column: str) -> Column:
    """The value of one column in a line of SHOW PARTITIONS."""
    value = F.regexp_extract(_col(shown), rf"(?:^|/){column}=([^/]*)", 1)
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def join_on_equal_or_null(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str, small: bool = False) -> DataFrame:
    """Join in which two null keys are equal; the keys of ``right`` are not repeated in the result.

    ``small`` broadcasts ``right`` and is for tables whose size the caller has bounded.
    """
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(F.broadcast(named) if small else named, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id(now: datetime | None = None) -> str:
    """``run_<UTC date>_<UTC time>_<6 hex>``; made once on the driver, so every row shares it."""
    return f"run_{now or utc_now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"
