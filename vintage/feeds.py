"""What the operators need to know about one feed, and the two feeds shipped as presets."""

from __future__ import annotations

from dataclasses import dataclass

from vintage.operators.rules import (
    Rule,
    be_between,
    be_in_set,
    compound_columns_unique,
    not_be_null,
    pair_a_at_least_b,
)


@dataclass(frozen=True)
class Feed:
    """One source of periodic records.

    ``fields`` lists (column, payload field, type); ``sentinel`` is the state whose newest period
    is the high-water mark (None: the newest period of any state); ``metric`` is the column scored
    for outliers (None: the feed is not scored).
    """

    table: str
    pipeline: str
    source: str
    period_field: str
    fields: tuple[tuple[str, str, str], ...]
    rules: tuple[Rule, ...]
    sentinel: str | None = None
    metric: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return ("run_id", "snapshot_date", "ingested_at", *(name for name, _, _ in self.fields))

    @property
    def validated_columns(self) -> tuple[str, ...]:
        """The columns the feed's rules look at, run id first."""
        used = dict.fromkeys(("run_id", *(c for rule in self.rules for c in rule.columns)))
        return tuple(used)


# --- fixed values: names, sentinels, accepted levels and rules of the two feeds ---

ACTIVITY_LEVELS = ("Very Low", "Low", "Moderate", "High", "Very High", "Data Unavailable")

DEATHS = Feed(
    table="covid_deaths_raw",
    pipeline="covid_deaths_pipeline",
    source="covid",
    period_field="week_ending_date",
    fields=(
        ("state", "state", "string"),
        ("covid_19_deaths", "covid_19_deaths", "bigint"),
        ("total_deaths", "total_deaths", "bigint"),
        ("pneumonia_deaths", "pneumonia_deaths", "bigint"),
        ("pneumonia_and_covid_19_deaths", "pneumonia_and_covid_19_deaths", "bigint"),
        ("influenza_deaths", "influenza_deaths", "bigint"),
    ),
    rules=(
        not_be_null("state"),
        not_be_null("snapshot_date"),
        be_between("covid_19_deaths", min_value=0),
        be_between("total_deaths", min_value=0),
        pair_a_at_least_b("total_deaths", "covid_19_deaths", ignore_row_if="either_value_is_missing"),
        compound_columns_unique("run_id", "snapshot_date", "state"),
    ),
    sentinel="United States",
    metric="covid_19_deaths",
)

ACTIVITY = Feed(
    table="flu_surveillance_raw",
    pipeline="flu_surveillance_pipeline",
    source="flu",
    period_field="week_end",
    fields=(
        ("state", "geography", "string"),
        ("activity_level", "label", "string"),
    ),
    rules=(
        not_be_null("state"),
        not_be_null("snapshot_date"),
        be_in_set("activity_level", ACTIVITY_LEVELS),
        compound_columns_unique("run_id", "snapshot_date", "state"),
    ),
    sentinel="Alabama",
)

FEEDS = (DEATHS, ACTIVITY)
