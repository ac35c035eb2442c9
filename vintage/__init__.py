"""Versioned reporting tables on Spark: ingest, upsert, validate, score, model."""

from vintage.feeds import ACTIVITY, DEATHS, Feed
from vintage.schemas import KEYS, VERSION, Layers

__all__ = ["ACTIVITY", "DEATHS", "Feed", "KEYS", "VERSION", "Layers"]
