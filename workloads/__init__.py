"""Registered queries over the driver tables, each with the SQL that must give the same rows."""

from workloads import events, indicators, notified, places, schemas, sketches, stored, streams, times
from workloads.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "events",
    "indicators",
    "notified",
    "places",
    "schemas",
    "sketches",
    "stored",
    "streams",
    "times",
]
