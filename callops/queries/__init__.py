"""Registered queries, each next to the plain SQL it is checked against."""

from callops.queries import (  # noqa: F401
    calls, cleaning, csat, gates, ingest, loads, people, productivity, quality, workforce,
)
from callops.queries import flows  # noqa: F401  reuses the SQL of the others
from callops.queries.registry import ORACLES, QUERIES  # noqa: F401
