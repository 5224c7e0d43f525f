"""Registered queries: every operator on the given tables, with SQL that must agree."""

from catalog.base import QUERIES, SQL  # noqa: F401
from catalog import (  # noqa: F401
    calendars,
    composed,
    guards,
    held,
    jobs,
    merging,
    monitoring,
    pit,
    sources,
    statistics,
    transforms,
)
