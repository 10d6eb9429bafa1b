"""Loads every group of queries."""

from catalog import (  # noqa: F401
    disruptions,
    experiments,
    exploration,
    extract,
    graphs,
    merging,
    networks,
    parsing,
    reports,
    surveys,
)
from catalog.registry import ORACLES, QUERIES  # noqa: F401
