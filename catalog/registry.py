"""The registered queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Query, prefix: str | None = None, body: str | None = None) -> None:
    """Add a query; ``prefix`` holds common tables and ``body`` the last select."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = build
    if body is not None:
        tables = (prefix or "").strip().rstrip(",")
        ORACLES[name] = (f"WITH RECURSIVE {tables}\n" if tables else "") + body
