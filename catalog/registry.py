"""Collects the queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from catalog.fixtures import Inputs, with_views

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``build(inputs)`` under ``name``; views in the oracle are added to it."""
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return build

    return register
