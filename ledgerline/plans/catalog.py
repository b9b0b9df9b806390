"""All registered queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "subscription", "cleaning", "periods", "series", "forecasting", "quality", "loading", "incremental",
)


def _merged(name: str) -> dict:
    merged: dict = {}
    for module in MODULES:
        part = getattr(import_module(f"{__package__}.{module}"), name)
        repeated = merged.keys() & part.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(part)
    return merged


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")
