"""All core queries and their SQL twins, gathered from the modules of folianth.plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folianth.plans import audits, cases, lookups, navigation, pages, records, shelf, text

MODULES = (records, text, navigation, pages, lookups, audits, cases, shelf)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
