"""All registered queries of the core, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexispark.plans import assembly, core_problems, extensions, lexicon, lookups

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (lexicon, assembly, lookups, extensions, core_problems)


def core_queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def core_oracle() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.ORACLE.items()}
