"""Registry of named queries: each is a Spark job over the driver tables plus,
where the result is exactly expressible in SQL, an independent DuckDB oracle.

``queries()`` / ``oracle_sql()`` in ``__spark_entry__`` are views of this
registry.  Every query reads whole tables; floats are rounded to 6 places on
both sides so that summation order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    bench: bool = False


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, bench)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the query modules fills the registry.
    from ratecraft.plans import (queries_core, queries_ml, queries_models,  # noqa: F401
                                 queries_relational, queries_tables, queries_text)
    return REGISTRY
