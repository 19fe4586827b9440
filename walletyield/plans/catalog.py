"""

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
Every query reads the bundled tables (through the fixtures) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from walletyield.plans.oracle import with_views

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, with_views(sql) if sql else None)
        return fn
    return deco


def _pinned(fn: Builder) -> Builder:
    """Run a builder with the session zone pinned to UTC:
    midnights, intervals and text times are defined in UTC."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    build.__name__ = getattr(fn, "__name__", "query")
    build.__doc__ = fn.__doc__
    return build


def queries() -> dict[str, Builder]:
    _load()
    return {k: _pinned(v[0]) for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


def _load() -> None:
    # importing the query modules fills REGISTRY
    from walletyield.plans import q_core, q_io, q_logs, q_metrics, q_quality, q_sinks  # noqa: F401
    from walletyield.streaming import queries as _sq  # noqa: F401
