"""Registry of analyses: key -> (Spark builder, DuckDB SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables; the SQL string (when present) computes the same rows in DuckDB
with the same column names, doubles rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def _load_all():
    # Importing the modules fills REGISTRY.
    from . import (q_eval, q_scalars, q_features, q_sources, q_stats,  # noqa: F401
                   q_knn, q_recommend, q_graph, q_dbscan, q_patterns, q_models, q_louvain)


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
