"""Query registry: every operator exercised on the driver's tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with an
optional SQL oracle (DuckDB dialect, tables registered as views).  Double
columns listed in ``dbl`` are rounded to 6 places on both sides so results
compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from faro.functions.core import round_doubles

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | Callable[[], str] | None = None  # a callable is resolved only when the oracle is asked for
    dbl: Sequence[str] = field(default_factory=tuple)
    big: Sequence[str] = field(default_factory=tuple)
    check: str = "O"  # O = SQL oracle, P = property test (tests/), F = fixture

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.build(spark, sf_dir), DIGITS)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sql = self.sql() if callable(self.sql) else self.sql
        if not self.dbl and not self.big:
            return sql
        scale = 10 ** DIGITS
        rep = ", ".join([f"ROUND(CAST({c} AS DOUBLE) * {scale}) / {scale} AS {c}" for c in self.dbl]
                        + [f"CAST({c} AS BIGINT) AS {c}" for c in self.big])
        return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | Callable[[], str] | None = None, dbl: Sequence[str] = (), big: Sequence[str] = (), check: str = "P"):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(dbl), tuple(big), check if sql is None else "O")
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from faro.plans import (  # noqa: F401
        q_annotate,
        q_cluster,
        q_fairness,
        q_features,
        q_metrics,
        q_models,
        q_penalised,
        q_profile,
        q_recipe,
        q_resample,
        q_sources,
        q_stream,
        q_text,
        q_topics,
        q_trees,
        q_verbs,
    )

    return dict(REGISTRY)
