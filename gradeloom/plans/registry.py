"""Queries by name with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.session import table

_ALL: dict[str, tuple] = {}


def query(sql: str | None = None, places: int = 6):
    """Register a query under its function's name, with the SQL for it. Floating results are rounded, as their sums depend on the order of addition."""

    def keep(f):
        def run(spark: SparkSession, d: str) -> DataFrame:
            df = f(lambda name: table(spark, d, name))
            return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

        _ALL[f.__name__] = (run, sql)
        return f

    return keep


def queries():
    return {k: v[0] for k, v in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _ALL.items() if v[1]}
