"""Query registry: one output specification serves the Spark result and the checking SQL.

A specification lists columns; ``name:digits`` rounds and ``name:digits@scale`` scales before rounding. The scale ``edge`` is for
values of the derived archive that often are short fractions: times it, none of them lies on a rounding edge.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.queries.ctes import CTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
OFF_EDGE = 0.7310585786300049


def _columns(spec: str) -> list[tuple[str, int | None, float | None]]:
    out = []
    for token in spec.split():
        name, _, rest = token.partition(":")
        digits, _, scale = rest.partition("@")
        out.append((name, int(digits) if digits else None, OFF_EDGE if scale == "edge" else float(scale) if scale else None))
    return out


def shape(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, digits, scale in _columns(spec):
        c = F.col(name)
        if scale is not None:
            c = c * F.lit(scale)
        cols.append((F.round(c, digits) if digits is not None else c).alias(name))
    return df.select(*cols)


def _shape_sql(spec: str) -> str:
    parts = []
    for name, digits, scale in _columns(spec):
        c = f'"{name}"'
        if scale is not None:
            c = f"{c} * {scale!r}::DOUBLE"
        parts.append(f'round(({c})::DOUBLE, {digits}) + 0.0 AS "{name}"' if digits is not None else c)
    return ", ".join(parts)


def with_ctes(sql: str) -> str:
    """Prefix the common table expressions the text names, in dependency order."""
    needed: list[str] = []
    open_names: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and name not in open_names and re.search(rf"\b{name}\b", text):
                open_names.add(name)
                visit(CTES[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" if not n.startswith("orbit") else f"{n} AS ({CTES[n]})" for n in needed) + "\n" + sql


def query(key: str, spec: str, sql: str | None = None):
    """Register a query; without SQL it has rows only."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: shape(fn(spark, sf_dir), spec)
        if sql is not None:
            SQL[key] = with_ctes(f"SELECT {_shape_sql(spec)} FROM ({sql}) AS result")
        return fn

    return register
