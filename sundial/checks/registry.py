"""Registration of queries with their SQL counterparts, in one comparable output form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sundial.checks.fixtures import Fixtures, ctes

INTEGERS = ("tinyint", "smallint", "int", "bigint", "boolean")


@dataclass(frozen=True)
class Query:
    build: Callable[[Fixtures], DataFrame]
    sql: str | None
    digits: int


REGISTRY: dict[str, Query] = {}


def nudge(digits: int) -> float:
    """Added before rounding in both engines, so that exact halves are not on a rounding edge."""
    return 2.718281 * 10.0 ** -(digits + 1)


def comparable(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded, days as text, whole numbers as bigint: the same form in both engines."""

    def form(name: str, kind: str) -> str:
        if kind in ("double", "float") or kind.startswith("decimal"):
            return f"round(CAST(`{name}` AS DOUBLE) + {nudge(digits):.12f}D, {digits}) + 0.0D AS `{name}`"
        return f"CAST(`{name}` AS {'BIGINT' if kind in INTEGERS else 'STRING'}) AS `{name}`"

    return df.selectExpr(*[form(name, kind) for name, kind in df.dtypes])


def comparable_sql(sql: str, tables: list[str], doubles: str, texts: str, whole: bool, digits: int) -> str:
    """The same form in SQL; columns are classed by name pattern, the rest are whole numbers."""
    parts = []
    if texts:
        parts.append(f"CAST(COLUMNS(lambda c: regexp_full_match(c, '{texts}')) AS VARCHAR)")
    if doubles:
        own = f"regexp_full_match(c, '{doubles}')" + (f" AND NOT regexp_full_match(c, '{texts}')" if texts else "")
        parts.append(f"round(CAST(COLUMNS(lambda c: {own}) AS DOUBLE) + {nudge(digits):.12f}, {digits}) + 0.0")
    if whole:
        known = "|".join(p for p in (texts, doubles) if p)
        test = f"NOT regexp_full_match(c, '{known}')" if known else "true"
        parts.append(f"CAST(COLUMNS(lambda c: {test}) AS BIGINT)")
    return f"{ctes(tables)}SELECT {', '.join(parts)} FROM ({sql}) AS result"


def query(name: str, sql: str | None = None, tables: str = "", doubles: str = "", texts: str = "",
          whole: bool = True, digits: int = 6):
    """Register a query; `tables` names the derived tables its SQL reads."""

    def add(build: Callable[[Fixtures], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        text = sql and comparable_sql(sql, tables.split(), doubles, texts, whole, digits)
        REGISTRY[name] = Query(build, text, digits)
        return build

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    entry = REGISTRY[name]
    return comparable(entry.build(Fixtures(spark, folder)), entry.digits)


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from sundial.checks import (  # noqa: F401
        calendar_queries, device_queries, dimension_queries, function_queries, lift_queries,
        operator_queries, payment_a_queries, payment_b_queries, place_queries, source_queries,
    )

    return REGISTRY
