"""Projections over whole schemas; they cost nothing at run time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FLOATS = ("float", "double")


def with_prefix(df: DataFrame, prefix: str, keys: Iterable[str]) -> DataFrame:
    keys = list(keys)
    return df.select(*keys, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys])


def with_suffix(df: DataFrame, suffix: str, keys: Iterable[str]) -> DataFrame:
    keys = list(keys)
    return df.select(*keys, *[F.col(c).alias(f"{c}_{suffix}") for c in df.columns if c not in keys])


def matching(df: DataFrame, starts: tuple[str, ...] = (), ends: tuple[str, ...] = (),
             without: tuple[str, ...] = (), keys: Iterable[str] = ()) -> DataFrame:
    """Keep keys and the columns whose names fit every given rule."""
    keys = list(keys)

    def fits(name: str) -> bool:
        return (
            (not starts or name.startswith(starts))
            and (not ends or name.endswith(ends))
            and not any(part in name for part in without)
        )

    return df.select(*keys, *[c for c in df.columns if c not in keys and fits(c)])


def decimals_to_double(df: DataFrame) -> DataFrame:
    return _cast(df, lambda name, kind: kind.startswith("decimal"))


def named_to_double(df: DataFrame, parts: Iterable[str]) -> DataFrame:
    """Cast columns whose name contains one of the parts; unreadable text becomes null."""
    parts = list(parts)
    return _cast(df, lambda name, kind: any(part in name for part in parts))


def _cast(df: DataFrame, chosen) -> DataFrame:
    return df.select([
        F.col(c).try_cast("double").alias(c) if chosen(c, kind) else F.col(c) for c, kind in df.dtypes
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Only float columns can hold NaN; asking others fails under ANSI rules."""
    return df.select([
        F.when(~F.isnan(c), F.col(c)).alias(c) if kind in _FLOATS else F.col(c) for c, kind in df.dtypes
    ])


def fill_missing(df: DataFrame, number: float = 0, text: str | None = None,
                 keys: Iterable[str] = ()) -> DataFrame:
    """Replace nulls in number columns, and in text columns when `text` is given."""
    keys = set(keys)
    names = {c: kind for c, kind in df.dtypes if c not in keys}
    numeric = [c for c, kind in names.items()
               if kind in _FLOATS or kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint")]
    texts = [c for c, kind in names.items() if kind == "string"]
    filled = df.fillna(number, subset=numeric) if numeric else df
    return filled.fillna(text, subset=texts) if text is not None and texts else filled


def align_to(df: DataFrame, columns: list[str], missing: float = -1) -> DataFrame:
    """The given columns in the given order; absent ones hold a marker value."""
    return df.select([F.col(c) if c in df.columns else F.lit(missing).alias(c) for c in columns])


def sorted_columns(df: DataFrame, first: Iterable[str] = ()) -> DataFrame:
    first = list(first)
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def keep(df: DataFrame, wanted: Iterable[str], keys: Iterable[str] = ()) -> DataFrame:
    """Keys and those wanted columns that exist, in the table's own order."""
    keys, wanted = list(keys), set(wanted)
    return df.select(*keys, *[c for c in df.columns if c in wanted and c not in keys])
