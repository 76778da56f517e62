"""Joining feature families to labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sundial.operators.columns import decimals_to_double, with_suffix
from sundial.operators.joins import outer_on_key, point_in_time, snapped_merge, wide_merge

LABEL_KEYS = ["phone_number", "disburse_date", "product", "label_value"]
JOIN_KEYS = ["phone_number", "disburse_date"]


def external_table(holidays: DataFrame, *others: DataFrame) -> DataFrame:
    """Calendar-wide families on one date column."""
    return outer_on_key([holidays, *others], ["date"])


def with_external(labels: DataFrame, table: DataFrame) -> DataFrame:
    """External features of the newest snapshot published before each label's day."""
    return snapped_merge(labels, table)


def merge_sample_tables(base: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Feature tables that already carry the label keys; columns get the table's name as suffix."""
    named = {name: with_suffix(df, name, JOIN_KEYS) for name, df in tables.items()}
    return wide_merge(base.select(*LABEL_KEYS), named, JOIN_KEYS)


def master_table(labels: DataFrame, families: dict[str, DataFrame], weekly: bool = True) -> DataFrame:
    """Every family's features as they stood three to nine days before the label's day.

    Each family is merged once on its own keys and then joined to the labels, which are the small
    side; feature tables are read only for the eligible days.
    """
    moments = labels.select(*JOIN_KEYS).distinct()
    merged = {}
    for name, table in families.items():
        found = point_in_time(moments, table, weekly=weekly)
        merged[name] = with_suffix(found.drop("date"), name, JOIN_KEYS)
    return decimals_to_double(wide_merge(labels, merged, JOIN_KEYS))
