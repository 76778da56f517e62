"""String clean-up used by the wallet, package and dimension jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(label: str) -> str:
    """A free-text label as a column-name suffix."""
    return label.lower().translate(str.maketrans("- ", "__"))


def code_list(column: Column) -> Column:
    """Distinct upper-case codes of a list such as `AB#AB,CD#CD,,EF`."""
    items = F.split(F.coalesce(column, F.lit("")), ",")
    codes = F.transform(items, lambda item: F.upper(F.trim(F.element_at(F.split(item, "#"), 1))))
    return F.array_distinct(F.filter(codes, lambda code: code != ""))


def item_list(column: Column) -> Column:
    """Distinct non-empty items of a comma-separated list."""
    return F.array_distinct(F.filter(F.split(column, ","), lambda item: item != ""))


def category_or_unmapped(key: Column, label: Column) -> Column:
    """Null without a key, 'unmapped' without a label, else the label in lower case."""
    return F.when(key.isNotNull(), F.coalesce(F.lower(label), F.lit("unmapped")))


def package_family(name: Column) -> Column:
    """Normal form of a data-package name: suffixes for price, period, channel and network are taken off.

    Fixed values: the name patterns, of which the first that fits decides.
    """
    def shorter(count: int) -> Column:
        return F.substring(name, F.lit(1), F.length(name) - count)

    def without(pattern: str) -> Column:
        return F.regexp_replace(name, pattern, "")

    return (
        F.when(name.endswith("X") & (name != "MIMAX"), shorter(1))
        .when(name.like("%_60"), without("_60"))
        .when(name.like("%_TS"), without("_TS"))
        .when(name.contains("VOICE"), without("-?VOICE"))
        .when(name.contains("DATA"), without("[-_]DATA"))
        .when(name.startswith("VTR"), F.lit("VTR"))
        .when(name.like("%_NEW"), shorter(4))
        .when(name.like("%_KDS"), F.lit("GOI_CUOC_DOANH_NGH_TANG/BAN"))
        .when(name.contains("KID"), F.lit("GOI_KID_DINH_VI"))
        .when(name.like("%_4G%"), without("_4G"))
        .when(name.like("%_4"), without("_4"))
        .when(name.like("%_1"), without("_1"))
        .when(name.endswith("U") & (name != "CAMAU_BACLIEU"), shorter(1))
        .otherwise(name))


def is_tracked_package(family: Column) -> Column:
    """Leave out locator, car and child packages."""
    return ~(family.like("VTR%") | family.like("%CAR%") | (family == "GOI_KID_DINH_VI"))
