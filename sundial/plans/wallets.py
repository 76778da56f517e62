"""Wallet accounts of several systems: newest snapshot, account, linked-bank and cross features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, days_since
from sundial.functions.numbers import present
from sundial.functions.texts import code_list, item_list, slug
from sundial.operators.columns import sorted_columns, with_prefix
from sundial.operators.joins import lookup
from sundial.operators.quality import require_days
from sundial.operators.sequences import newest_row
from sundial.sources.scans import last_weeks

PHONE, SYSTEM = "phone_number", "mother_system"


def side_by_side(df: DataFrame, key: str, split: str, blocks: dict[str, str]) -> DataFrame:
    """One row per key with a block of prefixed columns per value of `split`.

    Rows must be unique per (key, split). Same result as outer-joining the filtered parts, in one
    aggregate over one scan.
    """
    columns = [c for c in df.columns if c not in (key, split)]
    return df.filter(F.col(split).isin(list(blocks.values()))).groupBy(key).agg(*[
        F.max(F.when(F.col(split) == value, F.col(c))).alias(f"{prefix}_{c}")
        for prefix, value in blocks.items() for c in columns])


def newest_accounts(daily: DataFrame, snapshot: DateLike, check: bool = False) -> DataFrame:
    """The newest row of the week per subscriber and system."""
    week = last_weeks(daily, snapshot, 1)
    if check:
        week = require_days(week, 7)
    return newest_row(week.filter(f"{PHONE} IS NOT NULL"), [PHONE, SYSTEM], "date").drop("date")


# Milestone columns, the age each gives, and its distance from activation.
AGES = {"account_age_days": "actv_date", "days_since_update": "updated_date", "pin_age_days": "pin_date",
        "days_since_profile_update": "info_updated_date", "money_source_age_days": "money_source_linked_date",
        "customer_type_age_days": "customer_type_date"}
DISTANCES = {"days_active_to_update": "updated_date", "days_active_to_pin": "pin_date",
             "days_active_to_money_source": "money_source_linked_date"}
FLAGS = {"has_company": "company_id", "has_channel_type": "channel_type"}


def account_features(accounts: DataFrame, snapshot: DateLike, systems: dict[str, str]) -> DataFrame:
    """Ages of and gaps between account milestones and presence flags, per system."""
    dated = accounts.withColumns({c: F.to_date(c) for c in accounts.columns if "date" in c})
    described = dated.withColumns({
        **{name: days_since(F.col(c), snapshot) for name, c in AGES.items()},
        **{name: F.datediff(c, "actv_date") for name, c in DISTANCES.items()},
        **{name: present(F.col(c)) for name, c in FLAGS.items()}})
    return side_by_side(described, PHONE, SYSTEM, systems)


# Bank groups, tiers, and which groups are banks or finance companies.
BANK_GROUPS = ["State-Owned Commercial Bank", "State-Owned Limited Liability Bank", "Wholly Foreign-Owned Bank",
               "Non-Bank Financial Institution", "Joint Stock Commercial Bank", "Joint Venture Bank"]
TIERS = ["Large", "Medium", "Small"]
FINANCE_GROUPS = ["Non-Bank Financial Institution"]
BANK_KINDS = {"bank": [g for g in BANK_GROUPS if g not in FINANCE_GROUPS], "finance": FINANCE_GROUPS}


def linked_banks(accounts: DataFrame, bank_map: DataFrame) -> DataFrame:
    """One row per account and linked bank code (one row without a code if it has none)."""
    codes = accounts.withColumns({
        "__codes": code_list(F.col("money_sources")), "__methods": F.size(item_list(F.col("money_source_table")))})
    rows = codes.select("*", F.explode_outer("__codes").alias("bank_code")).drop("__codes")
    banks = bank_map.select("bank_code", F.col("bank_type").alias("bank_group"), F.col("bank_size").alias("tier"))
    return lookup(rows, banks, "bank_code")


def bank_features(accounts: DataFrame, bank_map: DataFrame, systems: dict[str, str],
                  codes: tuple[str, ...] = ("partner_bank_code", "core_bank_code")) -> DataFrame:
    """Distinct linked banks by group and tier, and number of link methods, per system.

    Codes are made unique per account first; groups and tiers have a handful of values.
    """
    unique = linked_banks(accounts, bank_map).groupBy(PHONE, SYSTEM, "bank_code").agg(
        *[F.min(c).alias(c) for c in codes], F.max("bank_group").alias("bank_group"), F.max("tier").alias("tier"), F.max("__methods").alias("methods"))
    group, tier, code = F.lower("bank_group"), F.lower("tier"), F.col("bank_code")
    counts = {f"num_distinct_{kind}": group.isin([g.lower() for g in groups]) for kind, groups in BANK_KINDS.items()}
    counts |= {f"num_distinct_{slug(g)}": group == g.lower() for g in BANK_GROUPS}
    counts |= {f"num_distinct_{slug(t)}": tier == t.lower() for t in TIERS}
    per_account = unique.groupBy(PHONE, SYSTEM).agg(
        *[F.min(c).alias(c) for c in codes], F.count("bank_code").alias("distinct_bank_code"),
        F.size(F.collect_set("bank_group")).alias("distinct_bank_group"), F.size(F.collect_set("tier")).alias("distinct_bank_tier"),
        *[F.count(F.when(test, code)).alias(name) for name, test in counts.items()],
        F.max(F.when(code.isNotNull(), F.col("methods"))).alias("distinct_method"))
    return side_by_side(per_account, PHONE, SYSTEM, systems)


def cross_features(banks: DataFrame, accounts: DataFrame, systems: tuple[str, str], prefix: str = "customer") -> DataFrame:
    """Accounts and banks of both systems with service counts and age extremes; names sorted."""
    a, b = systems
    joined = banks.join(accounts, PHONE)
    has = {s: present(F.col(f"{s}_mobile_id")) for s in systems}
    extra = {**{f"has_{s}": has[s] for s in systems}, "num_service": has[a] + has[b]}
    for name, source in (("account_age", "account_age_days"), ("money_source_age", "money_source_age_days")):
        left, right = F.col(f"{a}_{source}"), F.col(f"{b}_{source}")
        extra |= {f"max_{name}": F.greatest(left, right), f"min_{name}": F.least(left, right), f"{name}_gap": F.abs(left - right)}
    return sorted_columns(with_prefix(joined.withColumns(extra), prefix, [PHONE]), [PHONE])
