"""Province seeds and wallet families."""

from __future__ import annotations

from pyspark.sql import functions as F

from sundial.checks.fixtures import EVENTS_SNAPSHOT
from sundial.checks.registry import query
from sundial.functions.texts import slug
from sundial.session import cut_lineage
from sundial.plans import provinces, wallets

SNAP = f"DATE '{EVENTS_SNAPSHOT}'"
FIRST, UNTIL = "2000-01", "2001-01"

SEED_SQL = (
    "WITH cells AS (SELECT cell_id, province_name FROM cell_map QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY date DESC) = 1), "
    f"three AS (SELECT d.*, province_name FROM cell_daily d LEFT JOIN cells USING (cell_id) WHERE d.date BETWEEN {SNAP} - 2 AND {SNAP}), "
    f"today AS (SELECT cell_id, phone_number, province_name, sum(count) AS sum_logs_count FROM three WHERE date = {SNAP} GROUP BY 1, 2, 3), "
    "prov AS (SELECT phone_number, province_name, sum(count) AS total FROM three WHERE province_name IS NOT NULL GROUP BY 1, 2), "
    "ranked AS (SELECT *, dense_rank() OVER (PARTITION BY phone_number ORDER BY total DESC) AS r FROM prov), "
    "top AS (SELECT *, max(total) FILTER (r = 1) OVER w AS t1, max(total) FILTER (r = 2) OVER w AS t2, count(*) FILTER (r = 1) OVER w AS n1 FROM ranked WHERE r <= 2 WINDOW w AS (PARTITION BY phone_number)), "
    "stable AS (SELECT phone_number, province_name, total FROM top WHERE r = 1 AND n1 = 1 AND (t2 IS NULL OR t1 >= t2 * 9)) "
    "SELECT DISTINCT t.phone_number, t.cell_id, u.sum_logs_count, c.cell_id AS ref_cell_id, c.sum_logs_count AS ref_sum_logs_count, s.total AS ref_sum_logs_count_3d_prov, s.province_name AS ref_province_name "
    "FROM (SELECT DISTINCT phone_number, cell_id FROM three WHERE province_name IS NULL) t JOIN stable s USING (phone_number) "
    "JOIN today c ON c.phone_number = s.phone_number AND c.province_name = s.province_name JOIN today u ON u.phone_number = t.phone_number AND u.cell_id = t.cell_id")


@query("FP9_province_seed_day", SEED_SQL, "cell_daily cell_map", texts="ref_province_name")
def seed_day(f):
    return provinces.seed_day(f.cell_daily(), f.cell_map(), EVENTS_SNAPSHOT)


@query("FP10_sums_of_parts", f"SELECT cell_id, ref_province_name, sum(sum_logs_count) AS sum_logs_count, sum(ref_sum_logs_count) AS ref_sum_logs_count, count(*) AS pairs, count(DISTINCT phone_number) AS count_pn FROM ({SEED_SQL}) GROUP BY 1, 2",
       "cell_daily cell_map", texts="ref_province_name")
def sums_of_parts(f):
    """The sums of a day without its pairs of unmapped and reference cells."""
    return provinces.sums_of_parts(*provinces.seed_parts(f.cell_daily(), f.cell_map(), EVENTS_SNAPSHOT), ["phone_number"])


MONTH = "strftime(date_trunc('month', date) + INTERVAL 1 MONTH, '%Y-%m')"


def with_month(f):
    return f.seed_daily().withColumn("month", provinces.run_month(F.col("date")))


SUMS = f"SELECT {MONTH} AS month, cell_id, ref_province_name, sum(sum_logs_count) AS sum_logs_count, sum(ref_sum_logs_count) AS ref_sum_logs_count FROM seed_daily GROUP BY 1, 2, 3"
DAYS = f"SELECT {MONTH} AS month, cell_id, ref_province_name, count(DISTINCT date) AS count_date FROM seed_daily GROUP BY GROUPING SETS (({MONTH}, cell_id, ref_province_name), ({MONTH}, cell_id), ({MONTH}))"
TEXTS = "month|ref_province_name"


@query("FP10_month_of_run", "SELECT '2001-07' AS month, count(*) AS n, sum(sum_logs_count) AS logs FROM seed_daily WHERE date >= DATE '2001-06-01' AND date < DATE '2001-07-01'", "seed_daily", texts="month")
def month_of_run(f):
    return provinces.month_of_run(f.seed_daily(), "2001-07-01").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sum_logs_count").alias("logs"))


@query("FP10_monthly_sums", SUMS, "seed_daily", texts=TEXTS)
def monthly_sums(f):
    return provinces.monthly_sums(with_month(f))


@query("FP10_monthly_days", DAYS, "seed_daily", texts=TEXTS)
def monthly_days(f):
    return provinces.monthly_days(with_month(f))


@query("FP10_monthly_phones", f"SELECT DISTINCT {MONTH} AS month, cell_id, ref_province_name, phone_number FROM seed_daily", "seed_daily", texts=TEXTS)
def monthly_phones(f):
    return provinces.monthly_members(with_month(f), "phone_number")


@query("FP10_monthly_reference_cells", f"SELECT DISTINCT {MONTH} AS month, cell_id, ref_province_name, ref_cell_id FROM seed_daily", "seed_daily", texts=TEXTS)
def monthly_cells(f):
    return provinces.monthly_members(with_month(f), "ref_cell_id")


YEAR = f"(SELECT *, {MONTH} AS month FROM seed_daily WHERE {MONTH} >= '{FIRST}' AND {MONTH} < '{UNTIL}')"


def levels_sql(parts: dict[str, str]) -> str:
    inner = ", ".join(f"{e} AS {n}_cell_prov" for n, e in parts.items())
    outer = ", ".join(f"{e} AS {n}_cell" for n, e in parts.items())
    return (f"SELECT * FROM (SELECT cell_id, ref_province_name, {inner} FROM {YEAR} GROUP BY 1, 2) JOIN (SELECT cell_id, {outer} FROM {YEAR} GROUP BY 1) USING (cell_id)")


YEAR_SUMS = levels_sql({"sum_logs_count": "sum(sum_logs_count)", "ref_sum_logs_count": "sum(ref_sum_logs_count)", "count_month": "count(DISTINCT month)"})
YEAR_PHONES = levels_sql({"count_pn": "count(DISTINCT phone_number)"})
YEAR_CELLS = levels_sql({"count_ref_cell": "count(DISTINCT ref_cell_id)"})
YEAR_DAYS = (f"SELECT * FROM (SELECT cell_id, ref_province_name, sum(d) AS count_date_cell_prov FROM (SELECT month, cell_id, ref_province_name, count(DISTINCT date) AS d FROM {YEAR} GROUP BY 1, 2, 3) GROUP BY 1, 2) "
             f"JOIN (SELECT cell_id, sum(d) AS count_date_cell FROM (SELECT month, cell_id, count(DISTINCT date) AS d FROM {YEAR} GROUP BY 1, 2) GROUP BY 1) USING (cell_id)")


@query("FP11_yearly_sums", YEAR_SUMS, "seed_daily", texts=TEXTS)
def yearly_sums(f):
    return provinces.yearly_sums(provinces.monthly_sums(with_month(f)), FIRST, UNTIL)


@query("FP11_yearly_phones", YEAR_PHONES, "seed_daily", texts=TEXTS)
def yearly_phones(f):
    return provinces.yearly_members(provinces.monthly_members(with_month(f), "phone_number"), "phone_number", "count_pn", FIRST, UNTIL)


@query("FP11_yearly_reference_cells", YEAR_CELLS, "seed_daily", texts=TEXTS)
def yearly_cells(f):
    return provinces.yearly_members(provinces.monthly_members(with_month(f), "ref_cell_id"), "ref_cell_id", "count_ref_cell", FIRST, UNTIL)


@query("FP11_yearly_days", YEAR_DAYS, "seed_daily", texts=TEXTS)
def yearly_days(f):
    return provinces.yearly_days(provinces.monthly_days(with_month(f)), FIRST, UNTIL)


@query("FP12_yearly_report", f"SELECT * FROM ({YEAR_SUMS}) JOIN ({YEAR_PHONES}) USING (cell_id, ref_province_name) JOIN ({YEAR_CELLS}) USING (cell_id, ref_province_name) JOIN ({YEAR_DAYS}) USING (cell_id, ref_province_name)",
       "seed_daily", texts=TEXTS)
def report(f):
    seeds = cut_lineage(with_month(f))  # read by four monthly tables
    return provinces.yearly_report_of(provinces.monthly_sums(seeds), provinces.monthly_members(seeds, "phone_number"), provinces.monthly_members(seeds, "ref_cell_id"),
                                      provinces.monthly_days(seeds), FIRST, UNTIL)


@query("FP12_yearly_report_of_tables", f"SELECT * FROM ({YEAR_SUMS}) JOIN ({YEAR_PHONES}) USING (cell_id, ref_province_name) JOIN ({YEAR_CELLS}) USING (cell_id, ref_province_name) JOIN ({YEAR_DAYS}) USING (cell_id, ref_province_name)",
       "seed_daily", texts=TEXTS)
def report_of_tables(f):
    return provinces.yearly_report(yearly_sums(f), yearly_phones(f), yearly_cells(f), yearly_days(f))


# wallets

SYSTEMS = {"mm": "MM", "vp": "VP"}
NEWEST = f"newest AS (SELECT * EXCLUDE (date) FROM wallet_daily WHERE date BETWEEN {SNAP} - 6 AND {SNAP} QUALIFY row_number() OVER (PARTITION BY phone_number, mother_system ORDER BY date DESC) = 1)"
WALLET_TEXTS = ".*(actv_date|updated_date|pin_date|linked_date|type_date|money_source_table|money_sources|channel_type|_bank_code|mother_system)"


@query("FP13_newest_accounts", f"WITH {NEWEST} SELECT * FROM newest", "wallet_daily", texts=WALLET_TEXTS)
def newest(f):
    return wallets.newest_accounts(f.wallet_daily(), EVENTS_SNAPSHOT)


COLUMNS = ("mobile_id province_code district actv_date updated_date pin_date info_updated_date money_source_linked_date customer_type_date money_source_table "
           "money_sources pin_status mobile_level company_id channel_type partner_bank_code core_bank_code").split()


def account_sql(system: str, prefix: str) -> str:
    parts = {c: c for c in COLUMNS}
    parts |= {n: f"{SNAP} - {c}" for n, c in wallets.AGES.items()} | {n: f"{c} - actv_date" for n, c in wallets.DISTANCES.items()}
    parts |= {n: f"({c} IS NOT NULL)::INT" for n, c in wallets.FLAGS.items()}
    return f"(SELECT phone_number, {', '.join(f'{e} AS {prefix}_{n}' for n, e in parts.items())} FROM newest WHERE mother_system = '{system}')"


ACCOUNTS = f"SELECT * FROM {account_sql('MM', 'mm')} FULL JOIN {account_sql('VP', 'vp')} USING (phone_number)"
ACCOUNT_TEXTS = "(customer_)?(mm|vp)_(actv_date|updated_date|pin_date|info_updated_date|money_source_linked_date|customer_type_date|money_source_table|money_sources|channel_type|partner_bank_code|core_bank_code)"


@query("FP14_account_features", f"WITH {NEWEST} {ACCOUNTS}", "wallet_daily", texts=ACCOUNT_TEXTS)
def accounts(f):
    return wallets.account_features(newest(f), EVENTS_SNAPSHOT, SYSTEMS)


def bank_sql(system: str, prefix: str) -> str:
    group = "lower(bank_type)"
    kinds = {"bank": ", ".join(f"'{g.lower()}'" for g in wallets.BANK_KINDS["bank"]), "finance": "'non-bank financial institution'"}
    parts = {"partner_bank_code": "min(partner_bank_code)", "core_bank_code": "min(core_bank_code)", "distinct_bank_code": "count(DISTINCT code)",
             "distinct_bank_group": "count(DISTINCT bank_type)", "distinct_bank_tier": "count(DISTINCT bank_size)"}
    parts |= {f"num_distinct_{k}": f"count(DISTINCT code) FILTER ({group} IN ({v}))" for k, v in kinds.items()}
    parts |= {f"num_distinct_{slug(g)}": f"count(DISTINCT code) FILTER ({group} = '{g.lower()}')" for g in wallets.BANK_GROUPS}
    parts |= {f"num_distinct_{slug(t)}": f"count(DISTINCT code) FILTER (lower(bank_size) = '{t.lower()}')" for t in wallets.TIERS}
    parts["distinct_method"] = "max(CASE WHEN code IS NOT NULL THEN methods END)"
    return f"(SELECT phone_number, {', '.join(f'{e} AS {prefix}_{n}' for n, e in parts.items())} FROM linked WHERE mother_system = '{system}' GROUP BY 1)"


LINKED = ("linked AS (SELECT n.*, code, bank_type, bank_size, len(list_distinct(list_filter(string_split(money_source_table, ','), lambda x: x <> ''))) AS methods FROM newest n "
          "LEFT JOIN (SELECT phone_number, mother_system, unnest(list_distinct(list_filter(list_transform(string_split(money_sources, ','), lambda x: upper(trim(string_split(x, '#')[1]))), lambda x: x <> ''))) AS code FROM newest) c "
          "USING (phone_number, mother_system) LEFT JOIN bank_map m ON m.bank_code = code)")
BANKS = f"SELECT * FROM {bank_sql('MM', 'mm')} FULL JOIN {bank_sql('VP', 'vp')} USING (phone_number)"


@query("FP15_bank_features", f"WITH {NEWEST}, {LINKED} {BANKS}", "wallet_daily bank_map", texts=ACCOUNT_TEXTS)
def banks(f):
    return wallets.bank_features(newest(f), f.bank_map(), SYSTEMS)


def cross_sql() -> str:
    has = {s: f"({s}_mobile_id IS NOT NULL)::INT" for s in SYSTEMS}
    extra = {**{f"has_{s}": e for s, e in has.items()}, "num_service": f"{has['mm']} + {has['vp']}"}
    for name, c in (("account_age", "account_age_days"), ("money_source_age", "money_source_age_days")):
        extra |= {f"max_{name}": f"greatest(mm_{c}, vp_{c})", f"min_{name}": f"least(mm_{c}, vp_{c})", f"{name}_gap": f"abs(mm_{c} - vp_{c})"}
    account = [f"{s}_{n}" for s in SYSTEMS for n in [*COLUMNS, *wallets.AGES, *wallets.DISTANCES, *wallets.FLAGS] if n not in ("partner_bank_code", "core_bank_code")]
    bank = [f"{s}_{n}" for s in SYSTEMS for n in ["partner_bank_code", "core_bank_code", "distinct_bank_code", "distinct_bank_group", "distinct_bank_tier", "num_distinct_bank", "num_distinct_finance",
                                                  *[f"num_distinct_{slug(x)}" for x in [*wallets.BANK_GROUPS, *wallets.TIERS]], "distinct_method"]]
    named = ", ".join([f"{c} AS customer_{c}" for c in account + bank] + [f"{e} AS customer_{n}" for n, e in extra.items()])
    return (f"WITH {NEWEST}, {LINKED}, acc AS (SELECT * EXCLUDE (mm_partner_bank_code, mm_core_bank_code, vp_partner_bank_code, vp_core_bank_code) FROM ({ACCOUNTS})), bank AS ({BANKS}) "
            f"SELECT phone_number, {named} FROM bank JOIN acc USING (phone_number)")


@query("FP16_cross_features", cross_sql(), "wallet_daily bank_map", texts=ACCOUNT_TEXTS)
def cross(f):
    own = accounts(f).drop(*[f"{s}_{c}" for s in SYSTEMS for c in ("partner_bank_code", "core_bank_code")])
    return wallets.cross_features(banks(f), own, ("mm", "vp"))
