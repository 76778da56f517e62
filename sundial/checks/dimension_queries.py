"""Device-name clean-up and model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from sundial.checks.fixtures import ORDERS_SNAPSHOT
from sundial.checks.registry import query
from sundial.operators.joins import key_changes
from sundial.operators.quality import duplicate_rows
from sundial.plans import assignments, device_names as dn
from sundial.session import cut_lineage

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rules_sql(column: str, rules) -> str:
    for pattern, replacement in rules:
        column = f"regexp_replace({column}, {text(pattern)}, {text(replacement.replace('$', chr(92)))}, 'g')"
    return column


# a caller's model dictionary, derived from the parts
MODELS_SQL = ("models AS (SELECT DISTINCT 'samsung' AS device_brand, concat('galaxy s', p_size, ' ultra 5g') AS raw_model, concat('galaxy s', p_size, ' top') AS device_model FROM part WHERE p_size % 3 = 0 "
              "UNION SELECT DISTINCT 'xiaomi', concat('redmi note ', p_size, ' pro plus'), concat('redmi note ', p_size, ' prime') FROM part WHERE p_size % 4 = 0)")


def models(f):
    size = F.col("p_size").cast("string")
    samsung = f.part.filter("p_size % 3 = 0").select(F.lit("samsung").alias("device_brand"), F.concat(F.lit("galaxy s"), size, F.lit(" ultra 5g")).alias("raw_model"),
                                                     F.concat(F.lit("galaxy s"), size, F.lit(" top")).alias("device_model"))
    xiaomi = f.part.filter("p_size % 4 = 0").select(F.lit("xiaomi"), F.concat(F.lit("redmi note "), size, F.lit(" pro plus")), F.concat(F.lit("redmi note "), size, F.lit(" prime")))
    return samsung.union(xiaomi).distinct()


#: What each shape of model name in the test table has to become, by brand; written by hand from the shapes.
SPACE = r"\s+"
SIZED = r"\b(?:40|41|42|43|44|45|46|47|49)\b"
EXPECTED = {
    "apple": [(r"^ipad pro 11 (\d+)$", "ipad pro 11 gen$1"), (r"^iphone se 2 202\d$", "iphone se 2"), (r"^watch (\d+) 44mm$", "watch $1")],
    "google": [(r"^pixel (\d+)xl$", "pixel $1 xl")],
    "nokia": [(r"^pixel (\d+)xl$", "pixel $1 xl")],
    "huawei": [("^mate 20 x$", "mate 20x")],
    "honor": [("^mate 20 x$", "mate 20x")],
    "xiaomi": [(r"^note (\d+) pro plus$", "redmi note $1 pro plus")],
    "samsung": [
        (r"^a(\d+) 2020$", "galaxy a$1 2020"), (r"^iphone se 2 (202\d)$", "iphone 2 $1"), (r"^note (\d+) pro plus$", "note$1 pro plus"),
        (r"^sm-a\d+0f galaxy a(\d+)$", "galaxy a$1"), (r"^tab s(\d+)fe$", "tab s$1 fe"), (r"^watch (\d+) 44mm$", "watch$1"),
        (r"^z fold (\d+) z fold \d+ 5g$", "galaxy z fold$1"), (SIZED, "")],
}


#: What each brand text of the test table has to become, written by hand; all others are their own brand.
BRAND_OF = {"samsung electronics": "samsung", "apple inc": "apple", "redmi": "xiaomi", "poco": "xiaomi", "mi": "xiaomi", "zte corporation": "zte", "google inc": "google",
            "lg electronics": "lg", "shenzhen huafurui technology co ltd": "cubot", "quectel wireless solutions co ltd": "quectel", "fossil group inc": "fossil"}
#: Empty or meaningless models by brand, of those that can occur.
JUNK = "m = '' OR m IN ('unknown') OR (brand = 'apple' AND m = 'model') OR (brand = 'samsung' AND m IN ('galaxy', 'n')) OR (brand = 'xiaomi' AND m = 'redmi')"
DICTIONARY_FIRST, DICTIONARY_LAST = "'xiaomi', 'motorola', 'zte', 'google', 'nokia'", "'samsung', 'oppo', 'oneplus', 'vivo', 'huawei', 'honor', 'realme'"
NETWORK_CUT = "'huawei', 'honor', 'realme', 'motorola', 'zte', 'google', 'nokia'"


def clean_sql() -> str:
    brand = f"CASE b {' '.join(f'WHEN {text(k)} THEN {text(v)}' for k, v in BRAND_OF.items())} ELSE b END"
    tidy = "trim(replace(replace(regexp_replace(translate(replace(m, '+', ' plus '), '()', '  '), '\\s+', ' ', 'g'), 'pro max', 'promax'), '5 g', '5g'))"
    sub = ("CASE WHEN brand <> 'xiaomi' THEN m WHEN raw = 'redmi' THEN CASE WHEN starts_with(m, 'redmi') THEN m ELSE 'redmi ' || m END "
           "WHEN raw = 'poco' THEN CASE WHEN starts_with(m, 'poco') THEN m ELSE 'poco ' || m END WHEN starts_with(raw, 'mi') THEN regexp_replace(m, '^mi\\s+', 'redmi ') "
           "WHEN raw = 'xiaomi' AND starts_with(m, 'mi') THEN 'redmi ' || substr(m, 4) ELSE m END")
    strip = ("CASE WHEN contains(m, 'test imei') THEN '' WHEN m IN ('none', 'nan', '') THEN 'unknown' "
             "WHEN starts_with(m, brand || ' ') THEN trim(substr(m, length(brand) + 1)) ELSE trim(m) END")
    per_brand = " ".join(f"WHEN {text(b)} THEN trim({rules_sql(rules_sql('s', rules), [(SPACE, ' ')])})" for b, rules in EXPECTED.items())
    return (f"{MODELS_SQL}, a AS (SELECT tac, lower(trim(device_brand)) AS r, coalesce(lower(trim(device_brand)), 'other') AS b, coalesce(lower(trim(device_model)), '') AS m FROM tac_raw), "
            f"b AS (SELECT tac, coalesce(r, 'none') AS raw, {brand} AS brand, m FROM a), c AS (SELECT tac, brand, trim({sub}) AS m FROM b), d AS (SELECT tac, brand, {strip} AS m FROM c), "
            f"e AS (SELECT tac, brand, {tidy} AS m FROM d), "
            f"g AS (SELECT e.*, x.device_model AS hit1, trim({rules_sql('lower(trim(m))', [(SPACE, ' ')])}) AS s FROM e LEFT JOIN models x ON x.device_brand = brand AND x.raw_model = m AND brand IN ({DICTIONARY_FIRST})), "
            f"h AS (SELECT tac, brand, hit1, CASE brand {per_brand} ELSE m END AS m FROM g), "
            f"i AS (SELECT tac, brand, coalesce(hit1, x.device_model, CASE WHEN brand IN ({NETWORK_CUT}) THEN trim(regexp_replace(m, '\\s+(4g|5g)$', '')) ELSE m END) AS m FROM h "
            f"LEFT JOIN models x ON x.device_brand = brand AND x.raw_model = m AND brand IN ({DICTIONARY_LAST})), "
            f"cleaned AS (SELECT tac, brand AS device_brand, CASE WHEN {JUNK} THEN 'unknown' ELSE m END AS device_model FROM i), "
            "named AS (SELECT *, trim(regexp_replace(device_brand || ' ' || device_model, '\\s+', ' ', 'g')) AS device_name FROM cleaned)")


CLEAN = clean_sql()


def cleaned(f):
    return dn.clean_devices(f.tac_raw(), models=models(f))


@query("DC1_canonical_brand", f"WITH {CLEAN} SELECT tac, device_brand, count(*) AS n FROM named GROUP BY 1, 2", "tac_raw", texts="device_brand")
def brands(f):
    return dn.canonical_brands(f.tac_raw()).groupBy("tac", "device_brand").agg(F.count(F.lit(1)).alias("n"))


@query("DC1_own_brand_aliases", f"WITH {CLEAN} SELECT CASE WHEN raw <> 'none' AND length(raw) % 2 = 0 THEN 'own ' || raw ELSE brand END AS device_brand, count(*) AS n FROM b GROUP BY 1", "tac_raw", texts="device_brand")
def own_brands(f):
    """An alias table of the caller's own for about half of all brands; the others keep their canonical names."""
    raw = f.tac_raw()
    name = F.lower(F.trim("device_brand"))
    aliases = raw.filter(F.length(name) % 2 == 0).select(name.alias("alias"), F.concat(F.lit("own "), name).alias("brand")).distinct()
    return dn.canonical_brands(raw, aliases).groupBy("device_brand").agg(F.count(F.lit(1)).alias("n"))


DETAIL = "device_brand|device_model|device_name"


@query("DC2_DC3_model_start", f"WITH {CLEAN} SELECT tac, brand AS device_brand, m AS device_model FROM d", "tac_raw", texts=DETAIL)
def model_start(f):
    rows = dn.canonical_brands(f.tac_raw())
    start = dn.sub_brand_model(F.col("device_brand"), F.col("__raw_brand"), F.coalesce(F.lower(F.trim("device_model")), F.lit("")))
    started = rows.withColumn("device_model", start)
    return started.select("tac", "device_brand", dn.without_brand(F.col("device_brand"), F.col("device_model")).alias("device_model"))


@query("DC4_punctuation", f"WITH {CLEAN} SELECT tac, brand AS device_brand, m AS device_model FROM e", "tac_raw", texts=DETAIL)
def punctuation(f):
    return model_start(f).withColumn("device_model", dn.apply_rules(F.col("device_model"), dn.PUNCTUATION))


@query("DC5_brand_rules", f"WITH {CLEAN} SELECT tac, brand AS device_brand, m AS device_model FROM h", "tac_raw", texts=DETAIL)
def brand_rules(f):
    return punctuation(f).withColumn("device_model", dn.ruled_model(F.col("device_brand"), F.col("device_model")))


@query("DC6_DC7_clean_devices", f"WITH {CLEAN} SELECT * FROM named", "tac_raw", texts=DETAIL)
def clean(f):
    return cleaned(f)


@query("DC7_name_without_network", f"WITH {CLEAN} SELECT tac, trim(regexp_replace(regexp_replace(device_name, '(?i)\\b[345]g\\b', '', 'g'), '\\s+', ' ', 'g')) AS device_name FROM named", "tac_raw", texts=DETAIL)
def network(f):
    return cleaned(f).select("tac", dn.name_without_network(F.col("device_name")).alias("device_name"))


#: The kind of each shape of name in the test table: its words in order of precedence, written by hand.
KIND_WORDS = {
    "Tablet/Laptop": "tab|ipad|pad|chromebook", "IoT/Module/Industrial": "module|quectel", "Wearable": "watch|fossil", "Feature Phone": "flip|classic|3100",
    "Smartphone": "iphone|galaxy|pixel|redmi|oppo|vivo|huawei|oneplus|moto|lg|note|poco|blade|mate|honor|realme|fold|lumia|ultra|max|mi|zte|motorola|samsung|google|xiaomi|nokia|cubot"}


def any_sql(column: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({column}, {text(w)})" for w in words) + ")"


def category_sql() -> str:
    b, m, t = "device_brand", "device_model", "(device_brand || ' ' || device_model)"
    kinds = " ".join(f"WHEN regexp_matches({t}, '\\b(?:{words})\\b') THEN {text(n)}" for n, words in KIND_WORDS.items())
    return (f"CASE WHEN {b} = '' OR {m} = '' OR {m} = 'unknown' OR {b} = 'unknown' THEN 'Other/Check_Manually' WHEN {b} = 'amazon' THEN CASE WHEN contains({m}, 'phone') THEN 'Smartphone' ELSE 'Tablet/Laptop' END "
            f"{kinds} WHEN regexp_matches({m}, '\\d{{6,}}') THEN 'IoT/Module/Industrial' ELSE 'Other/Check_Manually' END")


@query("DC8_device_category", f"WITH {CLEAN} SELECT tac, device_name, {category_sql()} AS category FROM named", "tac_raw", texts="device_name|category")
def category(f):
    return cleaned(f).select("tac", "device_name", dn.device_category(F.col("device_brand"), F.col("device_model")).alias("category"))


def system_sql(k: str) -> str:
    b, m, t = "device_brand", "device_model", "(device_brand || ' ' || device_model)"
    android = ("'samsung', 'xiaomi', 'oppo', 'vivo', 'realme', 'oneplus', 'motorola', 'huawei', 'honor', 'lg', 'zte', 'nokia', 'google', 'cubot'")
    return (f"CASE WHEN {b} = '' OR {m} = '' OR {m} = 'unknown' THEN 'Unknown' "
            f"WHEN {any_sql(t, 'apple', 'iphone', 'ipad')} THEN CASE WHEN {k} = 'Tablet/Laptop' OR contains({t}, 'ipad') THEN 'iPadOS' WHEN {k} = 'Wearable' OR contains({t}, 'watch') THEN 'watchOS' ELSE 'iOS' END "
            f"WHEN contains({t}, 'lumia') THEN 'Windows Phone / Windows Mobile' WHEN {b} = 'amazon' THEN 'KindleOS' WHEN {k} = 'Tablet/Laptop' AND contains({t}, 'chromebook') THEN 'ChromeOS' "
            f"WHEN {k} = 'Wearable' OR contains({t}, 'watch') THEN CASE WHEN contains({t}, 'galaxy watch') THEN 'WearOS (Android)' ELSE 'Proprietary Wearable OS' END "
            f"WHEN {k} = 'Feature Phone' THEN 'Proprietary (Feature Phone)' WHEN {k} = 'IoT/Module/Industrial' THEN 'Proprietary / Embedded OS' "
            f"WHEN {k} IN ('Smartphone', 'Tablet/Laptop') OR {b} IN ({android}) THEN 'Android' ELSE 'Unknown/Proprietary' END")


@query("DC9_operating_system", f"WITH {CLEAN}, k AS (SELECT *, {category_sql()} AS kind FROM named) SELECT tac, device_name, {system_sql('kind')} AS os, {system_sql(chr(39) * 2)} AS os_without_category FROM k",
       "tac_raw", texts="device_name|os.*")
def system(f):
    brand, model = F.col("device_brand"), F.col("device_model")
    rows = cleaned(f).withColumn("kind", dn.device_category(brand, model))
    return rows.select("tac", "device_name", dn.operating_system(brand, model, F.col("kind")).alias("os"), dn.operating_system(brand, model).alias("os_without_category"))


# many names per code, so that prefixes and siblings occur: the code is the brand's first letter and a size class
GROUPED = f"{CLEAN}, g2 AS (SELECT DISTINCT ascii(device_brand) * 10 + tac % 5 AS code, device_name FROM named), w AS (SELECT *, string_split(device_name, ' ') AS ws FROM g2)"
OVERLAP = ("EXISTS (SELECT 1 FROM w o WHERE o.code = w.code AND o.device_name <> w.device_name AND ((len(o.ws) > len(w.ws) AND o.ws[1:len(w.ws)] = w.ws) OR "
           "(len(o.ws) = len(w.ws) AND len(w.ws) > 1 AND o.ws[1:len(w.ws) - 1] = w.ws[1:len(w.ws) - 1] AND length(o.device_name) >= length(w.device_name))))")


def grouped(f):
    return cleaned(f).select((F.ascii("device_brand") * 10 + F.col("tac") % 5).alias("code"), "device_name").distinct()


@query("DC10_near_duplicates", f"WITH {GROUPED} SELECT code, device_name FROM w WHERE NOT {OVERLAP}", "tac_raw", texts="device_name")
def near_duplicates(f):
    return dn.without_near_duplicates(grouped(f), "code")


@query("Q9_duplicate_rows", f"WITH {CLEAN}, n AS (SELECT tac, count(*) AS key_count FROM (SELECT DISTINCT tac, device_brand, device_model FROM named) GROUP BY 1 HAVING count(*) > 1) SELECT named.*, key_count FROM named JOIN n USING (tac)",
       "tac_raw", texts=DETAIL)
def duplicates(f):
    return duplicate_rows(cleaned(f), "tac", ["device_brand", "device_model"])


J20 = (f"WITH {GROUPED}, before AS (SELECT DISTINCT device_name FROM w), after AS (SELECT DISTINCT device_name FROM w WHERE NOT {OVERLAP} UNION SELECT device_model FROM models) "
       "SELECT device_name, 'lost' AS change FROM before WHERE device_name NOT IN (SELECT device_name FROM after) UNION ALL SELECT device_name, 'added' FROM after WHERE device_name NOT IN (SELECT device_name FROM before)")


@query("J20_key_changes", J20, "tac_raw", texts="device_name|change", whole=False)
def changes(f):
    """Names that the near-duplicate step removes everywhere, and names that only the model dictionary has."""
    before = cut_lineage(grouped(f))
    after = dn.without_near_duplicates(before, "code").select("device_name").unionByName(models(f).select(F.col("device_model").alias("device_name")))
    return key_changes(before, after, "device_name")


# registry

TOKENS = " ".join(f"WHEN {text(k)} THEN [{', '.join(text(v) for v in values)}]" for k, values in assignments.FAMILY_TOKENS.items())


def family_sql() -> str:
    def tokens(x: str) -> str:
        return f"CASE {x} {TOKENS} ELSE [{x}] END"

    return ("parts AS (SELECT *, regexp_extract(client_model_code, '^([a-z]+)_', 1) AS op, regexp_extract(client_model_code, '_\\[([^\\[]*)\\]$', 1) AS inr FROM assignments), "
            "split AS (SELECT *, regexp_extract(inr, '^(.*)_([^_]*)$', 1) AS head, regexp_extract(inr, '^(.*)_([^_]*)$', 2) AS ver FROM parts), "
            "split2 AS (SELECT *, regexp_extract(head, '^(.*)_([^_]*)$', 1) AS cp, regexp_extract(head, '^(.*)_([^_]*)$', 2) AS fs FROM split), "
            f"cand AS (SELECT *, CASE WHEN NOT contains(inr, '_') THEN [client_model_code] ELSE list_concat([client_model_code], CASE WHEN fs <> '' THEN list_transform({tokens('fs')}, lambda t: op || '_' || cp || '__' || t || '__' || ver) ELSE [] END, "
            f"list_transform({tokens('head')}, lambda t: op || '__' || t || '__' || ver)) END AS codes FROM split2), "
            "ranked AS (SELECT assignment_id, unnest(codes) AS base_code, generate_subscripts(codes, 1) AS pos FROM cand), "
            "best AS (SELECT assignment_id, min_by(base_code, pos) AS base_code, min_by(c.model_family, pos) AS model_family FROM ranked r JOIN catalog c ON c.client_model_code = r.base_code GROUP BY 1), "
            "resolved AS (SELECT a.*, base_code, coalesce(model_family, '') AS model_family FROM assignments a LEFT JOIN best USING (assignment_id))")


RG_TEXTS = "telco|client|client_product|client_model_code|target_score_table|date_start|date_end|base_code|model_family"
ACTIVE_TEST = f"client_model_code NOT IN ('', '-') AND date_start <= {SNAP} AND (date_end IS NULL OR date_end >= {SNAP})"


@query("RG1_active_assignments", f"SELECT * FROM assignments WHERE {ACTIVE_TEST} AND telco = 'opa'", "assignments", texts=RG_TEXTS)
def active(f):
    return assignments.active(f.assignments(), ORDERS_SNAPSHOT, telco=" OPA ")


@query("RG2_model_family", f"WITH {family_sql()} SELECT * FROM resolved", "assignments catalog", texts=RG_TEXTS)
def family(f):
    return assignments.with_family(f.assignments(), f.catalog(), ["assignment_id"])


@query("RG3_summary", f"WITH {family_sql()} SELECT {', '.join(assignments.SUMMARY)}, count(*) AS n FROM resolved WHERE {ACTIVE_TEST} GROUP BY ALL", "assignments catalog", texts=RG_TEXTS)
def summary(f):
    rows = assignments.active(assignments.with_family(f.assignments(), f.catalog(), ["assignment_id"]), ORDERS_SNAPSHOT)
    own = assignments.summary(rows)
    return own.groupBy(*own.columns).agg(F.count(F.lit(1)).alias("n"))


@query("RG3_per_operator", f"SELECT telco, count(*) AS assignments, count(DISTINCT client) AS clients FROM assignments WHERE {ACTIVE_TEST} GROUP BY 1", "assignments", texts="telco")
def per_operator(f):
    return assignments.per_operator(assignments.active(f.assignments(), ORDERS_SNAPSHOT))
