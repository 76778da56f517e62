"""Registry of which client uses which model, with validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike
from sundial.operators.joins import first_candidate, valid_at

# Family token in an assignment code and the catalog tokens it may stand for.
FAMILY_TOKENS = {
    "cs": ["cs_generic", "cs_bnpl", "cs"], "bnpl": ["cs_bnpl"], "lead": ["leadgen"], "leadgen": ["leadgen"],
    "is": ["is_numeric", "is_range", "is"], "is_generic": ["is_numeric", "is_range", "is_generic"],
    "is_numeric": ["is_numeric"], "numeric": ["is_numeric"]}
SUMMARY = ["telco", "client", "client_product", "client_model_code", "target_score_table", "model_family"]


def _tokens(token: Column) -> Column:
    table = F.create_map(*[x for k, v in FAMILY_TOKENS.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    return F.coalesce(F.try_element_at(table, token), F.array(token))


def base_codes(code: Column) -> Column:
    """Catalog codes an assignment code may stand for, best first.

    A code is first read as it is. A bracketed code `<operator>_..._[<client>_<family>_<version>]`
    may also name the client's own model or the operator's general one.
    """
    operator = F.regexp_extract(code, "^([a-z]+)_", 1)
    inner = F.regexp_extract(code, r"_\[([^\[]*)\]$", 1)
    head, version = F.regexp_extract(inner, "^(.*)_([^_]*)$", 1), F.regexp_extract(inner, "^(.*)_([^_]*)$", 2)
    client, family = F.regexp_extract(head, "^(.*)_([^_]*)$", 1), F.regexp_extract(head, "^(.*)_([^_]*)$", 2)
    own = F.transform(_tokens(family), lambda t: F.concat_ws("__", F.concat(operator, F.lit("_"), client), t, version))
    general = F.transform(_tokens(head), lambda t: F.concat_ws("__", operator, t, version))
    derived = F.when(family != "", F.concat(own, general)).otherwise(general)
    return F.when(inner.contains("_"), F.concat(F.array(code), derived)).otherwise(F.array(code))


def with_family(assignments: DataFrame, catalog: DataFrame, row_id: list[str]) -> DataFrame:
    """Adds the catalog code and model family; an unknown code has an empty family."""
    candidates = assignments.withColumn("__codes", base_codes(F.col("client_model_code")))
    found = first_candidate(candidates, "__codes", catalog.withColumnRenamed("client_model_code", "base_code"), "base_code", "model_family", row_id)
    return found.drop("__codes").fillna("", subset=["model_family"])


def active(assignments: DataFrame, date: DateLike | None = None, telco: str | None = None, client: str | None = None,
           code: str | None = None) -> DataFrame:
    """Assignments of an operator or client that hold at the day (any day when none is given)."""
    df = assignments.filter(~F.col("client_model_code").isin("", "-"))
    for column, value in (("telco", telco), ("client", client)):
        if value:
            df = df.filter(F.upper(F.trim(column)) == value.strip().upper())
    if code:
        df = df.filter(F.col("client_model_code") == code)
    return df if date is None else valid_at(df, date)


def summary(assignments: DataFrame) -> DataFrame:
    return assignments.select(*[c for c in SUMMARY if c in assignments.columns])


def per_operator(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("telco").agg(F.count(F.lit(1)).alias("assignments"), F.count_distinct("client").alias("clients"))
