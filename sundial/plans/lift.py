"""Does a candidate feature improve a model? Data preparation, exact metrics, decision; `evaluation` fits the models."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, day, month_label
from sundial.operators.columns import fill_missing
from sundial.operators.ordering import top_n
from sundial.operators.ranges import running_totals
from sundial.operators.sampling import PRIME as DRAWS
from sundial.operators.sampling import capped, draw_of, fraction_of, row_draw
from sundial.session import cut_lineage

NOISE = "__noise__"


# Data

def joined_features(base: DataFrame, new: DataFrame, keys: list[str], target: str, removed: tuple[str, ...] = (),
                    row_filter: str | None = None, to_double: tuple[str, ...] = ()) -> DataFrame:
    """Base rows with the candidate features beside them; decimals and chosen columns as doubles."""
    rows = base.filter(row_filter) if row_filter else base
    rows = rows.select(*[c for c in rows.columns if c not in removed])
    extra = [c for c in new.columns if c not in removed and c not in rows.columns and c != target]
    joined = rows.join(new.select(*keys, *extra), keys, "left")
    return joined.select([
        F.col(c).try_cast("double").alias(c) if kind.startswith("decimal") or any(p in c for p in to_double) else F.col(c)
        for c, kind in joined.dtypes])


def sampled_rows(df: DataFrame, keys: list[str], seed: int, fraction: float | None = None, rows: int | None = None,
                 row_filter: str | None = None) -> DataFrame:
    """Rows of one experiment: an optional filter, then a row cap or a fraction.

    Both follow a draw from the key, so a repeated task draws the same rows again. The cap is exact: a filter on the draw below
    which so many rows lie.
    """
    chosen = df.filter(row_filter) if row_filter else df
    if rows is not None:
        return capped(chosen, keys, seed, rows)
    return chosen if fraction is None else fraction_of(chosen, keys, seed, fraction)


def prepared_rows(df: DataFrame, keys: list[str], target: str, date: str = "disburse_date") -> DataFrame:
    """Missing numbers as -1 and texts as '', one row per key (the smallest), month label added."""
    filled = fill_missing(df, -1.0, "", keys=[*keys, target])
    rest = [c for c in filled.columns if c not in keys]
    unique = filled.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")
    return unique.withColumn("disburse_month", month_label(F.col(date)))


def time_split(df: DataFrame, split: DateLike, date: str = "disburse_date") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(date) < day(split)), df.filter(F.col(date) >= day(split))


def feature_samples(features: list[str], size: int, experiments: int, seed: int = 42) -> list[list[str]]:
    """The base features of every experiment: those whose places in the list have the smallest draws, in the order of the list."""
    order = [sorted(range(len(features)), key=lambda i: (draw_of([e, i], seed), i)) for e in range(experiments)]
    return [[features[i] for i in sorted(places[:size])] for places in order]


def with_noise(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """A uniform noise column from the draw of the key, the same on every evaluation."""
    return df.withColumn(NOISE, row_draw(df, keys, seed) / F.lit(float(DRAWS)))


# Metrics

GROUP = ["feature", "experiment_id"]


def auc(predictions: DataFrame) -> DataFrame:
    """Exact area under the ROC curve per experiment, ties counting half.

    Rows collapse to (experiment, model, score) first. What lies below a score is a prefix sum
    that never needs a whole experiment in one task.
    """
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("score")) for m in ("base", "new")])
    long = predictions.select(*GROUP, "y_true", F.inline(models))
    keys = [*GROUP, "model"]
    scores = long.groupBy(*keys, "score").agg(F.sum("y_true").cast("long").alias("pos"), F.sum(1 - F.col("y_true")).cast("long").alias("neg"))
    below = running_totals(scores, keys, "score", {"neg": "__below"})
    areas = below.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("__below") * 2 + F.col("neg"))).alias("__u2"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    value = F.try_divide(F.col("__u2").cast("double"), F.col("__p").cast("double") * F.col("__n") * 2.0)
    result = areas.groupBy(*GROUP).agg(*[F.max(F.when(F.col("model") == m, value)).alias(f"auc_{m}") for m in ("base", "new")])
    return result.withColumn("gap", F.col("auc_new") - F.col("auc_base"))


def gap_metrics(results: DataFrame) -> DataFrame:
    """Mean, population deviation, median, win and loss rate, effect size per feature."""
    rows = results.groupBy("feature").agg(
        F.avg("gap").alias("mean_gap"), F.stddev_pop("gap").alias("std_gap"), F.percentile("gap", 0.5).alias("median_gap"),
        F.avg((F.col("gap") > 0).cast("int")).alias("win_rate"), F.avg((F.col("gap") < 0).cast("int")).alias("loss_rate"),
        F.count(F.lit(1)).alias("n_experiments"))
    return rows.withColumn("effect_size", F.when(F.col("std_gap") > 0, F.try_divide("mean_gap", "std_gap")))


def dominance(results: DataFrame) -> DataFrame:
    """Share of (new, base) pairs with the larger new area, counted by rank instead of by pair."""
    sides = F.array(F.struct(F.lit(0).alias("is_base"), F.col("auc_new").alias("area")), F.struct(F.lit(1).alias("is_base"), F.col("auc_base").alias("area")))
    long = results.select("feature", F.inline(sides)).groupBy("feature", "area").agg(
        F.sum("is_base").alias("bases"), F.sum(1 - F.col("is_base")).alias("news"))
    below = running_totals(long, ["feature"], "area", {"bases": "__below"})
    return below.groupBy("feature").agg(F.try_divide(
        F.sum(F.col("news") * F.col("__below")).cast("double"), F.sum("news").cast("double") * F.sum("bases")).alias("dominance"))


# Fixed values of the resampling stream: modulus and multipliers.
PRIME, STREAM = 2_147_483_647, (2_654_435, 40_503, 97, 48_271, 12_345, 69_621)


def draw(resample: Column, position: Column, seed: int, n: Column) -> Column:
    """A reproducible draw from 0 .. n-1 for one position of one resample."""
    a, b, c, d, e, f = (F.lit(x).cast("long") for x in STREAM)
    p = F.lit(PRIME).cast("long")
    x = (resample * a + position * b + F.lit(seed) * c) % p
    x = ((x * x) % p * d + e) % p
    return (((x * x) % p) * f % p) % n


def bootstrap_interval(results: DataFrame, resamples: int = 10_000, level: float = 0.95, seed: int = 42, block: int = 250) -> DataFrame:
    """Percentile interval of the mean gap under resampling of experiments.

    A feature has as many gaps as experiments were run, a configured number. Its resamples are cut into blocks, one row each, so
    they spread over tasks; the quantiles are exact.
    """
    gaps = results.groupBy("feature").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("experiment_id", "gap"))), lambda s: s["gap"]).alias("gaps"))
    n = F.size("gaps").cast("long")
    positions = F.transform(F.sequence(F.lit(1), F.size("gaps")), lambda i: i.cast("long"))

    def mean_of(resample: Column) -> Column:
        total = F.aggregate(positions, F.lit(0.0), lambda acc, i: acc + F.element_at("gaps", (draw(resample.cast("long"), i, seed, n) + 1).cast("int")))
        return total / n

    # by a hash of the block: a task has some blocks of each feature
    blocks = gaps.withColumn("first", F.explode(F.sequence(F.lit(1), F.lit(resamples), F.lit(block)))).repartition("feature", "first")
    own = F.sequence(F.col("first"), F.least(F.col("first") + (block - 1), F.lit(resamples)))
    means = blocks.select("feature", F.explode(F.transform(own, mean_of)).alias("mean"))
    tail = (1 - level) / 2
    ends = means.groupBy("feature").agg(F.percentile("mean", [tail, 1 - tail]).alias("ends"))
    return ends.select("feature", F.col("ends")[0].alias("ci_lo"), F.col("ends")[1].alias("ci_hi"))


def paired_statistics(results: DataFrame) -> DataFrame:
    """Paired t statistic and signed-rank sums per feature."""
    gap = F.col("gap")
    t = results.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.try_divide(F.avg(gap), F.stddev(gap) / F.sqrt(F.count(gap).cast("double"))).alias("t"))
    size = F.abs(gap)
    nonzero = results.filter("gap <> 0")
    tied = Window.partitionBy("feature", size)
    ranked = nonzero.withColumns({
        "__ties": F.count(F.lit(1)).over(tied), "__rank": F.rank().over(Window.partitionBy("feature").orderBy(size))})
    rank = F.col("__rank") + (F.col("__ties") - 1) / 2.0
    ties = F.col("__ties")
    sums = ranked.groupBy("feature").agg(
        F.sum(F.when(gap > 0, rank).otherwise(0.0)).alias("w_plus"), F.sum(F.when(gap < 0, rank).otherwise(0.0)).alias("w_minus"),
        F.count(F.lit(1)).alias("n_nonzero"), F.sum((ties * ties - 1).cast("double")).alias("tie_term"),
        F.sort_array(F.collect_list((rank * 2).cast("int"))).alias("doubled_ranks"))
    return t.join(sums, "feature", "left")


def simpson(height, low: Column, high: Column, steps: int = 1_000) -> Column:
    """Numerical integral of a column function, evaluated inside the row."""
    width = (high - low) / float(steps)

    def weighted(total: Column, i: Column) -> Column:
        weight = F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return total + weight * height(low + width * i)

    return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), weighted) * width / 3.0


def t_p_value(t: Column, freedom: Column) -> Column:
    """Two-sided p-value of Student's t.

    With t = tan(u) * sqrt(freedom) the density is proportional to cos(u) ^ (freedom - 1), bounded
    on [0, pi / 2], so the tail is a ratio of two integrals and needs no gamma function.
    """
    end = F.lit(math.pi / 2)
    start = F.atan(F.abs(t) / F.sqrt(freedom.cast("double")))

    def density(u: Column) -> Column:
        return F.pow(F.greatest(F.cos(u), F.lit(0.0)), freedom - 1)

    return F.when(t.isNotNull() & (freedom >= 1), F.try_divide(simpson(density, start, end), simpson(density, F.lit(0.0), end)))


def sign_p_value(doubled_ranks: Column, smaller: Column) -> Column:
    """Exact two-sided p-value of the signed-rank statistic, with or without ties.

    With every rank doubled all sums are whole, so the chance of each sum over all sign patterns follows rank by rank: half of what
    it was, half of what it was one rank lower. Zeros have no rank. The work grows with the ranks' number times their sum; a
    feature has as many ranks as experiments were run.
    """
    total = F.aggregate(doubled_ranks, F.lit(0), lambda a, r: a + r)
    start = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), total))

    def with_rank(chances: Column, rank: Column) -> Column:
        raised = F.concat(F.array_repeat(F.lit(0.0), rank), F.slice(chances, F.lit(1), F.size(chances) - rank))
        return F.zip_with(chances, raised, lambda a, b: (a + b) / 2)

    chances = F.aggregate(doubled_ranks, start, with_rank)
    below = F.aggregate(F.slice(chances, F.lit(1), (smaller * 2).cast("int") + 1), F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(doubled_ranks) > 0, F.least(F.lit(1.0), below * 2.0))


def normal_p_value(smaller: Column, nonzero: Column, tie_term: Column) -> Column:
    """The normal approximation of the same, corrected for ties."""
    spread = F.sqrt((nonzero * (nonzero + 1) * (nonzero * 2 + 1) - tie_term / 2.0) / 24.0)
    z = F.abs(F.try_divide(smaller - nonzero * (nonzero + 1) / 4.0, spread))
    return F.when(nonzero > 0, F.least(F.lit(1.0), simpson(lambda x: F.exp(-x * x / 2.0), z, z + 12.0) * (2.0 / math.sqrt(2 * math.pi))))


def p_values(results: DataFrame, method: str = "exact") -> DataFrame:
    """Paired t and signed-rank p-values, one row per feature; null when all gaps are equal.

    `method` of the rank test: "exact" (`sign_p_value`) or "normal" (`normal_p_value`), whatever the number of pairs.
    """
    if method not in ("exact", "normal"):
        raise ValueError(f"unknown method: {method}")
    rows = paired_statistics(results)
    c, smaller = F.col, F.least("w_plus", "w_minus")
    ranked = sign_p_value(c("doubled_ranks"), smaller) if method == "exact" else normal_p_value(smaller, c("n_nonzero"), c("tie_term"))
    return rows.select("feature", t_p_value(c("t"), c("n") - 1).alias("p_value_ttest"), F.when(c("t").isNotNull(), ranked).alias("p_value_wilcoxon"))


def experiment_metrics(results: DataFrame, resamples: int = 10_000) -> DataFrame:
    """All metrics of every feature; the results have one row per feature and experiment."""
    results = cut_lineage(results)
    frames = [dominance(results), bootstrap_interval(results, resamples), p_values(results)]
    metrics = gap_metrics(results)
    for frame in frames:
        metrics = metrics.join(frame, "feature", "left")
    return metrics


# Decision

Table = tuple[tuple[float, ...], tuple[float, ...]]


@dataclass(frozen=True)
class Profile:
    """Gates, point tables and decision limits. Fixed values of the current profile."""

    gates: dict = field(default_factory=lambda: {"stability": 0.15, "win_rate": 0.50, "dominance": 0.47})
    tables: dict = field(default_factory=lambda: {
        "stability": ((3, 2, 1, 0.5, 0), (45, 38, 30, 20, 10)),
        "win_rate": ((0.9, 0.8, 0.7, 0.6, 0.55, 0.50, 0), (30, 26, 22, 16, 12, 8, 0)),
        "dominance": ((0.9, 0.8, 0.7, 0.6, 0.55, 0.50, 0.45, 0), (20, 17, 14, 10, 7, 4, 2, 0))})
    p_table: Table | None = ((-1e-6, -1e-5, -1e-4, -1e-3, -0.01, -0.05, 0), (5, 4, 3, 2, 1, 0, 0))
    # The limits of the p table are negative. Off: -p is compared, as they imply. On: p itself, so
    # that every feature gets the top points.
    literal_p: bool = False
    limits: tuple[float, ...] = (50, 65, 85)
    labels: tuple[str, ...] = ("reject", "weak_accept", "accept", "strong_accept")
    needs_positive_interval: bool = False


# Fixed values of the earlier profile.
EARLIER = Profile(
    gates={"stability": 0.15, "win_rate": 0.50},
    tables={"stability": ((3, 2, 1, 0.5, 0), (35, 30, 24, 16, 8)),
            "win_rate": ((0.9, 0.8, 0.7, 0.6, 0.55, 0.50, 0), (25, 22, 18, 14, 10, 6, 0)),
            "ci_lo": ((0.5, 0.3, 0.1, 0), (20, 15, 8, 0)), "median_gap": ((0.5, 0.3, 0.1, 0), (10, 7, 4, 0))},
    p_table=None, limits=(35, 55, 75), needs_positive_interval=True)


def points(value: Column, table: Table) -> Column:
    """Points of the first limit the value reaches; the last ones if it reaches none."""
    limits, scores = table
    result = F.lit(float(scores[-1]))
    for limit, score in reversed(list(zip(limits, scores))):
        result = F.when(value >= limit, float(score)).otherwise(result)
    return result


def decide(metrics: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """Gate, score and label every feature."""
    stability = F.least(F.try_divide(F.col("mean_gap"), F.greatest("std_gap", F.lit(1e-8))), F.lit(1000.0))
    rows = metrics.withColumn("stability", stability)
    reasons = F.when(F.col("mean_gap") <= 0, "negative uplift")
    for name, reason in (("stability", "unstable feature"), ("win_rate", "low consistency"), ("dominance", "weak dominance")):
        if name in profile.gates:
            reasons = reasons.when(F.col(name) < profile.gates[name], reason)
    if profile.needs_positive_interval:
        reasons = reasons.when(F.col("ci_lo") <= 0, "ci crosses zero")
    total = sum((points(F.col(name), table) for name, table in profile.tables.items()), F.lit(0.0))
    best_p = F.least("p_value_ttest", "p_value_wilcoxon")
    if profile.p_table:
        total = total + points(best_p if profile.literal_p else -best_p, profile.p_table)
    scored = rows.withColumns({"reason": reasons, "score": F.round(total, 2), "best_pvalue": best_p})
    reached = sum((F.when(F.col("score") >= limit, 1).otherwise(0) for limit in profile.limits), F.lit(0))
    label = F.element_at(F.array(*[F.lit(x) for x in profile.labels]), reached + 1)
    passed = F.col("reason").isNull()
    decided = scored.withColumns({"decision": F.when(passed, label).otherwise(profile.labels[0]), "score": F.when(passed, F.col("score"))})
    if profile.needs_positive_interval:
        decided = decided.withColumn("reason", F.when(passed & (F.col("decision") == profile.labels[0]), "low score").otherwise(F.col("reason")))
    return decided


def not_evaluated(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidate features without stored results."""
    return candidates.join(stored.select("feature").distinct(), "feature", "left_anti")


def compare_features(predictions: DataFrame, stored_results: DataFrame | None = None, profile: Profile = Profile(),
                     resamples: int = 10_000) -> DataFrame:
    """Evaluate all candidates at once; results of earlier runs are reused, not computed again."""
    if stored_results is not None:
        predictions = not_evaluated(predictions, stored_results)
    results = auc(predictions)
    if stored_results is not None:
        results = results.unionByName(stored_results.select(*results.columns))
    return decide(experiment_metrics(results, resamples), profile)


# Importance

def importance_summary(rows: DataFrame) -> DataFrame:
    """Mean, deviation and rank of absolute importance over experiments, per model."""
    size = F.abs(F.col("importance"))
    means = rows.groupBy("model", "feature").agg(F.avg(size).alias("mean_abs"), F.coalesce(F.stddev(size), F.lit(0.0)).alias("std_abs"))
    order = Window.partitionBy("model").orderBy(F.col("mean_abs").desc(), "feature")
    return means.withColumn("rank", F.row_number().over(order))


def importance_change(summary: DataFrame) -> DataFrame:
    """New minus baseline importance for features both models use."""
    sides = summary.groupBy("feature").agg(*[F.max(F.when(F.col("model") == m, F.col("mean_abs"))).alias(f"{m}_mean_abs") for m in ("baseline", "new")])
    return sides.filter("baseline_mean_abs IS NOT NULL AND new_mean_abs IS NOT NULL").withColumn("delta", F.col("new_mean_abs") - F.col("baseline_mean_abs"))


def best_accepted(decisions: DataFrame, n: int) -> DataFrame:
    """The n best-scored features that were not rejected."""
    return top_n(decisions.filter("decision <> 'reject'"), [F.col("score").desc(), F.col("feature")], n)
