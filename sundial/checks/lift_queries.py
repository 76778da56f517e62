"""Feature-lift evaluation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sundial.checks.fixtures import COSTS
from sundial.checks.registry import query
from sundial.checks.source_queries import scratch
from sundial.operators import ranges, sampling
from sundial.plans import evaluation, lift

KEYS = ["phone_number", "disburse_date"]
SPLIT = dt.date(2000, 1, 1)


def base_table(f):
    """One row per label key with a few base features."""
    label = f.label().groupBy(*KEYS).agg(F.max("label_value").alias("label_value"), F.min("product").alias("product"))
    customers = f.customer.selectExpr("c_custkey AS phone_number", "c_acctbal", "c_nationkey", "CAST(c_acctbal AS DECIMAL(10,2)) AS c_exact", "c_mktsegment AS segment")
    return label.join(customers, "phone_number", "left")


def new_table(f):
    return f.orders.groupBy(F.col("o_custkey").alias("phone_number"), F.to_date("o_orderdate").alias("disburse_date")).agg(
        F.max("o_totalprice").alias("new_price"), F.max(F.col("o_orderkey").cast("string")).alias("sms_key")).filter("new_price > 60000")


BASE = ("base AS (SELECT phone_number, disburse_date, max(label_value) AS label_value, min(product) AS product FROM label GROUP BY 1, 2), "
        "fresh AS (SELECT o_custkey AS phone_number, CAST(o_orderdate AS DATE) AS disburse_date, max(o_totalprice) AS new_price, max(o_orderkey::VARCHAR) AS sms_key FROM orders GROUP BY 1, 2 HAVING max(o_totalprice) > 60000), "
        "joined AS (SELECT b.phone_number, b.disburse_date, label_value, product, c_acctbal, c_acctbal AS c_exact, c_mktsegment AS segment, new_price, TRY_CAST(sms_key AS DOUBLE) AS sms_key "
        "FROM base b LEFT JOIN customer ON c_custkey = b.phone_number LEFT JOIN fresh n USING (phone_number, disburse_date) WHERE product <> '5-LOW')")


def joined(f):
    return lift.joined_features(base_table(f), new_table(f), KEYS, "label_value", removed=("c_nationkey",), row_filter="product <> '5-LOW'", to_double=("sms",))


@query("EV1_joined_features", f"WITH {BASE} SELECT * FROM joined", "label", "c_acctbal|c_exact|new_price|sms_key", "disburse_date|product|segment", digits=2)
def ev1(f):
    return joined(f)


def row_draw_sql(seed: int) -> str:
    """The draw of KEYS: one step per key part and a last one."""
    x = str(seed)
    for part in ("phone_number", "(disburse_date - DATE '1970-01-01')", "0"):
        y = f"(({x} * {sampling.MIX} + {part}) % {sampling.PRIME})"
        x = f"(({y} * {y} % {sampling.PRIME} * {sampling.LIFT} + {sampling.SHIFT}) % {sampling.PRIME})"
    return x


JOINED = ("label", "c_acctbal|c_exact|new_price|sms_key", "disburse_date|product|segment")


@query("EV2_sampled_fraction", f"WITH {BASE} SELECT * FROM joined WHERE {row_draw_sql(42)} < {int(0.3 * sampling.PRIME)}", *JOINED, digits=2)
def ev2(f):
    return lift.sampled_rows(joined(f), KEYS, 42, fraction=0.3)


@query("EV2_sampled_rows", f"WITH {BASE} SELECT * FROM joined WHERE label_value = 1 QUALIFY row_number() OVER (ORDER BY {row_draw_sql(43)}, phone_number, disburse_date) <= 500", *JOINED, digits=2)
def ev2b(f):
    return lift.sampled_rows(joined(f), KEYS, 43, rows=500, row_filter="label_value = 1")


# strategy: filter (a filter and a cap, own seed), random (a share, own seed), fixed (a share of all, then a cap)
STRATEGIES = {
    "filter": (dict(rows=300, filters=["label_value = 0", "c_acctbal > 1000"]), f"SELECT 1 AS experiment_id, * FROM joined WHERE c_acctbal > 1000 QUALIFY row_number() OVER (ORDER BY {row_draw_sql(43)}, phone_number, disburse_date) <= 300"),
    "random": (dict(fraction=0.2), f"SELECT 1 AS experiment_id, * FROM joined WHERE {row_draw_sql(43)} < {int(0.2 * sampling.PRIME)}"),
    "fixed": (dict(fraction=0.5, rows=400), f"SELECT 1 AS experiment_id, * FROM joined WHERE {row_draw_sql(42)} < {int(0.5 * sampling.PRIME)} QUALIFY row_number() OVER (ORDER BY {row_draw_sql(42)}, phone_number, disburse_date) <= 400"),
}


def sampled_by(strategy):
    options, sql = STRATEGIES[strategy]

    @query(f"EV2_strategy_{strategy}", f"WITH {BASE} {sql}", *JOINED, digits=2)
    def build(f):
        return sampling.experiment_rows(joined(f), KEYS, 42, 1, strategy, **options).withColumn("experiment_id", F.lit(1))


for each in STRATEGIES:
    sampled_by(each)


@query("EV3_prepared_rows", f"WITH {BASE} SELECT phone_number, disburse_date, label_value, product, coalesce(c_acctbal, -1) AS c_acctbal, coalesce(c_exact, -1) AS c_exact, segment, coalesce(new_price, -1) AS new_price, coalesce(sms_key, -1) AS sms_key, "
       "strftime(disburse_date, '%Y-%m') AS disburse_month FROM joined", "label", "c_acctbal|c_exact|new_price|sms_key", "disburse_date|product|segment|disburse_month", digits=2)
def ev3(f):
    return lift.prepared_rows(joined(f), KEYS, "label_value")


@query("EV4_time_split", f"WITH {BASE} SELECT CASE WHEN disburse_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS part, count(*) AS n, sum(label_value) AS positives FROM joined GROUP BY 1", "label", texts="part")
def ev4(f):
    train, test = lift.time_split(joined(f), SPLIT)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("label_value").alias("positives"))


FEATURES = [c for c in COSTS if c.endswith("cost")]


def feature_draw_sql(experiment: int) -> str:
    x = "42::BIGINT"
    for part in (str(experiment), "i", "0"):
        y = f"(({x} * {sampling.MIX} + {part}) % {sampling.PRIME})"
        x = f"(({y} * {y} % {sampling.PRIME} * {sampling.LIFT} + {sampling.SHIFT}) % {sampling.PRIME})"
    return x


@query("EV5_feature_samples", "WITH wide AS (SELECT phone_number, list_value(" + ", ".join(FEATURES) + ") AS v FROM usage_pre), "
       + ", ".join(f"e{e} AS (SELECT list(i::BIGINT) AS chosen FROM (SELECT i FROM range({len(FEATURES)}) r(i) ORDER BY {feature_draw_sql(e)}, i LIMIT 5))" for e in range(4))
       + " SELECT phone_number, " + ", ".join(f"list_sum(list_transform(e{e}.chosen, lambda i: v[i + 1])) AS experiment_{e}" for e in range(4)) + " FROM wide, e0, e1, e2, e3",
       "usage_pre", "experiment_.*", digits=2)
def ev5(f):
    chosen = lift.feature_samples(FEATURES, 5, 4)
    return f.usage_pre().select("phone_number", *[sum((F.col(c) for c in names[1:]), F.col(names[0])).alias(f"experiment_{i}") for i, names in enumerate(chosen)])


PREPARED = f"{BASE}, prepared AS (SELECT *, disburse_date >= DATE '2000-01-01' AS is_test, {row_draw_sql(42)} AS draw FROM joined)"
EARLIER_ROWS = "OVER (PARTITION BY {c} ORDER BY is_test, draw, phone_number, disburse_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def statistic_sql(c: str) -> str:
    over = EARLIER_ROWS.format(c=c)
    return (f"(coalesce(sum(CASE WHEN is_test THEN 0 ELSE label_value END) {over}, 0) + (SELECT avg(label_value) FROM prepared WHERE NOT is_test)) "
            f"/ (coalesce(sum((NOT is_test)::INT) {over}, 0) + 1) AS {c}")


def on_test() -> Column:
    return F.col("disburse_date") >= F.lit(SPLIT)


@query("EV6_target_statistics", f"WITH {PREPARED} SELECT phone_number, disburse_date, {statistic_sql('segment')}, {statistic_sql('product')} FROM prepared", "label", "segment|product", "disburse_date", digits=7)
def ev6b(f):
    rows = joined(f).select(*KEYS, "label_value", "segment", "product")
    return evaluation.target_statistics(rows, ["segment", "product"], "label_value", KEYS, ~on_test()).drop("label_value")


@query("EV6_validation_split", f"WITH {PREPARED} SELECT phone_number, disburse_date, row_number() OVER (PARTITION BY label_value ORDER BY draw) <= count(*) OVER (PARTITION BY label_value) // 5 AS held_out FROM prepared", "label", texts="disburse_date")
def ev6c(f):
    rows = joined(f)
    return rows.select(*KEYS, evaluation.validation_split(rows, "label_value", KEYS, 0.2).alias("held_out"))


MODEL = evaluation.ModelOptions(trees=8, first=4, patience=2, depth=3)
NUMBERS, TEXTS, CANDIDATES = ["c_acctbal", "c_exact"], ["segment", "product"], ["new_price", "sms_key"]


def run(f, **options):
    """A run over the whole joined table: text columns among the base features, two candidates."""
    chosen = evaluation.RunOptions(**({"base_size": 3, "experiments": 2, "fraction": 0.8, "workers": 2, "noise": True, "model": MODEL} | options))
    return evaluation.Run(f.spark, scratch(f), KEYS, "label_value", [*NUMBERS, *TEXTS], CANDIDATES, TEXTS, chosen)


@query("EV6_experiment_predictions", None)
def ev6(f):
    """Scores of the test rows by a model with text columns, and by one without the candidate."""
    mine = run(f, experiments=1)
    rows = mine.prepare(joined(f), on_test())
    train, test = rows.where("NOT __test"), rows.where("__test")
    out = test.select(*KEYS, F.col("label_value").alias("y_true"))
    for name, feature in (("p_base", evaluation.BASELINE), ("p_new", "new_price")):
        features = mine.features_of(feature, 0)
        model = evaluation.fit_model(train, features, "label_value", KEYS, MODEL)
        out = out.join(evaluation.scored(model, test, features, KEYS).withColumnRenamed("score", name), KEYS)
    return out


@query("EV7_noise_column", f"WITH {BASE} SELECT phone_number, disburse_date, {row_draw_sql(42)} / {sampling.PRIME}::DOUBLE AS {lift.NOISE} FROM joined", "label", lift.NOISE, "disburse_date", digits=9)
def ev7(f):
    return lift.with_noise(joined(f), KEYS).select(*KEYS, lift.NOISE)


def area(side: str) -> str:
    return (f"SELECT feature, experiment_id, sum(CASE WHEN y_true = 1 THEN r END) - count(*) FILTER (y_true = 1) * (count(*) FILTER (y_true = 1) + 1) / 2.0::DOUBLE AS u, count(*) FILTER (y_true = 1)::DOUBLE AS p, count(*) FILTER (y_true = 0)::DOUBLE AS n "
            f"FROM (SELECT *, rank() OVER (PARTITION BY feature, experiment_id ORDER BY p_{side}) + (count(*) OVER (PARTITION BY feature, experiment_id, p_{side}) - 1) / 2.0::DOUBLE AS r FROM predictions) GROUP BY 1, 2")


RESULTS = (f"results AS (SELECT feature, experiment_id, b.u / (b.p * b.n) AS auc_base, w.u / (w.p * w.n) AS auc_new, w.u / (w.p * w.n) - b.u / (b.p * b.n) AS gap FROM ({area('base')}) b JOIN ({area('new')}) w USING (feature, experiment_id))")


@query("EV8_auc", f"WITH {RESULTS} SELECT * FROM results", "predictions", "auc.*|gap", "feature", digits=9)
def ev8(f):
    return lift.auc(f.predictions())


METRICS = ("metrics AS (SELECT feature, avg(gap) AS mean_gap, stddev_pop(gap) AS std_gap, median(gap) AS median_gap, avg((gap > 0)::INT) AS win_rate, avg((gap < 0)::INT) AS loss_rate, count(*) AS n_experiments, avg(gap) / nullif(stddev_pop(gap), 0) AS effect_size FROM results GROUP BY 1)")


@query("EV9_gap_metrics", f"WITH {RESULTS}, {METRICS} SELECT * FROM metrics", "predictions", ".*_gap|.*_rate|effect_size", "feature", digits=7)
def ev9(f):
    return lift.gap_metrics(lift.auc(f.predictions()))


DOMINANCE = "dom AS (SELECT a.feature, avg((a.auc_new > b.auc_base)::INT) AS dominance FROM results a JOIN results b USING (feature) GROUP BY 1)"


@query("EV10_dominance", f"WITH {RESULTS}, {DOMINANCE} SELECT * FROM dom", "predictions", "dominance", "feature", whole=False)
def ev10(f):
    return lift.dominance(lift.auc(f.predictions()))


def draw_sql(n: str) -> str:
    a, b, c, d, e, g = lift.STREAM
    p = lift.PRIME
    x = f"((r.b * {a} + i.i * {b} + 42 * {c}) % {p})"
    x = f"(({x} * {x} % {p} * {d} + {e}) % {p})"
    return f"((({x} * {x}) % {p} * {g}) % {p}) % {n}"


RESAMPLES = 10_000
INTERVAL = (f"gaps AS (SELECT feature, list(gap ORDER BY experiment_id) AS g, count(*) AS n FROM results GROUP BY 1), "
            f"means AS (SELECT feature, r.b, avg(g[({draw_sql('n')}) + 1]) AS m FROM gaps, range(1, {RESAMPLES + 1}) r(b), LATERAL (SELECT unnest(range(1, n + 1)) AS i) i GROUP BY 1, 2), "
            "ci AS (SELECT feature, quantile_cont(m, 0.025) AS ci_lo, quantile_cont(m, 0.975) AS ci_hi FROM means GROUP BY 1)")


@query("EV11_bootstrap_interval", f"WITH {RESULTS}, {INTERVAL} SELECT * FROM ci", "predictions", "ci.*", "feature", whole=False, digits=8)
def ev11(f):
    return lift.bootstrap_interval(lift.auc(f.predictions()), RESAMPLES)


@query("EV12_paired_statistics",
       f"WITH {RESULTS}, r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY abs(gap)) + (count(*) OVER (PARTITION BY feature, abs(gap)) - 1) / 2.0::DOUBLE AS k, count(*) OVER (PARTITION BY feature, abs(gap)) AS c FROM results WHERE gap <> 0), "
       "t AS (SELECT feature, count(*) AS n, avg(gap) / nullif(stddev_samp(gap) / sqrt(count(gap)), 0) AS t FROM results GROUP BY 1), "
       "w AS (SELECT feature, coalesce(sum(k) FILTER (gap > 0), 0) AS w_plus, coalesce(sum(k) FILTER (gap < 0), 0) AS w_minus, count(*) AS n_nonzero, sum(c * c - 1) AS tie_term FROM r GROUP BY 1) SELECT * FROM t LEFT JOIN w USING (feature)",
       "predictions", "t|w_plus|w_minus|tie_term", "feature", digits=5)
def ev12(f):
    return lift.paired_statistics(lift.auc(f.predictions())).drop("doubled_ranks")


# by brute force: the t tail as a Riemann sum, the rank statistic over all sign assignments
P_VALUES = (f"WITH {RESULTS}, t AS (SELECT feature, count(*) AS n, avg(gap) / nullif(stddev_samp(gap) / sqrt(count(gap)), 0) AS t FROM results GROUP BY 1), "
            "tail AS (SELECT feature, sum(CASE WHEN u >= atan(abs(t) / sqrt(n - 1)) THEN h END) / sum(h) AS p_value_ttest FROM (SELECT feature, t, n, u, pow(cos(u), n - 2) AS h FROM t, "
            "(SELECT (i + 0.5::DOUBLE) * pi() / 2 / 400000 AS u FROM range(400000) r(i)) g) GROUP BY 1), "
            "r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY abs(gap)) AS k FROM results), "
            "w AS (SELECT feature, count(*) AS n, least(sum(CASE WHEN gap > 0 THEN k ELSE 0 END), sum(CASE WHEN gap < 0 THEN k ELSE 0 END)) AS w FROM r GROUP BY 1), "
            "signs AS (SELECT feature, m, sum(CASE WHEN (m >> (k - 1)::INT) & 1 = 1 THEN k ELSE 0 END) AS total FROM r, range(256) s(m) GROUP BY 1, 2), "
            "p AS (SELECT feature, least(1, 2 * avg((total <= w)::INT)) AS p_value_wilcoxon FROM signs JOIN w USING (feature) GROUP BY 1) SELECT * FROM tail JOIN p USING (feature)")


@query("EV12_p_values", P_VALUES, "predictions", "p_.*", "feature", whole=False, digits=4)
def ev12b(f):
    return lift.p_values(lift.auc(f.predictions()))


def points_sql(value: str, table) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {limit} THEN {score}" for limit, score in zip(*table)) + f" ELSE {table[1][-1]} END"


def decision_sql(profile: lift.Profile) -> str:
    reasons = ("CASE WHEN mean_gap <= 0 THEN 'negative uplift' WHEN stability < 0.15 THEN 'unstable feature' WHEN win_rate < 0.5 THEN 'low consistency' "
               + ("WHEN ci_lo <= 0 THEN 'ci crosses zero' " if profile.needs_positive_interval else "WHEN dominance < 0.47 THEN 'weak dominance' ") + "END")
    total = " + ".join(points_sql(c, t) for c, t in profile.tables.items())
    label = f"CASE WHEN total >= {profile.limits[2]} THEN 'strong_accept' WHEN total >= {profile.limits[1]} THEN 'accept' WHEN total >= {profile.limits[0]} THEN 'weak_accept' ELSE 'reject' END"
    final = f"CASE WHEN reason IS NULL AND {label} = 'reject' THEN 'low score' ELSE reason END" if profile.needs_positive_interval else "reason"
    return (f"WITH {RESULTS}, {METRICS}, {DOMINANCE}, {INTERVAL}, m AS (SELECT *, least(mean_gap / greatest(std_gap, 1e-8), 1000) AS stability FROM metrics JOIN dom USING (feature) JOIN ci USING (feature)), "
            f"s AS (SELECT *, {reasons} AS reason, {total} AS total FROM m) SELECT feature, stability, CASE WHEN reason IS NULL THEN total END AS score, CASE WHEN reason IS NULL THEN {label} ELSE 'reject' END AS decision, {final} AS reason FROM s")


def decided(f, profile):
    results = lift.auc(f.predictions())
    metrics = lift.gap_metrics(results).join(lift.dominance(results), "feature").join(lift.bootstrap_interval(results, RESAMPLES), "feature")
    return metrics.withColumns({"p_value_ttest": F.lit(None).cast("double"), "p_value_wilcoxon": F.lit(None).cast("double")})


CURRENT = lift.Profile(p_table=None)


@query("EV13_decision", decision_sql(CURRENT), "predictions", "stability|score", "feature|decision|reason", whole=False)
def ev13(f):
    return lift.decide(decided(f, CURRENT), CURRENT).select("feature", "stability", "score", "decision", "reason")


@query("EV13_decision_earlier_profile", decision_sql(lift.EARLIER), "predictions", "stability|score", "feature|decision|reason", whole=False)
def ev13b(f):
    return lift.decide(decided(f, lift.EARLIER), lift.EARLIER).select("feature", "stability", "score", "decision", "reason")


@query("EV14_compare_features", None)
def ev14(f):
    stored = lift.auc(f.predictions().filter("feature = 'f0'"))
    return lift.compare_features(f.predictions(), stored)


@query("EV14_evaluation_run", None)
def ev14c(f):
    """From candidates over samples, fits and areas to a decision for each; started again, it has nothing left to fit."""
    mine = run(f)
    result = evaluation.evaluate(mine, joined(f), on_test())
    if mine.fit_pending(joined(f), on_test()):
        raise RuntimeError("stored cells were fitted again")
    return result


@query("EV14_not_evaluated", "SELECT DISTINCT feature, experiment_id FROM predictions WHERE feature <> 'f0'", "predictions", texts="feature")
def ev14b(f):
    rows = f.predictions().select("feature", "experiment_id").distinct()
    return lift.not_evaluated(rows, rows.filter("feature = 'f0'"))


IMPORTANCE = ("imp AS (SELECT CASE o_orderkey % 2 WHEN 0 THEN 'baseline' ELSE 'new' END AS model, o_custkey % 4 AS experiment_id, concat('c', (o_orderkey // 2) % 7) AS feature, o_totalprice - 250000 AS importance FROM orders), "
              "summary AS (SELECT model, feature, avg(abs(importance)) AS mean_abs, coalesce(stddev_samp(abs(importance)), 0) AS std_abs FROM imp GROUP BY 1, 2)")


def importance_rows(f):
    return f.orders.selectExpr("CASE o_orderkey % 2 WHEN 0 THEN 'baseline' ELSE 'new' END AS model", "o_custkey % 4 AS experiment_id", "concat('c', (o_orderkey DIV 2) % 7) AS feature", "o_totalprice - 250000 AS importance")


@query("EV15_importance_summary", f"WITH {IMPORTANCE} SELECT *, row_number() OVER (PARTITION BY model ORDER BY mean_abs DESC, feature) AS rank FROM summary", "", ".*_abs", "model|feature", digits=3)
def ev15(f):
    return lift.importance_summary(importance_rows(f))


@query("EV15_importance_change", f"WITH {IMPORTANCE} SELECT feature, b.mean_abs AS baseline_mean_abs, n.mean_abs AS new_mean_abs, n.mean_abs - b.mean_abs AS delta FROM (SELECT * FROM summary WHERE model = 'baseline') b JOIN (SELECT * FROM summary WHERE model = 'new') n USING (feature)",
       "", ".*_abs|delta", "feature", whole=False, digits=3)
def ev15b(f):
    return lift.importance_change(lift.importance_summary(importance_rows(f)))


@query("EV15_best_accepted", f"SELECT feature, score FROM ({decision_sql(CURRENT)}) WHERE decision <> 'reject' ORDER BY score DESC, feature LIMIT 2", "predictions", "score", "feature", whole=False)
def ev15c(f):
    return lift.best_accepted(ev13(f), 2).select("feature", "score")


@query("EV15_rotated_columns", f"WITH {PREPARED}, r AS (SELECT *, row_number() OVER (ORDER BY draw, phone_number, disburse_date) - 1 AS k, count(*) OVER () AS n FROM prepared WHERE is_test) "
       "SELECT a.phone_number, a.disburse_date, b.c_acctbal AS partner_balance FROM r a JOIN r b ON b.k = (a.k + 3) % a.n", "label", "partner_balance", "disburse_date", digits=2)
def ev15d(f):
    rows = joined(f).where(on_test())
    place = F.struct(sampling.row_draw(rows, KEYS, 42).alias("draw"), *KEYS)
    return ranges.rotated(rows.withColumn("place", place), "place", ["c_acctbal"], 3).select(*KEYS, F.col("partner.c_acctbal").alias("partner_balance"))


@query("EV15_fitted_importances", None)
def ev15e(f):
    """Importances of the stored models of a candidate and of its baselines, summed up over experiments."""
    mine = run(f)
    mine.fit_pending(joined(f), on_test())
    long = mine.importances("new_price")
    return lift.importance_summary(long.where("kind = 'rotation'")).withColumn("kind", F.lit("rotation")).unionByName(
        lift.importance_summary(long.where("kind = 'split'")).withColumn("kind", F.lit("split")))
