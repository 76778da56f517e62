"""The bulk run: candidate features, experiments, fits, areas, decision; and what the fitted models rest on.

A run is a grid of (feature, experiment). Every cell is one fit whose scores and model are stored under its key; a cell counts as
stored when its mark is written, which comes last. A run that was killed is started again with the same arguments and fits only the
cells without a mark. The baseline of an experiment does not depend on the candidate, so it is a cell of its own, fitted once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sundial.operators.columns import fill_missing
from sundial.operators.ranges import rotated, running_totals
from sundial.operators.sampling import experiment_rows, nth_smallest, row_draw
from sundial.plans import lift
from sundial.session import cut_lineage

BASELINE = "__baseline__"
NOISE = lift.NOISE
DATA = "__test", "__partner"
GRID = "feature string, experiment_id int"


@dataclass(frozen=True)
class ModelOptions:
    """Boosted trees: at most `trees`, as many as the validation loss asks for. It is looked at after `first`, 2 x `first`, ... trees, or all."""

    trees: int = 400
    first: int = 50
    patience: int = 50
    depth: int = 4
    step: float = 0.1
    bins: int = 32
    seed: int = 42
    validation_share: float = 0.2


@dataclass(frozen=True)
class RunOptions:
    base_size: int = 40
    experiments: int = 30
    seed: int = 42
    strategy: str = "random"
    fraction: float | None = None
    rows: int | None = None
    filters: list[str] = field(default_factory=list)
    noise: bool = False
    workers: int = 4
    model: ModelOptions = ModelOptions()


# Columns

def target_statistics(rows: DataFrame, categories: list[str], target: str, keys: list[str], is_train: Column, seed: int = 42, weight: float = 1.0) -> DataFrame:
    """Text columns replaced by ordered target statistics.

    Training rows stand in a hashed order; a row gets the mean target of the earlier rows of its category, with `weight` rows at the
    overall mean added, so its own target never enters. Other rows come after all training rows. A category that
    occurs nowhere before has the overall mean; null is the category ''. Keys are unique.

    All columns go through one prefix sum as long rows (column, category, row); a category that holds most rows is cut by ranges.
    """
    if not categories:
        return rows
    overall = rows.where(is_train).agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0
    place = F.struct((~is_train).cast("int").alias("late"), row_draw(rows, keys, seed).alias("draw"), *keys)
    one = is_train.cast("long")
    pairs = F.array(*[F.struct(F.lit(c).alias("__column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("__category")) for c in categories])
    long = rows.select(*keys, place.alias("__order"), one.alias("__one"), F.when(is_train, F.col(target).cast("long")).otherwise(0).alias("__y"), F.inline(pairs))
    before = running_totals(long, ["__column", "__category"], "__order", {"__y": "__sum", "__one": "__rows"})
    value = (F.col("__sum") + weight * overall) / (F.col("__rows") + weight)
    wide = before.groupBy(*keys).agg(*[F.max(F.when(F.col("__column") == c, value)).alias(c) for c in categories])
    return rows.drop(*categories).join(wide, keys).select(*rows.columns)


def validation_split(df: DataFrame, target: str, keys: list[str], share: float = 0.2, seed: int = 42, draw: Column | None = None) -> Column:
    """True for the rows of either class with the lowest draws, `share` of each class, rounded down. draw: where it stands already."""
    draw = row_draw(df, keys, seed) if draw is None else draw
    last = nth_smallest(df, draw, lambda size: int(size * share), by=target)
    test = F.lit(False)
    for group, (value, _) in last.items():
        test = test | (F.col(target).eqNullSafe(F.lit(group)) & (draw <= value))
    return test


# Fits

def _vector(features: list[str]) -> Column:
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.array(*[F.col(c).cast("double") for c in features])).alias("features")


def best_size(losses: list[float], patience: int) -> tuple[int, bool]:
    """Number of trees with the smallest loss before `patience` trees without a better one; whether that end was reached."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_model(train: DataFrame, features: list[str], target: str, keys: list[str], options: ModelOptions):
    """Boosted trees with balanced classes: a stratified validation part finds their number, then all rows are used.

    Growing starts again with twice the trees as long as the end was not reached: the same seed grows the same first trees, so the
    losses continue, and the work is at most twice that of the last try. A first try of half the trees or more is not made, as what it
    can save is not more than what it costs. The rows are read once and kept with their draws.
    """
    from pyspark.ml.classification import GBTClassifier

    kept = train.select(_vector(features), F.col(target).cast("int").alias("class"), row_draw(train, keys, options.seed).alias("draw")).persist()

    def grown(df: DataFrame, trees: int):
        return GBTClassifier(maxIter=trees, maxDepth=options.depth, stepSize=options.step, seed=options.seed, maxBins=options.bins, weightCol="weight").fit(df)

    try:
        sizes = {r[0]: r[1] for r in kept.groupBy("class").agg(F.count(F.lit(1))).collect()}
        total = sum(sizes.values())
        if not total:
            raise ValueError("no rows to train on")
        weight = F.when(F.col("class") == 1, total / (2.0 * sizes.get(1, total))).otherwise(total / (2.0 * sizes.get(0, total)))
        held_out = validation_split(kept, "class", keys, options.validation_share, options.seed, F.col("draw"))
        rows = kept.select("features", F.col("class").cast("double").alias("label"), weight.alias("weight"), held_out.alias("held_out"))
        apart, size = rows.where("held_out"), options.first if 2 * options.first < options.trees else options.trees
        best, ended = (options.trees, True) if apart.isEmpty() else (0, False)
        while not ended:
            best, ended = best_size(grown(rows.where("NOT held_out"), size).evaluateEachIteration(apart), options.patience)
            ended, size = ended or size >= options.trees, min(2 * size, options.trees)
        return grown(rows, best)
    finally:
        kept.unpersist()


def scored(model, rows: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Columns `keep` and the score of every row."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(rows.select(*keep, _vector(features))).select(*keep, vector_to_array("probability")[1].alias("score"))


def score_counts(scores: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """Rows of either class per score."""
    y = F.col(target).cast("long")
    return scores.groupBy(*keys, "score").agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def areas(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Exact area under the ROC curve per key from counts per score, ties counting half; null with one class only."""
    below = running_totals(counts, keys, "score", {"neg": "__below"})
    sums = below.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("__below") * 2 + F.col("neg"))).alias("__u2"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    return sums.select(*keys, F.try_divide(F.col("__u2").cast("double"), F.col("__p").cast("double") * F.col("__n") * 2.0).alias("area"))


# The run

class Run:
    """Evaluates candidate features over a table with one row per key; results live under `store`, a folder all executors share."""

    def __init__(self, spark: SparkSession, store: str, keys: list[str], target: str, base: list[str], candidates: list[str], categories: list[str] = (),
                 options: RunOptions = RunOptions(), fit: Callable = fit_model):
        taken = {*keys, target, *DATA}
        for name in [*base, *candidates]:
            if name in taken or name in (BASELINE, NOISE):
                raise ValueError(f"not a feature name: {name}")
        if set(base) & set(candidates):
            raise ValueError("a candidate is among the base features")
        self.spark, self.store, self.keys, self.target, self.options, self.fit = spark, store.rstrip("/"), keys, target, options, fit
        self.base, self.candidates, self.categories = base, candidates, [c for c in [*base, *candidates] if c in categories]
        self.samples = lift.feature_samples(base, options.base_size, options.experiments, options.seed)

    def _path(self, feature: str, experiment: int, part: str) -> str:
        """Feature names may hold anything, so folders are named by a digest."""
        return f"{self.store}/fits/{hashlib.sha256(f'{feature}:{experiment}'.encode()).hexdigest()[:32]}/{part}"

    def _stored(self, part: str, schema: str) -> DataFrame:
        """A part of all stored cells; empty before the first one."""
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(schema).parquet(f"{self.store}/fits/*/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def grid(self) -> DataFrame:
        """All cells of the run."""
        cells = [(f, e) for e in range(self.options.experiments) for f in [BASELINE, *self.candidates]]
        return self.spark.createDataFrame(cells, GRID)

    def pending(self) -> DataFrame:
        """Cells without a mark."""
        return self.grid().join(self._stored("mark", GRID), ["feature", "experiment_id"], "left_anti")

    def prepare(self, rows: DataFrame, is_test: Column, rotate: int = 1) -> DataFrame:
        """Write the one table that all fits read: numbers only, test rows with the values of another test row beside them.

        Missing numbers are -1, texts become target statistics. Written again only if a feature is missing in it.
        """
        path, features = f"{self.store}/rows", [*self.base, *self.candidates, *([NOISE] if self.options.noise else [])]
        if "rows" in self._tables() and not set(features) - set(self.spark.read.parquet(path).columns):
            return self.spark.read.parquet(path)
        data = rows.select(*self.keys, F.col(self.target).cast("int").alias(self.target), *self.base, *self.candidates, F.coalesce(is_test, F.lit(False)).alias("__test"))
        data = cut_lineage(fill_missing(data, -1.0, "", keys=[*self.keys, self.target, "__test"]))
        data = target_statistics(data, self.categories, self.target, self.keys, ~F.col("__test"), self.options.seed)
        if self.options.noise:
            data = lift.with_noise(data, self.keys, self.options.seed)
        data = cut_lineage(data.select(*self.keys, self.target, "__test", *[F.col(c).cast("double").alias(c) for c in features]))
        place = F.struct(row_draw(data, self.keys, self.options.seed).alias("draw"), *self.keys)
        test = rotated(data.where("__test").withColumn("__place", place), "__place", features, rotate, "__partner").drop("__place")
        data.where("NOT __test").unionByName(test, allowMissingColumns=True).write.mode("overwrite").parquet(path)
        self.spark.createDataFrame([("rows",)], "name string").coalesce(1).write.mode("overwrite").parquet(f"{self.store}/tables/rows")
        return self.spark.read.parquet(path)

    def _tables(self) -> set[str]:
        from pyspark.errors import AnalysisException

        try:
            return {r.name for r in self.spark.read.schema("name string").parquet(f"{self.store}/tables/*").collect()}
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()

    def features_of(self, feature: str, experiment: int) -> list[str]:
        """What a cell's model is fitted on."""
        base = self.samples[experiment]
        if feature == BASELINE:
            return [*base, NOISE] if self.options.noise else base
        return [*base, feature]

    def _sample(self, rows: DataFrame, experiment: int) -> DataFrame:
        o = self.options
        return experiment_rows(rows, self.keys, o.seed, experiment, o.strategy, o.fraction, o.rows, o.filters)

    def _cell(self, rows: DataFrame, feature: str, experiment: int) -> None:
        """One fit: model, scores, then the mark. Parts left by a killed run are overwritten."""
        features = self.features_of(feature, experiment)
        needed = self._sample(rows.drop("__partner"), experiment).select(*self.keys, self.target, "__test", *features)
        model = self.fit(needed.where("NOT __test"), features, self.target, self.keys, self.options.model)
        model.write().overwrite().save(self._path(feature, experiment, "model"))
        counts = score_counts(scored(model, needed.where("__test"), features, [self.target]), self.target, [])
        counts.select(F.lit(feature).alias("feature"), F.lit(experiment).alias("experiment_id"), "score", "pos", "neg").write.mode("overwrite").parquet(
            self._path(feature, experiment, "scores"))
        self.spark.createDataFrame([(feature, experiment)], GRID).coalesce(1).write.mode("overwrite").parquet(self._path(feature, experiment, "mark"))

    def _each(self, cells: list[tuple[str, int]], work: Callable[[str, int], None]) -> None:
        """Work on cells from a bounded pool of threads; each slot has a scheduler pool of its own, so with FAIR scheduling none waits for another.

        After a failure no further cell starts; those under way end, then the first error is raised.
        """
        context, failed = self.spark.sparkContext, []

        def one(slot: int) -> None:
            context.setLocalProperty("spark.scheduler.pool", f"fit-{slot}")
            for cell in cells[slot::workers]:
                if failed:
                    return
                try:
                    work(*cell)
                except Exception as e:
                    failed.append(e)
                    return

        workers = max(1, min(self.options.workers, len(cells)))
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(one), range(workers)))
        if failed:
            raise failed[0]

    def fit_pending(self, rows: DataFrame, is_test: Column) -> int:
        """Fit what is not stored yet; the number of fits. The driver sees the cells of the grid, a configured number."""
        cells = [(r.feature, r.experiment_id) for r in self.pending().orderBy("experiment_id", "feature").collect()]
        if cells:
            data = self.prepare(rows, is_test)
            self._each(cells, lambda feature, experiment: self._cell(data, feature, experiment))
        return len(cells)

    def results(self) -> DataFrame:
        """feature, experiment_id, auc_base, auc_new, gap of all stored cells of this run."""
        counts = self._stored("scores", GRID + ", score double, pos long, neg long").join(self.grid(), ["feature", "experiment_id"], "left_semi")
        marked = counts.join(self._stored("mark", GRID), ["feature", "experiment_id"], "left_semi")
        found = cut_lineage(areas(marked, ["feature", "experiment_id"]))
        base = found.where(F.col("feature") == BASELINE).select("experiment_id", F.col("area").alias("auc_base"))
        new = found.where(F.col("feature") != BASELINE).withColumnRenamed("area", "auc_new").join(base, "experiment_id")
        return new.select("feature", "experiment_id", "auc_base", "auc_new", (F.col("auc_new") - F.col("auc_base")).alias("gap"))

    def decisions(self, profile: lift.Profile = lift.Profile(), resamples: int = 10_000) -> DataFrame:
        return lift.decide(lift.experiment_metrics(self.results(), resamples), profile)

    def importances(self, feature: str) -> DataFrame:
        """model, kind, experiment_id, feature, importance of the stored models of a candidate and of their baselines.

        "split": the model's own importances. "rotation": by how much the area falls when a column's values come from another
        test row. All columns of a model are scored in one job: a test row becomes one row per column.
        """
        from pyspark.ml.classification import GBTClassificationModel
        from pyspark.ml.functions import array_to_vector, vector_to_array

        rows = self.spark.read.parquet(f"{self.store}/rows").where("__test")
        cells = [(f, e) for e in range(self.options.experiments) for f in (BASELINE, feature)]
        parts = {}

        def one(name: str, experiment: int) -> None:
            model, features = GBTClassificationModel.load(self._path(name, experiment, "model")), self.features_of(name, experiment)
            own, other = F.array(*features), F.array(*[F.col(f"__partner.`{c}`") for c in features])
            # place 0 leaves the row as it is
            long = self._sample(rows, experiment).select(self.target, own.alias("own"), other.alias("other"), F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("place"))
            mixed = F.transform("own", lambda v, i: F.when(F.col("place") == i + 1, F.element_at("other", i + 1)).otherwise(v))
            found = model.transform(long.select(self.target, "place", array_to_vector(mixed).alias("features"))).select(self.target, "place", vector_to_array("probability")[1].alias("score"))
            area = {r.place: r.area for r in areas(score_counts(found, self.target, ["place"]), ["place"]).collect()}
            label = "baseline" if name == BASELINE else "new"
            split = model.featureImportances.toArray().tolist()
            parts[name, experiment] = [(label, kind, experiment, c, value) for i, c in enumerate(features) for kind, value in (
                ("split", float(split[i])), ("rotation", None if area.get(0) is None or area.get(i + 1) is None else area[0] - area[i + 1]))]

        self._each(cells, one)
        return self.spark.createDataFrame([r for cell in cells for r in parts[cell]], "model string, kind string, experiment_id int, feature string, importance double")

    def accepted_importances(self, decisions: DataFrame, n: int) -> DataFrame:
        """Importance summaries of the n best accepted candidates: candidate, kind, model, feature, mean_abs, std_abs, rank."""
        schema = "candidate string, kind string, model string, feature string, mean_abs double, std_abs double, rank int"
        found = self.spark.createDataFrame([], schema)
        for row in lift.best_accepted(decisions, n).collect():
            long = self.importances(row.feature)
            for kind in ("split", "rotation"):
                summary = lift.importance_summary(long.where(F.col("kind") == kind))
                found = found.unionByName(summary.select(F.lit(row.feature).alias("candidate"), F.lit(kind).alias("kind"), "model", "feature", "mean_abs", "std_abs", "rank"))
        return found


def evaluate(run: Run, rows: DataFrame, is_test: Column, profile: lift.Profile = lift.Profile(), resamples: int = 10_000) -> DataFrame:
    """From candidates to decisions; only cells that are not stored are fitted."""
    run.fit_pending(rows, is_test)
    return run.decisions(profile, resamples)
