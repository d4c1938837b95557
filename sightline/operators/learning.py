"""Feature vectors, threat classifiers with cross-validation, and their reports."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import Bucketizer, RFormula, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.scoring import binary_label, ternary_label
from sightline.functions.values import hash_unit
from sightline.operators.sampling import hash_balance, hash_split
from sightline.operators.stats import confusion, prediction_counts
from sightline.session import cut

# The settings of the reference jobs.
FOLDS = 10
SEED = 90
SVM_ITERATIONS = 250

# Rows of one part of the vectors: as many as there are cores below, no more than this above.
SMALL_PART, LARGE_PART = 10_000, 1_000_000
# Rows held by all fits that run at once, as each fit keeps its own copy.
ROWS_AT_ONCE = 20_000_000

# From so many rows on, trees are fitted on counted rows, with numbers in as many bins as trees use.
COUNTED_ROWS, BINS = 1_000_000, 32
# Numbers with at most so many values are looked at one by one before they are binned.
LISTED_VALUES = 100

# Columns that identify a row of the vectors.
ROW_KEYS = ("ip", "_row")

# Columns of the enriched sightings the first family of models uses.
DISTINCT_COLUMNS = [
    "data",
    "continent",
    "country",
    "count_seen",
    "score_direction",
    "elapsed",
    "sector",
    "size",
    "estimate",
]
CATEGORIES = {
    "sector": "sectorIndex",
    "size": "sizeIndex",
    "estimate": "estimateIndex",
    "score_direction": "rescoreIndex",
    "continent": "continentIndex",
}
LABEL = "score_direction"
ENRICHED_FEATURES = [
    "sizeIndex",
    "sectorIndex",
    "estimateIndex",
    "continentIndex",
    "elapsed",
    "count_seen",
]

# Columns of the per-IP features that never enter a vector.
NOT_FEATURES = ["ip", "lastScore", "mostCommonCustomerHit", "avgScore", "minScore", "maxScore"]
NOT_SVM_FEATURES = [
    "ip",
    "maxScore",
    "minScore",
    "avgScore",
    "trendUp",
    "trendDown",
    "trueCount",
    "dataSetCount",
    "mostCommonCustomerHit",
    "lastScore",
]


def distinct_enriched(enriched: DataFrame) -> DataFrame:
    return enriched.select(*DISTINCT_COLUMNS).distinct()


def index_categories(enriched: DataFrame) -> DataFrame:
    """Categories as numbers, commonest first, ties in alphabetical order.

    ``_row`` identifies a row by all its columns. The label gets no index for
    unknown values, so it declares the classes that are there. The rows are
    written, as both indexers and the caller read them.
    """
    rows = cut(distinct_enriched(enriched))

    def indexer(names: list[str], invalid: str) -> StringIndexer:
        return StringIndexer(
            inputCols=names,
            outputCols=[CATEGORIES[c] for c in names],
            stringOrderType="frequencyDesc",
            handleInvalid=invalid,
        )

    keyed = rows.withColumn("_row", F.xxhash64(*DISTINCT_COLUMNS))
    indexed = indexer([c for c in CATEGORIES if c != LABEL], "keep").fit(rows).transform(keyed)
    labelled = indexer([LABEL], "skip").fit(rows).transform(indexed)
    return labelled.select(*CATEGORIES.values(), "elapsed", "count_seen", "_row")


def _assembled(frame: DataFrame, columns: list[str], label) -> DataFrame:
    vector = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")
    keys = [c for c in frame.columns if c in (*ROW_KEYS, "counts") or c.startswith("draw_")]
    return (
        vector.transform(frame.withColumn("label", label))
        .where(F.col("label").isNotNull())
        .select(*keys, "label", "features")
    )


def enriched_vectors(indexed: DataFrame) -> DataFrame:
    """Label is the indexed score direction, features the six other columns."""
    return _assembled(indexed, ENRICHED_FEATURES, F.col("rescoreIndex"))


# Upper bounds of the numbers 0, 1, 2 ... of a Poisson draw of mean one, on a unit scale.
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(12)]).tolist()


def _bucketed(frame: DataFrame, splits: dict[str, list[float]]) -> DataFrame:
    """Columns replaced by the number of ``splits`` at or below them."""
    names = list(splits)
    # A transformer, as a chain of conditions makes a method too long for the compiler.
    bounds = [[-math.inf, *splits[c], math.inf] for c in names]
    buckets = Bucketizer(splitsArray=bounds, inputCols=names, outputCols=[f"_{c}_bucket" for c in names])
    others = [c for c in frame.columns if c not in splits]
    return buckets.transform(frame).select(*others, *[F.col(f"_{c}_bucket").alias(c) for c in names])


def counted_vectors(
    indexed: DataFrame, learner: Learner, folds: int = FOLDS, least: int | None = None
) -> DataFrame:
    """The enriched vectors, each once with ``counts`` of its rows by fold, if trees learn from many rows.

    Trees look at a number only by its bin, and at rows only by how many are in
    each bin, so counts tell them all. Numbers are binned by their quantiles over
    all rows, where a fit takes them from a sample; a number of at most as many
    values as bins keeps them all. For forests ``draw_0`` and so on hold, by fold,
    how often the bootstrap of a tree takes a vector, drawn row by row.
    """
    if learner.model not in ("tree", "forest"):
        return enriched_vectors(indexed)
    numbers = [c for c in ENRICHED_FEATURES if c not in CATEGORIES.values()]
    usable = indexed.na.drop(subset=[*ENRICHED_FEATURES, CATEGORIES[LABEL]])
    shares = [i / BINS for i in range(1, BINS)]
    figures = [F.count("*").alias("rows")]
    for c in numbers:
        x = F.col(c).cast("double")
        figures += [
            F.percentile_approx(x, shares, 10_000).alias(f"{c}_points"),
            F.min(x).alias(f"{c}_bottom"),
            F.max(x).alias(f"{c}_top"),
            F.approx_count_distinct(x).alias(f"{c}_values"),
        ]
    seen = usable.agg(*figures).first()
    if seen["rows"] < (COUNTED_ROWS if least is None else least):
        return enriched_vectors(indexed)
    splits = {}
    for c in numbers:
        points = seen[f"{c}_points"]
        if seen[f"{c}_values"] <= LISTED_VALUES:
            values = [r[0] for r in usable.select(F.col(c).cast("double")).distinct().collect()]
            points = values if len(values) <= BINS else points
        # All are at or above the least value, which is no split; one beyond the top splits nothing.
        points = sorted({p for p in points if p > seen[f"{c}_bottom"]})
        splits[c] = points or [math.nextafter(seen[f"{c}_top"], math.inf)]
    trees = learner.settings["numTrees"] if learner.model == "forest" else 0
    draws = [f"draw_{k}" for k in range(trees)]
    keys = list(CATEGORIES.values())
    rows = with_folds(usable, folds).select(
        *keys,
        *[F.col(c).cast("double").alias(c) for c in numbers],
        "fold",
        *[(F.pmod(F.xxhash64(F.lit(c), "_row"), F.lit(2**32)) / F.lit(float(2**32))).alias(c) for c in draws],
    )
    rows = _bucketed(rows, splits | dict.fromkeys(draws, _DRAWS))
    sums = [F.count("*").alias("counts"), *[F.sum(c).cast("long").alias(c) for c in draws]]
    grouped = cut(rows.groupBy(*keys, *numbers, "fold").agg(*sums))
    # One struct for each fold that has the vector; its place in the arrays is the number of the fold.
    entries = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("counts", *draws))))
    gathered = grouped.groupBy(*keys, *numbers).agg(entries.alias("_folds"))

    def by_fold(name: str) -> F.Column:
        zero = F.lit(0).cast("long")
        found = F.transform(
            F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: F.coalesce(F.try_element_at("_folds", f)[name], zero)
        )
        return found.alias(name)

    gathered = gathered.select(*keys, *numbers, *[by_fold(c) for c in ("counts", *draws)])
    return _assembled(gathered, ENRICHED_FEATURES, F.col(CATEGORIES[LABEL]))


def _feature_names(features: DataFrame, left_out: list[str]) -> list[str]:
    return sorted(c for c in features.columns if c not in left_out)


def profile_vectors(features: DataFrame, without_neutral: bool = False) -> DataFrame:
    """Label is whether the last score is above neutral.

    With ``without_neutral`` the rows at neutral are dropped before training.
    """
    names = _feature_names(features, NOT_FEATURES)
    label = ternary_label("lastScore") if without_neutral else binary_label("lastScore")
    return _assembled(features, names, label)


def svm_vectors(features: DataFrame) -> DataFrame:
    """Customers hit in all and per customer; rows without a usable score drop out."""
    return _assembled(features, _feature_names(features, NOT_SVM_FEATURES), binary_label("lastScore"))


def svm_scoring_vectors(features: DataFrame) -> DataFrame:
    """The same vectors for rows whose label does not matter."""
    return _assembled(features, _feature_names(features, NOT_SVM_FEATURES), F.lit(1.0))


@dataclass(frozen=True)
class Learner:
    """One training job: which vectors, which model, which grid, which measure."""

    vectors: str
    model: str
    settings: dict
    grid: dict
    measure: str


_TREE_GRID = {"maxDepth": [2, 5]}
_LINEAR_GRID = {"regParam": [0.0, 0.1]}
_MODELS = {
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
    "logistic": LogisticRegression,
    "boosted": GBTClassifier,
}
_SMALL_FOREST = {"numTrees": 3, "maxDepth": 2, "seed": SEED}
_LARGE_FOREST = {"numTrees": 30, "maxDepth": 5, "seed": SEED}
_BOOSTED = {"maxIter": 5, "maxDepth": 2, "seed": SEED}

LEARNERS = {
    "ml_tree": Learner("enriched", "tree", {"maxDepth": 2}, _TREE_GRID, "multiclass"),
    "ml_tree2": Learner("profile", "tree", {"maxDepth": 2}, _TREE_GRID, "multiclass"),
    "ml_tree3": Learner("no_neutral", "tree", {"maxDepth": 2}, _TREE_GRID, "multiclass"),
    "ml_rf": Learner("enriched", "forest", _SMALL_FOREST, _TREE_GRID, "multiclass"),
    "ml_rf2": Learner("profile", "forest", _SMALL_FOREST, _TREE_GRID, "binary"),
    "ml_rf3": Learner("no_neutral", "forest", _LARGE_FOREST, _TREE_GRID, "multiclass"),
    "ml_lr": Learner("enriched", "logistic", {"maxIter": 10}, _LINEAR_GRID, "multiclass"),
    "ml_lr2": Learner("profile", "logistic", {"maxIter": 10}, _LINEAR_GRID, "binary"),
    "ml_lr3": Learner("no_neutral", "logistic", {"maxIter": 10}, _LINEAR_GRID, "binary"),
    "ml_gbt": Learner("profile", "boosted", _BOOSTED, _TREE_GRID, "binary"),
    "ml_gbt2": Learner("no_neutral", "boosted", _BOOSTED, _TREE_GRID, "multiclass"),
}


def evaluator(measure: str):
    return MulticlassClassificationEvaluator() if measure == "multiclass" else BinaryClassificationEvaluator()


def with_folds(vectors: DataFrame, folds: int) -> DataFrame:
    """Fold number from the key of the row, so a rerun has the same folds.

    Rows with equal vectors and different keys spread over the folds. Vectors
    without a key are told apart by their label and values alone.
    """
    keys = [c for c in ROW_KEYS if c in vectors.columns]
    unit = hash_unit(F.lit("fold"), *(keys or ["label", F.col("features").cast("string")]))
    return vectors.withColumn("fold", F.floor(unit * folds).cast("int"))


def cross_validate(
    vectors: DataFrame, learner: Learner, folds: int = FOLDS, parallelism: int = 4
):
    """Choose from the grid by k-fold cross-validation and fit the winner on all rows.

    Fits of small tables leave most cores idle, so fits of all folds run up to
    ``parallelism`` at once, fewer when the rows are many. Folds are read from
    ``vectors``, which are not copied per fold.
    """
    counted = "counts" in vectors.columns
    estimator = _MODELS[learner.model](**learner.settings)
    grid = ParamGridBuilder()
    for name, values in learner.grid.items():
        grid = grid.addGrid(estimator.getParam(name), values)
    settings, judge = grid.build(), evaluator(learner.measure)
    if counted:
        judge.setWeightCol("weight")
        # A fit adds a zero where its sample of numbers falls short, which needs a bin of its own.
        estimator.setWeightCol("weight").setMaxBins(2 * BINS)
        sums = [F.sum(F.col("counts")[f]).alias(str(f)) for f in range(folds)]
        sizes = {f: n or 0 for f, n in enumerate(vectors.agg(*sums).first())}
        held = vectors.count()
    else:
        vectors = vectors if "fold" in vectors.columns else with_folds(vectors, folds)
        sizes = dict(vectors.groupBy("fold").agg(F.count("*")).collect())
        held = sum(sizes.values())
    rows = sum(sizes.values())
    for fold in range(folds):
        if not 0 < sizes.get(fold, 0) < rows:
            raise ValueError(f"fold {fold} has no rows to train on or none to validate with")

    def part(fold: int, out: bool) -> DataFrame:
        """The rows of a fold, held out, or those of all others."""
        if counted:
            return weighed(vectors, [f for f in range(folds) if (f == fold) == out])
        return vectors.where(F.col("fold") == fold if out else F.col("fold") != fold)

    def held_out(task: tuple[int, int]) -> float:
        fold, k = task
        model = _fit(estimator, part(fold, False), settings[k])
        return judge.evaluate(model.transform(part(fold, True), settings[k]))

    tasks = [(fold, k) for fold in range(folds) for k in range(len(settings))]
    with ThreadPool(max(1, min(parallelism, ROWS_AT_ONCE // held))) as pool:
        found = pool.map(inheritable_thread_target(vectors.sparkSession)(held_out), tasks, chunksize=1)
    means = np.mean(np.reshape(found, (folds, len(settings))), axis=0)
    best = int(np.argmax(means) if judge.isLargerBetter() else np.argmin(means))
    whole = weighed(vectors, list(range(folds))) if counted else vectors
    return CrossValidatorModel(_fit(estimator, whole, settings[best]), means.tolist())


def weighed(vectors: DataFrame, folds: list[int]) -> DataFrame:
    """Counted vectors with the ``weight`` they have in some folds, and their draws for each tree."""

    def total(lists: F.Column) -> F.Column:
        return reduce(add, [lists[f] for f in folds]).cast("double")

    draws = [total(F.col(c)).alias(c) for c in vectors.columns if c.startswith("draw_")]
    return vectors.select("label", "features", total(F.col("counts")).alias("weight"), *draws).where(F.col("weight") > 0)


def _fit(estimator, rows: DataFrame, settings: dict):
    """Fit; a forest on counted rows grows each tree on its own draws, as the fit itself would draw a vector, not its rows."""
    draws = [c for c in rows.columns if c.startswith("draw_")]
    if not draws:
        return estimator.fit(rows, settings)
    forest = estimator.copy(settings)
    one = forest.copy().setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy("sqrt")
    grown = [
        one.copy().setWeightCol(c).setSeed(forest.getSeed() + k).fit(rows.where(F.col(c) > 0))
        for k, c in enumerate(draws)
    ]
    context = rows.sparkSession.sparkContext
    models = context._jvm.org.apache.spark.ml.classification
    trees = context._gateway.new_array(models.DecisionTreeClassificationModel, len(grown))
    for k, model in enumerate(grown):
        trees[k] = model._java_obj.trees()[0]
    joined = models.RandomForestClassificationModel(forest.uid, trees, grown[0].numFeatures, grown[0].numClasses)
    return forest._copyValues(RandomForestClassificationModel(joined))


def importances(model, names: list[str] | None = None) -> list[tuple[str, float]]:
    weights = model.featureImportances.toArray().tolist()
    names = names or [f"feature_{i}" for i in range(len(weights))]
    return list(zip(names, weights))


def _metrics(spark: SparkSession, rows: list[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame([(n, float(v)) for n, v in rows], "name string, value double")


def feature_names(vectors: DataFrame) -> list[str] | None:
    attributes = vectors.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    named = [a for group in attributes.values() for a in group]
    # Places of the sparse counts are known by their customer alone, as count columns are.
    names = [a.get("name", str(a["idx"])) for a in sorted(named, key=lambda a: a["idx"])]
    return [n.removeprefix("customerCounts_") for n in names] or None


def laid_out(vectors: DataFrame) -> DataFrame:
    """Fold or counts, label and features, cached in parts that suit their number.

    The vectors are written first, which counts them; a fit runs hundreds of
    short jobs over them, so small tables must not have many parts.
    """
    kept = [c for c in vectors.columns if c == "counts" or c.startswith("draw_")] or ["fold"]
    written = cut(vectors.select(*kept, "label", "features"))
    rows, cores = written.count(), written.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, math.ceil(rows / SMALL_PART)), math.ceil(rows / LARGE_PART))
    return written.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)


def train_and_report(
    vectors: DataFrame, learner: Learner, folds: int = FOLDS, parallelism: int = 4
) -> DataFrame:
    """Train one job; rows (name, value) with its measures and feature importances.

    ``held_out`` is the mean over the folds of the chosen setting, ``training``
    the measure on the rows the final model was fitted on.
    """
    counted = "counts" in vectors.columns
    vectors = laid_out(vectors if counted else with_folds(vectors, folds))
    try:
        found = cross_validate(vectors, learner, folds, parallelism)
        judge, whole = evaluator(learner.measure), vectors
        n = vectors.count()
        if counted:
            whole, judge = weighed(vectors, list(range(folds))), judge.setWeightCol("weight")
            n = whole.agg(F.sum("weight")).first()[0]
        best = max(found.avgMetrics) if judge.isLargerBetter() else min(found.avgMetrics)
        rows = [
            ("held_out", best),
            ("training", judge.evaluate(found.transform(whole))),
            ("rows", n),
        ]
        if hasattr(found.bestModel, "featureImportances"):
            rows += [
                (f"importance:{n}", w)
                for n, w in importances(found.bestModel, feature_names(vectors))
            ]
        return _metrics(vectors.sparkSession, rows)
    finally:
        vectors.unpersist()


def _svm() -> LinearSVC:
    return LinearSVC(maxIter=SVM_ITERATIONS, regParam=0.01)


def train_svm(vectors: DataFrame, balanced: bool = False) -> tuple[LinearSVCModel, DataFrame]:
    """Fit on a 65 % split; the confusion of the held-out rest, one row, comes with the model."""
    vectors = vectors.persist()
    try:
        train, test = hash_split(vectors, ["ip"])
        if balanced:
            train = hash_balance(train, ["ip"])
        model = _svm().fit(train)
        report = confusion(model.transform(test))
        return model, vectors.sparkSession.createDataFrame(report.collect(), report.schema)
    finally:
        vectors.unpersist()


def score_cohort(model: Transformer, vectors: DataFrame) -> DataFrame:
    """How many unlabelled rows a model puts above and below neutral."""
    return prediction_counts(model.transform(vectors))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_svm(path: str) -> LinearSVCModel:
    return LinearSVCModel.load(path)


def fit_logistic_formula(
    frame: DataFrame, formula: str, folds: int = FOLDS
) -> tuple[PipelineModel, DataFrame]:
    """Binomial regression from a formula: AIC, k-fold cost and R squared of the fit."""
    frame = frame.persist()
    try:
        glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="label")
        flow = Pipeline(stages=[RFormula(formula=formula), glm])
        cost = RegressionEvaluator(labelCol="label", metricName="mse")
        search = CrossValidator(
            estimator=flow,
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=cost,
            numFolds=folds,
            seed=SEED,
        ).fit(frame)
        model = search.bestModel
        r2 = RegressionEvaluator(labelCol="label", metricName="r2").evaluate(model.transform(frame))
        rows = [
            ("aic", model.stages[-1].summary.aic),
            ("cv_cost", search.avgMetrics[0]),
            ("r2", r2),
        ]
        return model, _metrics(frame.sparkSession, rows)
    finally:
        frame.unpersist()
