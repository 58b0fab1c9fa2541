"""Tree regressors: grids, cross-validation, comparison and choice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from math import ceil, sqrt
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from latebird.functions.bucket import fold
from latebird.operators.encoding import FEATURES
from latebird.operators.leaderboard import best_model, with_score
from latebird.operators.metrics import compare_predictions
from latebird.plans.fold_statistics import FOLD, FoldStatistics, fold_statistics
from latebird.plans.histograms import HistogramBoosting, HistogramForest, HistogramTree, shared_bins
from latebird.plans.nested import ParamPoint, SharedFit, shared_fits, with_predictions
from latebird.plans.recipes import DETAILED, Recipe
from latebird.schema import LABEL, PREDICTION
from latebird.session import drop_staged, shared_dir, stage_table, storage_bytes

DEFAULT_SEED = 89
#: Levels from which trees keep the rows' nodes.
DEEP = 8
#: Model rows that one task reads. What a fit keeps of a row, a number for each
#: slot of its vector and more, is many times what the row takes in its file.
ROWS_A_TASK = 200_000
#: Bytes that a fit keeps of a row: a binned number for each slot of its vector, and
#: the row's objects, label, weight and draws; and that an encoded row takes, by
#: category or numeric and besides. Estimates.
SLOT_BYTES, FIT_BYTES = 4, 180
VALUE_BYTES, ENCODED_BYTES = 12, 60
#: The part of the executors' storage that running fits may take.
STORAGE_SHARE = 0.8


def decision_tree(seed: int = DEFAULT_SEED, **params: Any) -> HistogramTree:
    return HistogramTree(labelCol=LABEL, featuresCol=FEATURES, seed=seed, **params)


def random_forest(seed: int = DEFAULT_SEED, **params: Any) -> HistogramForest:
    return HistogramForest(labelCol=LABEL, featuresCol=FEATURES, seed=seed, **params)


def boosted_trees(seed: int = DEFAULT_SEED, **params: Any) -> HistogramBoosting:
    return HistogramBoosting(labelCol=LABEL, featuresCol=FEATURES, seed=seed, **params)


REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "Decision Tree": decision_tree,
    "Random Forest": random_forest,
    "GBT": boosted_trees,
}

# The parameter grids, by size.
GRIDS: dict[str, dict[str, dict[str, list[int]]]] = {
    "single": {
        "Decision Tree": {"maxDepth": [5], "maxBins": [32]},
        "Random Forest": {"numTrees": [20], "maxDepth": [5]},
        "GBT": {"maxIter": [10], "maxDepth": [3]},
    },
    "exploratory": {
        "Decision Tree": {"maxDepth": [5, 10]},
        "Random Forest": {"numTrees": [20, 50], "maxDepth": [5, 10]},
        "GBT": {"maxIter": [10, 20], "maxDepth": [5]},
    },
    "full": {
        "Decision Tree": {"maxDepth": [5, 10], "maxBins": [32, 48]},
        "Random Forest": {"numTrees": [20, 50], "maxDepth": [5, 10]},
        "GBT": {"maxIter": [10, 20], "maxDepth": [3, 5]},
    },
}

def param_grid(estimator: Estimator, values: Mapping[str, Sequence[Any]]) -> list[ParamPoint]:
    """Every combination of the given parameter values."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder.addGrid(estimator.getParam(name), list(choices))
    return builder.build()


def recoverable(estimator: Estimator, grid: Sequence[ParamPoint] = ({},)) -> Estimator:
    """`estimator` set to keep what a lost executor costs small; its models are the same.

    Boosting carries each row's prediction from round to round. A checkpoint every
    square root of the rounds (of the longest point) bounds both the rounds to be
    made again and the checkpoints: 5 and 4 of 20 rounds. Trees of `DEEP` levels or
    more keep each row's node instead of walking it down from the root, with a
    checkpoint every square root of the levels; shallower ones have nothing to lose.
    Checkpoints go to the session's checkpoint folder (`shared_dir`).
    """

    def largest(name: str) -> int:
        param = estimator.getParam(name)
        return max(point.get(param, estimator.getOrDefault(param)) for point in grid)

    steps = largest("maxIter") if estimator.hasParam("maxIter") else largest("maxDepth")
    return estimator.copy(
        {
            estimator.checkpointInterval: max(2, ceil(sqrt(steps))),
            estimator.cacheNodeIds: largest("maxDepth") >= DEEP,
        }
    )


def describe_point(point: ParamPoint) -> dict[str, Any]:
    return {param.name: value for param, value in point.items()}


@dataclass(frozen=True)
class Candidate:
    """A regressor and the grid to search."""

    name: str
    estimator: Estimator
    grid: Sequence[ParamPoint] = field(default_factory=lambda: [{}])


def candidates(
    size: str = "single",
    seed: int = DEFAULT_SEED,
    names: Sequence[str] = tuple(REGRESSORS),
) -> list[Candidate]:
    made = []
    for name in names:
        estimator = REGRESSORS[name](seed=seed)
        grid = param_grid(estimator, GRIDS[size][name])
        made.append(Candidate(name, recoverable(estimator, grid), grid))
    return made


def cross_validator(
    estimator: Estimator,
    grid: Sequence[ParamPoint],
    *,
    folds: int = 3,
    seed: int = DEFAULT_SEED,
    parallelism: int = 1,
) -> CrossValidator:
    """Spark's own cross-validator by RMSE, over a whole pipeline or a bare
    regressor. `cross_validate` gives the same kind of result with less work."""
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=list(grid),
        evaluator=RegressionEvaluator(
            labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse"
        ),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )


def model_rows(flights: DataFrame, recipe: Recipe) -> DataFrame:
    """Flights after the recipe's row stages, with the columns a model needs."""
    rows = flights
    for stage in recipe.row_stages():
        rows = stage.transform(rows)
    return rows.select(*recipe.model_columns())


def with_fold(df: DataFrame, folds: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add a fold number made of all columns of the row. It stays the same when a
    task re-runs elsewhere, which a random draw over shuffled rows does not, and
    does not depend on the order of the columns."""
    return df.withColumn(FOLD, F.expr(fold(seed + 1, folds, sorted(df.columns))))


def stage_folds(
    flights: DataFrame, recipe: Recipe, folds: int, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, str]:
    """A recipe's model rows in the shared folder, parted by fold number, and their
    path: a filter on the fold skips the other folds' files."""
    return stage_table(with_fold(model_rows(flights, recipe), folds, seed), "folds", [FOLD], ROWS_A_TASK)


def _in_threads(
    spark: SparkSession, work: Callable[[Any], Any], items: Sequence[Any], threads: int
) -> list[Any]:
    """Run `work` on every item, at most `threads` at a time. The threads only
    submit Spark jobs; the cluster shares its cores among them."""
    if threads <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def runs_at_a_time(
    storage: int, rows: int, slots: int, values: int, folds: int, fits: int, cached: bool = True
) -> tuple[int, int]:
    """How many folds to run at a time, at most `folds`, and fits within each, at most
    `fits`, so that what they keep stays within the executors' `storage` bytes. Fits
    that run side by side beyond it push one another's rows out, and each pass of
    each fit then reads them from disk. One fold and one fit always run.

    A fold keeps its encoded rows of `values` categories and numerics (`cached`; else
    they are in the shared folder), and each fit in it `slots` numbers a row."""
    encoded = rows * (VALUE_BYTES * values + ENCODED_BYTES) if cached else 0
    one_fit = rows * (SLOT_BYTES * slots + FIT_BYTES)
    room = max(storage * STORAGE_SHARE, 1)
    while folds > 1 and folds * (encoded + fits * one_fit) > room:
        folds -= 1
    while fits > 1 and encoded + fits * one_fit > room:
        fits -= 1
    return folds, fits


def _fit_all(
    encoded: DataFrame, jobs: Sequence[tuple[Candidate, ParamPoint]], parallelism: int
) -> list[Model]:
    def fit(job: tuple[Candidate, ParamPoint]) -> Model:
        candidate, point = job
        return candidate.estimator.fit(encoded, point)

    return _in_threads(encoded.sparkSession, fit, jobs, parallelism)


def _measure(models: Mapping[str, Model], encoded: DataFrame) -> DataFrame:
    """Metrics of all models over one encoded table, in one pass."""
    columns = {name: f"prediction_{i}" for i, name in enumerate(models)}
    scored = encoded
    for name, model in models.items():
        scored = with_predictions(scored, model, {columns[name]: None})
    return compare_predictions(scored, columns)


def _all_fits(tried: Sequence[Candidate], nested: bool) -> list[tuple[Candidate, SharedFit]]:
    """The fits that serve all candidates' points, which are numbered throughout."""
    fits, first = [], 0
    for candidate in tried:
        found = (
            shared_fits(candidate.estimator, candidate.grid)
            if nested
            else [SharedFit(point, {i: None}) for i, point in enumerate(candidate.grid)]
        )
        for fit in found:
            fits.append((candidate, SharedFit(fit.point, {first + i: part for i, part in fit.serves.items()})))
        first += len(candidate.grid)
    return fits


def _measure_points(models: Sequence[Model], fits: Sequence[SharedFit], encoded: DataFrame) -> DataFrame:
    """Metrics of all grid points that the fits serve, in their order, in one pass."""
    scored = encoded
    for model, fit in zip(models, fits):
        scored = with_predictions(scored, model, {f"prediction_{i}": part for i, part in fit.serves.items()})
    numbers = sorted(i for fit in fits for i in fit.serves)
    return compare_predictions(scored, {str(i): f"prediction_{i}" for i in numbers}).orderBy("order_no")


@dataclass(frozen=True)
class GridResult:
    """A grid point's mean over the folds."""

    candidate: Candidate
    point: ParamPoint
    rmse: float
    mae: float


def _encode(encoder: PipelineModel | None, rows: DataFrame) -> DataFrame:
    """Labels and features; without an encoder, of rows that are encoded already."""
    return (rows if encoder is None else encoder.transform(rows)).select(LABEL, FEATURES)


def stage_encoded(rows: DataFrame, encoder: PipelineModel) -> tuple[DataFrame, str]:
    """Rows of `stage_folds` encoded once, in the shared folder and parted by fold, and
    their path: each fold then reads its vectors instead of making them."""
    encoded = encoder.transform(rows).select(LABEL, FEATURES, FOLD)
    return stage_table(encoded, "encoded", [FOLD], ROWS_A_TASK)


@contextmanager
def _kept(
    rows: DataFrame, encoder: PipelineModel | None, storage: StorageLevel | None, estimators: Sequence[Estimator] = ()
) -> Iterator[DataFrame]:
    """Encoded rows kept for the passes of a fit: by Spark's storage, or, where
    `storage` is None, in the shared folder, which costs a write and holds nothing
    on the executors. Fits from histograms share the blocks they make of the rows
    instead, and the rows themselves are not kept."""
    encoded = _encode(encoder, rows)
    if estimators and all(isinstance(e, (HistogramTree, HistogramForest, HistogramBoosting)) for e in estimators):
        with shared_bins(encoded, storage, made_of=None if encoder is None else (rows, encoder)):
            yield encoded
    elif storage is None:
        table, path = stage_table(encoded, "encoded", rows=ROWS_A_TASK)
        try:
            yield table
        finally:
            drop_staged(encoded.sparkSession, path)
    else:
        encoded.persist(storage)
        try:
            yield encoded
        finally:
            encoded.unpersist()


def _within_storage(
    rows: DataFrame,
    recipe: Recipe,
    encoder: PipelineModel | None,
    parallel_folds: int,
    parallelism: int,
    storage: StorageLevel | None,
    folds: int | None = None,
) -> tuple[int, int]:
    """`runs_at_a_time` for fits on `rows`, or, with `folds`, on all folds but one."""
    if parallel_folds <= 1 and parallelism <= 1:
        return parallel_folds, parallelism
    n = rows.count()  # a staged table: read from the footers
    if folds is not None and folds > 1:
        n = n * (folds - 1) // folds
    values = len(recipe.categories) + len(recipe.numerics)
    return runs_at_a_time(
        storage_bytes(rows.sparkSession), n, _slots(rows, encoder), values, parallel_folds, parallelism, storage is not None
    )


def _slots(rows: DataFrame, encoder: PipelineModel | None) -> int:
    """The length of the feature vector, as the encoded table's schema tells it."""
    encoded = _encode(encoder, rows)
    return encoded.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs", 0)


def fit_encoder(rows: DataFrame, recipe: Recipe) -> PipelineModel:
    """Fit a recipe's encoder; `rows` should be a stored table, since each
    learning stage reads it once."""
    return Pipeline(stages=recipe.encoder_stages()).fit(rows)


def cross_validate(
    rows: DataFrame,
    recipe: Recipe,
    tried: Sequence[Candidate],
    *,
    folds: int = 3,
    parallelism: int = 1,
    parallel_folds: int = 1,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    prefitted: PipelineModel | None = None,
    statistics: FoldStatistics | None = None,
    nested: bool = True,
) -> list[GridResult]:
    """k-fold cross-validation of several regressors at once.

    `rows` comes from `model_rows` and carries a fold number. What the encoders
    learn comes from `statistics`, collected in one pass for all folds (here, if
    not given), so that each fold's encoder has seen that fold's training rows
    only, without a pass of its own. It is shared by all regressors and grid
    points; all of them are then measured in one pass over the held-out rows.
    Whole-pipeline cross-validation gives the same metrics but fits the encoder
    once per regressor, grid point and fold.

    Points that one fit serves (`plans/nested.py`) are fitted once; `nested=False`
    fits each by itself.

    With `prefitted`, an encoder fitted beforehand is used in every fold and only
    the regressors are fitted: cheaper, but held-out rows have then had a part in
    the encoding. The same holds for rows that carry their features already
    (`stage_encoded`); these are not encoded again in any fold.

    `parallelism` is the most fits running at a time within a fold, and
    `parallel_folds` the most folds; each running fold keeps its encoded rows, and
    each fit their binned form. Fewer run at a time where the executors' storage
    would not take that (`runs_at_a_time`). With `storage=None` encoded rows go to
    the shared folder.
    """
    jobs = [(candidate, point) for candidate in tried for point in candidate.grid]
    fits = _all_fits(tried, nested)
    encoded_already = FEATURES in rows.columns

    def encoder_of(number: int) -> PipelineModel | None:
        return None if encoded_already else prefitted or statistics.encoder(number)

    if prefitted is None and statistics is None and not encoded_already:
        statistics = fold_statistics(rows, recipe, folds)
    parallel_folds, parallelism = _within_storage(
        rows, recipe, encoder_of(0), parallel_folds, parallelism, storage, folds
    )

    def one_fold(number: int) -> list[tuple[float, float]]:
        encoder = encoder_of(number)
        estimators = [c.estimator for c in tried]
        with _kept(rows.where(F.col(FOLD) != number), encoder, storage, estimators) as encoded:
            models = _fit_all(encoded, [(c, f.point) for c, f in fits], parallelism)
        held_out = _encode(encoder, rows.where(F.col(FOLD) == number))
        measured = _measure_points(models, [f for _, f in fits], held_out)
        return [(r["rmse"], r["mae"]) for r in measured.collect()]

    measured = _in_threads(rows.sparkSession, one_fold, range(folds), parallel_folds)
    results = []
    for (candidate, point), by_fold in zip(jobs, zip(*measured)):
        mean_rmse, mean_mae = (sum(values) / folds for values in zip(*by_fold))
        results.append(GridResult(candidate, point, mean_rmse, mean_mae))
    return results


def grid_report(spark: SparkSession, results: Sequence[GridResult]) -> DataFrame:
    """Rows (name, point_no, params, rmse, mae), one per grid point."""
    seen: dict[str, int] = {}
    records = []
    for result in results:
        number = seen[result.candidate.name] = seen.get(result.candidate.name, -1) + 1
        params = ", ".join(f"{k}={v}" for k, v in describe_point(result.point).items())
        records.append((result.candidate.name, number, params, result.rmse, result.mae))
    return spark.createDataFrame(
        records, "name string, point_no int, params string, rmse double, mae double"
    )


def best_points(results: Sequence[GridResult]) -> list[GridResult]:
    """Each candidate's grid point with the lowest mean RMSE."""
    best: dict[str, GridResult] = {}
    for result in results:
        current = best.get(result.candidate.name)
        if current is None or result.rmse < current.rmse:
            best[result.candidate.name] = result
    return list(best.values())


def scoring_pipeline(recipe: Recipe, encoder: PipelineModel, model: Model) -> PipelineModel:
    """Raw flights to predictions. Flights without a label are scored too."""
    return PipelineModel(recipe.row_stages(require_label=False) + encoder.stages + [model])


def train_models(
    flights: DataFrame,
    estimators: Sequence[Estimator],
    recipe: Recipe = DETAILED,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> list[PipelineModel]:
    """Fit regressors on the same flights, one after the other, and return the whole
    pipeline of each from raw flights on.

    The same as fitting `recipe.workflow(estimator)`, but the source is read,
    the row stages run and the encoder is fitted once, instead of once per regressor
    and pass of a fit. The staged rows and, with `recoverable` estimators,
    checkpoints bound what is made again when an executor is lost.
    """
    spark = flights.sparkSession
    rows, path = stage_table(model_rows(flights, recipe), "train", rows=ROWS_A_TASK)
    try:
        encoder = fit_encoder(rows, recipe)
        with _kept(rows, encoder, storage, estimators) as encoded:
            models = [estimator.fit(encoded) for estimator in estimators]
    finally:
        drop_staged(spark, path)
    return [scoring_pipeline(recipe, encoder, model) for model in models]


def train_model(
    flights: DataFrame,
    estimator: Estimator,
    recipe: Recipe = DETAILED,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> PipelineModel:
    """`train_models` of one regressor."""
    return train_models(flights, [estimator], recipe, storage)[0]


@dataclass(frozen=True)
class Comparison:
    """Outcome of `compare_models`."""

    leaderboard: DataFrame
    grid: DataFrame
    models: Mapping[str, PipelineModel]

    def best(self) -> tuple[str, PipelineModel]:
        name = best_model(self.leaderboard).first()["name"]
        return name, self.models[name]


def compare_models(
    train: DataFrame,
    test: DataFrame,
    recipe: Recipe = DETAILED,
    tried: Sequence[Candidate] | None = None,
    *,
    folds: int = 3,
    seed: int = DEFAULT_SEED,
    parallelism: int = 1,
    parallel_folds: int = 1,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> Comparison:
    """Cross-validate every candidate, refit each at its best grid point on all
    training rows, measure it on the test rows and apply the score rule.

    The row stages run once; the folds, the refit and the passes inside each
    fit read their narrow result from the shared folder, where it is parted by
    fold, so that a fold reads its own files only. All folds' encoders and the
    last one come from one pass over it, whatever the number of candidates.
    """
    spark = train.sparkSession
    shared_dir(spark)
    tried = candidates(seed=seed) if tried is None else tried
    rows, path = stage_folds(train, recipe, folds, seed)
    try:
        statistics = fold_statistics(rows, recipe, folds)
        results = cross_validate(
            rows,
            recipe,
            tried,
            folds=folds,
            parallelism=parallelism,
            parallel_folds=parallel_folds,
            storage=storage,
            statistics=statistics,
        )
        chosen = best_points(results)
        encoder = statistics.encoder()
        _, parallelism = _within_storage(rows, recipe, encoder, 1, parallelism, storage)
        with _kept(rows, encoder, storage, [c.candidate.estimator for c in chosen]) as encoded:
            fitted = _fit_all(encoded, [(c.candidate, c.point) for c in chosen], parallelism)
    finally:
        drop_staged(spark, path)

    models = {c.candidate.name: m for c, m in zip(chosen, fitted)}
    measured = _measure(models, _encode(encoder, model_rows(test, recipe)))
    # One row per candidate: kept as values, so that reading the leaderboard
    # does not score the test rows again.
    leaderboard = with_score(spark.createDataFrame(measured.collect(), measured.schema))
    return Comparison(
        leaderboard=leaderboard,
        grid=grid_report(spark, results),
        models={
            name: scoring_pipeline(recipe, encoder, model)
            for name, model in models.items()
        },
    )
