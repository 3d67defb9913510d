"""Selection, refit and prediction of a boosted-tree model on Spark ML.

Candidates are fitted on train rows only and judged on validation rows. The
winner is refitted on train + validation with its round count locked; test rows
are scored once, by that refit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.feature import Bucketizer, OneHotEncoder, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.quantiles import exact_quantiles
from hourgrid.functions.scoring import absolute_error, clip_at_zero, rounded
from hourgrid.operators.boosting import BINS, Boosting
from hourgrid.operators.features import training_rows
from hourgrid.operators.metrics import forecast_metrics
from hourgrid.schemas import (
    FIT_SCOPES,
    HISTORY_FEATURES,
    KEY,
    MODEL_PREDICTIONS,
    NUMERIC_FEATURES,
    SPLIT_NAMES,
)
from hourgrid.session import cut_lineage, shuffle_partitions

# Histogram bins and the boosting budget.
MAX_BINS = BINS
MAX_ROUNDS = 500
PATIENCE = 30
SEED = 42
MAX_CANDIDATES = 3
# Zones are told apart by the digits of their ids to the base of MAX_BINS; ids are
# ints, so five digits are enough for any of them.
ZONE_DIGITS = 5
LOWEST_ZONE = -(2**31)
# Rounds that are fitted between two looks at the validation error.
BLOCK_ROUNDS = 32


@dataclass(frozen=True)
class Candidate:
    name: str
    max_depth: int
    step_size: float
    min_rows_per_leaf: int = 5
    row_rate: float = 0.8
    feature_rate: float = 0.8


# The two candidates.
CANDIDATES = (
    Candidate("depth4", max_depth=4, step_size=0.08),
    Candidate("depth6", max_depth=6, step_size=0.05),
)


CANDIDATE_REPORT = (
    "candidate_name string, boost_rounds int, scored_rows long, mae double, wape double, "
    "is_selected boolean"
)


@dataclass(frozen=True)
class Selection:
    candidate: Candidate
    rounds: int
    metrics: DataFrame
    validation_predictions: DataFrame


Cuts = dict[str, list[float]]


def learn_cuts(features: DataFrame) -> Cuts:
    """Bounds of the bins of each history feature: exact quantiles of eligible train rows.

    No target is seen. Repeated quantiles fall together, so there are MAX_BINS bins
    at most; features of the calendar are their own bins.
    """
    rows = training_rows(features, "train")
    values = rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value"))
                    for name in HISTORY_FEATURES
                ]
            )
        )
    )
    shares = tuple(k / MAX_BINS for k in range(1, MAX_BINS))
    found = exact_quantiles(values, "value", shares, ("feature",)).collect()
    cuts = {name: {r.quantile for r in found if r.feature == name} for name in HISTORY_FEATURES}
    return {name: sorted(bounds or {0.0}) for name, bounds in cuts.items()}


def zone_digits() -> dict[str, Column]:
    """Digits of zone_id as nominal columns: the same number of columns for any zones.

    Different ids differ in a digit, so trees can tell any two zones apart.
    """
    code = F.col("zone_id").cast("long") - LOWEST_ZONE
    digits = {}
    for place in range(ZONE_DIGITS):
        name = f"zone_digit_{place}"
        nominal = {"ml_attr": {"type": "nominal", "name": name, "num_vals": MAX_BINS}}
        digit = F.floor(code / F.lit(MAX_BINS**place)) % MAX_BINS
        digits[name] = digit.cast("double").alias(name, metadata=nominal)
    return digits


def with_vectors(rows: DataFrame, cuts: Cuts, one_hot: bool = False) -> DataFrame:
    """Rows with their feature vector: the zone's digits, then the numeric features.

    Each digit is a nominal column, which trees split into two sets of values; for
    squared loss the best such split is found among values ordered by their mean. With
    one_hot each digit is MAX_BINS indicator columns. History features are given by
    their bins, so the cuts that trees choose from do not depend on the rows fitted.
    """
    rows = rows.where(F.col("zone_id").isNotNull()).withColumns(zone_digits())
    zone = [f"zone_digit_{place}" for place in range(ZONE_DIGITS)]
    if one_hot:
        names = [f"{name}_onehot" for name in zone]
        encoder = OneHotEncoder(inputCols=zone, outputCols=names, dropLast=False)
        rows, zone = encoder.fit(rows).transform(rows), names
    infinity = float("inf")
    binned = Bucketizer(
        inputCols=list(HISTORY_FEATURES),
        outputCols=[f"{name}_bin" for name in HISTORY_FEATURES],
        splitsArray=[[-infinity, *cuts[name], infinity] for name in HISTORY_FEATURES],
    )
    numeric = [f"{n}_bin" if n in HISTORY_FEATURES else n for n in NUMERIC_FEATURES]
    rows = binned.transform(rows)
    for name in HISTORY_FEATURES:  # bins are ordered, not nominal
        rows = rows.withMetadata(f"{name}_bin", {"ml_attr": {"type": "numeric"}})
    assembler = VectorAssembler(
        inputCols=[*zone, *numeric], outputCol="features", handleInvalid="error"
    )
    return assembler.transform(rows)


def check_split_labels(features: DataFrame) -> None:
    """The split labels must be exactly train, validation and test."""
    other = features.where(
        F.col("split").isNull() | ~F.col("split").isin(*SPLIT_NAMES)
    )
    present = [not features.where(F.col("split") == n).isEmpty() for n in SPLIT_NAMES]
    if not all(present) or not other.isEmpty():
        raise ContractError("split labels are missing or unknown")


def prepare(
    features: DataFrame, cuts: Cuts | None = None, one_hot: bool = False
) -> DataFrame:
    """Eligible rows of all splits with their feature vector, written out once.

    Rows are spread by key: time-ordered files would leave the train rows in a
    few partitions. The order inside a partition is fixed, so that row sampling
    repeats from run to run on the same number of partitions. Without cuts they are
    learned from the train rows first.
    """
    partitions = shuffle_partitions(features.sparkSession)
    rows = training_rows(features, *SPLIT_NAMES)
    rows = rows.repartition(partitions, *KEY).sortWithinPartitions(*KEY)
    if cuts is None:
        rows = cut_lineage(rows)
        cuts = learn_cuts(rows)
    return cut_lineage(
        with_vectors(rows, cuts, one_hot).select(
            *KEY,
            "split",
            F.col("target_trip_count").alias("actual_trip_count"),
            F.col("target_trip_count").cast("double").alias("label"),
            "features",
        )
    )


def regressor(candidate: Candidate, rounds: int, seed: int = SEED) -> Boosting:
    return Boosting(
        rounds,
        candidate.max_depth,
        candidate.step_size,
        candidate.min_rows_per_leaf,
        candidate.row_rate,
        candidate.feature_rate,
        seed,
    )


def best_round(errors: list[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the first best one before patience runs out."""
    best = 0
    for index, error in enumerate(errors):
        if error < errors[best]:
            best = index
        elif index - best >= patience:
            break
    return best + 1


@dataclass
class Growth:
    """A growing ensemble: its trees with their weights, and what they leave of the label.

    Trees are added in blocks. A block is a fit on the residual, whose first tree counts
    fully and the others by the step size; a tree that was added is never fitted again.
    The residual is written to the checkpoint folder after each block. A tree's seed
    depends on its place in the whole ensemble alone, so a shorter block is the beginning
    of a longer one.
    """

    candidate: Candidate
    rows: DataFrame
    seed: int = SEED
    block: int = BLOCK_ROUNDS
    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    last: GBTRegressionModel | None = None
    taken_off: bool = True

    def following(self, rounds: int) -> GBTRegressionModel:
        """The next trees, at most a block; they are not added."""
        if not self.taken_off:
            self.rows, self.taken_off = left_over(self.rows, self.last), True
        rounds = min(rounds, self.block)
        return regressor(self.candidate, rounds, self.seed + len(self.trees)).fit(self.rows)

    def grow(self, rounds: int) -> GBTRegressionModel:
        """Add trees, at most a block, and return the block that was added."""
        self.last, self.taken_off = self.following(rounds), False
        self.trees += list(self.last._java_obj.trees())
        self.weights += self.last.treeWeights
        return self.last

    def model(self, rounds: int) -> GBTRegressionModel:
        """The ensemble of the first trees as one model."""
        context = SparkContext._active_spark_context
        package = context._jvm.org.apache.spark.ml.regression
        trees = context._gateway.new_array(package.DecisionTreeRegressionModel, rounds)
        weights = context._gateway.new_array(context._jvm.double, rounds)
        for k in range(rounds):
            trees[k], weights[k] = self.trees[k], self.weights[k]
        java = package.GBTRegressionModel(self.last.uid, trees, weights, self.last.numFeatures)
        return GBTRegressionModel(java).setFeaturesCol("features").setPredictionCol("prediction_raw")


def left_over(rows: DataFrame, block: GBTRegressionModel) -> DataFrame:
    """Rows whose label is what a block of trees leaves of it, written out."""
    scored = block.transform(rows)
    return cut_lineage(
        scored.withColumn("label", F.col("label") - F.col("prediction_raw")).select(*rows.columns)
    )


def fit_rounds(
    rows: DataFrame, candidate: Candidate, rounds: int, seed: int = SEED,
    block_rounds: int = BLOCK_ROUNDS,
) -> Growth:
    """An ensemble of a fixed number of trees."""
    growth = Growth(candidate, rows, seed, block_rounds)
    while len(growth.trees) < rounds:
        growth.grow(rounds - len(growth.trees))
    return growth


def fit_candidate(
    train: DataFrame, validation: DataFrame, candidate: Candidate, max_rounds: int,
    patience: int, seed: int, block_rounds: int = BLOCK_ROUNDS,
) -> tuple[GBTRegressionModel, int]:
    """Fit on train until validation MAE has not improved for `patience` rounds.

    The ensemble grows block by block; the errors of a block's rounds are those of its
    trees on what the blocks before it left of the validation labels. The model is the
    ensemble's first trees up to the best round. If patience is half spent and the rest of
    it is half a block at most, those rounds are tried first: without a better one among
    them the whole block would change nothing, else it is fitted in full.
    """
    growth, errors, best = Growth(candidate, train, seed, block_rounds), [], 0
    while True:
        patient = best + patience - len(errors)
        whole = min(block_rounds, max_rounds - len(errors))
        if errors and 2 * patient <= min(patience, whole):
            tried = growth.following(patient).evaluateEachIteration(validation, "absolute")
            if best_round(errors + tried, patience) == best:
                return growth.model(best), best
        block = growth.grow(max_rounds - len(errors))
        errors += block.evaluateEachIteration(validation, "absolute")
        best = best_round(errors, patience)
        if len(errors) == max_rounds or best + patience <= len(errors):
            return growth.model(best), best
        validation = left_over(validation, block)


def predict(
    model: GBTRegressionModel, rows: DataFrame, candidate: Candidate, split: str
) -> DataFrame:
    """Prediction table of one split, labelled with the scope its model was fitted on."""
    scored = model.transform(rows.where(F.col("split") == split))
    clipped = clip_at_zero(F.col("prediction_raw"))
    return scored.withColumns(
        {
            "prediction": clipped,
            "absolute_error": absolute_error(F.col("actual_trip_count"), clipped),
            "candidate_name": F.lit(candidate.name),
            "fit_scope": F.lit(FIT_SCOPES[split]),
        }
    ).select(*MODEL_PREDICTIONS.names)


def has_history(prepared: DataFrame) -> bool:
    """Whether both splits that selection reads have eligible rows."""
    return all(
        not prepared.where(F.col("split") == name).isEmpty() for name in ("train", "validation")
    )


def choose(metrics: DataFrame) -> DataFrame:
    """The candidate with the lowest MAE, then WAPE (unknown last), then name."""
    return metrics.orderBy("mae", F.asc_nulls_last("wape"), "candidate_name").limit(1)


def select_candidate(
    prepared: DataFrame,
    candidates: tuple[Candidate, ...] = CANDIDATES,
    max_rounds: int = MAX_ROUNDS,
    patience: int = PATIENCE,
    seed: int = SEED,
) -> Selection:
    """Fit every candidate and choose on validation rows; test rows are never read."""
    names = [candidate.name for candidate in candidates]
    if not 1 <= len(names) <= MAX_CANDIDATES or len(set(names)) != len(names):
        raise ParameterError(f"give 1 to {MAX_CANDIDATES} candidates with distinct names")
    train = prepared.where(F.col("split") == "train")
    validation = prepared.where(F.col("split") == "validation")
    for name, rows in (("train", train), ("validation", validation)):
        if rows.isEmpty():
            raise ContractError(f"split {name} has no eligible rows")
    metrics, tables, rounds = None, {}, {}

    def fitted(candidate: Candidate) -> tuple[GBTRegressionModel, int]:
        return fit_candidate(train, validation, candidate, max_rounds, patience, seed)

    # Jobs of a level are short, so candidates that are fitted side by side share the cores.
    with ThreadPoolExecutor(len(candidates)) as pool:
        fits = list(pool.map(inheritable_thread_target(prepared.sparkSession)(fitted), candidates))
    for candidate, (model, kept) in zip(candidates, fits, strict=True):
        table = predict(model, prepared, candidate, "validation")
        row = forecast_metrics(table, "candidate_name").withColumn(
            "boost_rounds", F.lit(kept)
        )
        metrics = row if metrics is None else metrics.unionByName(row)
        tables[candidate.name], rounds[candidate.name] = table, kept
    metrics = cut_lineage(metrics)
    winner = choose(metrics).first()
    if winner is None:
        raise ContractError("no candidate has validation metrics")
    chosen = next(c for c in candidates if c.name == winner.candidate_name)
    return Selection(chosen, rounds[chosen.name], metrics, tables[chosen.name])


def refit(
    prepared: DataFrame, candidate: Candidate, rounds: int, seed: int = SEED
) -> GBTRegressionModel:
    """Fit the chosen candidate on train + validation, rounds locked."""
    rows = prepared.where(F.col("split").isin("train", "validation"))
    return fit_rounds(rows, candidate, rounds, seed).model(rounds)


def model_predictions(
    prepared: DataFrame, selection: Selection, seed: int = SEED
) -> tuple[DataFrame, GBTRegressionModel]:
    """Validation rows by the train-only fit and test rows by the refit."""
    final = refit(prepared, selection.candidate, selection.rounds, seed)
    test = predict(final, prepared, selection.candidate, "test")
    return selection.validation_predictions.unionByName(test), final


def candidate_report(selection: Selection) -> DataFrame:
    """Validation metrics per candidate and which one was selected; no test figures."""
    return selection.metrics.select(
        "candidate_name",
        "boost_rounds",
        "scored_rows",
        rounded(F.col("mae")).alias("mae"),
        rounded(F.col("wape")).alias("wape"),
        (F.col("candidate_name") == selection.candidate.name).alias("is_selected"),
    )


def check_isolation(report: DataFrame, final_rounds: int) -> None:
    """Candidate reports carry no test metrics; one is selected, with the final rounds."""
    if any("test" in name for name in report.columns):
        raise ContractError("the candidate report names a test column")
    selected = report.where("is_selected").take(2)
    if len(selected) != 1 or selected[0].boost_rounds != final_rounds:
        raise ContractError("selected candidate and final fit disagree")
