"""The whole backtest as a chain of written tables.

Every stage reads the table the stage before has written, so a lost executor
costs at most the stage in flight. Raw events are read once, into cells with
mergeable states from which the profile and the counts are folded, and once more
for the manifest, of which only changed files are read again.

A run writes to a folder of its own. Only when all stages are done and all
contracts hold is one record added that names the versions of all its tables.
Readers take the last complete record: they see one run or another, never parts of
two, and a broken contract in any stage leaves them on the run before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.calendar import LocalWindow
from hourgrid.operators import classify, compare, counts, features, grid, metrics, model, profile
from hourgrid.operators.baseline import SEASONAL_LAG_HOURS, seasonal_naive
from hourgrid.operators.integrity import file_manifest, folded, manifest, manifest_check
from hourgrid.operators.serve import SERVED, ForecastStore, predictions_to_serve
from hourgrid.operators.splits import Splits, assign_splits, check_splits
from hourgrid.schemas import (
    BASELINE_PREDICTIONS,
    FEATURES,
    GRID,
    MODEL_PREDICTIONS,
    OBSERVED,
)
from hourgrid.session import configure, cut_lineage
from hourgrid.sources.contracts import (
    assert_fields,
    assert_schema,
    require_rows,
    required_columns,
)
from hourgrid.sources.tables import (
    check_written,
    nested_report,
    read_table,
    write_report,
    write_sorted,
)

TABLES = ("counts", "grid", "baseline", "features", "model_predictions", "served")
# What a committed run also has: tables that stages leave to later ones, and its manifest.
EXTRAS = ("states", "cells", "comparison", "model", "metrics/baseline", "metrics/model", "manifest")
COMMIT = "sequence long, run string, committed_at timestamp, tables map<string,string>"


def new_run() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class BacktestConfig:
    """Parameters of one run. month_col names the source month of multi-month events."""

    window: LocalWindow
    splits: Splits
    ts_col: str = "pickup_ts"
    zone_col: str = "zone_raw"
    month_col: str | None = None
    special: classify.SpecialValues = field(default_factory=lambda: dict(classify.SPECIAL))
    lag_hours: int = SEASONAL_LAG_HOURS
    top_n: int = 10
    candidates: tuple[model.Candidate, ...] = model.CANDIDATES
    max_rounds: int = model.MAX_ROUNDS
    patience: int = model.PATIENCE
    seed: int = model.SEED


@dataclass(frozen=True)
class Backtest:
    """One run: raw events and a lookup in, tables and reports under out.

    event_files are the paths events was read from, if it was; the manifest then
    knows their files one by one. Stages called by themselves work on what this run
    has written, and on the committed run where it has written nothing.
    """

    spark: SparkSession
    events: DataFrame
    lookup: DataFrame
    config: BacktestConfig
    out: str
    event_files: tuple[str, ...] = ()
    run_id: str = field(default_factory=new_run)
    written: dict[str, str] = field(default_factory=dict)

    def fresh(self) -> Backtest:
        """The same backtest as a run that has written nothing yet."""
        return replace(self, run_id=new_run(), written={})

    def path(self, name: str) -> str:
        """Where this run writes."""
        return f"{self.out}/runs/{self.run_id}/{name}"

    def report(self, name: str, sections: dict[str, DataFrame]) -> None:
        write_report(nested_report(sections), self.path(f"reports/{name}"))

    def _own(self, name: str) -> str:
        """A path for a table of this run; a second version gets a name of its own."""
        path = self.path(name)
        return path if name not in self.written else f"{path}-{uuid.uuid4().hex}"

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table that later stages read."""
        path = self._own(name)
        df.write.option("compression", "zstd").parquet(path)
        self.written[name] = path
        return self.spark.read.parquet(path)

    def _store(
        self,
        df: DataFrame,
        name: str,
        schema,
        partition_by: str | None = None,
        check: Callable[[DataFrame], object] | None = None,
    ) -> DataFrame:
        """Write a stage table and check it; later stages read it only if it passed."""
        assert_schema(df, schema)
        path = self._own(name)
        rows = write_sorted(df, path, partition_by)
        table = check_written(self.spark, path, schema, rows)
        if check is not None:
            check(table)
        self.written[name] = path
        return table

    def commits(self) -> DataFrame:
        """Records of complete runs. A record is one file, which its writer's commit moves in whole."""
        folder = f"{self.out}/commits"
        try:
            return self.spark.read.schema(COMMIT).json(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT)

    def committed(self) -> Row | None:
        """The last complete run, if there is one."""
        return self.commits().orderBy(F.desc("sequence"), "run").first()

    def commit(self) -> None:
        """Make this run, whole, the one that readers see."""
        missing = [name for name in (*TABLES, *EXTRAS) if name not in self.written]
        if missing:
            raise ContractError(f"the run has not written {', '.join(missing)}")
        last = self.committed()
        record = self.spark.range(1).select(
            F.lit((last.sequence if last else 0) + 1).cast("long").alias("sequence"),
            F.lit(self.run_id).alias("run"),
            F.current_timestamp().alias("committed_at"),
            F.create_map(*[F.lit(x) for pair in self.written.items() for x in pair]).alias("tables"),
        )
        record.coalesce(1).write.mode("append").json(f"{self.out}/commits")

    def current(self, name: str) -> str:
        """Path of a table: this run's if it has written it, else the committed one's."""
        if name in self.written:
            return self.written[name]
        last = self.committed()
        if last is None or name not in last.tables:
            raise ContractError(f"neither this run nor a committed one has a table {name}")
        return last.tables[name]

    def table(self, name: str, schema) -> DataFrame:
        return read_table(self.spark, self.current(name), schema=schema)

    def kept(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.current(name))

    # -- stages -------------------------------------------------------------

    def scan(self) -> DataFrame:
        """The pass over raw events: cells with their counts and first and last times."""
        c = self.config
        names = [c.ts_col, c.zone_col, *([c.month_col] if c.month_col else [])]
        required_columns(self.events, names)
        states = self._keep(
            "states",
            profile.raw_states(self.events, c.window, c.ts_col, c.zone_col, c.month_col),
        )
        return require_rows(states)

    def profile(self) -> None:
        c = self.config
        states = self.kept("states")
        zones = profile.zones_of_states(states, self.lookup, c.window, c.special)
        hourly = profile.hours_of_states(states, c.window)
        self.report(
            "profile",
            {
                "raw": profile.profile_of_states(states, c.window),
                "zones": profile.zone_profile(zones),
                "coverage": profile.coverage_summary(hourly, c.window),
            },
        )
        write_report(profile.missing_hours(hourly, c.window), self.path("reports/missing_hours"))
        write_report(profile.invalid_zones(zones), self.path("reports/invalid_zones"))

    def aggregate(self) -> DataFrame:
        """Labelled cells, then observed counts."""
        c = self.config
        grid.check_lookup(self.lookup)
        cells = self._keep(
            "cells",
            classify.label_cells(
                profile.time_cells_of_states(self.kept("states")), self.lookup, c.special
            ),
        )
        observed = self._store(
            counts.hourly_counts(cells),
            "counts",
            OBSERVED,
            "source_month",
            lambda written: counts.check_counts(written, cells),
        )
        self.report(
            "aggregate",
            {
                "dispositions": classify.disposition_counts(cells),
                "months": classify.monthly_totals(cells),
                "output": counts.counts_summary(observed),
            },
        )
        return observed

    def cells(self) -> DataFrame:
        return self.kept("cells")

    def complete(self) -> DataFrame:
        c = self.config
        self.recount()
        coverage = grid.coverage_status(counts.source_activity(self.cells()), c.window)
        full = grid.complete_grid(
            grid.service_entities(self.lookup, c.special),
            coverage,
            self.table("counts", OBSERVED),
            c.window,
            month_of_hour=True,
        )
        written = self._store(
            full,
            "grid",
            GRID,
            "source_month",
            lambda table: grid.check_grid(table, c.window.utc_start, c.window.utc_end),
        )
        self.report("grid", {"summary": grid.grid_summary(written)})
        write_report(grid.uncovered_hours(coverage), self.path("reports/uncovered_hours"))
        return written

    def recount(self) -> None:
        """The stored counts must be those of the cells, row by row."""
        stored = self.table("counts", OBSERVED)
        again = counts.hourly_counts(self.cells()).select(*stored.columns)
        if grid.bag_diff_rows(stored, again).first()[0]:
            raise ContractError("stored counts differ from a recount of the cells")

    def _assigned(self) -> DataFrame:
        c = self.config
        whole = self.table("grid", GRID)
        grid.check_grid(whole, c.splits.start, c.splits.end)
        assigned = assign_splits(whole, c.splits)
        check_splits(assigned)
        return assigned

    def baseline(self) -> DataFrame:
        predictions = self._store(
            seasonal_naive(self._assigned(), self.config.lag_hours),
            "baseline",
            BASELINE_PREDICTIONS,
            check=lambda written: metrics.check_scored(metrics.split_metrics(written)),
        )
        scores = cut_lineage(metrics.split_metrics(predictions))
        self._keep("metrics/baseline", scores.select("split", "mae", "wape"))
        self.report(
            "baseline",
            {
                "splits": scores,
                "sources": metrics.source_counts(predictions),
                "mae_by_utc_hour": metrics.mae_by_hour(predictions),
            },
        )
        write_report(metrics.mae_by_zone(predictions), self.path("reports/mae_by_zone"))
        return predictions

    def features(self) -> DataFrame:
        table = self._store(
            features.build_features(self._assigned()),
            "features",
            FEATURES,
            check=features.check_features,
        )
        self.report("features", {"splits": features.feature_report(table)})
        return table

    def model(self) -> DataFrame:
        c = self.config
        table = self.table("features", FEATURES)
        model.check_split_labels(table)
        cuts = model.learn_cuts(table)
        prepared = model.prepare(table, cuts)
        chosen = model.select_candidate(
            prepared, c.candidates, c.max_rounds, c.patience, c.seed
        )
        predictions, final = model.model_predictions(prepared, chosen, c.seed)
        candidates = model.candidate_report(chosen)
        model.check_isolation(candidates, final.getNumTrees)
        written = self._store(
            predictions, "model_predictions", MODEL_PREDICTIONS, check=compare.check_predictions
        )
        path = self._own("model")
        final.write().save(f"{path}/trees")
        bounds = [(name, values) for name, values in cuts.items()]
        bounds = self.spark.createDataFrame(bounds, "feature string, cuts array<double>")
        bounds.coalesce(1).write.json(f"{path}/cuts")
        self.written["model"] = path
        by_split = metrics.forecast_metrics(written, "split")
        self._keep("metrics/model", by_split.select("split", "mae", "wape"))
        by_hour = written.withColumn("utc_hour", F.hour("target_hour_utc"))
        self.report(
            "model",
            {
                "candidates": candidates,
                "splits": by_split,
                "audit": compare.prediction_audit(written),
                "by_utc_hour": metrics.forecast_metrics(by_hour, "utc_hour"),
            },
        )
        write_report(metrics.forecast_metrics(written, "zone_id"), self.path("reports/model_by_zone"))
        return written

    def analyse(self) -> str:
        """Compare two predictors scored on the same rows; return the one to serve."""
        c = self.config
        predicted = self.table("model_predictions", MODEL_PREDICTIONS)
        naive = self.table("baseline", BASELINE_PREDICTIONS)
        compare.check_alignment(predicted, naive)
        if not compare.uncovered_zones(predicted, self.lookup).isEmpty():
            raise ContractError("some predicted zones have no lookup row")
        rows = require_rows(
            self._keep("comparison", compare.align_predictions(predicted, naive))
        )
        by_zone = cut_lineage(compare.zone_metrics(rows, self.lookup))
        by_hour = cut_lineage(compare.hour_metrics(rows))
        residuals = cut_lineage(compare.residual_metrics(rows))
        self.check_recorded(residuals)
        verdict = compare.decision(residuals)
        self.report(
            "analysis",
            {
                "alignment": compare.alignment(predicted, naive),
                "summary": compare.comparison_summary(rows),
                "overall": residuals,
                "quantiles": compare.residual_quantiles(rows),
                "improvement": compare.improvement(residuals),
                "zones": compare.win_loss(by_zone),
                "worst_zones": compare.worst_zones(by_zone, c.top_n),
                "improvements": compare.top_improvements(by_zone, c.top_n),
                "regressions": compare.regressions(by_zone, c.top_n),
                "worst_hours": compare.worst_hours(by_hour, c.top_n),
                "by_utc_hour": by_hour,
                "decision": verdict,
            },
        )
        write_report(by_zone, self.path("reports/by_zone"))
        return verdict.first().serving_winner

    def check_recorded(self, residuals: DataFrame) -> None:
        """The metrics recorded when the predictions were written must come out again."""
        recorded = None
        for predictor in ("model", "baseline"):
            one = self.kept(f"metrics/{predictor}").where(F.col("split") == "test").select(
                F.lit(predictor).alias("predictor"), "mae", "wape"
            )
            recorded = one if recorded is None else recorded.unionByName(one)
        odd = compare.metric_mismatches(residuals, recorded, ("predictor",), ("mae", "wape"))
        if not odd.isEmpty():
            raise ContractError("recomputed test metrics differ from the recorded ones")

    def serve(self, winner: str) -> ForecastStore:
        """Write the test predictions of the winner in (hour, zone) order."""
        table = predictions_to_serve(
            winner,
            self.table("model_predictions", MODEL_PREDICTIONS),
            self.table("baseline", BASELINE_PREDICTIONS),
        )
        assert_fields(table, SERVED)
        test = self.config.splits.test
        self._store(
            table,
            "served",
            SERVED,
            check=lambda written: ForecastStore(written, self.lookup, *test).check(),
        )
        return self.store()

    def store(self) -> ForecastStore:
        test = self.config.splits.test
        return ForecastStore(self.table("served", SERVED), self.lookup, test[0], test[1])

    def fingerprints(self, known: DataFrame | None = None) -> DataFrame:
        """Fingerprints of the inputs and of every table, file by file where there are files.

        Files that known has under the same name, size and time are not read.
        """
        c = self.config
        parts = []
        for name in TABLES:
            parts.append(file_manifest(self.spark, name, (self.current(name),), None, known))
        loose = {"lookup": self.lookup}
        if self.event_files:
            columns = (c.ts_col, c.zone_col, *([c.month_col] if c.month_col else []))
            parts.append(file_manifest(self.spark, "events", self.event_files, columns, known))
        else:
            loose["events"] = self.events
        whole = manifest(loose).select(
            "dataset",
            "schema",
            F.lit(None).cast("string").alias("file_path"),
            F.lit(None).cast("long").alias("file_size"),
            F.lit(None).cast("timestamp").alias("file_time"),
            "rows",
            F.col("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
            "hash_xor",
        )
        return reduce(DataFrame.unionByName, parts, whole)

    def write_manifest(self) -> DataFrame:
        """Rows, schema and fingerprint of the inputs and of every table of the run."""
        return self._keep("manifest", self.fingerprints())

    def verify(self) -> None:
        """Raise unless inputs and tables are still those that the manifest records."""
        recorded = self.kept("manifest")
        now = self.fingerprints(recorded)
        changed = manifest_check(folded(recorded), folded(now)).take(10)
        if changed:
            names = sorted(f"{row.dataset} ({row.reason})" for row in changed)
            raise ContractError(f"data differ from the manifest: {', '.join(names)}")

    def run(self) -> ForecastStore:
        """Run all stages anew and commit; an error leaves the committed run as it was."""
        configure(self.spark)
        one = self.fresh()
        one.scan()
        one.profile()
        one.aggregate()
        one.complete()
        one.baseline()
        one.features()
        one.model()
        one.serve(one.analyse())
        one.write_manifest()
        one.verify()
        one.commit()
        return one.store()
