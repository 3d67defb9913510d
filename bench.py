"""Time the stages of a backtest at BENCH_SF_DIR; prints one JSON line.

Each stage reads the tables the stage before has written, as a production run
does. Every query runs twice untimed on the same tables; the median of three
timed runs counts. Model selection runs once, at the full budget of rounds; one
candidate is also fitted on a target with signal, outside the total. The
stage tables go to BENCH_OUT, by default a folder in the session's warehouse.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.operators import compare, counts, features, grid, metrics, model, profile, serve
from hourgrid.operators.baseline import seasonal_naive
from hourgrid.operators.classify import disposition_counts, label_cells
from hourgrid.operators.splits import assign_splits
from hourgrid.plans.registry import FORECAST_HOUR, FORECAST_ZONE, HISTORY_HOURS, TOP_N
from hourgrid.plans.workload import SPECIAL, SPLITS, Workload, blend_predictions
from hourgrid.session import build_session
from hourgrid.sources.tables import write_sorted

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Rounds at most for the candidate that is fitted on a target with signal.
SIGNAL_ROUNDS = 160


def drain(df: DataFrame) -> None:
    """Run a plan to the end without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


def timed(build: Callable[[], DataFrame], repeats: int = 3) -> float:
    """Median seconds of a run after two untimed runs."""
    for _ in range(2):
        drain(build())
    seconds = []
    for _ in range(repeats):
        started = time.perf_counter()
        drain(build())
        seconds.append(time.perf_counter() - started)
    return round(sorted(seconds)[len(seconds) // 2], 4)


def main() -> None:
    spark = build_session(
        "hourgrid-bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    out = os.environ.get("BENCH_OUT", f"{warehouse}/bench-{uuid.uuid4().hex}")
    w = Workload(spark, SF_DIR)
    results: dict[str, float] = {}

    def path(name: str) -> str:
        return f"{out}/{name}"

    def table(name: str) -> DataFrame:
        return spark.read.parquet(path(name))

    def lookup() -> DataFrame:
        return table("lookup")

    w.lookup.write.parquet(path("lookup"))

    # Profile and aggregation read the raw events.
    results["raw_profile"] = timed(lambda: profile.raw_profile(w.events, w.window))
    results["zone_profile"] = timed(
        lambda: profile.zone_profile(
            profile.zone_cells(w.events, lookup(), w.window, special=SPECIAL)
        )
    )
    results["coverage_summary"] = timed(
        lambda: profile.coverage_summary(profile.hourly_coverage(w.events, w.window), w.window)
    )
    results["dispositions"] = timed(lambda: disposition_counts(w.cells))
    results["hourly_counts"] = timed(
        lambda: counts.hourly_counts(label_cells(w.usable, lookup(), SPECIAL))
    )
    label_cells(w.usable, lookup(), SPECIAL).write.parquet(path("cells"))
    write_sorted(counts.hourly_counts(table("cells")), path("counts"))

    def full_grid() -> DataFrame:
        return grid.complete_grid(
            grid.service_entities(lookup(), SPECIAL),
            grid.coverage_status(table("cells"), w.window),
            table("counts"),
            w.window,
        )

    results["full_grid"] = timed(full_grid)
    write_sorted(full_grid(), path("grid"))
    results["grid_validation"] = timed(
        lambda: grid.validate_grid(table("grid"), SPLITS.start, SPLITS.end)
    )

    def assigned() -> DataFrame:
        return assign_splits(table("grid"), SPLITS)

    results["seasonal_naive"] = timed(lambda: seasonal_naive(assigned()))
    write_sorted(seasonal_naive(assigned()), path("baseline"))
    results["split_metrics"] = timed(lambda: metrics.split_metrics(table("baseline")))
    results["mae_by_zone"] = timed(lambda: metrics.mae_by_zone(table("baseline")))
    results["feature_table"] = timed(lambda: features.build_features(assigned()))
    write_sorted(features.build_features(assigned()), path("features"))
    results["feature_report"] = timed(lambda: features.feature_report(table("features")))

    write_sorted(blend_predictions(table("features")), path("model"))
    results["prediction_compare"] = timed(
        lambda: compare.align_predictions(table("model"), table("baseline"))
    )
    compare.align_predictions(table("model"), table("baseline")).write.parquet(path("comparison"))
    results["residual_metrics"] = timed(lambda: compare.residual_metrics(table("comparison")))
    results["residual_quantiles"] = timed(lambda: compare.residual_quantiles(table("comparison")))
    results["zone_metrics"] = timed(lambda: compare.zone_metrics(table("comparison"), lookup()))

    write_sorted(serve.served_predictions(table("baseline")), path("served"))
    store = serve.ForecastStore(table("served"), lookup(), SPLITS.test[0], SPLITS.test[1])
    reads = {
        "forecast_point": lambda: store.forecast(FORECAST_ZONE, FORECAST_HOUR),
        "history_window": lambda: store.history(FORECAST_ZONE, FORECAST_HOUR, HISTORY_HOURS),
        "rankings": lambda: store.rankings(FORECAST_HOUR, TOP_N),
        "rankings_all_hours": lambda: store.rankings_all_hours(TOP_N),
    }
    for name, build in reads.items():
        results[name] = timed(build, repeats=5)

    started = time.perf_counter()
    prepared = model.prepare(table("features"))
    chosen = model.select_candidate(prepared)
    drain(model.model_predictions(prepared, chosen)[0])
    results["model_selection"] = round(time.perf_counter() - started, 4)
    rounds_kept = {r.candidate_name: r.boost_rounds for r in chosen.metrics.collect()}

    # The events hold no signal and stop early; a target with one shows the cost of a round.
    noise = F.pmod(F.xxhash64("zone_id", "target_hour_utc"), F.lit(7))
    daily = F.sin(F.col("utc_hour") * (math.pi / 12)) * (3 + F.pmod("zone_id", F.lit(11)))
    level = F.pmod(F.col("zone_id") * 37, F.lit(101)) + 5 * F.col("utc_day_of_week")
    signal = table("features").withColumn(
        "target_trip_count", F.greatest(F.lit(0), F.round(30 + level + 4 * daily + noise)).cast("long")
    )
    prepared = model.prepare(signal)
    train, validation = (prepared.where(F.col("split") == n) for n in ("train", "validation"))
    started = time.perf_counter()
    _, kept = model.fit_candidate(
        train, validation, model.CANDIDATES[0], SIGNAL_ROUNDS, model.PATIENCE, model.SEED
    )
    seconds = time.perf_counter() - started
    fitted = min(SIGNAL_ROUNDS, -(-(kept + model.PATIENCE) // model.BLOCK_ROUNDS) * model.BLOCK_ROUNDS)
    signal_fit = {
        "rounds_kept": kept,
        "trees_fitted": fitted,
        "seconds": round(seconds, 2),
        "seconds_a_round": round(seconds / fitted, 4),
    }

    grid_rows = table("grid").agg(F.count("*")).first()[0]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "backtest_total",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "grid_rows": grid_rows,
                "model_rounds_kept": rounds_kept,
                "model_budget": [model.MAX_ROUNDS, model.PATIENCE],
                "model_with_signal": signal_fit,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
