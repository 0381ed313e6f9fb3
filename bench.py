"""Headline queries, timed warm; prints one line of JSON.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
all cores), BENCH_RUNS (timed runs per query after a warm-up,
default 3; the median counts).
"""

from __future__ import annotations

import json
import math
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_queries
import driver_views as views
from casametra.plans.gold import write_gold
from casametra.plans.maintained import GoldState
from casametra.plans.maintained import write_gold as write_gold_from_state
from casametra.plans.silver import backfill
from casametra.sources.silver_table import read_history
from casametra.staging import scratch_dir

HEADLINE = (
    "silver_clean",
    "bronze_quality_profile",
    "silver_from_pages",
    "dedup_snapshot",
    "latest_by_property",
    "price_ts_neighborhood",
    "price_ts_district",
    "weekly_volume",
    "ratio_all",
    "ratio_ts",
    "boxplot_all",
    "boxplot_last_3m",
    "size_hist",
    "price_hist",
    "location_grid",
    "describe_by_operation",
    "correlation_pairs",
    "kpi_summary",
    "execution_success",
    "api_quota",
    "cost_matrix",
)


#: How much larger the history of the scaling run is.
SCALE = 4


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("casametra-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.path.abspath("spark-warehouse/_shared"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    """Compute every row and column without sending them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def silver_job(spark: SparkSession, pages_root: str) -> str:
    """The silver job itself: landed page files to a partitioned silver history."""
    root = f"{scratch_dir(spark, 'silver')}/history"
    backfill(spark, pages_root, root)
    return root


def gold_job(spark: SparkSession, history: DataFrame) -> None:
    """All datasets of the gold layer as tables, and the document."""
    write_gold(
        spark,
        history,
        f"{scratch_dir(spark, 'gold')}/gold",
        F.lit("2026-01-01T12:00:00+00:00"),
        views.MARKET,
    )


def one_more_snapshot(spark: SparkSession, history: DataFrame) -> tuple[float, float]:
    """Seconds to build the maintained state of all snapshots but the last, and for gold after that one."""
    root = scratch_dir(spark, "state")
    days = sorted(r[0] for r in history.select("snapshot_date").distinct().collect())
    state = GoldState(spark, f"{root}/state", views.MARKET)
    start = time.perf_counter()
    state.absorb(history.filter(F.col("snapshot_date") < days[-1]), [(None, d) for d in days[:-1]])
    built = time.perf_counter() - start
    start = time.perf_counter()
    state.absorb(history.filter(F.col("snapshot_date") == days[-1]), [(None, days[-1])])
    write_gold_from_state(spark, state, f"{root}/gold", F.lit("2026-01-01T12:00:00+00:00"))
    return round(built, 4), round(time.perf_counter() - start, 4)


def replicated(history: DataFrame, times: int) -> DataFrame:
    """The history with each property as so many properties of the same snapshots."""
    copy = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_copy")
    code = F.concat("propertyCode", F.lit("-"), F.col("_copy").cast("string"))
    return history.select("*", copy).withColumn("propertyCode", code).drop("_copy")


def timed(run: Callable[[], None], runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()
    results = {
        name: timed(lambda: consume(driver_queries.QUERIES[name](spark, sf_dir)), runs)
        for name in HEADLINE
    }
    pages_root = f"{scratch_dir(spark, 'pages')}/bronze"
    views.land_pages(spark, sf_dir, pages_root)
    roots: list[str] = []
    results["silver_job"] = timed(lambda: roots.append(silver_job(spark, pages_root)), 1)
    history = read_history(spark, roots[-1])
    results["gold_job"] = timed(lambda: gold_job(spark, history), runs)
    built, results["gold_after_one_more_snapshot"] = one_more_snapshot(spark, history)
    # the same job over a history four times as large, written to the same shared folder
    larger = f"{scratch_dir(spark, 'larger')}/history"
    replicated(history, SCALE).write.partitionBy("snapshot_date").parquet(larger)
    scaled = timed(lambda: gold_job(spark, spark.read.schema(history.schema).parquet(larger)), 1)
    growth = math.log(scaled / results["gold_job"]) / math.log(SCALE)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
                "gold_state_built": built,
                "gold_job_larger": {"times": SCALE, "sec": scaled, "power_of_input": round(growth, 2)},
                "cpus": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
