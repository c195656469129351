"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the
median is reported. Results go to a no-op sink, so every row is computed and
none is brought to the driver. Queries that run Spark jobs while they are
built (streams, checkpoints) are timed with those jobs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.quality import validity_flag
from opinara.plans import fixtures as fx
from opinara.plans.catalog import CATALOG
from opinara.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "tumbling_final", "sliding_agg", "tumbling_changelog", "late_classes", "upsert_windows",
    "validate_reviews", "validation_summary", "error_breakdown", "json_quarantine", "encode_raw",
    "review_stats", "rating_distribution", "top_products", "throughput", "moving_rps",
    "kpi_windows", "kpi_latest", "latency_series", "top20_latest", "filter_prefix",
    "dedup_reviews", "dedup_within_horizon", "paths_equal", "anomalies", "anomaly_history", "alert_cooldown",
    "stream_tumbling_table", "stream_dedup",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    work()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def validation_rates(spark: SparkSession) -> dict[str, float]:
    """Rows per second of the rules alone, on a cached table: native columns against a pandas UDF."""
    reviews = fx.reviews_with_text(spark, SF_DIR).select("rating_f", "text", "likes").repartition(int(CPUS)).cache()
    n = reviews.count()

    @F.pandas_udf("boolean")
    def in_pandas(rating: pd.Series, text: pd.Series, likes: pd.Series) -> pd.Series:
        return rating.between(1, 5) & text.str.len().between(1, 5000) & (likes >= 0)

    forms = {"native": validity_flag("rating_f"), "pandas_udf": in_pandas("rating_f", "text", "likes")}
    rates = {name: round(n / timed(lambda c=c: run(reviews.select(c)))) for name, c in forms.items()}
    reviews.unpersist()
    return {"rows": n, **rates}


def scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark_sql_shuffle_partitions=CPUS,
                          spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda name=name: run(CATALOG[name](spark, SF_DIR))) for name in HEADLINE}
    rates = validation_rates(spark)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": scale(SF_DIR),
                      "validation_rows_per_sec": rates}))


if __name__ == "__main__":
    main()
