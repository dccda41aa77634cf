"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times to a sink that reads every row and
keeps none; its figure is the median. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data
and cores, arguments choose other queries of the catalogue (``all`` for every one).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from starmill.catalog import QUERIES
from starmill.session import build_session

HEADLINE = [
    "clean_reviews",
    "clean_meta",
    "dedup_by_key",
    "yearly_trend",
    "rating_distribution",
    "verified_compare",
    "votes_by_length",
    "user_frequency",
    "price_buckets",
    "brand_ranking",
    "keyword_ranking",
    "join_own_total",
    "ml_features",
    "ml_metrics",
]
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def scale_of(sf_dir: str) -> float | str:
    """The scale factor in a folder name such as sf0.1."""
    name = Path(sf_dir).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 4)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": scale_of(sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    arguments = sys.argv[1:]
    main(list(QUERIES) if arguments == ["all"] else arguments or HEADLINE)
