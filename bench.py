"""Headline reports, whole query into a no-op sink, warm median. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from spindlewatch.plans.registry import HOURS, QUERIES, telemetry
from spindlewatch.plans.reports import hours_by_cohort
from spindlewatch.session import build_session

HEADLINE = ("daily_vault_failures", "top_models", "top_vaults", "hours_by_cohort", "hours_by_cohort_sketch")


def sketch_report(spark, sf_dir):
    """The report itself; the named query also checks its ranks."""
    return hours_by_cohort(telemetry(spark, sf_dir, "data", "serial_number", "failure", HOURS), accuracy=10_000)


TIMED = QUERIES | {"hours_by_cohort_sketch": sketch_report}
WARM_UP = 2
RUNS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians = {}
    for name in HEADLINE:
        times = []
        for _ in range(WARM_UP + RUNS):
            start = time.perf_counter()
            TIMED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        medians[name] = round(statistics.median(times[WARM_UP:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline reports, warm median, total",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
