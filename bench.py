"""Times the headline queries: the median of three warm runs each, results fully computed and dropped. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from geoquilt import registry

HEADLINE = {
    "a9_overviews": "overview pyramid",
    "j3_point_in_cell": "point-in-cell join",
    "j9_descriptor_knn": "descriptor k-NN",
    "a11_rasterise_highest": "rasterise points",
    "tie_point_quality": "parallax filter and best two of each tile",
    "k5_resample": "bilinear resampling",
    "j2_footprint_overlap": "footprint overlap",
}
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registry.queries(), {}
    for name in HEADLINE:
        seconds = []
        for _ in range(RUNS + 1):  # the first run warms up
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
