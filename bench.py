"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES

HEADLINE = [
    "tile_inputs_distance", "tile_inputs_wrap", "tile_inputs_corners", "tile_inputs_any_corner",
    "inputs_per_tile_band", "coadd_inputs_per_tile_band", "catalogs_of_exposures",
    "build_images", "build_images_3plane", "provenance_3key", "zeropoint_backfill",
    "tiling_grid", "tiling_home_tiles", "survey_inputs_per_tile", "wcs_corners", "hpix_assign",
    "depth_fractions", "band_lists", "sample_exposures", "sample_images",
    "plane_diff", "mask_rectangles", "constraint_violations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # start-up and compilation do not count
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries after one untimed run of the first", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
