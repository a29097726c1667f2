"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.operators import deskew, fusion, reduce, stencil
from voxelspark.plans.queries import GEOMETRY, QUERIES, SIZES
from voxelspark.sources import rasters

HEADLINE = ["rasterise_lineitem", "correct_max_z", "max_z", "downsample_axis_z", "pyramid_stride", "pyramid_block_mean", "deskew", "fuse_2d", "fuse_3d", "box_filter", "ssim", "overlap_patches"]


#: Time points of the larger raster, which shows how the operators grow; it is no part of the metric.
TIMES = 25


def large(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The stack at TIMES time points."""
    stack = rasters.stack(spark, sf).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))))
    tiles = rasters.tiles(spark, sf).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))))
    rows = deskew.deskew_lines(deskew.lines(stack, GEOMETRY.columns), GEOMETRY)
    return {
        "large_max_z": reduce.max_project(stack),
        "large_deskew": rows,
        "large_fuse_2d": fusion.fuse_2d(deskew.max_lines(rows), tiles, rasters.PIXEL, GEOMETRY.out[1], GEOMETRY.columns),
        "large_box_filter": stencil.box_filter(stack, 1, SIZES),
    }


def seconds(frame: DataFrame) -> float:
    began = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):  # the first one compiles
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    value = round(sum(took.values()), 3)
    for name, frame in large(spark, sf).items():
        took[name] = round(min(seconds(frame) for _ in range(2)), 3)
    print(json.dumps({"metric": "image query seconds, sum of medians of 3 warm runs", "value": value, "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
