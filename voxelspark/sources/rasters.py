"""Voxel rasters from relational tables: how a table's rows become (t, p, c, z, y, x, v)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Geometry and camera constants that the registered queries share.
PIXEL, STEP, TILT, OFFSET, GAIN = 0.115, 0.4, 30.0, 100.0, 0.24
SHAPE = (5, 25, 64)
AXES = ("t", "p", "c", "z", "y", "x")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense tiles from ``embeddings``: 125 vectors a tile, 25 a plane, one a row of 64 pixels."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("x", "e"))
    i = lambda c: c.cast("int")
    return e.select(F.lit(0).alias("t"), i(F.floor(F.col("vec_id") / 125)).alias("p"), F.lit(0).alias("c"), i(F.floor(F.col("vec_id") % 125 / 25)).alias("z"), i(F.col("vec_id") % 25).alias("y"), "x", (i(F.floor((F.col("e").cast("double") + 1.0) * 1000.0)) + 100).alias("v"))


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse voxels from ``lineitem``."""
    keys = [F.lit(0).alias("t"), F.expr("cast(l_suppkey % 4 as int)").alias("p"), F.lit(0).alias("c"), F.expr("l_linenumber - 1").alias("z"), F.expr("cast(floor(l_quantity) as int) - 1").alias("y"), F.expr("cast(l_partkey % 64 as int)").alias("x")]
    value = F.expr("cast(least(65535, sum(cast(floor(l_extendedprice / 100.0D) as bigint))) as int)")
    return read(spark, sf_dir, "lineitem").groupBy(*keys).agg(value.alias("v"))


def timelapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames by day from ``events``."""
    keys = [F.expr("datediff(cast(ts as date), date'2024-01-01')").alias("t"), F.expr("cast(user_id % 4 as int)").alias("p"), F.lit(0).alias("c"), F.lit(0).alias("z"), F.expr("cast(floor(user_id / 4) % 16 as int)").alias("y"), F.expr("cast(least(31, floor(value / 16.0D)) as int)").alias("x")]
    return read(spark, sf_dir, "events").groupBy(*keys).agg(F.expr("cast(100 + 50 * count(*) as int)").alias("v"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, p, stage_z, stage_y, stage_x) of every tile of the stack: a grid two tiles wide with overlaps."""
    p = read(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 125).cast("int").alias("p")).distinct()
    return p.select(F.lit(0).alias("t"), "p", F.lit(0.0).alias("stage_z"), (F.floor(F.col("p") / 2) * 20 * PIXEL).alias("stage_y"), (F.col("p") % 2 * 50 * PIXEL).alias("stage_x"))


def flat_field(spark: SparkSession, height: int = SHAPE[1], width: int = SHAPE[2]) -> DataFrame:
    """(c, y, x, ff): a fixed flat-field that is exact in binary."""
    grid = spark.range(height * width).select(F.lit(0).alias("c"), F.floor(F.col("id") / width).cast("int").alias("y"), (F.col("id") % width).cast("int").alias("x"))
    return grid.withColumn("ff", 1.0 + (F.col("y") * 7 + F.col("x") * 3) % 5 * 0.125)
