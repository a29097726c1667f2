"""Projections, block means and pyramids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_project(voxels: DataFrame, axis: str = "z") -> DataFrame:
    keys = [k for k in voxels.columns if k not in (axis, "v")]
    return voxels.groupBy(*keys).agg(F.max("v").alias("v"))


def mean_time(voxels: DataFrame, frames: int) -> DataFrame:
    """Truncated mean over ``frames`` time points; a voxel that is not there is 0."""
    keys = [k for k in voxels.columns if k not in ("t", "v")]
    return voxels.groupBy(*keys).agg(F.floor(F.sum("v") / F.lit(frames)).cast("int").alias("v"))


def downsample_axis(voxels: DataFrame, axis: str, level: int, size: int) -> DataFrame:
    """Mean of ``level`` neighbours along an axis, truncated; a remainder is trimmed. Sums of whole numbers, so exact."""
    keys = [k for k in voxels.columns if k not in (axis, "v")]
    kept = voxels.where(F.col(axis) < size // level * level).withColumn(axis, F.floor(F.col(axis) / level).cast("int"))
    return kept.groupBy(*keys, axis).agg(F.floor(F.sum("v") / F.lit(level)).cast("int").alias("v")).select(voxels.columns)


def downsample(voxels: DataFrame, level: int, shape: dict[str, int]) -> DataFrame:
    """One axis after the other, truncating between them."""
    for axis, size in shape.items():
        voxels = downsample_axis(voxels, axis, level, size)
    return voxels


def block_reduce(voxels: DataFrame, factors: dict[str, int], truncate: bool = False) -> DataFrame:
    """Mean over blocks; a ragged edge counts as padded with 0."""
    keys = [k for k in voxels.columns if k != "v"]
    cut = voxels
    volume = 1
    for axis, f in factors.items():
        cut = cut.withColumn(axis, F.floor(F.col(axis) / f).cast("int"))
        volume *= f
    mean = F.sum("v") / F.lit(volume)
    return cut.groupBy(*keys).agg((F.floor(mean).cast("int") if truncate else mean).alias("v"))


def stride(voxels: DataFrame, factors: dict[str, int]) -> DataFrame:
    for axis, f in factors.items():
        voxels = voxels.where(F.col(axis) % f == 0).withColumn(axis, F.floor(F.col(axis) / f).cast("int"))
    return voxels


def pyramid(voxels: DataFrame, factors: Sequence[int], axes: Sequence[str] = ("z", "y", "x"), mode: str = "stride") -> DataFrame:
    """All levels as one table with a ``level`` column. Stride levels come straight from the base (a stride of a stride is
    the stride of the product); block means come from the level before, as each truncates."""
    if mode not in ("stride", "block_mean"):
        raise ValueError("mode is stride or block_mean")
    out, last, done = None, voxels, 1
    for n, f in enumerate(factors, 1):
        if mode == "stride":
            level = stride(voxels, dict.fromkeys(axes, f))
        else:
            level = last = block_reduce(last, dict.fromkeys(axes, f // done), truncate=True)
            done = f
        level = level.withColumn("level", F.lit(n))
        out = level if out is None else out.unionByName(level)
    return out


def kl_divergence(pairs: DataFrame, p: str = "p", q: str = "q", floor: float = 1e-4, keys: Sequence[str] = ()) -> DataFrame:
    """sum p (ln p - ln q) of two columns, each raised by ``floor`` and normalised to sum 1, for each value of ``keys``."""
    raised = pairs.select(*keys, (F.col(p) + floor).alias("p_"), (F.col(q) + floor).alias("q_"))
    sums = raised.groupBy(*keys).agg(F.sum("p_").alias("sp"), F.sum("q_").alias("sq"), F.sum(F.col("p_") * (F.ln("p_") - F.ln("q_"))).alias("raw"))
    return sums.select(*keys, (F.col("raw") / F.col("sp") - F.ln(F.col("sp") / F.col("sq"))).alias("kl"))
