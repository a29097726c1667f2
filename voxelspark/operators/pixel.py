"""Element-wise operators, filters and index maps on voxel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = 65535


def _clip(x: Column, top: float = TOP) -> Column:
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(top)), x))).cast("int")


def camera_correct(voxels: DataFrame, offset: float, gain: float, flat: DataFrame | None = None) -> DataFrame:
    """(raw - offset) * gain / flat, clipped to 16 bits and truncated. ``flat`` is (c, y, x, ff), one row a sensor pixel and
    channel; Catalyst broadcasts it where its measured size allows."""
    v = (F.col("v") - F.lit(offset)) * F.lit(gain)
    if flat is None:
        return voxels.withColumn("v", _clip(v))
    return voxels.join(flat, ["c", "y", "x"]).withColumn("v", _clip(v / F.col("ff"))).select(voxels.columns)


def camera_correct_qe(voxels: DataFrame, offset: float = 100.0, gain: float = 0.24, efficiency: float = 0.9) -> DataFrame:
    return voxels.withColumn("v", F.floor(F.greatest(F.col("v") - F.lit(offset), F.lit(0.0)) * F.lit(gain) / F.lit(efficiency)).cast("int"))


def photon_convert(voxels: DataFrame, offset: float = 100.0, gain: float = 0.24) -> DataFrame:
    return camera_correct(voxels, offset, gain)


def flip(voxels: DataFrame, axis: str, size: int) -> DataFrame:
    return voxels.withColumn(axis, F.lit(size - 1) - F.col(axis))


def crop(voxels: DataFrame, axis: str, start: int, stop: int) -> DataFrame:
    """Keep [start, stop) of an axis and count it from 0. A crop of nothing keeps everything."""
    return voxels.where((F.col(axis) >= start) & (F.col(axis) < stop)).withColumn(axis, F.col(axis) - start)


def between(voxels: DataFrame, **ranges: tuple[int, int]) -> DataFrame:
    """Half-open ranges of axes, coordinates as they are: filters that reach the scan."""
    for axis, (a, b) in ranges.items():
        voxels = voxels.where((F.col(axis) >= a) & (F.col(axis) < b))
    return voxels


def pad_to_multiple(n: Column, multiple: int = 4) -> Column:
    return F.pmod(-n, F.lit(multiple))


def subtract_background(voxels: DataFrame, background: DataFrame) -> DataFrame:
    """clip(v - bg) by (t, p, c, z, y, x); where there is no background it is 0."""
    keys = [k for k in voxels.columns if k != "v"]
    bg = background.select(*keys, F.col("v").alias("bg"))
    return voxels.join(bg, keys, "left").withColumn("v", F.greatest(F.lit(0), F.least(F.lit(TOP), F.col("v") - F.coalesce("bg", F.lit(0)))).cast("int")).select(voxels.columns)


def reflect_index(i: Column, n: int) -> Column:
    """Index after mirror padding without repeating the edge."""
    if n == 1:
        return F.lit(0)
    m = F.pmod(i, F.lit(2 * n - 2))
    return F.when(m < n, m).otherwise(F.lit(2 * n - 2) - m)


def consensus_update(cells: DataFrame) -> DataFrame:
    """recon * ratio where consensus is not negative, else recon."""
    return cells.withColumn("recon", F.when(F.col("consensus") < 0, F.col("recon")).otherwise(F.greatest(F.lit(0.0), F.col("recon") * F.col("ratio"))))


AXES = ("t", "p", "c", "z", "y", "x")


def normalise_axes(voxels: DataFrame, axes: str) -> DataFrame:
    """Voxels of an image whose axes are ``axes`` (any of t, p, c, z, and y and x) as (t, p, c, z, y, x, v): axes that are
    not there are 0. Other names are refused."""
    unknown = set(axes.lower()) - set(AXES)
    if unknown or not {"y", "x"} <= set(axes.lower()):
        raise ValueError(f"axes {axes!r}: y and x, and of t, p, c and z")
    return voxels.select(*[F.col(a) if a in axes.lower() else F.lit(0).alias(a) for a in AXES], "v")


def split_index(index: Column, n_positions: int) -> tuple[Column, Column]:
    """Time and position of a tile's flattened number."""
    return F.floor(index / n_positions).cast("int"), F.pmod(index, F.lit(n_positions)).cast("int")


def read_tile(voxels: DataFrame, index: int, n_positions: int, n_times: int = 1, channel: int | None = None, **ranges: tuple[int, int]) -> DataFrame:
    """The part of one tile, by its flattened number, within half-open ranges of its axes: filters that reach the scan.
    ValueError for a negative number, IndexError for one beyond the last time."""
    if index < 0:
        raise ValueError("a tile's number is not negative")
    if index // n_positions >= n_times:
        raise IndexError(f"tile {index} is beyond {n_times} times of {n_positions} positions")
    own = voxels.where((F.col("t") == index // n_positions) & (F.col("p") == index % n_positions))
    return between(own if channel is None else own.where(F.col("c") == channel), **ranges)


def chunk_cover(length: Column, chunk: Column) -> Column:
    """array<struct<start, stop>>: chunks that cover a length wholly; the last one is moved back to end with it."""
    starts = F.sequence(F.lit(0), length - 1, chunk)
    first = lambda s: F.greatest(F.lit(0), F.least(s, length - chunk))
    return F.transform(starts, lambda s: F.struct(first(s).alias("start"), F.least(length, first(s) + chunk).alias("stop")))
