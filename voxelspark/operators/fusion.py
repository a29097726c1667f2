"""Blend weights, fused extents and tile fusion."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Added before a weighted mean is truncated, so that a whole number is not cut by the last bits of a sum.
CLOSE = 1e-9


#: A voxel's size: one number for all axes, or one for each of z, y and x.
Voxel = float | Mapping[str, float]


def voxel_size(voxel: Voxel, axis: str) -> float:
    return float(voxel[axis] if isinstance(voxel, Mapping) else voxel)


def feather_profile(length: int, blend: int) -> list[float]:
    """Linear ramps at both ends; the end ramp is written last. A blend as long as the axis makes a tent."""
    if length <= 2 or blend <= 0:
        return [1.0] * length
    if blend >= length:
        half = (length - 1) / 2
        inner = [max(1e-6, 1 - abs(i - half) / half) for i in range(length)]
        return [0.0, *inner[1:-1], 0.0]
    out = [i / blend if i < blend else 1.0 for i in range(length)]
    for i in range(blend):
        out[length - 1 - i] = i / blend
    return out


def cosine_mask(length: int, blend: int = 380) -> list[float]:
    n = min(blend, length // 2)
    ramp = [0.5 * (1 - math.cos(math.pi * i / (n - 1))) if n > 1 else 1.0 for i in range(n)] if n != 1 else [0.0]
    return [ramp[i] if i < n else ramp[length - 1 - i] if length - 1 - i < n else 1.0 for i in range(length)]


def slab_feather(length: int, feather: int) -> list[float]:
    n = min(feather, length // 2)
    ramp = [0.5 * (1 - math.cos(math.pi * i / (2 * n - 1))) for i in range(2 * n)]
    return [ramp[i] if i < n else ramp[2 * n - length + i] if i >= length - n else 1.0 for i in range(length)]


def extent(tiles: DataFrame, voxel: Voxel, lengths: dict[str, int], multiple: dict[str, int], up: bool) -> DataFrame:
    """Origin and padded size of the fused space by axis; ``up`` rounds sizes up, else they are truncated."""
    aggs = [f(f"stage_{a}").alias(f"{n}_{a}") for a in lengths for n, f in (("lo", F.min), ("hi", F.max))]
    row = tiles.agg(*aggs)
    out = [F.col(f"lo_{a}").alias(f"origin_{a}") for a in lengths]
    for a, n in lengths.items():
        step = voxel_size(voxel, a)
        size = (F.col(f"hi_{a}") + F.lit(n * step) - F.col(f"lo_{a}")) / F.lit(step)
        size = (F.ceil(size) if up else F.floor(size)).cast("int")
        out.append((size + F.pmod(-size, F.lit(multiple[a]))).alias(f"size_{a}"))
    return row.select(*out)


def tile_offsets(tiles: DataFrame, voxel: Voxel, axes: tuple[str, ...], half_even: bool) -> DataFrame:
    """(t, p, o_axis...): voxel offsets from the smallest position; rounded half to even, or truncated. The minimum is a
    one-row aggregate that joins back, so no task holds all tiles."""
    lows = tiles.agg(*[F.min(f"stage_{a}").alias(f"lo_{a}") for a in axes])
    shift = {a: (F.col(f"stage_{a}") - F.col(f"lo_{a}")) / F.lit(voxel_size(voxel, a)) for a in axes}
    return tiles.crossJoin(F.broadcast(lows)).select("t", "p", *[(F.bround(s) if half_even else F.floor(s)).cast("int").alias(f"o_{a}") for a, s in shift.items()])


#: Edge of the square blocks of a fused image.
FUSED = 512


def fuse_2d(rows: DataFrame, tiles: DataFrame, pixel: Voxel, height: int, width: int, mode: str = "fold") -> DataFrame:
    """Fused image (t, c, y, x, v) of tile lines(t, p, c, y, line) of height x width.

    fold: tiles in order of p, f <- trunc(clip((f + v w) / (1 + w))), from 0. weighted_mean: sum(w v) / sum(w). Rows of a
    tile that are not there count as zeros, as in a dense image. Lines are cut at the borders of the fused image's blocks
    and meet there: what moves is the tiles' pixels once, and a block holds the tiles that lie over it.
    """
    if mode not in ("fold", "weighted_mean"):
        raise ValueError("mode is fold or weighted_mean")
    offsets = tile_offsets(tiles, pixel, ("y", "x"), half_even=False)
    wy, wx = np.array(cosine_mask(height)), np.array(cosine_mask(width))
    # each row brings the absent rows before it, the last one those after it too
    frame = Window.partitionBy("t", "p", "c").orderBy("y")
    gaps = rows.where((F.col("y") >= 0) & (F.col("y") < height)).withColumns({"after": F.coalesce(F.lag("y").over(frame) + 1, F.lit(0)), "upto": F.when(F.lead("y").over(frame).isNull(), F.lit(height - 1)).otherwise(F.col("y"))})
    dense = gaps.select("t", "p", "c", "line", F.col("y").alias("own"), F.explode(F.sequence("after", "upto")).alias("y"))
    placed = dense.join(offsets, ["t", "p"]).withColumn("gy", F.col("y") + F.col("o_y"))
    cut = F.explode(F.sequence(F.floor(F.col("o_x") / FUSED).cast("int"), F.floor((F.col("o_x") + F.lit(width - 1)) / FUSED).cast("int")))
    placed = placed.withColumn("bx", cut).withColumn("x0", F.greatest(F.lit(0), F.col("bx") * FUSED - F.col("o_x")))
    size = F.least(F.lit(width), (F.col("bx") + 1) * FUSED - F.col("o_x")) - F.col("x0")
    line = F.when(F.col("y") == F.col("own"), F.slice("line", F.col("x0") + 1, size))
    pieces = placed.select("t", "c", F.floor(F.col("gy") / FUSED).cast("int").alias("by"), "bx", "p", "y", "gy", "x0", "o_x", size.alias("size"), line.alias("line"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("p", "ascending"), ("gy", "ascending")]).combine_chunks()
        by, bx = key[2].as_py() * FUSED, key[3].as_py() * FUSED
        fused, weight, seen = np.zeros((FUSED, FUSED)), np.zeros((FUSED, FUSED)), np.zeros((FUSED, FUSED), bool)
        columns = (table.column(c).to_numpy() for c in ("p", "y", "gy", "x0", "o_x", "size"))
        lines = table.column("line").combine_chunks()
        here, at, data = lines.is_valid().to_numpy(zero_copy_only=False), lines.offsets.to_numpy(), lines.values.to_numpy()
        for n, (_, y, gy, x0, o_x, size) in enumerate(zip(*(c.tolist() for c in columns))):
            place = gy - by, slice(o_x + x0 - bx, o_x + x0 - bx + size)
            w = wy[y] * wx[x0 : x0 + size]
            v = data[at[n] : at[n + 1]].astype(float) if here[n] else 0.0
            seen[place] = True
            if mode == "fold":
                fused[place] = np.floor(np.clip((fused[place] + v * w) / (1 + w), 0.0, 65535.0))
            else:
                fused[place] += v * w
                weight[place] += w
        if mode == "weighted_mean":
            fused = np.floor(np.divide(fused, weight, out=np.zeros_like(fused), where=weight > 0) + CLOSE)
        y, x = np.nonzero(seen)
        same = [pa.array(np.full(len(y), k.as_py(), np.int32)) for k in key[:2]]
        return pa.table([*same, *(pa.array(a.astype(np.int32)) for a in (y + by, x + bx, fused[y, x]))], names=["t", "c", "y", "x", "v"])

    return pieces.groupBy("t", "c", "by", "bx").applyInArrow(run, "t int, c int, y int, x int, v int")


def fuse_3d(voxels: DataFrame, tiles: DataFrame, voxel: Voxel, shape: tuple[int, int, int], blend: tuple[int, int, int], gaps: bool = False) -> DataFrame:
    """Weighted mean (t, c, z, y, x, v) of all tiles over each voxel that one covers, truncated; 0 where no weight is. Voxels go
    to blocks of the result by shards of planes (``arrays.fused_voxels``). A tile covers its whole box, 0 where it has no voxel;
    with ``gaps`` only its voxels."""
    from . import arrays

    profiles = [np.array(feather_profile(n, b)) for n, b in zip(shape, blend)]
    return arrays.fused_voxels(voxels, tiles, voxel, shape, profiles, SHARD, gaps)


#: Edges (z, y, x) of the blocks in which voxel tables are fused.
SHARD = (4, 512, 512)


def shard_overlap(tiles: DataFrame, voxel: Voxel, depth: int, step: int, half_even: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(t, p, shard, z0, z1): the z range of each tile in each shard of ``step`` planes that it reaches, by dealing a tile
    to its shards and not by comparing all of them; and the offsets o_z and those of the axes ``keep`` where asked for."""
    o = tile_offsets(tiles, voxel, ("z", *keep), half_even)
    dealt = o.select("*", F.explode(F.sequence(F.floor(F.col("o_z") / step), F.floor((F.col("o_z") + depth - 1) / step))).alias("shard"))
    own = ["o_z", *(f"o_{a}" for a in keep)] if keep else []
    return dealt.select("t", "p", F.col("shard").cast("int").alias("shard"), F.greatest(F.col("shard") * step, F.col("o_z")).cast("int").alias("z0"), F.least((F.col("shard") + 1) * step, F.col("o_z") + depth).cast("int").alias("z1"), *own)
