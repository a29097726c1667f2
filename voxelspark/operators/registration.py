"""Tile pairs, shifts between tiles, and the positions that fit them best."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .fusion import Voxel, voxel_size


def overlap_pairs(tiles: DataFrame, voxel: Voxel, shape: dict[str, int]) -> DataFrame:
    """(t, i, j) with the voxel bounds of the overlap in both tiles, for i < j of one time point.

    Tiles are dealt to grid cells of a tile's size and meet the tiles of neighbouring cells by an equi-join; the exact
    bounds decide. So the work follows the number of neighbours and not of all pairs.
    """
    axes = list(shape)
    cell = [F.floor(F.col(f"stage_{a}") / F.lit(n * voxel_size(voxel, a))).alias(f"g_{a}") for a, n in shape.items()]
    placed = tiles.select("t", "p", *[f"stage_{a}" for a in axes], *cell)
    near = placed
    for a in axes:
        near = near.withColumn(f"n_{a}", F.explode(F.sequence(F.col(f"g_{a}") - 1, F.col(f"g_{a}") + 1)))
    left = placed.select("t", F.col("p").alias("i"), *[F.col(f"stage_{a}").alias(f"i_{a}") for a in axes], *[f"g_{a}" for a in axes])
    right = near.select("t", F.col("p").alias("j"), *[F.col(f"stage_{a}").alias(f"j_{a}") for a in axes], *[F.col(f"n_{a}").alias(f"g_{a}") for a in axes])
    met = left.join(right, ["t", *[f"g_{a}" for a in axes]]).where("i < j")
    out = ["t", "i", "j"]
    for a, n in shape.items():
        off = F.bround((F.col(f"j_{a}") - F.col(f"i_{a}")) / F.lit(voxel_size(voxel, a))).cast("int")
        met = met.withColumn(f"off_{a}", off).where((F.col(f"off_{a}") < n) & (F.col(f"off_{a}") > -n))
        out += [F.greatest(F.lit(0), F.col(f"off_{a}")).alias(f"i_{a}0"), F.least(F.lit(n), F.col(f"off_{a}") + n).alias(f"i_{a}1"), F.greatest(F.lit(0), -F.col(f"off_{a}")).alias(f"j_{a}0"), F.least(F.lit(n), n - F.col(f"off_{a}")).alias(f"j_{a}1")]
    return met.select(*out)


def _patch_rows(found: DataFrame) -> DataFrame:
    """Patches as rows (t, i, j, f_z, f_y, f_x, z, y, x, a, b), none where both are 0."""
    names = ["t", "i", "j", "f_z", "f_y", "f_x", "z", "y", "x"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b, f = arrays.patch_arrays(table)
        at = np.nonzero((a != 0) | (b != 0))
        same = [pa.array(np.full(len(at[0]), k, np.int32)) for k in [*(k.as_py() for k in key), *f]]
        return pa.table([*same, *(pa.array(x.astype(np.int32)) for x in at), *(pa.array(x[at]) for x in (a, b))], names=[*names, "a", "b"])

    return found.groupBy("t", "i", "j").applyInArrow(run, ", ".join(f"{n} int" for n in names) + ", a double, b double")


def _overlaps(voxels: DataFrame, pairs: DataFrame, kernel: Callable[[tuple[int, ...], pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``kernel`` over the overlap of each pair, given as both tiles' voxels in arrays, 0 where there is none, and where there are
    some; it gets the pair and its voxels too. Voxels inside an overlap go to its pair, once."""
    sides = [pairs.select("t", F.col(tile).alias("p"), "i", "j", F.lit(k).alias("side"), *[F.col(f"{tile}_{a}0").alias(f"s_{a}") for a in "zyx"], *[(F.col(f"i_{a}1") - F.col(f"i_{a}0")).alias(f"n_{a}") for a in "zyx"]) for k, tile in enumerate("ij")]
    met = voxels.select("t", "p", "z", "y", "x", "v").join(sides[0].unionByName(sides[1]), ["t", "p"])
    for a in "zyx":
        met = met.withColumn(a, F.col(a) - F.col(f"s_{a}")).where((F.col(a) >= 0) & (F.col(a) < F.col(f"n_{a}")))
    number = np.dtype("f8" if voxels.schema["v"].dataType.simpleString() == "double" else "i4")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        size = [table.column(f"n_{a}")[0].as_py() for a in "zyx"]
        both, there = np.zeros((2, *size), number), np.zeros((2, *size), bool)
        at = tuple(table.column(c).to_numpy() for c in ("side", "z", "y", "x"))
        both[at], there[at] = table.column("v").to_numpy(), True
        return kernel(tuple(k.as_py() for k in key), table, both, there)

    rows = met.select("t", "i", "j", "side", "n_z", "n_y", "n_x", "z", "y", "x", F.col("v"))
    return rows.groupBy("t", "i", "j").applyInArrow(run, schema)


def _patch(same: list[int], names: list[str], own: np.ndarray, both: np.ndarray) -> pa.Table:
    """Rows of the places where ``own`` is true."""
    at = np.nonzero(own)
    return pa.table([*(pa.array(np.full(len(at[0]), k, np.int32)) for k in same), *(pa.array(x.astype(np.int32)) for x in at), *(pa.array(x[at]) for x in both)], names=[*names, "z", "y", "x", "a", "b"])


def overlap_patches(voxels: DataFrame, pairs: DataFrame, gaps: bool = False) -> DataFrame:
    """(t, i, j, z, y, x, a, b): both tiles' voxels over each pair's overlap, in the overlap's own coordinates, 0 where only
    the other tile has one and no row where neither has; with ``gaps`` rows only where both have one."""
    kind = voxels.schema["v"].dataType.simpleString()

    def rows(key: tuple[int, ...], _: pa.Table, both: np.ndarray, there: np.ndarray) -> pa.Table:
        return _patch(list(key), ["t", "i", "j"], there.all(0) if gaps else (both != 0).any(0), both)

    return _overlaps(voxels, pairs, rows, f"t int, i int, j int, z int, y int, x int, a {kind}, b {kind}")


def reduced_patches(voxels: DataFrame, pairs: DataFrame, factors: tuple[int, int, int] = (3, 5, 5), gaps: bool = False) -> DataFrame:
    """The overlaps' voxels as means over blocks of ``factors`` (z, y, x), with the factors that were used, f_z, f_y and f_x:
    none is larger than the overlap. A ragged edge counts as filled with 0; with ``gaps`` so do places that not both tiles have a
    voxel at, and blocks without a place that both have are left out."""

    def means(key: tuple[int, ...], _: pa.Table, both: np.ndarray, there: np.ndarray) -> pa.Table:
        own = there.all(0)
        f = [max(1, min(k, n)) for k, n in zip(factors, own.shape)]
        parts = [own.astype(float), *(np.where(own, x, 0).astype(float) for x in both)]
        for axis, k in enumerate(f):
            parts = [np.add.reduceat(x, np.arange(0, x.shape[axis], k), axis) for x in parts]
        return _patch([*key, *f], ["t", "i", "j", "f_z", "f_y", "f_x"], parts[0] > 0, np.stack(parts[1:]) / math.prod(f))

    if gaps:
        return _overlaps(voxels, pairs, means, "t int, i int, j int, f_z int, f_y int, f_x int, z int, y int, x int, a double, b double")
    return _patch_rows(arrays.patches(arrays.of_voxels(voxels), pairs, factors))


def gate_edges(edges: DataFrame, score: float = 0.7, limits: tuple[int, int, int] = (20, 50, 100)) -> DataFrame:
    """Edges whose score reaches the threshold (0: any) and whose shifts are within limits."""
    kept = edges.where(F.col("score") >= score) if score else edges
    for a, n in zip("zyx", limits):
        kept = kept.where(F.abs(F.col(f"d{a}")) <= n)
    return kept


def residuals(edges: DataFrame, offsets: DataFrame) -> DataFrame:
    """Distance between each edge's shift and the difference of its tiles' offsets(t, p, dz, dy, dx)."""
    a, b = (offsets.select("t", F.col("p").alias(n), *[F.col(f"d{x}").alias(f"{n}_{x}") for x in "zyx"]) for n in "ij")
    joined = edges.join(a, ["t", "i"]).join(b, ["t", "j"])
    gap = [F.pow(F.col(f"j_{x}") - F.col(f"i_{x}") - F.col(f"d{x}"), 2) for x in "zyx"]
    return joined.select("t", "i", "j", F.sqrt((gap[0] + gap[1]) + gap[2]).alias("residual"))


def outliers(found: DataFrame, rel: float = 0.5, least: float = 1.5) -> DataFrame:
    """Edges whose residual is over max(least, rel * median), by time point."""
    medians = found.groupBy("t").agg(F.expr("percentile(residual, 0.5)").alias("median"))
    return found.join(medians, "t").where(F.col("residual") > F.greatest(F.lit(least), F.lit(rel) * F.col("median"))).drop("median")


def least_squares(links: np.ndarray, n: int, fixed: tuple[int, ...] = (0,)) -> np.ndarray:
    """Offsets of n tiles from links (i, j, dz, dy, dx, score): weighted least squares with anchors at 0, the least ones where
    tiles hang on no anchor. The normal equations are solved by conjugate gradients: one number a link, no matrix."""
    i, j, w = links[:, 0].astype(int), links[:, 1].astype(int), links[:, 5]
    anchor = np.bincount(np.array(fixed, int), minlength=n).astype(float)

    def normal(x: np.ndarray) -> np.ndarray:
        pull = w * (x[j] - x[i])
        return np.bincount(j, pull, n) - np.bincount(i, pull, n) + anchor * x

    out = np.zeros((n, 3))
    for axis in range(3):
        want = w * links[:, 2 + axis]
        right = np.bincount(j, want, n) - np.bincount(i, want, n)
        x, r = np.zeros(n), right.copy()
        p, size = r.copy(), r @ r
        least = 1e-24 * max(size, 1e-300)
        for _ in range(20 * n + 100):
            if size <= least:
                break
            q = normal(p)
            step = size / (p @ q)
            x += step * p
            r -= step * q
            new = r @ r
            p, size = r + new / size * p, new
        out[:, axis] = x
    return out


def optimize(links: np.ndarray, n: int, method: str, rel: float, least: float) -> np.ndarray:
    if method not in ("ONE_ROUND", "TWO_ROUND", "TWO_ROUND_ITERATIVE"):
        raise ValueError("unknown method")
    if not len(links):
        return np.zeros((n, 3))
    found = least_squares(links, n)
    while method != "ONE_ROUND":
        gap = np.linalg.norm(found[links[:, 1].astype(int)] - found[links[:, 0].astype(int)] - links[:, 2:5], axis=1)
        bad = gap > max(least, rel * np.median(gap))
        if not bad.any() or bad.all():
            break
        links = links[~bad]
        found = least_squares(links, n)
        if method == "TWO_ROUND":
            break
    return found


def solve_offsets(edges: DataFrame, tiles: DataFrame, method: str = "TWO_ROUND_ITERATIVE", rel: float = 0.5, least: float = 1.5) -> DataFrame:
    """(t, p, dz, dy, dx) of every tile. A time point's graph of tiles is solved in one task; time points are independent."""
    marked = edges.select("t", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), *[F.col(f"d{a}").cast("double").alias(f"d{a}") for a in "zyx"], F.col("score").cast("double").alias("score"))
    nodes = tiles.select("t", F.col("p").cast("int").alias("i"), F.lit(None).cast("int").alias("j"), *[F.lit(0.0).alias(f"d{a}") for a in "zyx"], F.lit(0.0).alias("score"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(group[group.j.isna()].i)
        at = {p: k for k, p in enumerate(ids)}
        own = group[group.j.notna()].sort_values(["i", "j"])
        links = np.array([(at[i], at[j], a, b, c, s) for i, j, a, b, c, s in zip(own.i, own.j.astype(int), own.dz, own.dy, own.dx, own.score)]).reshape(-1, 6)
        found = optimize(links, len(ids), method, rel, least)
        return pd.DataFrame({"t": group.t.iloc[0], "p": ids, "dz": found[:, 0], "dy": found[:, 1], "dx": found[:, 2]})

    return marked.unionByName(nodes).groupBy("t").applyInPandas(run, "t int, p int, dz double, dy double, dx double")


def apply_offsets(tiles: DataFrame, offsets: DataFrame, voxel: tuple[float, float, float]) -> DataFrame:
    """Positions moved by offsets in voxels; tiles without one stay."""
    joined = tiles.join(offsets, ["t", "p"], "left")
    return joined.select("t", "p", *[(F.col(f"stage_{a}") + F.coalesce(f"d{a}", F.lit(0.0)) * F.lit(v)).alias(f"stage_{a}") for a, v in zip("zyx", voxel)])


# ------------------------------------------------------------------------------------------------ image kernels


def match_histogram(image: np.ndarray, to: np.ndarray) -> np.ndarray:
    """``image`` with its values moved so that their distribution is that of ``to``."""
    _, at, counts = np.unique(image.ravel(), return_inverse=True, return_counts=True)
    values, wanted = np.unique(to.ravel(), return_counts=True)
    return np.interp(np.cumsum(counts) / image.size, np.cumsum(wanted) / to.size, values)[at].reshape(image.shape)


def _overlap(fixed: np.ndarray, moving: np.ndarray, shift: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Where ``moving``, moved by whole steps, lies on ``fixed``."""
    a = fixed[tuple(slice(max(0, s), min(n, n + s)) for s, n in zip(shift, fixed.shape))]
    b = moving[tuple(slice(max(0, -s), min(n, n - s)) for s, n in zip(shift, fixed.shape))]
    return a.ravel(), b.ravel()


def unwrapped(fixed: np.ndarray, moving: np.ndarray, peak: np.ndarray, ratio: float = 0.5) -> np.ndarray:
    """Of the shifts that a circular peak stands for (each axis as it is, or less the axis' length), the one at which what
    overlaps correlates best; shifts that leave less than ``ratio`` of the largest overlap are not believed unless the
    others do not correlate at all. Of equals the one that overlaps more."""
    size = np.array(fixed.shape)
    found = []
    for wrap in itertools.product(*[(0, 1) if n > 1 and p else (0,) for n, p in zip(size, np.rint(peak) % size)]):
        shift = np.where(size > 1, peak % size, 0.0) - np.array(wrap) * size
        a, b = _overlap(fixed, moving, tuple(np.rint(shift).astype(int)))
        if a.size > 2 and a.std() > 0 and b.std() > 0:
            found.append((float(np.corrcoef(a, b)[0, 1]), a.size, shift))
    if not found:
        return np.where(peak % size > size // 2, peak % size - size, peak % size)
    largest = max(n for _, n, _ in found)
    wide = [f for f in found if f[1] >= ratio * largest and f[0] > 0] or found
    return max(wide, key=lambda f: (round(f[0], 6), f[1]))[2]


def phase_shift(fixed: np.ndarray, moving: np.ndarray, upsample: int = 10) -> np.ndarray:
    """The shift by which ``moving`` must go to lie on ``fixed``: the peak of the phase correlation, refined around it by a
    matrix-multiplied transform in steps of 1 / upsample, and unwrapped by what then overlaps."""
    size = np.array(fixed.shape)
    cross = np.fft.fftn(fixed) * np.fft.fftn(moving).conj()
    cross /= np.maximum(np.abs(cross), 100 * np.finfo(float).eps)
    peak = np.array(np.unravel_index(np.abs(np.fft.ifftn(cross)).argmax(), cross.shape), float)
    if upsample > 1:
        reach = np.arange(-upsample, upsample + 1) / upsample
        data, grids = cross, []
        for n, at in zip(size, peak):
            grids.append(at + reach)
            kernel = np.exp(2j * np.pi * grids[-1][:, None] * np.fft.fftfreq(n)[None])
            data = np.tensordot(data, kernel, axes=(0, 1))
        best = np.unravel_index(np.abs(data).argmax(), data.shape)
        peak = np.where(size == 1, 0.0, [g[k] for g, k in zip(grids, best)])
    return unwrapped(fixed, moving, peak) + 0.0


def window_ssim(a: np.ndarray, b: np.ndarray, win: int, k1: float = 0.01, k2: float = 0.03) -> float:
    """Mean structural similarity with clamped box windows, as the voxel operator has it."""
    def box(x: np.ndarray) -> np.ndarray:
        for axis in range(x.ndim):
            pad = [(0, 0)] * x.ndim
            pad[axis] = (win // 2, win // 2)
            sums = np.cumsum(np.pad(x, pad, "edge"), axis=axis)
            sums = np.concatenate([np.zeros_like(np.take(sums, [0], axis)), sums], axis)
            n = x.shape[axis]
            x = (np.take(sums, range(win, win + n), axis) - np.take(sums, range(n), axis)) / win
        return x
    a, b = a.astype(float), b.astype(float)
    spread = np.ptp(a) or 1.0
    c1, c2, unbias = (k1 * spread) ** 2, (k2 * spread) ** 2, win**3 / (win**3 - 1)
    ma, mb = box(a), box(b)
    va, vb, vab = unbias * (box(a * a) - ma * ma), unbias * (box(b * b) - mb * mb), unbias * (box(a * b) - ma * mb)
    return float((((2 * ma * mb + c1) * (2 * vab + c2)) / ((ma**2 + mb**2 + c1) * (va + vb + c2))).mean())


def linear_shift(image: np.ndarray, shift: np.ndarray) -> np.ndarray:
    for axis, s in enumerate(shift):
        f = int(np.floor(s))
        n = image.shape[axis]
        at = np.arange(n) - f
        def take(k: np.ndarray) -> np.ndarray:
            inside = ((k >= 0) & (k < n)).reshape([-1 if a == axis else 1 for a in range(image.ndim)])
            return np.where(inside, np.take(image, np.clip(k, 0, n - 1), axis), 0)
        image = (1 - (s - f)) * take(at) + (s - f) * take(at - 1)
    return image


def register_pairs(patches: DataFrame, win: int = 7, score: float = 0.0, limits: tuple[int, int, int] = (20, 50, 100)) -> DataFrame:
    """(t, i, j, dz, dy, dx, score) of the pairs of patches (see ``arrays.patches``): histogram match, phase correlation, shift,
    SSIM. Shifts are in voxels before the reduction, rounded half to even; links whose score or shifts are beyond their gates
    are left out. A patch is one task's, so it is reduced first."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b, factors = arrays.patch_arrays(table)
        moved = match_histogram(b, a)
        shift = phase_shift(a, moved)
        found = max(1e-6, window_ssim(a, linear_shift(moved, shift), win))
        whole = np.rint(shift * np.array(factors)).astype(np.int32)
        return pa.table([*([k.as_py()] for k in key), *([int(x)] for x in whole), [found]], schema=pa.schema([(c, pa.int32()) for c in ("t", "i", "j", "dz", "dy", "dx")] + [("score", pa.float64())]))
    found = patches.groupBy("t", "i", "j").applyInArrow(run, "t int, i int, j int, dz int, dy int, dx int, score double")
    return gate_edges(found, score, limits).withColumn("score", F.round("score", 3))


def tile_digests(blocks: DataFrame) -> DataFrame:
    """(t, p, digest): what a tile's blocks hold, whatever the order in which they come."""
    one = F.sha2(F.concat(F.to_json("origin").cast("binary"), F.to_json("shape").cast("binary"), F.encode("dtype", "utf-8"), "data"), 256)
    own = blocks.select(F.element_at("origin", 1).alias("t"), F.element_at("origin", 2).alias("p"), one.alias("one"))
    return own.groupBy("t", "p").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("one")), ","), 256).alias("digest"))


def stored_edges(blocks: DataFrame, pairs: DataFrame, store: str, factors: tuple[int, int, int] = (3, 5, 5), win: int = 7) -> DataFrame:
    """(t, i, j, dz, dy, dx, score) of all pairs, from a table of edges at ``store`` that is keyed by what they are found from: both
    tiles' contents, the bounds of the overlap, and the parameters. Only pairs whose key is not there are registered, and
    appended; so a second run registers nothing, and a new or changed tile its own edges. Links are stored ungated."""
    spark = blocks.sparkSession
    digests = tile_digests(blocks)
    a, b = (digests.select("t", F.col("p").alias(n), F.col("digest").alias(f"of_{n}")) for n in "ij")
    bounds = [c for c in pairs.columns if c not in ("t", "i", "j")]
    key = F.sha2(F.concat_ws("|", "of_i", "of_j", *bounds, F.lit(f"{factors} {win}")), 256)
    keyed = pairs.join(a, ["t", "i"], "left").join(b, ["t", "j"], "left").withColumn("key", key).drop("of_i", "of_j")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    kinds = "key string, dz int, dy int, dx int, score double"
    known = (spark.read.parquet(store) if there else spark.createDataFrame([], kinds)).dropDuplicates(["key"])
    new = keyed.join(known, "key", "left_anti")
    found = register_pairs(arrays.patches(blocks, new.drop("key"), factors), win, 0.0, (1 << 30,) * 3)
    # tiles of equal contents in equal places share a key
    found.join(new.select("t", "i", "j", "key"), ["t", "i", "j"]).select("key", "dz", "dy", "dx", "score").dropDuplicates(["key"]).write.mode("append").parquet(store)
    every = spark.read.schema(kinds).parquet(store).dropDuplicates(["key"])
    return keyed.select("t", "i", "j", "key").join(every, "key").select("t", "i", "j", "dz", "dy", "dx", "score")


def refine_positions(blocks: DataFrame, tiles: DataFrame, voxel: Voxel, shape: dict[str, int], factors: tuple[int, int, int] = (3, 5, 5), win: int = 7, score: float = 0.7, method: str = "TWO_ROUND_ITERATIVE", channel: int = 0, store: str | None = None) -> DataFrame:
    """tiles(t, p, stage_z, stage_y, stage_x) of ``blocks`` moved to where their overlaps fit best: pairs, patches of one channel,
    shifts between them, the offsets that fit these, and the positions with the offsets. With ``store`` edges that were found
    before are taken from there (see ``stored_edges``)."""
    if shape["z"] == 1:
        factors = (1, *factors[1:])
    pairs = overlap_pairs(tiles, voxel, shape)
    own = blocks.where(F.element_at("origin", 3) == channel)
    if store:
        edges = gate_edges(stored_edges(own, pairs, store, factors, win), score)
    else:
        edges = register_pairs(arrays.patches(own, pairs, factors), win, score)
    return apply_offsets(tiles, solve_offsets(edges, tiles, method), tuple(voxel_size(voxel, a) for a in "zyx"))
