"""Oblique-to-Cartesian resampling, and its geometry."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Geometry:
    planes: int
    rows: int
    columns: int
    theta: float = 30.0
    distance: float = 0.4
    pixel: float = 0.115
    factor: int = 2

    @property
    def step(self) -> float:
        return self.distance / self.pixel

    @property
    def sin(self) -> float:
        return math.sin(math.radians(self.theta))

    @property
    def cos(self) -> float:
        return math.cos(math.radians(self.theta))

    @property
    def tan(self) -> float:
        return math.tan(math.radians(self.theta))

    def shape(self, crop: bool = False, multiple: int = 4) -> tuple[int, int, int, int, int]:
        """(nz, ny, nx, pad of y, crop of y): padded after the crop, so that stores and data agree."""
        ny = math.ceil(self.planes * self.step + self.rows * self.cos)
        nz = math.ceil(self.rows * self.sin)
        cut = math.ceil(self.rows * self.cos) if crop else 0
        ny -= 2 * cut
        pad = -ny % multiple
        return nz, ny + pad, self.columns + -self.columns % multiple, pad, cut

    @property
    def out(self) -> tuple[int, int]:
        """z and y sizes of the result, before padding."""
        nz, ny, _, pad, _ = self.shape()
        return max(1, nz // self.factor), ny - pad


def deskewed_shape(planes: Column, rows: Column, columns: Column, theta: float = 30.0, distance: float = 0.4, pixel: float = 0.115, crop: bool = False, multiple: int = 4) -> dict[str, Column]:
    """``Geometry.shape`` of columns of stack sizes: nz, ny and nx, padded, the pad of y and its crop."""
    r = math.radians(theta)
    cut = F.ceil(rows * F.lit(math.cos(r))) if crop else F.lit(0)
    ny = F.ceil(planes * F.lit(distance / pixel) + rows * F.lit(math.cos(r))) - 2 * cut
    pad = F.pmod(-ny, F.lit(multiple))
    out = {"nz": F.ceil(rows * F.lit(math.sin(r))), "ny": ny + pad, "nx": columns + F.pmod(-columns, F.lit(multiple)), "pad": pad, "crop": cut}
    return {k: v.cast("int") for k, v in out.items()}


def lines(voxels: DataFrame, columns: int) -> DataFrame:
    """Rows of pixels as arrays over x = 0 .. columns - 1, which deskewing leaves as it is: one row where there were as many
    as pixels. A pixel that is not in the table is 0."""
    found = F.collect_list(F.struct("x", F.col("v").cast("double").alias("v")))
    own = voxels.where((F.col("x") >= 0) & (F.col("x") < columns)).groupBy("t", "p", "c", "z", "y").agg(found.alias("found"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(columns - 1)), F.transform("found", lambda s: s["x"]))
    zeros = F.transform(missing, lambda x: F.struct(x.cast("int").alias("x"), F.lit(0.0).alias("v")))
    whole = F.when(F.size("found") == columns, F.col("found")).otherwise(F.concat("found", zeros))
    return own.select("t", "p", "c", "z", "y", F.transform(F.array_sort(whole), lambda s: s["v"]).alias("line"))


@dataclass(frozen=True)
class Taps:
    """The four source rows of output rows (z, y): planes after and before, the upper row's number in each, weights."""

    z: np.ndarray
    y: np.ndarray
    plane: np.ndarray
    ja: np.ndarray
    jb: np.ndarray
    va: np.ndarray
    vb: np.ndarray


def taps(g: Geometry, z: np.ndarray, y: np.ndarray) -> Taps:
    """Of those output rows that have four taps inside the stack."""
    vp = y - z / g.tan
    pb = np.floor(vp / g.step).astype(np.int64)
    ahead = vp - pb * g.step
    za = z / g.sin
    vb, va = za + ahead * g.cos, za - (g.step - ahead) * g.cos
    jb, ja = np.floor(vb).astype(np.int64), np.floor(va).astype(np.int64)
    ok = (pb >= 0) & (pb + 1 < g.planes) & (jb >= 0) & (ja >= 0) & (jb + 1 < g.rows) & (ja + 1 < g.rows)
    return Taps(*(x[ok] for x in (z, y, pb, ja, jb, va, vb)))


def slanted_rows(image: np.ndarray, low: int, g: Geometry, oz: int, y: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (oz, y) of the result, and which of them read a row that is there. ``image`` has the rows of the planes from ``low``
    on, one plane after another. A row is a fixed-order sum of its four taps, clipped as the accumulation clips, divided by
    the factor and truncated."""
    depth = g.out[0] * g.factor if g.shape()[0] >= g.factor else g.shape()[0]
    total, some = np.zeros((len(y), image.shape[1])), np.zeros(len(y), bool)
    for z in range(oz * g.factor, min((oz + 1) * g.factor, depth)):
        t = taps(g, np.full(len(y), z), y)
        before = (t.plane - low) * g.rows
        rows_of = before + g.rows + t.ja + 1, before + g.rows + t.ja, before + t.jb + 1, before + t.jb
        weights = t.va - t.ja, 1 - t.va + t.ja, t.vb - t.jb, 1 - t.vb + t.jb
        four = [image[r] * w[:, None] for r, w in zip(rows_of, weights)]
        value = (((four[0] + four[1]) + four[2]) + four[3]) / g.step
        own = np.searchsorted(y, t.y)
        total[own] = np.minimum(65534.0, total[own] + np.clip(value, 0.0, 65534.0))
        some[own] |= there[rows_of[0]] | there[rows_of[1]] | there[rows_of[2]] | there[rows_of[3]]
    return np.floor(total / float(g.factor)), some


def deskew_lines(rows: DataFrame, g: Geometry, reverse: bool = False, block: int = 32) -> DataFrame:
    """Deskewed lines of lines(t, p, c, z, y, line); ``reverse`` counts the result's z from its other end.

    The taps of an output row (see ``slanted_rows``) are in two neighbouring planes, so the result is dealt to blocks of ``block`` planes by the plane of
    its first z, and a plane goes to its block and, near a border, to the next: one shuffle. A line that is not in the table
    is 0; a row of the result is there where any line that it reads is.
    """
    nz, ny = g.out
    reach = math.ceil((g.factor - 1) / g.tan / g.step)  # planes between the first and the last z of a row
    n_blocks = -(-g.planes // block)
    first = F.greatest(F.lit(0), F.floor((F.col("z") - 1) / block)).cast("int")
    last = F.least(F.lit(n_blocks - 1), F.floor((F.col("z") + reach) / block)).cast("int")
    dealt = rows.where((F.col("z") >= 0) & (F.col("z") < g.planes) & (F.col("y") >= 0) & (F.col("y") < g.rows)).withColumn("block", F.explode(F.sequence(first, last)))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        number = key[3].as_py()
        low = max(0, number * block - reach)
        planes = min(g.planes, (number + 1) * block + 1) - low
        image = np.zeros((planes * g.rows, g.columns))
        there = np.zeros(planes * g.rows, bool)
        at = (table.column("z").to_numpy() - low) * g.rows + table.column("y").to_numpy()
        image[at] = table.column("line").combine_chunks().flatten().to_numpy().reshape(-1, g.columns)
        there[at] = True
        zs, ys, out = [], [], []
        for oz in range(nz):
            # the rows whose first z reads a plane of this block
            y = np.arange(ny)
            own_block = np.minimum(np.floor((y - oz * g.factor / g.tan) / g.step).astype(np.int64) // block, n_blocks - 1)
            y = y[own_block == number]
            if not len(y):
                continue
            total, some = slanted_rows(image, low, g, oz, y, there)
            zs.append(np.full(int(some.sum()), nz - 1 - oz if reverse else oz, np.int32))
            ys.append(y[some].astype(np.int32))
            out.append(total[some].astype(np.int32))
        z, y = (np.concatenate([*x, np.zeros(0, np.int32)]) for x in (zs, ys))
        flat = np.concatenate([x.ravel() for x in out] + [np.zeros(0, np.int32)])
        line = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * g.columns), pa.array(flat))
        same = [pa.array(np.full(len(z), k.as_py(), np.int32)) for k in key[:3]]
        return pa.table([*same, pa.array(z), pa.array(y), line], names=["t", "p", "c", "z", "y", "line"])

    return dealt.groupBy("t", "p", "c", "block").applyInArrow(run, "t int, p int, c int, z int, y int, line array<int>")


def voxels_of(rows: DataFrame) -> DataFrame:
    keys = [c for c in rows.columns if c != "line"]
    return rows.select(*keys, F.posexplode("line").alias("x", "v"))


def deskew(voxels: DataFrame, g: Geometry, reverse: bool = False, block: int = 32) -> DataFrame:
    return voxels_of(deskew_lines(lines(voxels, g.columns), g, reverse, block))


def max_lines(rows: DataFrame) -> DataFrame:
    """Maximum over z of lines: as one array maximum for each pixel of the lines that meet."""
    folded = F.aggregate(F.col("all"), F.element_at("all", 1), lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))
    return rows.groupBy("t", "p", "c", "y").agg(F.collect_list("line").alias("all")).select("t", "p", "c", "y", folded.alias("line"))


def lab_to_camera(x: Column, y: Column, z: Column, theta: float) -> tuple[Column, Column, Column]:
    r = math.radians(theta)
    return x, z / F.lit(math.sin(r)), y - z / F.lit(math.tan(r))
