"""A fitted model of the illumination: images are one smooth field, each times its own level, plus what is sparse."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .deconvolve import batch_means

#: Cells along an axis of the images that a field is fitted to. At most 15 positions x 25 batches x 64 x 64 of them meet in the
#: one task of a channel: 1.5 million numbers.
CELLS = 64


def cosines(n: int, cells: float, per_cell: float = 1.0, terms: int | None = None) -> np.ndarray:
    """(n, terms): the orthonormal cosines of ``cells`` cells at the middles of n pixels, of which ``per_cell`` make a cell."""
    k = np.arange(terms or int(cells))
    waves = np.cos(np.pi * np.outer((np.arange(n) + 0.5) / per_cell, k) / cells)
    return waves * np.sqrt(np.where(k == 0, 1.0, 2.0) / cells)


def _shrink(values: np.ndarray, by: np.ndarray | float) -> np.ndarray:
    return np.sign(values) * np.maximum(np.abs(values) - by, 0)


def _split(images: np.ndarray, weights: np.ndarray, smooth: float, tolerance: float, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cosine terms of the field, levels, sparse part) with images = level x field + sparse, by an augmented Lagrangian: least
    sum of |weights x sparse| plus ``smooth`` times that of the field's cosine terms, but for the constant one."""
    n, h, w = images.shape
    down, across = cosines(h, h), cosines(w, w)
    sparse, dual = np.zeros_like(images), np.zeros_like(images)
    levels = images.mean((1, 2))
    size = np.linalg.norm(images)
    stiff = 12.5 / size
    top = stiff * 1e7
    terms = np.zeros((h, w))
    for _ in range(steps):
        target = images - sparse + dual / stiff
        power = (levels**2).sum()
        if power == 0:
            break
        raw = down.T @ (np.tensordot(levels, target, 1) / power) @ across
        terms = _shrink(raw, smooth / (stiff * power))
        terms[0, 0] = raw[0, 0]
        field = down @ terms @ across.T
        mean = field.mean()
        if mean <= 0:
            break
        terms, field = terms / mean, field / mean
        levels = np.maximum(np.tensordot(target, field, 2) / (field**2).sum(), 0)
        fitted = levels[:, None, None] * field
        sparse = _shrink(images - fitted + dual / stiff, weights / stiff)
        left = images - fitted - sparse
        dual += stiff * left
        stiff = min(stiff * 1.5, top)
        if np.linalg.norm(left) < tolerance * size:
            break
    return terms, levels, sparse


def fit(images: np.ndarray, smooth: float = 0.5, rounds: int = 10, tolerance: float = 1e-6, steps: int = 200) -> np.ndarray:
    """The cosine terms (h, w) of the field of ``images`` (n, h, w), of mean 1.

    The field's terms pay ``smooth`` standard deviations of what random signs of the images' residuals add up to: with 3 noise
    makes no term, but a steep corner is flattened by some 3 %; with 0.5 by less than 1 %. Places with a large sparse part weigh less in the next round, until the field stands still. Images
    without light have the field 1.
    """
    n, h, w = images.shape
    plain = np.zeros((h, w))
    plain[0, 0] = np.sqrt(h * w)
    level = images.mean()
    if not level > 0:
        return plain
    images = images / level
    weights, last = np.ones_like(images), plain
    for _ in range(rounds):
        terms, levels, sparse = _split(images, weights, smooth * np.sqrt(n), tolerance, steps)
        if not terms.any():
            return plain
        change = np.linalg.norm(terms - last) / np.linalg.norm(last)
        last = terms
        if change < 1e-3:
            break
        weights = 1 / (np.abs(sparse) / max(levels.mean(), 1e-12) + 0.1)
        weights /= weights.mean()
    return last


def fitted_flat_field(voxels: DataFrame, offset: float, gain: float, shape: tuple[int, int, int], positions: int, seed: int = 0, batches: int = 25, cells: int = CELLS) -> DataFrame:
    """(c, y, x, ff) of mean 1: the field of each channel, fitted to the batch means of ``deconvolve.batch_means``.

    Batch means are averaged over at most ``cells`` cells an axis before the images of a channel meet in a task. The field
    is positive: where the fit is below a hundredth it is a hundredth. A channel without a voxel has no rows; a stack of
    fewer planes than batches has one plane a batch.
    """
    depth, height, width = shape
    means = batch_means(voxels, offset, gain, depth, positions, seed, min(batches, depth))
    fy, fx = -(-height // cells), -(-width // cells)
    rows, columns = -(-height // fy), -(-width // fx)
    pixels = F.least(F.lit(fy), height - F.col("cy") * fy) * F.least(F.lit(fx), width - F.col("cx") * fx)
    inside = means.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    coarse = inside.groupBy("c", "p", "batch", F.floor(F.col("y") / fy).cast("int").alias("cy"), F.floor(F.col("x") / fx).cast("int").alias("cx"))
    coarse = coarse.agg(F.sum("v").alias("total")).withColumn("v", F.col("total") / pixels).drop("total")

    def model(group: pd.DataFrame) -> pd.DataFrame:
        number = group.groupby(["p", "batch"]).ngroup().to_numpy()
        images = np.zeros((number.max() + 1, rows, columns))
        images[number, group.cy.to_numpy(), group.cx.to_numpy()] = group.v.to_numpy()
        return pd.DataFrame({"c": [group.c.iloc[0]], "terms": [fit(images).ravel()]})

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        down, across = cosines(height, rows, fy, rows), cosines(width, columns, fx, columns)
        for frame in frames:
            for c, terms in zip(frame.c, frame.terms):
                own = np.asarray(terms).reshape(rows, columns) @ across.T
                level = (down.mean(0) @ own).mean()
                for y in range(0, height, 64):
                    part = np.maximum((down[y : y + 64] @ own) / level, 0.01)
                    at = np.indices(part.shape).reshape(2, -1).astype(np.int32)
                    yield pd.DataFrame({"c": np.int32(c), "y": at[0] + np.int32(y), "x": at[1], "ff": part.ravel()})

    return coarse.groupBy("c").applyInPandas(model, "c int, terms array<double>").mapInPandas(lines, "c int, y int, x int, ff double")
