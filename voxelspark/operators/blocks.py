"""Dense blocks of voxel tables with their neighbourhood, for array kernels: one shuffle, in which only the voxels near a
block's border are sent twice. A voxel that is not in the table is 0, as in a dense image."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edge lengths of a block by axis: a million voxels, some 100 MB as rows in a task and 9 MB as doubles.
BLOCK = {"z": 8, "y": 384, "x": 384}


def over_blocks(
    voxels: DataFrame,
    sizes: dict[str, int],
    halo: dict[str, int],
    kernel: Callable[..., pd.DataFrame | np.ndarray],
    schema: str,
    values: tuple[str, ...] = ("v",),
    pad: str | float = "edge",
    block: dict[str, int] | None = None,
) -> DataFrame:
    """``kernel`` over blocks of an image of ``sizes``, given as voxels with the columns ``values``.

    The kernel gets, for each of ``values``, the block with ``halo`` voxels more on both sides of each axis, where what is
    beyond the image repeats its edge (pad "edge") or is a number; and the block's origin by axis. It returns either the
    block's new values, which become voxels (schema: the keys and v), or a table, which gets the keys of its block.
    """
    axes = list(sizes)
    keys = [k for k in ("t", "p", "c", "z", "y", "x") if k in voxels.columns and k not in axes]
    edge = {a: min(n, (block or BLOCK)[a]) for a, n in sizes.items()}
    dealt = voxels.select(*keys, *axes, *values)
    for a, n in sizes.items():
        first = F.greatest(F.lit(0), F.floor((F.col(a) - halo.get(a, 0)) / edge[a]))
        last = F.least(F.lit((n - 1) // edge[a]), F.floor((F.col(a) + halo.get(a, 0)) / edge[a]))
        number = F.lit(0) if n <= edge[a] else F.explode(F.sequence(first.cast("int"), last.cast("int")))
        dealt = dealt.where((F.col(a) >= 0) & (F.col(a) < n)).withColumn(f"b_{a}", number)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        at = {a: int(group[f"b_{a}"].iloc[0]) * edge[a] for a in axes}
        inner = {a: min(edge[a], sizes[a] - at[a]) for a in axes}
        low = {a: max(0, at[a] - halo.get(a, 0)) for a in axes}
        high = {a: min(sizes[a], at[a] + inner[a] + halo.get(a, 0)) for a in axes}
        missing = [(halo.get(a, 0) - at[a] + low[a], at[a] + inner[a] + halo.get(a, 0) - high[a]) for a in axes]
        place = tuple(group[a].to_numpy() - low[a] for a in axes)
        images = []
        for v in values:
            image = np.zeros([high[a] - low[a] for a in axes])
            image[place] = group[v].to_numpy()
            if any(map(any, missing)):
                image = np.pad(image, missing, "edge") if pad == "edge" else np.pad(image, missing, constant_values=pad)
            images.append(image)
        out = kernel(*images, at)
        if isinstance(out, np.ndarray):
            grid = np.indices(out.shape).reshape(len(axes), -1)
            out = pd.DataFrame({**{a: (grid[i] + at[a]).astype(np.int32) for i, a in enumerate(axes)}, "v": out.ravel()})
        return out.assign(**{k: group[k].iloc[0] for k in keys})[names]

    return dealt.groupBy(*keys, *[f"b_{a}" for a in axes]).applyInPandas(run, schema)


def box_mean(image: np.ndarray, radius: int) -> np.ndarray:
    """Mean over 2 radius + 1 neighbours along every axis, one axis after the other; the result lacks the border."""
    n = 2 * radius + 1
    for axis in range(image.ndim):
        # running sums of whole numbers are exact; of others the windows are summed one by one, so that errors don't add up
        parts: Iterator[np.ndarray] = (np.take(image, range(k, image.shape[axis] - n + 1 + k), axis) for k in range(n))
        image = sum(parts) / n
    return image
