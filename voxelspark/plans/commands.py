"""From an acquisition's store to processed and fused stores.

    python -m voxelspark.plans.commands process /data/run.zarr --max-projection
    python -m voxelspark.plans.commands fuse /data/run.zarr

Paths may be URIs of any file system that pyarrow reads.
"""

from __future__ import annotations

import argparse
import json
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..operators import arrays as A
from ..operators import deconvolve as D
from ..operators import illumination as I
from ..operators import deskew as S
from ..operators import fusion as U
from ..operators import registration as G
from ..sources import files, tiff, zarr


@dataclass(frozen=True)
class Acquisition:
    """What an acquisition's attributes say. positions: (z, y, x) by position number; excess: planes before the scan runs
    evenly."""

    mode: str
    step: float
    excess: int
    pixel: float
    theta: float
    offset: float
    gain: float
    channels: list[str]
    positions: dict[int, tuple[float, float, float]]


def acquisition(path: str) -> Acquisition:
    """Of the store at ``path``. The modes are mirror, stage and projection; ValueError for another one."""
    doc = zarr.read_attributes(path)
    mode = str(M.find_key(doc, "mode"))
    number = lambda key: float(M.find_key(doc, key))
    if "mirror" in mode:
        step, excess = number("image_mirror_step_um"), 0
    elif "stage" in mode:
        step, excess = number("scan_axis_step_um"), int(number("excess_scan_positions"))
    elif "projection" in mode:
        step, excess = 0.0, 0
    else:
        raise ValueError(f"unknown mode {mode}")
    channels: list[str] = []
    positions: dict[int, tuple[float, float, float]] = {}
    for frame in M.find_key(doc, "frame_metadatas") or []:
        event = frame.get("mda_event", {})
        name = event.get("metadata", {}).get("DAQ", {}).get("current_channel")
        if name and name not in channels:
            channels.append(name)
        index, stage = event.get("index", {}), event.get("metadata", {}).get("Stage", {})
        if index.get("t") == 0 and "p" in index and {"x_pos", "y_pos", "z_pos"} <= set(stage):
            positions.setdefault(int(index["p"]), (float(stage["z_pos"]), float(stage["x_pos"]), float(stage["y_pos"])))
    return Acquisition(mode, step, excess, number("pixel_size_um"), number("angle_deg") if step else 0.0, number("offset"), number("e_to_ADU"), channels, positions)


def acquisition_of_tiff(path: str) -> Acquisition:
    """Of the TIFF stack of a stage-tilted instrument: camera values from the first page's metadata, geometry and channels from
    the summary in it. The stage moves at an angle to the coverslip, see ``metadata.scan_geometry``."""
    doc = tiff.instrument(files.read_bytes(path))
    offset, gain = tiff.camera(doc)
    summary = M.find_key(doc, "Summary") or doc
    settings = M.find_key(summary, "SPIMAcqSettings") or {}
    settings = json.loads(settings) if isinstance(settings, str) else settings
    tilt = float(summary["StageScanAnglePathA"])
    step = float(summary["z-step_um"]) / math.tan(math.radians(tilt))
    micrometres = lambda key: float(str(summary[key]).strip(" \u00b5m"))
    channels = []
    for channel in settings.get("channels", []):
        if found := re.search(r"(\d+(?:\.\d+)?)\s*em", channel.get("config_", "")):
            channels.append(f"{float(found[1]):g}nm")
    mode = "stage" if settings.get("isStageScanning") else "mirror"
    return Acquisition(mode, step, 0, float(summary["PixelSize_um"]), 90.0 - tilt, offset, gain, channels, {0: (0.0, micrometres("Position_Y"), micrometres("Position_X"))})


def read_tiff(spark: SparkSession, path: str, axes: str, where: dict[str, tuple[int, int]]) -> tuple[DataFrame, tuple[int, ...]]:
    """The blocks of a TIFF stack within ``where``, and its shape."""
    index = tiff.page_index(spark, path, axes)
    high = index.agg(*[F.max(F.element_at("at", k)).alias(f"n{k}") for k in range(1, 5)], F.max("height").alias("h"), F.max("width").alias("w")).first()
    blocks = tiff.read_blocks(spark, path, axes)
    for a, (lo, hi) in where.items():
        own = F.element_at("origin", A.AXES.index(a) + 1)
        blocks = blocks.where((own >= lo) & (own < hi))
    return blocks, (*(high[f"n{k}"] + 1 for k in range(1, 5)), high["h"], high["w"])


def tiles_of(spark: SparkSession, acq: Acquisition, times: range, positions: range | None = None) -> DataFrame:
    """(t, p, stage_z, stage_y, stage_x) with the axes flipped as the camera sees them; times and positions count from 0."""
    kept = [(p - positions.start if positions else p, at) for p, at in sorted(acq.positions.items()) if positions is None or p in positions]
    rows = [(t, p, *at) for t in range(len(times)) for p, at in kept]
    tiles = spark.createDataFrame(rows, "t int, p int, stage_z double, stage_y double, stage_x double")
    return M.flip_positions(tiles, {"stage_x": False, "stage_y": True, "stage_z": True})


#: Bytes of a flat-field that is sent to all tasks: 4 channels of 2,304 x 2,304 doubles have 170 MB.
FLAT_BYTES = 1 << 29


def flat_array(flat: DataFrame, channels: int, height: int, width: int) -> np.ndarray:
    """The flat-field (c, y, x, ff) as an array, 1 where it has no row. ValueError where a camera's frames are so large that tasks
    should not get it whole."""
    if 8 * channels * height * width > FLAT_BYTES:
        raise ValueError(f"a flat-field of {channels} x {height} x {width} is too large to be sent to all tasks")
    out = np.ones((channels, height, width))
    inside = flat.where((F.col("c") < channels) & (F.col("y") < height) & (F.col("x") < width)).select("c", "y", "x", F.col("ff").cast("double")).toArrow()
    c, y, x, ff = (column.to_numpy() for column in inside.columns)
    out[c, y, x] = ff
    return out


def flat_of(spark: SparkSession, path: str, acq: Acquisition, axes: str) -> DataFrame:
    """The flat-field that is kept beside the acquisition (a TIFF, or Parquet from an earlier run), else one that is estimated
    from its first time point and kept there."""
    kept = f"{_stem(path)}_flatfield.ome.tif"

    def make() -> DataFrame:
        if path.lower().endswith((".tif", ".tiff")):
            blocks, shape = read_tiff(spark, path, axes, {"t": (0, 1)})
        else:
            blocks, shape = A.read(spark, path, axes, {"t": (0, 1)})
        return I.fitted_flat_field(A.voxels(blocks, shape), acq.offset, acq.gain, shape[3:], shape[1])

    return D.cached_flat_field(spark, kept if files.exists(kept) else f"{_stem(path)}_flatfield.parquet", make)


def out_path(path: str, kind: str) -> str:
    return f"{_stem(path)}_{kind}.zarr"


def _stem(path: str) -> str:
    return re.sub(r"(\.ome)?\.(zarr|tiff?)/?$", "", path.rstrip("/"), flags=re.IGNORECASE)


def _describe(path: str, acq: Acquisition, tiles: DataFrame, more: dict) -> None:
    """Global attributes, and the position and channel of every (t, p, c): all written at once."""
    per_index: dict = {}
    for r in tiles.collect():  # one row for each stage position and time
        own = {str(c): {"stage_position": [r["stage_z"], r["stage_y"], r["stage_x"]], "channel": name} for c, name in enumerate(acq.channels)}
        per_index.setdefault(str(r["t"]), {})[str(r["p"])] = own
    M.merge_attributes(path, {"pixel_size_um": acq.pixel, "scan_axis_step_um": acq.step, "angle_deg": acq.theta, "channels": acq.channels, **more, "per_index_metadata": per_index})


def process(
    spark: SparkSession,
    path: str,
    max_projection: bool = True,
    deconvolve: bool = False,
    flat: DataFrame | None = None,
    flat_field: bool = False,
    crop_after_deskew: bool = False,
    times: tuple[int, int] | None = None,
    positions: tuple[int, int] | None = None,
    excess: int | None = None,
    flyback: int = 0,
    factor: int = 2,
    axes: str = "",
) -> dict[str, str]:
    """Correct, deconvolve if asked to, deskew and project the acquisition at ``path``; returns the paths of the stores that
    are written beside it, by kind. A projection is corrected (and deconvolved) only.

    What moves from store to store is blocks (``operators.arrays``). ``flat`` is a flat-field (c, y, x, ff); with ``flat_field``
    the one that is kept beside the acquisition is used, or estimated and kept. Each channel has a PSF of its own. Of a range
    of ``times`` or ``positions`` the result holds just these, counted from 0. A TIFF stack has its pages' ``axes``, such as
    "tzcyx".
    """
    where = {a: tuple(r) for a, r in (("t", times), ("p", positions)) if r}
    if path.lower().endswith((".tif", ".tiff")):
        acq = acquisition_of_tiff(path)
        axes = axes.lower() or "tzcyx"
        blocks, (all_t, all_p, n_c, depth, height, width) = read_tiff(spark, path, axes, where)
    else:
        acq = acquisition(path)
        axes = axes or ("tpcyx" if len(zarr.layout(path).shape) == 5 else "tpczyx")
        blocks, (all_t, all_p, n_c, depth, height, width) = A.read(spark, path, axes, where)
    spans = {"t": range(*where.get("t", (0, all_t))), "p": range(*where.get("p", (0, all_p)))}
    for a in where:
        blocks = A.crop(blocks, a, spans[a].start, spans[a].stop)
    n_t, n_p = len(spans["t"]), len(spans["p"])
    if flat is None and flat_field:
        flat = flat_of(spark, path, acq, axes)
    blocks = A.correct(blocks, acq.offset, acq.gain, None if flat is None else flat_array(flat, n_c, height, width))
    tiles = tiles_of(spark, acq, spans["t"], spans["p"])
    named = "decon_" if deconvolve else ""
    if "z" not in axes or not acq.step:
        if deconvolve:
            psfs = {c: D.projection_psf(_wavelength(acq, c), 1.35, 1.4, acq.pixel, 31)[None] for c in range(n_c)}
            blocks = A.to_16_bits(A.deconvolve(blocks, (n_t, n_p, n_c, 1, height, width), psfs))
        out = out_path(path, f"{named}projection")
        A.write(blocks, out, zarr.acquisition_layout((n_t, n_p, n_c, 1, height, width)))
        _describe(out, acq, tiles, {})
        return {"projection": out}
    skip = acq.excess if excess is None else excess
    planes = depth - skip - flyback
    if "stage" in acq.mode:
        blocks = A.flip(blocks, "z", depth)
    blocks = A.crop(blocks, "z", skip, skip + planes)
    scanned = (n_t, n_p, n_c, planes, height, width)
    if deconvolve:
        psfs = {c: D.skewed_psf(_wavelength(acq, c), 1.35, 1.4, acq.pixel, acq.step, acq.theta, (31, 31, 31)) for c in range(n_c)}
        blocks = A.deconvolve(blocks, scanned, psfs)
    g = S.Geometry(planes, height, width, acq.theta, acq.step, acq.pixel, factor)
    nz, ny = g.out
    _, padded, columns, pad, cut = g.shape(crop_after_deskew)
    whole = A.deskew(blocks, scanned, g)
    if crop_after_deskew:
        whole = A.crop(whole, "y", cut, ny - cut)
    out = {"deskewed": out_path(path, f"{named}deskewed")}
    A.write(whole, out["deskewed"], zarr.acquisition_layout((n_t, n_p, n_c, nz, padded, columns)))
    more = {"deskewed_pad_y": pad, "deskewed_pad_x": columns - width, "deskewed_voxel_size_um": [factor * acq.pixel, acq.pixel, acq.pixel]}
    _describe(out["deskewed"], acq, tiles, more)
    if max_projection:
        out["projection"] = out_path(path, f"{named}max_z_deskewed")
        written, shape = A.read(spark, out["deskewed"])
        A.write(A.project(written, shape), out["projection"], zarr.acquisition_layout((n_t, n_p, n_c, 1, padded, columns)))
        _describe(out["projection"], acq, tiles, more)
    return out


def _wavelength(acq: Acquisition, channel: int) -> float:
    name = acq.channels[channel] if acq.channels else "500nm"
    return float(name.rstrip("nm").strip()) / 1000


def stored_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(t, p, stage_z, stage_y, stage_x) from a processed store's attributes."""
    found = zarr.read_attributes(path).get("per_index_metadata", {})
    rows = [(int(t), int(p), *map(float, next(iter(by_c.values()))["stage_position"])) for t, by_p in found.items() for p, by_c in by_p.items()]
    return spark.createDataFrame(rows, "t int, p int, stage_z double, stage_y double, stage_x double")


def fuse(spark: SparkSession, path: str, register: bool = True, channel: int = 0, blend: tuple[int, int, int] = (10, 600, 600), factors: tuple[int, ...] = (2, 4, 8, 16, 32), score: float = 0.7) -> str:
    """Register and fuse the processed store at ``path``, or the one beside the acquisition at ``path``: a stack to a
    multiscale group of (t, c, z, y, x), a projection to one array (t, 1, c, 1, y, x). Edges between tiles are kept beside the
    store, and found anew only for tiles that changed. Returns the path of the result."""
    attributes = zarr.read_attributes(path)
    if "per_index_metadata" not in attributes:
        root, stem = path.rstrip("/").rsplit("/", 1)
        path = zarr.find_store(root, stem.removesuffix(".zarr").removesuffix(".ome"))
        attributes = zarr.read_attributes(path)
    blocks, (n_t, _, n_c, nz, ny, nx) = A.read(spark, path)
    tiles = stored_tiles(spark, path)
    pixel = float(attributes["pixel_size_um"])
    voxel = dict(zip("zyx", map(float, attributes.get("deskewed_voxel_size_um", [pixel] * 3))))
    shape = {"z": nz, "y": ny, "x": nx}
    if nz == 1:
        tiles = tiles.withColumn("stage_z", F.lit(0.0))
    if register:
        tiles = G.refine_positions(blocks, tiles, voxel, shape, score=score, channel=channel, store=out_path(path, "edges").removesuffix(".zarr") + ".parquet")
    tiles = tiles.cache()
    channels = spark.range(n_c).select(F.col("id").cast("int").alias("c"))
    out = out_path(path, "fused")
    if nz == 1:
        size = U.extent(tiles, voxel, {"y": ny, "x": nx}, {"y": 8, "x": 8}, up=False).first()
        profiles = [np.ones(1), np.array(U.cosine_mask(ny)), np.array(U.cosine_mask(nx))]
        fused = A.fused_blocks(blocks, tiles, voxel, (1, ny, nx), profiles, "fold", False, (1, U.FUSED, U.FUSED), channels)
        A.write(fused, out, zarr.fused_2d_layout((n_t, 1, n_c, 1, size["size_y"], size["size_x"])))
        M.merge_attributes(out, {"origin": [size["origin_y"], size["origin_x"]], "pixel_size_um": pixel})
    else:
        size = U.extent(tiles, voxel, shape, shape, up=True).first()
        profiles = [np.array(U.feather_profile(n, b)) for n, b in zip((nz, ny, nx), blend)]
        fused = A.fused_blocks(blocks, tiles, voxel, (nz, ny, nx), profiles, channels=channels)
        whole = (n_t, n_c, size["size_z"], size["size_y"], size["size_x"])
        origin = {a: size[f"origin_{a}"] for a in "zyx"}
        used = [f for f in factors if f <= max(whole[2:])]
        group = M.multiscale_json(out.rsplit("/", 1)[-1], list("tczyx"), voxel, origin, used, attributes.get("channels", []))
        A.write_levels(fused, out, whole, group, used)
    tiles.unpersist()
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    kinds = parser.add_subparsers(dest="command", required=True)
    one = kinds.add_parser("process")
    one.add_argument("path")
    for name in ("max-projection", "deconvolve", "crop-after-deskew", "flat-field"):
        one.add_argument(f"--{name}", action="store_true")
    for name in ("times", "positions"):
        one.add_argument(f"--{name}", type=int, nargs=2)
    one.add_argument("--axes", default="")
    one.add_argument("--excess", type=int)
    one.add_argument("--flyback", type=int, default=0)
    two = kinds.add_parser("fuse")
    two.add_argument("path")
    two.add_argument("--channel", type=int, default=0)
    two.add_argument("--no-register", action="store_true")
    args = vars(parser.parse_args(argv))
    spark = SparkSession.builder.getOrCreate()
    if args.pop("command") == "process":
        args = {k: tuple(v) if isinstance(v, list) else v for k, v in args.items()}
        print(process(spark, **args))
    else:
        print(fuse(spark, args["path"], not args["no_register"], args["channel"]))


if __name__ == "__main__":
    main()
