"""Acquisition metadata: key search, positions, channels, grids, names, and the layout of multiscale stores."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Gain by the camera port's name, in this order.
PORT_GAINS = (("Dynamic Range", 0.23), ("Speed", 0.85), ("Sensitivity", 0.25), ("Sub-Electron", 0.015))


def find_key(data: Any, key: str) -> Any:
    """Depth-first, in the document's order: the first value of ``key`` that is not None."""
    if isinstance(data, dict):
        if data.get(key) is not None:
            return data[key]
        data = list(data.values())
    if isinstance(data, list):
        for item in data:
            if (got := find_key(item, key)) is not None:
                return got
    return None


def json_find(text: Column, key: str) -> Column:
    """``find_key`` over JSON text, as JSON, in Arrow batches; for documents without a fixed shape."""
    @F.pandas_udf(T.StringType())
    def find(texts: pd.Series) -> pd.Series:
        found = [find_key(json.loads(t), key) if t else None for t in texts]
        return pd.Series([None if x is None else json.dumps(x) for x in found], dtype=object)

    return find(text)


def port_gain(port: Column) -> Column:
    """Null where the port is unknown, for the caller to refuse."""
    out = F.lit(None).cast("double")
    for name, gain in reversed(PORT_GAINS):
        out = F.when(port.contains(name), F.lit(gain)).otherwise(out)
    return out


def required_gain(port: Column) -> Column:
    """``port_gain``, an error where the port is unknown."""
    return F.coalesce(port_gain(port), F.raise_error(F.concat(F.lit("unknown camera port "), F.coalesce(port, F.lit("null")))).cast("double"))


def wavelength_um(name: Column) -> Column:
    """The wavelength of a channel that is named by nanometres ("488nm") in micrometres, null for other names."""
    number = F.trim(F.regexp_replace(name, "[nm]+$", ""))
    return F.when(number.rlike(r"^\d+(\.\d+)?$"), number.cast("double") / 1000.0)


def plain_number(text: Column) -> Column:
    """A number that is written with its unit of micrometres, such as "0.4 µm"."""
    return F.regexp_replace(text, "^[ \u00b5m]+|[ \u00b5m]+$", "").cast("double")


def emission_um(name: Column) -> Column:
    """The number before "em" in micrometres; null where there is none."""
    got = F.regexp_extract(name, r"(\d+(?:\.\d+)?)\s*em", 1)
    return F.when(got != "", got.cast("double") / 1000.0)


def first_positions(frames: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """The values of each key's first frame."""
    return frames.groupBy(key).agg(*[F.min_by(v, order).alias(v) for v in values])


def first_time_positions(frames: DataFrame, values: list[str], order: str = "event_id") -> DataFrame:
    """(p, values...) of each position's first frame at the least time; frames that lack p, t or a value are skipped."""
    whole = frames.where(" and ".join(f"{c} is not null" for c in ("t", "p", *values)))
    start = whole.agg(F.min("t").alias("start"))
    return first_positions(whole.join(F.broadcast(start), F.col("t") == F.col("start")), "p", order, values)


def with_positions(frames: DataFrame, tiles: DataFrame) -> DataFrame:
    """frames(t, p, ...) with their tile's stage position; frames without one are skipped."""
    return frames.join(tiles.select("t", "p", "stage_z", "stage_y", "stage_x"), ["t", "p"])


def ordered_distinct(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, place) in order of first appearance; nulls and empty strings are skipped."""
    first = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(value).agg(F.min(order).alias("first"))
    return first.select(value, (F.row_number().over(Window.orderBy("first", value)) - 1).alias("place"))


def flip_positions(tiles: DataFrame, flips: dict[str, bool]) -> DataFrame:
    """Axis positions as distance from the largest one, for the axes that are flipped."""
    on = [a for a, f in flips.items() if f]
    if not on:
        return tiles
    highs = tiles.agg(*[F.max(a).alias(f"hi_{a}") for a in on])
    return tiles.crossJoin(F.broadcast(highs)).select(*[(F.col(f"hi_{a}") - F.col(a)).alias(a) if a in on else F.col(a) for a in tiles.columns])


def grid_overlap(tiles: DataFrame, axis: str, size: int, pixel: float) -> DataFrame:
    """(steps, overlap): distinct coordinates along an axis and the signed overlap of neighbours, 0 if there is one. A
    coordinate within 1e-4 of the next smaller one is the same; the first tile of each gives its place."""
    near = Window.orderBy("at")
    each = tiles.select(F.round(axis, 5).alias("at"), "p").groupBy("at").agg(F.min("p").alias("p"))  # a grid's few steps
    run = F.sum(F.when(F.col("at") - F.lag("at").over(near) <= 1e-4, 0).otherwise(1)).over(near)
    spots = each.withColumn("run", run).groupBy("run").agg(F.min_by("at", "p").alias("at"), F.min("p").alias("p"))
    firsts = spots.agg(F.count(F.lit(1)).alias("steps"), F.slice(F.array_sort(F.collect_list(F.struct("p", "at"))), 1, 2).alias("two"))
    step = F.when(F.size("two") > 1, F.expr("element_at(two, 2).at - element_at(two, 1).at")).otherwise(0.0)
    return firsts.select("steps", F.when(step == 0, 0.0).otherwise(F.round(F.signum(step) * (F.lit(size * pixel) - F.abs(step)), 2)).alias("overlap"))


def export_name(tile: Column, channel: Column, name: Column, stamp: str, x: Column, y: Column, z: Column, t: Column) -> Column:
    return F.format_string(f"Scan_Iter_%04d_0000_CamA_ch%d_CAM1_stack000_%s_{stamp}_%03dx_%03dy_%03dz_%04dt.zarr", tile, channel, name, x, y, z, t)


def pyramid_transforms(base: dict[str, float | Column], origin: dict[str, float | Column], factors: list[int]) -> list[dict]:
    """Scale and translation of each level, of numbers or of columns: translations move by half the voxel of the level before."""
    out = [{"level": 0, **{f"scale_{a}": s for a, s in base.items()}, **{f"shift_{a}": origin[a] * 1.0 for a in base}}]
    done = 1
    for n, f in enumerate(factors, 1):
        last = out[-1]
        ratio = f / done
        out.append({"level": n, **{f"scale_{a}": s * f for a, s in base.items()}, **{f"shift_{a}": last[f"shift_{a}"] + last[f"scale_{a}"] * (0.5 * (ratio - 1)) for a in base}})
        done = f
    return out


def multiscale_json(name: str, axes: list[str], base: dict[str, float], origin: dict[str, float], factors: list[int], channels: list[str]) -> dict:
    """The group document of a multiscale store (version 0.5)."""
    kinds = {"t": "time", "c": "channel"}
    units = {a: "micrometer" for a in "zyx"}
    sets = []
    for row in pyramid_transforms(base, origin, factors):
        scale = [row.get(f"scale_{a}", 1.0) for a in axes]
        shift = [row.get(f"shift_{a}", 0.0) for a in axes]
        sets.append({"path": f"scale{row['level']}/image", "coordinateTransformations": [{"type": "scale", "scale": scale}, {"type": "translation", "translation": shift}]})
    described = [{"name": a, "type": kinds.get(a, "space"), **({"unit": units[a]} if a in units else {})} for a in axes]
    return {"zarr_format": 3, "node_type": "group", "attributes": {"ome": {"version": "0.5", "multiscales": [{"name": name, "axes": described, "datasets": sets}], "omero": {"channels": [{"label": c} for c in channels]}}}}


def multiscale_json_v04(axes: list[dict], base: float, origin: tuple[float, float], channels: list[dict], levels: int) -> dict:
    """The older document (version 0.4) of planes (t, c, y, x) whose levels halve the one before."""
    rows = pyramid_transforms({"y": base, "x": base}, dict(zip("yx", origin)), [2**k for k in range(1, levels)])
    steps = lambda r: [{"type": "scale", "scale": [1.0, 1.0, r["scale_y"], r["scale_x"]]}, {"type": "translation", "translation": [0.0, 0.0, r["shift_y"], r["shift_x"]]}]
    sets = [{"path": str(r["level"]), "coordinateTransformations": steps(r)} for r in rows]
    return {"multiscales": [{"version": "0.4", "name": "/", "axes": axes, "datasets": sets}], "omero": {"channels": channels}}


_MULTISCALES = (
    "array<struct<axes: array<struct<name: string>>, datasets: array<struct<path: string, "
    "coordinateTransformations: array<struct<type: string, scale: array<double>, translation: array<double>>>>>>>"
)


def multiscale_levels(docs: DataFrame, text: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, level, path, axis, scale, shift): every level and axis that the group documents in ``text`` list, of version 0.5
    (under attributes.ome) or 0.4. Transforms apply in their order: a scale after a translation scales that too. A
    document without multiscales gives no rows."""
    doc = F.from_json(text, f"multiscales {_MULTISCALES}, attributes struct<ome: struct<multiscales: {_MULTISCALES}>>")
    scales = docs.select(*keep, F.explode(F.coalesce(doc["attributes"]["ome"]["multiscales"], doc["multiscales"])).alias("m"))
    levels = scales.select(*keep, "m.axes", F.posexplode("m.datasets").alias("level", "d"))
    axes = levels.select(*keep, "level", "d.path", "d.coordinateTransformations", F.posexplode("axes").alias("n", "a"))
    at = F.col("n") + 1

    def step(done: Column, one: Column) -> Column:
        by = F.coalesce(F.try_element_at(one["scale"], at), F.lit(1.0))
        move = F.coalesce(F.try_element_at(one["translation"], at), F.lit(0.0))
        return F.struct((done["scale"] * by).alias("scale"), (done["shift"] * by + move).alias("shift"))

    found = F.aggregate(F.coalesce("coordinateTransformations", F.array()), F.struct(F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift")), step)
    return axes.select(*keep, "level", "path", F.col("a.name").alias("axis"), found.alias("f")).select(*keep, "level", "path", "axis", "f.scale", "f.shift")


def scan_geometry(stage_angle: Column, stage_step: Column) -> tuple[Column, Column]:
    """Tilt in degrees and scan step of a stage that moves at an angle (degrees) to the coverslip."""
    return F.lit(90.0) - stage_angle, stage_step / F.tan(F.radians(stage_angle))


def skewed_size(z: Column, y: Column, x: Column, theta: float, pixel: float, step: float, odd: bool = True) -> tuple[Column, Column, Column]:
    """Planes, rows and columns of a skewed region that holds z by y by x micrometres; theta is in radians. The scan length
    is rounded up to whole micrometres before it is divided into steps."""
    columns = F.ceil(x / F.lit(pixel))
    rows = F.ceil(z / F.lit(pixel) / F.lit(math.sin(theta)))
    planes = F.floor(F.ceil((rows + 1) * F.lit(0.5) * F.lit(pixel) * F.lit(math.cos(theta)) + y) / F.lit(step))
    sizes = [n.cast("int") for n in (planes, rows, columns)]
    return tuple(n + (n % 2 == 0).cast("int") if odd else n for n in sizes)


def skewed_coords(plane: Column, row: Column, theta: float, pixel: float, step: float, kind: str) -> Column:
    """Where a voxel of an oblique scan lies, in micrometres: along the scan ("lateral") or in depth ("axial"); theta is in
    degrees. ValueError for another kind."""
    r = math.radians(theta)
    if kind == "lateral":
        return plane * F.lit(step) + row * F.lit(pixel) * F.lit(math.cos(r))
    if kind == "axial":
        return row * F.lit(pixel) * F.lit(math.sin(r))
    raise ValueError("kind is lateral or axial")


def layer_placement(tiles: DataFrame, pixel: float) -> DataFrame:
    """(t, p, scale_z, scale_y, scale_x, stage_z, stage_y, stage_x): the scale of a viewer's layer, whose depth is sampled
    half as finely, and where it is put."""
    return tiles.select("t", "p", F.lit(2 * pixel).alias("scale_z"), F.lit(pixel).alias("scale_y"), F.lit(pixel).alias("scale_x"), "stage_z", "stage_y", "stage_x")


def fused_placement(tiles: DataFrame, pixel: float, lengths: dict[str, int]) -> DataFrame:
    """The centre of the space that all tiles cover, by axis: where the layer of a fused image is put."""
    rows = tiles.agg(*[f(f"stage_{a}").alias(f"{n}_{a}") for a in lengths for n, f in (("lo", F.min), ("hi", F.max))])
    return rows.select(*[((F.col(f"lo_{a}") + F.col(f"hi_{a}") + F.lit(n * pixel)) / 2.0).alias(f"centre_{a}") for a, n in lengths.items()])


def index_to_physical(index: Column, transforms: list[tuple[str, float]]) -> Column:
    """Scales and translations in the order in which they are listed."""
    for kind, value in transforms:
        index = index * F.lit(value) if kind == "scale" else index + F.lit(value)
    return index


def per_index_map(meta: DataFrame) -> DataFrame:
    """The nested map t -> p -> c -> (stage_position, channel) of meta(t, p, c, stage_z, stage_y, stage_x, channel), one
    row for each time point."""
    leaf = F.struct(F.array("stage_z", "stage_y", "stage_x").alias("stage_position"), "channel")
    text = lambda k: F.col(k).cast("string")
    by_c = meta.groupBy("t", "p").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(text("c").alias("key"), leaf.alias("value"))))).alias("m"))
    return by_c.groupBy("t").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(text("p").alias("key"), F.to_json("m").alias("value"))))).alias("m"))


def edges_to_json(edges: DataFrame) -> DataFrame:
    """One JSON object "i,j" -> [dz, dy, dx, score] for each time point."""
    entry = F.struct(F.concat_ws(",", "i", "j").alias("key"), F.array(*[F.col(c).cast("double") for c in ("dz", "dy", "dx", "score")]).alias("value"))
    return edges.groupBy("t").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("json"))


def edges_from_json(rows: DataFrame) -> DataFrame:
    parsed = rows.select("t", F.explode(F.from_json("json", "map<string, array<double>>")).alias("k", "e"))
    ij = F.split("k", ",")
    return parsed.select("t", ij[0].cast("int").alias("i"), ij[1].cast("int").alias("j"), *[F.col("e")[n].cast("int").alias(c) for n, c in enumerate(("dz", "dy", "dx"))], F.col("e")[3].alias("score"))


def json_safe(value: Any) -> Any:
    """Arrays as lists, through dicts and lists."""
    if hasattr(value, "tolist"):
        return value.tolist()
    if isinstance(value, dict):
        return {k: json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    return value


def merge_attributes(path: str, new: dict) -> dict:
    """Read-modify-write of a store's attributes in its zarr.json, which is replaced whole. Where there is none, a group's is
    made."""
    from ..sources import files

    place = f"{path}/zarr.json"
    doc = files.read_json(place) if files.exists(place) else {"zarr_format": 3, "node_type": "group"}
    doc.setdefault("attributes", {}).update(json_safe(new))
    files.write_json(place, doc)
    return doc["attributes"]
