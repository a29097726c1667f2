"""Zarr stores, version 2 and 3, as tables of chunks and as voxels; written as version 3, sharded or not.

Chunks are read by executors through pyarrow's file systems, one row a chunk: (origin array<int>, shape array<int>, dtype
string, data binary). Codecs: none, gzip, zlib, zstd, Blosc (see ``codecs``). A sharded array is read through the index at
the end of each shard, and only the inner chunks that are asked for are read. A chunk that is not stored holds the fill
value: if that is not 0 it is made, else its voxels are absent, which all operators take as 0.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .codecs import crc32c, decode, encode

EMPTY = 2**64 - 1
#: Decoded bytes of chunks that a task of a read is given.
TASK_BYTES = 32 << 20


@dataclass(frozen=True)
class Layout:
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    dtype: str
    codec: str
    fill: float
    separator: str = "/"
    version: int = 3
    inner: tuple[int, ...] | None = None

    def path(self, at: tuple[int, ...]) -> str:
        name = self.separator.join(map(str, at))
        return f"c/{name}" if self.version == 3 and self.separator == "/" else f"c{self.separator}{name}" if self.version == 3 else name

    @property
    def unit(self) -> tuple[int, ...]:
        """The shape of what is encoded together."""
        return self.inner or self.chunk


def _fill(value: object) -> float:
    return float("nan") if value == "NaN" else float(value or 0)


def layout(path: str) -> Layout:
    """The layout of the array at ``path``: version 3 where there is a zarr.json of an array, else version 2."""
    if files.exists(f"{path}/zarr.json"):
        m = files.read_json(f"{path}/zarr.json")
        if m.get("node_type") != "array":
            raise ValueError(f"{path} is a group; open one of its levels")
        chunk = tuple(m["chunk_grid"]["configuration"]["chunk_shape"])
        codecs, inner = m["codecs"], None
        if codecs[0]["name"] == "sharding_indexed":
            inner = tuple(codecs[0]["configuration"]["chunk_shape"])
            codecs = codecs[0]["configuration"]["codecs"]
        names = [c["name"] for c in codecs if c["name"] not in ("bytes", "crc32c")]
        separator = m.get("chunk_key_encoding", {}).get("configuration", {}).get("separator", "/")
        return Layout(tuple(m["shape"]), chunk, np.dtype(m["data_type"]).newbyteorder("<").str, names[0] if names else "", _fill(m.get("fill_value")), separator, 3, inner)
    m = files.read_json(f"{path}/.zarray")
    return Layout(tuple(m["shape"]), tuple(m["chunks"]), m["dtype"], (m.get("compressor") or {}).get("id", ""), _fill(m.get("fill_value")), m.get("dimension_separator", "."), 2)


def stored(path: str, m: Layout, at: tuple[int, ...], wanted: list[tuple[int, int]] | None) -> Iterator[tuple[tuple[int, ...], np.ndarray | None]]:
    """(origin, block) of the encoded units of one file that meet the wanted ranges; None where nothing is stored."""
    system, root = files.place(f"{path}/{m.path(at)}")
    origin = tuple(a * c for a, c in zip(at, m.chunk))
    here = system.get_file_info(root)
    there = here.type.name == "File"

    def meets(start: tuple[int, ...]) -> bool:
        inside = all(s < n for s, n in zip(start, m.shape))
        return inside and all(s < hi and s + u > lo for s, u, (lo, hi) in zip(start, m.unit, wanted or [(0, n) for n in m.shape]))

    if m.inner is None:
        if not there:
            yield origin, None
            return
        with system.open_input_stream(root) as f:
            yield origin, np.frombuffer(decode(f.read(), m.codec), m.dtype).reshape(m.chunk)
        return
    grid = tuple(c // i for c, i in zip(m.chunk, m.inner))
    n = math.prod(grid)
    index, source = np.full((n, 2), EMPTY, np.uint64), None
    if there:
        source = system.open_input_file(root)
        tail = source.read_at(16 * n + 4, here.size - 16 * n - 4)
        if crc32c(tail[:-4]) != int.from_bytes(tail[-4:], "little"):
            raise ValueError(f"the index of shard {root} is damaged")
        index = np.frombuffer(tail[:-4], "<u8").reshape(n, 2)
    for k, (offset, size) in zip(itertools.product(*map(range, grid)), index.tolist()):
        start = tuple(o + a * i for o, a, i in zip(origin, k, m.inner))
        if meets(start):
            yield start, None if offset == EMPTY else np.frombuffer(decode(source.read_at(size, offset), m.codec), m.dtype).reshape(m.inner)
    if source:
        source.close()


CHUNKS = "origin array<int>, shape array<int>, dtype string, data binary"


def read_chunks(spark: SparkSession, path: str, where: dict[int, tuple[int, int]] | None = None, dense: bool = False) -> DataFrame:
    """One row for each stored chunk; ``where`` prunes files, and inner chunks of shards, by half-open ranges of axes before
    any is read. Chunks that are not stored are made where the fill value is not 0, or if ``dense``."""
    m = layout(path)
    wanted = [(where or {}).get(axis, (0, n)) for axis, n in enumerate(m.shape)]
    spans = [range(max(0, lo) // c, max(max(0, lo) // c, -(-min(n, hi) // c))) for (lo, hi), c, n in zip(wanted, m.chunk, m.shape)]
    sizes = [len(s) for s in spans]
    total = math.prod(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                at = tuple(int(i) + s.start for i, s in zip(np.unravel_index(n, sizes), spans))
                for origin, block in stored(path, m, at, wanted):
                    if block is None and (dense or m.fill):
                        block = np.full(m.unit, m.fill).astype(m.dtype)
                    if block is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([origin], pa.list_(pa.int32())), pa.array([block.shape], pa.list_(pa.int32())), pa.array([m.dtype]), pa.array([block.tobytes()], pa.binary())], ["origin", "shape", "dtype", "data"])

    each = max(1, TASK_BYTES // (math.prod(m.chunk) * np.dtype(m.dtype).itemsize))
    return spark.range(0, total, 1, max(1, -(-total // each))).mapInArrow(run, CHUNKS)


def voxels(chunks: DataFrame, axes: str, shape: tuple[int, ...], kind: str = "int") -> DataFrame:
    """Voxels of chunks, with values of ``kind``; axes that are not in the store are 0, and what a chunk has beyond the shape
    is cut."""
    names = ["t", "p", "c", "z", "y", "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, size, dtype, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                block = np.frombuffer(data, dtype).reshape(size)
                block = block[tuple(slice(0, max(0, n - o)) for n, o in zip(shape, origin))]
                grid = np.indices(block.shape, np.int32).reshape(block.ndim, -1)
                cols = {a: grid[i] + np.int32(origin[i]) for i, a in enumerate(axes)}
                zero = np.zeros(block.size, np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(cols.get(a, zero)) for a in names), pa.array(block.ravel().astype(np.int32 if kind == "int" else np.float64))], [*names, "v"])

    return chunks.mapInArrow(run, f"t int, p int, c int, z int, y int, x int, v {kind}")


def read(spark: SparkSession, path: str, axes: str = "tpczyx", where: dict[str, tuple[int, int]] | None = None, dense: bool = False) -> DataFrame:
    """The voxels of the array at ``path``: whole numbers, or doubles where it holds floating-point ones."""
    m = layout(path)
    kind = "double" if np.dtype(m.dtype).kind == "f" else "int"
    found = voxels(read_chunks(spark, path, {axes.index(a): r for a, r in (where or {}).items()}, dense), axes, m.shape, kind)
    for a, (lo, hi) in (where or {}).items():
        found = found.where((F.col(a) >= lo) & (F.col(a) < hi))
    return found


# ---------------------------------------------------------------------------------------------- groups of levels


def levels(path: str) -> tuple[str, list[str]]:
    """The axes' initials and the levels' paths of the multiscale group at ``path``, of version 0.5 or 0.4."""
    doc = read_attributes(path)
    scales = (doc.get("ome") or doc).get("multiscales")
    if not scales:
        raise ValueError(f"{path} is no multiscale group")
    return "".join(a["name"] for a in scales[0]["axes"]), [d["path"] for d in scales[0]["datasets"]]


def open_level(spark: SparkSession, path: str, level: int = 0, dataset: str | None = None, where: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """The voxels of one level of a multiscale group, by its number or its path in the group; nothing is read before the
    result is used. ValueError for a path that the group does not list, IndexError for a level that it has not."""
    axes, paths = levels(path)
    if dataset is not None and dataset not in paths:
        raise ValueError(f"{dataset} is not one of {paths}")
    return read(spark, f"{path}/{dataset or paths[level]}", axes, where)


# ---------------------------------------------------------------------------------------------- writing


def acquisition_layout(shape: tuple[int, ...], dtype: str = "uint16", divisor: int = 4) -> Layout:
    """Of a processed stack (t, p, c, z, y, x): a shard for each (t, p, c), inner chunks of a plane's parts."""
    *_, z, y, x = shape
    return sharded(shape, (1, 1, 1, z, y, x), (1, 1, 1, 1, max(1, y // divisor), max(1, x // divisor)), dtype)


def fused_2d_layout(shape: tuple[int, ...], chunk: int = 512, per_shard: int = 8) -> Layout:
    """Of a fused projection (t, 1, c, 1, y, x): a shard holds all channels of ``per_shard`` x ``per_shard`` chunks."""
    side = chunk * per_shard
    return sharded(shape, (1, 1, shape[2], 1, side, side), (1, 1, 1, 1, chunk, chunk), "uint16")


def fused_3d_layout(shape: tuple[int, ...], planes: int = 4, chunk: int = 1024) -> Layout:
    """Of a fused image (t, c, z, y, x): a shard holds ``planes`` planes of 2 x 2 chunks."""
    return sharded(shape, (1, 1, planes, 2 * chunk, 2 * chunk), (1, 1, 1, chunk, chunk), "uint16")


def sharded(shape: tuple[int, ...], shard: tuple[int, ...], inner: tuple[int, ...], dtype: str) -> Layout:
    """A layout of whole inner chunks a shard: a shard that they do not fill is made larger."""
    whole = tuple(-(-s // i) * i for s, i in zip(shard, inner))
    return Layout(tuple(shape), whole, np.dtype(dtype).newbyteorder("<").str, "blosc", 0, inner=tuple(inner))


def create(path: str, m: Layout, attributes: dict | None = None, axes: str = "tpczyx", level: int = 5) -> Layout:
    """Write the metadata of an array of version 3."""
    if m.codec == "blosc":
        compressor = {"name": "blosc", "configuration": {"cname": "zstd", "clevel": level, "shuffle": "bitshuffle", "typesize": np.dtype(m.dtype).itemsize, "blocksize": 0}}
    else:
        compressor = {"name": "zstd", "configuration": {"level": level, "checksum": False}}
    little = {"name": "bytes", "configuration": {"endian": "little"}}
    codecs = [little, compressor]
    if m.inner:
        codecs = [{"name": "sharding_indexed", "configuration": {"chunk_shape": list(m.inner), "codecs": codecs, "index_codecs": [little, {"name": "crc32c"}], "index_location": "end"}}]
    files.write_json(f"{path}/zarr.json", {"zarr_format": 3, "node_type": "array", "shape": list(m.shape), "data_type": np.dtype(m.dtype).name, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(m.chunk)}}, "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}}, "fill_value": 0, "codecs": codecs, "attributes": attributes or {}, "dimension_names": list(axes)})
    return m


def write(frame: DataFrame, path: str, m: Layout, axes: str = "tpczyx", attributes: dict | None = None, level: int = 5) -> int:
    """Write voxels as an array of version 3; returns the number of its files.

    A task packs the voxels of one encoded unit; of a sharded array another one puts the packed units of a shard together,
    so no task holds more than a unit's voxels or a shard's packed bytes. A file appears by a rename, so a task that runs
    again is harmless. Voxels beyond the shape are left out, absent ones are 0.
    """
    create(path, m, attributes, axes, level)
    inside = frame.select(*axes, "v")
    for a, n in zip(axes, m.shape):
        inside = inside.where((F.col(a) >= 0) & (F.col(a) < n))
    units = [F.floor(F.col(a) / u).cast("int").alias(f"u_{a}") for a, u in zip(axes, m.unit)]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        at = tuple(int(group[f"u_{a}"].iloc[0]) for a in axes)
        block = np.zeros(m.unit, m.dtype)
        block[tuple(group[a].to_numpy() - k * u for a, k, u in zip(axes, at, m.unit))] = group.v.to_numpy().astype(m.dtype)
        if not block.any():
            return pd.DataFrame({"file": [], "place": [], "data": []}).astype({"file": str, "place": np.int32})
        file, place, data = packed(path, m, at, block, level)
        return pd.DataFrame({"file": [file], "place": [place], "data": [data]})

    return join_units(inside.select("*", *units).groupBy(*[f"u_{a}" for a in axes]).applyInPandas(pack, PACKED), path, m)


PACKED = "file string, place int, data binary"


def packed(path: str, m: Layout, at: tuple[int, ...], block: np.ndarray, level: int) -> tuple[str, int, bytes]:
    """The file of the encoded unit at place ``at``, its place in that file, and its bytes; none where they are written already
    because a file is one unit."""
    ratio = [c // u for c, u in zip(m.chunk, m.unit)]
    file = m.path(tuple(k // r for k, r in zip(at, ratio)))
    data = encode(np.ascontiguousarray(block).tobytes(), m.codec, block.itemsize, level)
    if m.inner is None:
        files.write_bytes(f"{path}/{file}", data)
        data = b""
    return file, int(np.ravel_multi_index([k % r for k, r in zip(at, ratio)], ratio)), data


def write_shard(file: str, units: list[tuple[int, bytes]], count: int) -> None:
    """A shard of ``count`` places from packed units (place, data), with its index at the end."""
    index, body, size = np.full((count, 2), EMPTY, np.uint64), [], 0
    for place, data in sorted(units):
        index[place] = size, len(data)
        body.append(data)
        size += len(data)
    tail = index.astype("<u8").tobytes()
    files.write_bytes(file, b"".join([*body, tail, crc32c(tail).to_bytes(4, "little")]))


def join_units(units: DataFrame, path: str, m: Layout) -> int:
    """Put the packed units (file, place, data) of each shard together and write it; the number of files."""
    if m.inner is None:
        return units.count()
    count = math.prod(c // u for c, u in zip(m.chunk, m.unit))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        write_shard(f"{path}/{group.file.iloc[0]}", list(zip(group.place, group.data)), count)
        return pd.DataFrame({"file": [group.file.iloc[0]]})

    return units.groupBy("file").applyInPandas(join, "file string").count()


def write_levels(frame: DataFrame, path: str, shape: tuple[int, ...], group: dict, factors: list[int], mode: str = "stride", axes: str = "tczyx", level_of=fused_3d_layout) -> None:
    """A multiscale group: ``group`` is its document, the image is level 0 and pyramid levels follow, each made from the one
    that was written before it."""
    from ..operators.reduce import block_reduce, stride

    files.write_json(f"{path}/zarr.json", group)
    spark, done = frame.sparkSession, 1
    shape = tuple(shape)
    write(frame, f"{path}/scale0/image", level_of(shape), axes)
    for n, f in enumerate(factors, 1):
        ratio = f // done
        done = f
        last = read(spark, f"{path}/scale{n - 1}/image", axes).select(*axes, "v")
        by = {a: ratio for a, s in zip(axes, shape) if a in "zyx" and s > 1}
        own = stride(last, by) if mode == "stride" else block_reduce(last, by, truncate=True)
        shape = tuple(-(-s // by.get(a, 1)) for a, s in zip(axes, shape))
        write(own, f"{path}/scale{n}/image", level_of(shape), axes)


# ---------------------------------------------------------------------------------------------- attributes, discovery


def read_attributes(path: str) -> dict:
    for name in ("zarr.json", ".zattrs"):
        if files.exists(f"{path}/{name}"):
            doc = files.read_json(f"{path}/{name}")
            return doc.get("attributes", {}) if name == "zarr.json" else doc
    return {}


def find_store(root: str, stem: str) -> str:
    """The processed store beside an acquisition, in order of preference."""
    for kind in ("_decon_deskewed", "_deskewed", "_decon_projection", "_projection"):
        for ending in (".zarr", ".ome.zarr"):
            if files.exists(f"{root}/{stem}{kind}{ending}"):
                return f"{root}/{stem}{kind}{ending}"
    raise FileNotFoundError(f"{root}/{stem}: no processed store")


def stores_in(root: str) -> list[str]:
    return [f"{root}/{n}" for n in files.children(root) if n.endswith("zarr") and (files.exists(f"{root}/{n}/zarr.json") or files.exists(f"{root}/{n}/.zarray") or files.exists(f"{root}/{n}/.zattrs"))]


def full_boxes(there: np.ndarray) -> Iterator[tuple[slice, ...]]:
    """Boxes without gaps that are all that is true in ``there``: one where it is true everywhere, else its like slices
    along an axis are taken together and each of these parts is cut on along the next axis."""
    todo = [(tuple(slice(0, n) for n in there.shape), 0)]
    while todo:
        box, axis = todo.pop()
        own = there[box]
        if own.all():
            yield box
        elif own.any():
            rows = np.moveaxis(own, axis, 0).reshape(own.shape[axis], -1)
            cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(1)) + 1).tolist(), len(rows)]
            first = box[axis].start
            todo += [((*box[:axis], slice(first + a, first + b), *box[axis + 1 :]), axis + 1) for a, b in zip(cuts, cuts[1:])]


def chunk_table(frame: DataFrame, chunk: tuple[int, ...] = (1, 1, 1, 8, 256, 256), axes: str = "tpczyx", gaps: bool = False) -> DataFrame:
    """Voxels as rows of packed chunks (origin, shape, dtype, data): the layout that array kernels read. A chunk is the box around
    its voxels, 0 where there is none; with ``gaps`` it is as many boxes as hold its voxels and no other. Values beyond 16 bits
    are kept in 32."""
    keys = [F.floor(F.col(a) / c).cast("int").alias(f"k_{a}") for a, c in zip(axes, chunk)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        low = [int(group[a].min()) for a in axes]
        size = [int(group[a].max()) - lo + 1 for a, lo in zip(axes, low)]
        at, v = tuple(group[a].to_numpy() - lo for a, lo in zip(axes, low)), group.v.to_numpy()
        kind = "<u2" if 0 <= v.min() and v.max() <= 65535 else "<i4"
        block = np.zeros(size, kind)
        block[at] = v
        boxes = [tuple(slice(0, n) for n in size)]
        if gaps:
            there = np.zeros(size, bool)
            there[at] = True
            boxes = list(full_boxes(there))
        parts = [block[box] for box in boxes]
        origins = [[lo + b.start for lo, b in zip(low, box)] for box in boxes]
        return pd.DataFrame({"origin": origins, "shape": [list(x.shape) for x in parts], "dtype": kind, "data": [x.tobytes() for x in parts]})

    return frame.select(*axes, "v", *keys).groupBy(*[f"k_{a}" for a in axes]).applyInPandas(run, CHUNKS)
