"""Block columns: tables whose rows are typed n-d arrays with their place in an image, and operators on them.

A row is (origin array<int>, shape array<int>, dtype string, data binary) over the axes t, p, c, z, y, x, as the reader of
stores gives it and its writer takes it. What an operator moves is bytes of blocks: each block is cut at the borders of the
blocks that the operator works on, with the halo these need, and its pieces meet there (``regroup``). What no block covers
is 0, as in a dense image.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import zarr
from . import fusion as U
from .deskew import Geometry, slanted_rows
from .pixel import TOP

AXES = "tpczyx"
SCHEMA = zarr.CHUNKS
_INTS = pa.list_(pa.int32())
Place = tuple[int, ...]
Block = tuple[Place, np.ndarray]
#: Edges (z, y, x) of the blocks of a fused image.
FUSED = (4, 1024, 1024)


# ---------------------------------------------------------------------------------------------- rows and arrays


def of_batch(origin: pa.Array, shape: pa.Array, dtype: pa.Array, data: pa.Array) -> Iterator[Block]:
    for o, s, k, d in zip(origin.to_pylist(), shape.to_pylist(), dtype.to_pylist(), data):
        yield tuple(o), np.frombuffer(d.as_buffer(), k).reshape(s)


def _columns(found: list[Block]) -> list[pa.Array]:
    return [
        pa.array([list(map(int, o)) for o, _ in found], _INTS),
        pa.array([list(a.shape) for _, a in found], _INTS),
        pa.array([a.dtype.str for _, a in found], pa.string()),
        pa.array([np.ascontiguousarray(a).tobytes() for _, a in found], pa.binary()),
    ]


def map_blocks(blocks: DataFrame, work: Callable[[Place, np.ndarray], Iterable[Block]]) -> DataFrame:
    """``work`` on every block, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, array in of_batch(*batch.columns):
                for one in work(origin, array):
                    yield pa.RecordBatch.from_arrays(_columns([one]), ["origin", "shape", "dtype", "data"])

    return blocks.select("origin", "shape", "dtype", "data").mapInArrow(run, SCHEMA)


#: Gives the numbers of the target blocks that a range [low, high) of one axis meets, and the range that each asks for.
Meet = Callable[[int, int], Iterable[tuple[int, int, int]]]


def grid(edge: int, size: int, before: int = 0, after: int = 0) -> Meet:
    """Targets of ``edge`` on an axis of ``size``, which ask for ``before`` and ``after`` more on their sides."""

    def meet(low: int, high: int) -> Iterator[tuple[int, int, int]]:
        for k in range(max(0, (low - after) // edge), min(-(-size // edge), (high - 1 + before) // edge + 1)):
            yield k, max(0, k * edge - before), min(size, (k + 1) * edge + after)

    return meet


def _cut(origin: Place, array: np.ndarray, meets: list[Meet]) -> Iterator[tuple[Place, Place, np.ndarray]]:
    """(target, origin, piece) of one block."""
    ranges = [[(k, max(o, lo), min(o + n, hi)) for k, lo, hi in meet(o, o + n)] for meet, o, n in zip(meets, origin, array.shape)]
    for some in itertools.product(*ranges):
        if all(lo < hi for _, lo, hi in some):
            yield tuple(k for k, _, _ in some), tuple(lo for _, lo, _ in some), array[tuple(slice(lo - o, hi - o) for (_, lo, hi), o in zip(some, origin))]


def regroup(blocks: DataFrame, meets: list[Meet], kernel: Callable[[Place, list[Block]], Iterable[Block]]) -> DataFrame:
    """``kernel`` on each target block, given its place in the grid of targets and the pieces that it asked for. One shuffle,
    of the pieces' bytes; a piece with nothing but zeros is not sent."""
    names = ["at", "origin", "shape", "dtype", "data"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, array in of_batch(*batch.columns):
                found = [(at, (o, piece)) for at, o, piece in _cut(origin, array, meets) if piece.any()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([list(at) for at, _ in found], _INTS), *_columns([b for _, b in found])], names)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        pieces = list(of_batch(*(table.column(c).combine_chunks() for c in names[1:])))
        return pa.table(_columns(list(kernel(tuple(key[0].as_py()), pieces))), names=names[1:])

    dealt = blocks.select("origin", "shape", "dtype", "data").mapInArrow(cut, f"at array<int>, {SCHEMA}")
    return dealt.groupBy("at").applyInArrow(run, SCHEMA)


def assemble(pieces: list[Block], low: Place, high: Place, dtype: object = None) -> np.ndarray:
    """The image over [low, high) that the pieces make up."""
    out = np.zeros([b - a for a, b in zip(low, high)], dtype or np.result_type(*{p.dtype for _, p in pieces} or {np.uint16}))
    for origin, piece in pieces:
        lo = [max(o, a) for o, a in zip(origin, low)]
        hi = [min(o + n, b) for o, n, b in zip(origin, piece.shape, high)]
        if all(x < y for x, y in zip(lo, hi)):
            out[tuple(slice(x - a, y - a) for x, y, a in zip(lo, hi, low))] = piece[tuple(slice(x - o, y - o) for x, y, o in zip(lo, hi, origin))]
    return out


# ---------------------------------------------------------------------------------------------- from and to tables, stores


def read(spark: SparkSession, path: str, axes: str = AXES, where: dict[str, tuple[int, int]] | None = None) -> tuple[DataFrame, Place]:
    """The blocks of the array at ``path``, cut to ``where`` (half-open ranges by axis, in the array's own numbers) and to the
    array's shape, and its shape. Axes that it has not are of size 1."""
    m = zarr.layout(path)
    where = where or {}
    size = {a: n for a, n in zip(axes, m.shape)}
    limits = [tuple(where.get(a, (0, size.get(a, 1)))) for a in AXES]
    chunks = zarr.read_chunks(spark, path, {axes.index(a): r for a, r in where.items()})
    pick = lambda c, fill: F.array(*[F.element_at(c, axes.index(a) + 1) if a in axes else F.lit(fill) for a in AXES])
    blocks = chunks.select(pick("origin", 0).alias("origin"), pick("shape", 1).alias("shape"), "dtype", "data")

    def inside(origin: Place, array: np.ndarray) -> Iterator[Block]:
        lo = [max(o, a) for o, (a, _) in zip(origin, limits)]
        hi = [min(o + n, b, size.get(k, 1)) for o, n, (_, b), k in zip(origin, array.shape, limits, AXES)]
        if all(a < b for a, b in zip(lo, hi)):
            yield tuple(lo), array[tuple(slice(a - o, b - o) for a, b, o in zip(lo, hi, origin))]

    return map_blocks(blocks, inside), tuple(size.get(a, 1) for a in AXES)


def of_voxels(voxels: DataFrame, edges: Place = (1, 1, 1, 8, 256, 256)) -> DataFrame:
    """Voxels (t, p, c, z, y, x, v) as blocks."""
    return zarr.chunk_table(voxels.select(*AXES, "v"), edges)


def voxels(blocks: DataFrame, shape: Place, kind: str = "int") -> DataFrame:
    return zarr.voxels(blocks, AXES, shape, kind)


def write(blocks: DataFrame, path: str, m: zarr.Layout, axes: str = AXES, attributes: dict | None = None, level: int = 5) -> int:
    """Write blocks as an array of version 3 with the layout ``m`` over ``axes``; returns the number of its files. Pieces meet by
    encoded unit, and packed units by file; a file appears by a rename, so that a task may run again."""
    zarr.create(path, m, attributes, axes, level)
    own = [AXES.index(a) for a in axes]
    unit, size = [1] * len(AXES), [1] * len(AXES)
    for i, u, n in zip(own, m.unit, m.shape):
        unit[i], size[i] = u, n
    names = ["at", "origin", "shape", "dtype", "data"]
    meets = [grid(u, n) for u, n in zip(unit, size)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, array in of_batch(*batch.columns):
                found = [(at, (o, piece)) for at, o, piece in _cut(origin, array, meets) if piece.any()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([list(at) for at, _ in found], _INTS), *_columns([b for _, b in found])], names)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        at = key[0].as_py()
        low = tuple(k * u for k, u in zip(at, unit))
        whole = assemble(list(of_batch(*(table.column(c).combine_chunks() for c in names[1:]))), low, tuple(a + u for a, u in zip(low, unit)), m.dtype)
        file, place, data = zarr.packed(path, m, tuple(at[i] for i in own), whole.reshape(m.unit), level)
        return pa.table({"file": [file], "place": pa.array([place], pa.int32()), "data": pa.array([data], pa.binary())})

    packed = blocks.select("origin", "shape", "dtype", "data").mapInArrow(cut, f"at array<int>, {SCHEMA}").groupBy("at").applyInArrow(pack, zarr.PACKED)
    return zarr.join_units(packed, path, m)


# ---------------------------------------------------------------------------------------------- operators


def correct(blocks: DataFrame, offset: float, gain: float, flat: np.ndarray | None = None) -> DataFrame:
    """(raw - offset) * gain / flat, clipped to 16 bits and truncated. ``flat`` is (c, y, x), as large as a camera's frames."""

    def work(origin: Place, array: np.ndarray) -> Iterator[Block]:
        v = (array.astype(np.float64) - offset) * gain
        if flat is not None:
            c, y, x = (slice(origin[i], origin[i] + array.shape[i]) for i in (2, 4, 5))
            v /= flat[c, None, y, x]
        yield origin, np.floor(np.clip(v, 0.0, float(TOP))).astype(np.uint16)

    return map_blocks(blocks, work)


def to_16_bits(blocks: DataFrame) -> DataFrame:
    return map_blocks(blocks, lambda o, a: [(o, np.floor(np.clip(a, 0.0, float(TOP))).astype(np.uint16))])


def flip(blocks: DataFrame, axis: str, size: int) -> DataFrame:
    i = AXES.index(axis)
    return map_blocks(blocks, lambda o, a: [((*o[:i], size - o[i] - a.shape[i], *o[i + 1 :]), np.flip(a, i))])


def crop(blocks: DataFrame, axis: str, start: int, stop: int) -> DataFrame:
    """Keep [start, stop) of an axis and count it from 0."""
    i = AXES.index(axis)

    def work(o: Place, a: np.ndarray) -> Iterator[Block]:
        lo, hi = max(o[i], start), min(o[i] + a.shape[i], stop)
        if lo < hi:
            yield (*o[:i], lo - start, *o[i + 1 :]), a[(slice(None),) * i + (slice(lo - o[i], hi - o[i]),)]

    return map_blocks(blocks, work)


def deskew(blocks: DataFrame, shape: Place, g: Geometry, reverse: bool = False, across: int = 512, wide: int = 128) -> DataFrame:
    """Oblique stacks deskewed: blocks of all planes of the result, ``across`` of its rows and ``wide`` of its columns. A block of
    the result asks for the scanned planes that its rows cross."""
    nz, ny = g.out
    depth = nz * g.factor if g.shape()[0] >= g.factor else g.shape()[0]
    spans = []
    for a in range(0, ny, across):
        b = min(ny, a + across)
        spans.append((max(0, math.floor((a - (depth - 1) / g.tan) / g.step) - 1), min(g.planes, math.floor((b - 1) / g.step) + 2)))

    def planes(low: int, high: int) -> Iterator[tuple[int, int, int]]:
        for k, (lo, hi) in enumerate(spans):
            if lo < high and hi > low:
                yield k, lo, hi

    meets = [*(grid(1, n) for n in shape[:3]), planes, grid(g.rows, g.rows), grid(wide, g.columns)]

    def kernel(at: Place, pieces: list[Block]) -> Iterator[Block]:
        (lo, hi), x0 = spans[at[3]], at[5] * wide
        x1 = min(g.columns, x0 + wide)
        image = assemble(pieces, (*at[:3], lo, 0, x0), (*(k + 1 for k in at[:3]), hi, g.rows, x1))[0, 0, 0].reshape(-1, x1 - x0)
        y = np.arange(at[3] * across, min(ny, (at[3] + 1) * across))
        there = np.ones(len(image), bool)
        out = np.zeros((nz, len(y), x1 - x0), np.uint16)
        for oz in range(nz):
            out[nz - 1 - oz if reverse else oz] = slanted_rows(image, lo, g, oz, y, there)[0]
        yield (*at[:3], 0, int(y[0]), x0), out[None, None, None]

    return regroup(blocks, meets, kernel)


def project(blocks: DataFrame, shape: Place, axis: str = "z", edges: tuple[int, int] = (512, 512)) -> DataFrame:
    """Maximum over an axis: of each block where it is, then of what meets."""
    i = AXES.index(axis)
    flat = map_blocks(blocks, lambda o, a: [((*o[:i], 0, *o[i + 1 :]), a.max(i, keepdims=True))])
    edge = [1, 1, 1, 1, *edges]
    sizes = [1 if k == i else n for k, n in enumerate(shape)]

    def kernel(at: Place, pieces: list[Block]) -> Iterator[Block]:
        low = tuple(k * e for k, e in zip(at, edge))
        high = tuple(min(n, a + e) for a, e, n in zip(low, edge, sizes))
        out = np.zeros([b - a for a, b in zip(low, high)], pieces[0][1].dtype)
        for o, p in pieces:
            own = tuple(slice(x - a, x - a + n) for x, a, n in zip(o, low, p.shape))
            out[own] = np.maximum(out[own], p)
        yield low, out

    return regroup(flat, [grid(e, n) for e, n in zip(edge, sizes)], kernel)


def deconvolve(blocks: DataFrame, shape: Place, psfs: dict[int, np.ndarray], slab: int | None = None, overlap: int = 32, safe: bool = True, seed: int = 42) -> DataFrame:
    """Slabs along z with ``overlap`` planes of their neighbours, each deconvolved with its channel's PSF in a task of its own and
    blended with cosine ramps where they overlap; blocks of a slab's planes, as doubles. An image of one slab starts from
    its median, one of several from the mean of all."""
    from . import deconvolve as D

    *_, depth, height, width = shape
    slab = slab or D.slab_planes(height)
    count = max(1, -(-depth // slab))
    starts: dict[Place, float] = {}
    if count > 1:
        sums = map_blocks(blocks, lambda o, a: [((*o[:3], 0, 0, 0), a.sum(dtype=np.float64).reshape((1,) * 6))])
        total = regroup(sums, [grid(1, n) for n in shape[:3]] + [grid(1, 1)] * 3, lambda at, pieces: [((*at[:3], 0, 0, 0), sum(p for _, p in pieces))])
        starts = {tuple(r["origin"][:3]): float(np.frombuffer(r["data"])[0]) / (depth * height * width) for r in total.collect()}  # one number a stack
    meets = [*(grid(1, n) for n in shape[:3]), grid(slab, depth, overlap, overlap) if count > 1 else grid(depth, depth), grid(height, height), grid(width, width)]

    def solve(at: Place, pieces: list[Block]) -> Iterator[Block]:
        s = at[3]
        lo, hi = (max(0, s * slab - overlap), min(depth, (s + 1) * slab + overlap)) if count > 1 else (0, depth)
        image = assemble(pieces, (*at[:3], lo, 0, 0), (*(k + 1 for k in at[:3]), hi, height, width), float)[0, 0, 0]
        out = D.rlgc(image, psfs[at[2]], safe, start=starts.get(at[:3], 0.0) if count > 1 else float(np.median(image)), seed=seed)
        yield (*at[:3], lo, 0, 0), (out * D.slab_weights(lo, hi, s, slab, count, overlap)[:, None, None])[None, None, None]

    parts = regroup(blocks, meets, solve)
    if count == 1:
        return parts

    def blend(at: Place, pieces: list[Block]) -> Iterator[Block]:
        lo, hi = at[3] * slab, min(depth, (at[3] + 1) * slab)
        out, weight = np.zeros((hi - lo, height, width)), np.zeros(hi - lo)
        for o, p in sorted(pieces, key=lambda x: x[0]):
            out[o[3] - lo : o[3] - lo + p.shape[3]] += p[0, 0, 0]
        for s in range(max(0, at[3] - 1), min(count, at[3] + 2)):
            a, b = max(0, s * slab - overlap), min(depth, (s + 1) * slab + overlap)
            own = slice(max(a, lo), min(b, hi))
            if own.start < own.stop:
                weight[own.start - lo : own.stop - lo] += D.slab_weights(a, b, s, slab, count, overlap)[own.start - a : own.stop - a]
        yield (*at[:3], lo, 0, 0), (out / weight[:, None, None])[None, None, None]

    return regroup(parts, [*(grid(1, n) for n in shape[:3]), grid(slab, depth), grid(height, height), grid(width, width)], blend)


# ---------------------------------------------------------------------------------------------- fusion


def _cells(tiles: DataFrame, voxel: U.Voxel, shape: tuple[int, int, int], edges: tuple[int, int, int], half_even: bool) -> DataFrame:
    """(t, p, o_z, o_y, o_x, sz, sy, sx): the blocks of the fused image that each tile reaches."""
    shards = U.shard_overlap(tiles, voxel, shape[0], edges[0], half_even, ("y", "x"))
    cells = lambda o, n, e: F.explode(F.sequence(F.floor(F.col(o) / e).cast("int"), F.floor((F.col(o) + n - 1) / e).cast("int")))
    return shards.select("t", "p", "o_z", "o_y", "o_x", F.col("shard").alias("sz"), cells("o_y", shape[1], edges[1]).alias("sy")).withColumn("sx", cells("o_x", shape[2], edges[2]))


def fused_blocks(
    blocks: DataFrame, tiles: DataFrame, voxel: U.Voxel, shape: tuple[int, int, int], profiles: list[np.ndarray], mode: str = "weighted_mean", half_even: bool = True, edges: tuple[int, int, int] = FUSED, channels: DataFrame | None = None
) -> DataFrame:
    """Tiles of ``shape`` (z, y, x) fused in blocks of the whole image, at p = 0: each tile is dealt to the shards of planes that it
    reaches (``fusion.shard_overlap``), its blocks are cut there, and a task holds one block of the image with the tiles that
    lie over it and adds value times weight and weight as arrays.

    mode weighted_mean: sum(w v) / sum(w), 0 where no weight is; fold: tiles in order of p, f <- trunc(clip((f + v w) / (1 + w))).
    What a tile has no block for is 0 and weighs.
    """
    ez, ey, ex = edges
    shards = U.shard_overlap(tiles, voxel, shape[0], ez, half_even, ("y", "x"))
    own = blocks.select(F.element_at("origin", 1).alias("t"), F.element_at("origin", 2).alias("p"), F.element_at("origin", 3).alias("c"), "origin", "shape", "dtype", "data")
    seen = (channels if channels is not None else own.select("c").distinct()).select("c")
    keys = ["t", "c", "sz", "sy", "sx"]
    met = _cells(tiles, voxel, shape, edges, half_even)
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("origin", "array<int>"), ("shape", "array<int>"), ("dtype", "string"), ("data", "binary"))]
    marks = met.crossJoin(F.broadcast(seen)).select(*keys, "p", "o_z", "o_y", "o_x", *nothing)  # channels: a few numbers
    first, last = F.element_at("origin", 4), F.element_at("origin", 4) + F.element_at("shape", 4)
    near = own.join(shards, ["t", "p"]).where((first + F.col("o_z") < F.col("z1")) & (last + F.col("o_z") > F.col("z0")))
    columns = ["t", "p", "c", "shard", "o_z", "o_y", "o_x", "origin", "shape", "dtype", "data"]
    schema = "t int, c int, sz int, sy int, sx int, p int, o_z int, o_y int, o_x int, " + SCHEMA

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = 1 << 30
        for batch in batches:
            head = [batch.column(i).to_pylist() for i in range(7)]
            for (t, p, c, sz, *o), (origin, array) in zip(zip(*head), of_batch(*batch.columns[7:])):
                at = tuple(a + b for a, b in zip(origin[3:], o))
                meets = [lambda low, high, sz=sz: [(sz, sz * ez, (sz + 1) * ez)], grid(ey, whole), grid(ex, whole)]
                found = [(k, (lo, piece)) for k, lo, piece in _cut(at, array[0, 0, 0], meets) if piece.any()]
                if found:
                    n = len(found)
                    same = [pa.array([x] * n, pa.int32()) for x in (p, *o)]
                    yield pa.RecordBatch.from_arrays([pa.array([t] * n, pa.int32()), pa.array([c] * n, pa.int32()), *(pa.array([k[i] for k, _ in found], pa.int32()) for i in range(3)), *same, *_columns([b for _, b in found])], [*keys, "p", "o_z", "o_y", "o_x", "origin", "shape", "dtype", "data"])

    dealt = near.select(*columns).mapInArrow(cut, schema).unionByName(marks.select([c.split()[0] for c in schema.split(", ")]))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        t, c, *cell = (k.as_py() for k in key)
        low = tuple(k * e for k, e in zip(cell, edges))
        table = table.combine_chunks()
        tile = {p: o for p, *o in zip(*(table.column(n).to_pylist() for n in ("p", "o_z", "o_y", "o_x")))}
        given = table.filter(table.column("data").is_valid()).combine_chunks()
        pieces: dict[int, list[Block]] = {}
        if given.num_rows:
            for p, one in zip(given.column("p").to_pylist(), of_batch(*(given.column(n).combine_chunks() for n in ("origin", "shape", "dtype", "data")))):
                pieces.setdefault(p, []).append(one)
        value, there = fuse_cell(low, edges, tile, shape, profiles, mode, lambda p, lo, hi: assemble(pieces.get(p, []), lo, hi, float))
        return pa.table(_columns([((t, 0, c, *low), value.astype(np.uint16)[None, None, None])]), names=["origin", "shape", "dtype", "data"])

    return dealt.groupBy(*keys).applyInArrow(run, SCHEMA)


def fused_voxels(voxels: DataFrame, tiles: DataFrame, voxel: U.Voxel, shape: tuple[int, int, int], profiles: list[np.ndarray], edges: tuple[int, int, int], gaps: bool = False) -> DataFrame:
    """``fused_blocks`` of a voxel table, as voxels (t, c, z, y, x, v) of what tiles cover: voxels go straight to the blocks of the
    result, one shuffle of them, and meet the tiles that lie over these. With ``gaps`` a tile covers only its voxels in the table."""
    place = U.tile_offsets(tiles, voxel, ("z", "y", "x"), True)
    keys, names = ["t", "c", "sz", "sy", "sx"], ["z", "y", "x"]
    met = _cells(tiles, voxel, shape, edges, True).crossJoin(F.broadcast(voxels.select("c").distinct()))  # channels: a few numbers
    inside = voxels.join(place, ["t", "p"])
    for a, n in zip(names, shape):
        inside = inside.where((F.col(a) >= 0) & (F.col(a) < n))
    cells = [F.floor((F.col(a) + F.col(f"o_{a}")) / e).cast("int").alias(f"s{a}") for a, e in zip(names, edges)]
    dealt = inside.select("t", "c", *cells, "p", "o_z", "o_y", "o_x", *names, F.col("v").cast("double").alias("v"))
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (*((a, "int") for a in names), ("v", "double"))]
    dealt = dealt.unionByName(met.select(*keys, "p", "o_z", "o_y", "o_x", *nothing))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        t, c, *cell = (k.as_py() for k in key)
        low = tuple(k * e for k, e in zip(cell, edges))
        marks, own = table.filter(table.column("v").is_null()), table.filter(table.column("v").is_valid())
        tile = {p: o for p, *o in zip(*(marks.column(n).to_pylist() for n in ("p", "o_z", "o_y", "o_x")))}
        of, v = own.column("p").to_numpy(), own.column("v").to_numpy()
        at = [own.column(n).to_numpy() + own.column(f"o_{n}").to_numpy() for n in names]
        order = np.argsort(of, kind="stable")
        ends = np.searchsorted(of[order], sorted(tile), "right")
        rows = {p: order[np.searchsorted(of[order], p, "left") : end] for p, end in zip(sorted(tile), ends)}

        def values(p: int, lo: Place, hi: Place) -> np.ndarray:
            out = np.full([y - x for x, y in zip(lo, hi)], np.nan if gaps else 0.0)
            out[tuple(a[rows[p]] - x for a, x in zip(at, lo))] = v[rows[p]]
            return out

        value, there = fuse_cell(low, edges, tile, shape, profiles, "weighted_mean", values, gaps)
        z, y, x = np.nonzero(there)
        same = [pa.array(np.full(len(z), k, np.int32)) for k in (t, c)]
        return pa.table([*same, *(pa.array((i + a).astype(np.int32)) for i, a in zip((z, y, x), low)), pa.array(value[z, y, x].astype(np.int32))], names=["t", "c", *names, "v"])

    return dealt.groupBy(*keys).applyInArrow(run, "t int, c int, z int, y int, x int, v int")


def fuse_cell(low: Place, edges: Place, tile: dict[int, Place], shape: Place, profiles: list[np.ndarray], mode: str, values: Callable[[int, Place, Place], np.ndarray], gaps: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """One block of a fused image from ``low`` on, and where tiles cover it. ``tile`` has the tiles' origins, ``values`` gives a tile's
    values over a box of the image; with ``gaps`` the tile does not cover what is NaN in them."""
    value, weight, there = np.zeros(edges), np.zeros(edges), np.zeros(edges, bool)
    for p in sorted(tile):
        lo = [max(o, a) for o, a in zip(tile[p], low)]
        hi = [min(o + n, a + e) for o, n, a, e in zip(tile[p], shape, low, edges)]
        if any(a >= b for a, b in zip(lo, hi)):
            continue
        here = tuple(slice(a - x, b - x) for a, b, x in zip(lo, hi, low))
        wz, wy, wx = (w[a - o : b - o] for w, a, b, o in zip(profiles, lo, hi, tile[p]))
        w = wz[:, None, None] * wy[None, :, None] * wx
        v = values(p, tuple(lo), tuple(hi))
        if gaps:
            own = ~np.isnan(v)
            w, v = w * own, np.where(own, v, 0.0)
            there[here] |= own
        else:
            there[here] = True
        if mode == "fold":
            value[here] = np.floor(np.clip((value[here] + v * w) / (1 + w), 0.0, float(TOP)))
        else:
            value[here] += v * w
            weight[here] += w
    if mode != "fold":
        value = np.floor(np.divide(value, weight, out=np.zeros_like(value), where=weight > 0) + U.CLOSE)
    return value, there


# ---------------------------------------------------------------------------------------------- overlaps of tiles


def _sides(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Blocks with each pair whose overlap they reach: side 0 is tile i of the pair, 1 tile j; s_ is where the overlap begins in
    the tile, n_ its size."""
    own = blocks.select(F.element_at("origin", 1).alias("t"), F.element_at("origin", 2).alias("p"), "origin", "shape", "dtype", "data")
    size = [(F.col(f"i_{a}1") - F.col(f"i_{a}0")).alias(f"n_{a}") for a in "zyx"]
    sides = [pairs.select("t", F.col(tile).alias("p"), "i", "j", F.lit(k).alias("side"), *[F.col(f"{tile}_{a}0").alias(f"s_{a}") for a in "zyx"], *size) for k, tile in enumerate("ij")]
    met = own.join(sides[0].unionByName(sides[1]), ["t", "p"])
    for k, a in enumerate("zyx", 4):
        first = F.element_at("origin", k)
        met = met.where((first < F.col(f"s_{a}") + F.col(f"n_{a}")) & (first + F.element_at("shape", k) > F.col(f"s_{a}")))
    return met


#: Pieces of both tiles' overlap: sums over blocks of f_ voxels, at ``origin`` in such blocks.
PATCHES = "t int, i int, j int, side int, n_z int, n_y int, n_x int, f_z int, f_y int, f_x int, " + SCHEMA


def patches(blocks: DataFrame, pairs: DataFrame, factors: tuple[int, int, int] = (3, 5, 5)) -> DataFrame:
    """The overlaps (t, i, j with bounds, see ``registration.overlap_pairs``) of blocks of one channel as sums over blocks of
    ``factors`` (z, y, x) voxels, none larger than the overlap, taken where the blocks are read; see ``PATCHES``."""
    head = ["t", "i", "j", "side", "s_z", "s_y", "s_x", "n_z", "n_y", "n_x"]
    names = [c.split()[0] for c in PATCHES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(len(head))))
            for (t, i, j, side, *box), (origin, array) in zip(rows, of_batch(*batch.columns[len(head) :])):
                start, size = box[:3], box[3:]
                lo = [max(o - s, 0) for o, s in zip(origin[3:], start)]
                hi = [min(o + n - s, m) for o, n, s, m in zip(origin[3:], array.shape[3:], start, size)]
                piece = array[0, 0, 0][tuple(slice(a + s - o, b + s - o) for a, b, s, o in zip(lo, hi, start, origin[3:]))].astype(float)
                f = [max(1, min(k, n)) for k, n in zip(factors, size)]
                for axis, (a, b, k) in enumerate(zip(lo, hi, f)):
                    piece = np.add.reduceat(piece, [max(0, c * k - a) for c in range(a // k, -(-b // k))], axis)
                if piece.any():
                    same = [pa.array([x], pa.int32()) for x in (t, i, j, side, *size, *f)]
                    yield pa.RecordBatch.from_arrays([*same, *_columns([(tuple(a // k for a, k in zip(lo, f)), piece)])], names)

    return _sides(blocks, pairs).select(*head, "origin", "shape", "dtype", "data").mapInArrow(cut, PATCHES)


def patch_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Both tiles' means over one pair's overlap, and the factors. A ragged edge counts as filled with 0."""
    table = table.combine_chunks()
    size, f = ([table.column(f"{c}_{a}")[0].as_py() for a in "zyx"] for c in "nf")
    both = np.zeros((2, *(-(-n // k) for n, k in zip(size, f))))
    for side, (o, piece) in zip(table.column("side").to_pylist(), of_batch(*(table.column(c).combine_chunks() for c in ("origin", "shape", "dtype", "data")))):
        both[(side, *(slice(a, a + n) for a, n in zip(o, piece.shape)))] += piece
    return both[0] / math.prod(f), both[1] / math.prod(f), f


# ---------------------------------------------------------------------------------------------- pyramids


def stride(blocks: DataFrame, factors: dict[str, int]) -> DataFrame:
    """Every f-th place of an axis, without a shuffle."""
    steps = [factors.get(a, 1) for a in AXES]

    def work(origin: Place, array: np.ndarray) -> Iterator[Block]:
        out = array[tuple(slice(-o % f, None, f) for o, f in zip(origin, steps))]
        if out.size:
            yield tuple(-(-o // f) for o, f in zip(origin, steps)), out

    return map_blocks(blocks, work)


def block_mean(blocks: DataFrame, shape: Place, factors: dict[str, int], edges: Place = (1, 1, 1, 4, 512, 512)) -> DataFrame:
    """Truncated means over blocks of ``factors``; a ragged edge counts as filled with 0."""
    steps = [factors.get(a, 1) for a in AXES]
    wide = [e * f for e, f in zip(edges, steps)]

    def kernel(at: Place, pieces: list[Block]) -> Iterator[Block]:
        low = tuple(k * w for k, w in zip(at, wide))
        high = tuple(min(-(-n // f) * f, a + w) for n, f, a, w in zip(shape, steps, low, wide))
        image = assemble(pieces, low, high, float)
        for axis, f in enumerate(steps):
            image = np.add.reduceat(image, np.arange(0, image.shape[axis], f), axis)
        yield tuple(k * e for k, e in zip(at, edges)), np.floor(image / math.prod(steps)).astype(pieces[0][1].dtype)

    return regroup(blocks, [grid(w, n) for w, n in zip(wide, shape)], kernel)


def write_levels(blocks: DataFrame, path: str, shape: Place, group: dict, factors: list[int], mode: str = "stride", axes: str = "tczyx", level_of: Callable[[Place], zarr.Layout] = zarr.fused_3d_layout) -> None:
    """A multiscale group of blocks over ``axes``, as ``zarr.write_levels`` makes it of voxels: level 0, and pyramid levels each made
    from the one that was written before."""
    from ..sources import files

    files.write_json(f"{path}/zarr.json", group)
    spark, done = blocks.sparkSession, 1
    write(blocks, f"{path}/scale0/image", level_of(tuple(shape)), axes)
    for n, f in enumerate(factors, 1):
        by = {a: f // done for a, s in zip(axes, shape) if a in "zyx" and s > 1}
        done = f
        last, whole = read(spark, f"{path}/scale{n - 1}/image", axes)
        shape = tuple(-(-s // by.get(a, 1)) for a, s in zip(axes, shape))
        write(stride(last, by) if mode == "stride" else block_mean(last, whole, by), f"{path}/scale{n}/image", level_of(shape), axes)
