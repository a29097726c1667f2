"""Zarr arrays as a Spark data source: ``spark.read.format("zarr")`` and ``df.write.format("zarr")``.

    register(spark)
    v = spark.read.format("zarr").option("axes", "tpczyx").load(path).where("t = 3 and z >= 10")
    v.write.format("zarr").option("shape", "1,1,1,50,512,512").option("chunk", "1,1,1,8,256,256").mode("append").save(other)

Rows are voxels (t, p, c, z, y, x, v). Filters of one axis (=, <, <=, >, >=, in) are pushed down, to the files and to the inner
chunks of shards; a task is given files of about ``taskbytes`` decoded bytes. The writer takes rows in any order: a task writes
the parts of files that it holds beside the array, and the commit puts parts of one file together, so a file appears once the
whole job has succeeded.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from . import files, zarr

NAMES = ["t", "p", "c", "z", "y", "x"]


@dataclass
class Files(InputPartition):
    """Places of an array's files in its grid."""

    places: list[tuple[int, ...]]


class Reader(DataSourceReader):
    def __init__(self, path: str, axes: str, task_bytes: int):
        self.path, self.axes, self.task_bytes = path, axes, task_bytes
        self.layout = zarr.layout(path)
        self.wanted = [(0, n) for n in self.layout.shape]

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrow the ranges of axes; what cannot be told by a range is returned, for Spark to do."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else ""
            if name not in self.axes or not name or name not in NAMES:
                yield f
                continue
            k = self.axes.index(name)
            lo, hi = self.wanted[k]
            match f:
                case EqualTo(value=v) if v == int(v):
                    self.wanted[k] = max(lo, int(v)), min(hi, int(v) + 1)
                case GreaterThan(value=v):
                    self.wanted[k] = max(lo, math.floor(v) + 1), hi
                case GreaterThanOrEqual(value=v):
                    self.wanted[k] = max(lo, math.ceil(v)), hi
                case LessThan(value=v):
                    self.wanted[k] = lo, min(hi, math.ceil(v))
                case LessThanOrEqual(value=v):
                    self.wanted[k] = lo, min(hi, math.floor(v) + 1)
                case In(value=values) if values:
                    self.wanted[k] = max(lo, int(min(values))), min(hi, int(max(values)) + 1)
                    yield f  # the numbers between
                case _:
                    yield f

    def partitions(self) -> list[Files]:
        m = self.layout
        if any(lo >= hi for lo, hi in self.wanted):
            return [Files([])]
        spans = [range(lo // c, -(-hi // c)) for (lo, hi), c in zip(self.wanted, m.chunk)]
        sizes = [len(s) for s in spans]
        total, each = math.prod(sizes), max(1, self.task_bytes // (math.prod(m.chunk) * np.dtype(m.dtype).itemsize))
        place = lambda n: tuple(int(i) + s.start for i, s in zip(np.unravel_index(n, sizes), spans))
        return [Files([place(n) for n in range(a, min(total, a + each))]) for a in range(0, total, each)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        m = self.layout
        kind = np.float64 if np.dtype(m.dtype).kind == "f" else np.int32
        for at in partition.places:
            for origin, block in zarr.stored(self.path, m, at, self.wanted):
                if block is None and m.fill:
                    block = np.full(m.unit, m.fill).astype(m.dtype)
                if block is None:
                    continue
                low = [max(o, a) for o, (a, _) in zip(origin, self.wanted)]
                high = [min(o + n, b) for o, n, (_, b) in zip(origin, block.shape, self.wanted)]
                if any(a >= b for a, b in zip(low, high)):
                    continue
                part = block[tuple(slice(a - o, b - o) for a, b, o in zip(low, high, origin))]
                grid = np.indices(part.shape, np.int32).reshape(part.ndim, -1)
                found = {a: grid[i] + np.int32(low[i]) for i, a in enumerate(self.axes)}
                zero = np.zeros(part.size, np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(found.get(a, zero)) for a in NAMES), pa.array(part.ravel().astype(kind))], [*NAMES, "v"])


@dataclass
class Written(WriterCommitMessage):
    """Names of files of which a task wrote parts, with their places."""

    parts: list[tuple[str, tuple[int, ...]]]


class Writer(DataSourceArrowWriter):
    """A task keeps what it gets of each encoded unit (bounded by the rows it is given) and writes the units of each file as one
    part; a unit that several tasks hold is added up, as each voxel is written once and what is absent is 0."""

    def __init__(self, path: str, axes: str, layout: zarr.Layout, overwrite: bool):
        self.path, self.axes, self.layout, self.job = path, axes, layout, uuid.uuid4().hex
        if overwrite or not files.exists(f"{path}/zarr.json"):
            zarr.create(path, layout, axes=axes)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        m, held = self.layout, {}
        for batch in iterator:
            columns = {n: batch.column(batch.schema.get_field_index(n)).to_numpy() for n in (*self.axes, "v")}
            inside = np.logical_and.reduce([(columns[a] >= 0) & (columns[a] < n) for a, n in zip(self.axes, m.shape)])
            at = np.stack([columns[a][inside] for a in self.axes], 1)
            unit, inverse = np.unique(at // np.array(m.unit), axis=0, return_inverse=True)
            for k, place in enumerate(unit.tolist()):
                own = inverse.ravel() == k
                block = held.setdefault(tuple(place), np.zeros(m.unit, m.dtype))
                block[tuple((at[own] - np.array(place) * np.array(m.unit)).T)] = columns["v"][inside][own].astype(m.dtype)
        ratio = [c // u for c, u in zip(m.chunk, m.unit)]
        by_file: dict[tuple[int, ...], dict] = {}
        for place, block in held.items():
            by_file.setdefault(tuple(k // r for k, r in zip(place, ratio)), {})[place] = block
        parts, task = [], uuid.uuid4().hex
        for file, units in by_file.items():
            name = f"_parts-{self.job}/{'.'.join(map(str, file))}-{task}"
            stacked = np.stack(list(units.values()))
            head = np.array(list(units), "<i8")
            files.write_bytes(f"{self.path}/{name}", np.array([len(units)], "<i8").tobytes() + head.tobytes() + stacked.tobytes())
            parts.append((name, file))
        return Written(parts)

    def commit(self, messages: list[Written | None]) -> None:
        """File by file: one shard's parts are in memory at a time."""
        m = self.layout
        ratio = [c // u for c, u in zip(m.chunk, m.unit)]
        found: dict[tuple[int, ...], list[str]] = {}
        for message in messages:
            for name, file in message.parts if message else []:
                found.setdefault(file, []).append(name)
        for file, names in found.items():
            units: dict[tuple[int, ...], np.ndarray] = {}
            for name in names:
                data = files.read_bytes(f"{self.path}/{name}")
                n, d = int(np.frombuffer(data[:8], "<i8")[0]), len(self.axes)
                places = np.frombuffer(data[8 : 8 + 8 * n * d], "<i8").reshape(n, d)
                blocks = np.frombuffer(data[8 + 8 * n * d :], m.dtype).reshape(n, *m.unit)
                for place, block in zip(map(tuple, places.tolist()), blocks):
                    units[place] = units[place] + block if place in units else block
            packed = [zarr.packed(self.path, m, place, block, 5) for place, block in units.items()]
            if m.inner is not None:
                zarr.write_shard(f"{self.path}/{packed[0][0]}", [(place, data) for _, place, data in packed], math.prod(ratio))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files.remove_folder(f"{self.path}/_parts-{self.job}")


class Zarr(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zarr"

    def _axes(self) -> str:
        return self.options.get("axes", "tpczyx")

    def schema(self) -> str:
        kind = "double" if np.dtype(zarr.layout(self.options["path"]).dtype).kind == "f" else "int"
        return f"t int, p int, c int, z int, y int, x int, v {kind}"

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], self._axes(), int(self.options.get("taskbytes", 64 << 20)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        numbers = lambda key: tuple(int(n) for n in self.options[key].split(","))
        dtype = np.dtype(self.options.get("dtype", "uint16"))
        if "shard" in self.options:
            m = zarr.sharded(numbers("shape"), numbers("shard"), numbers("chunk"), dtype.name)
        else:
            m = zarr.Layout(numbers("shape"), numbers("chunk"), dtype.newbyteorder("<").str, "zstd", 0)
        return Writer(self.options["path"], self._axes(), m, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Zarr)
