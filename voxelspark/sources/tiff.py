"""Baseline TIFF stacks: reading and writing uncompressed or zlib-compressed 16- and 32-bit pages, with OME axes."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import files, zarr

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 16: 8}


Fetch = Callable[[int, int], bytes]


def _tags(fetch: Fetch, at: int, order: str, wanted: frozenset[int] | None = None) -> tuple[dict[int, list], int]:
    """The tags of the page directory at ``at``, all or the ``wanted`` ones, and where the next directory is (0: nowhere)."""
    n = struct.unpack(order + "H", fetch(at, 2))[0]
    body = fetch(at + 2, 12 * n + 4)
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", body, 12 * k)
        if wanted is not None and tag not in wanted:
            continue
        size = _SIZES.get(kind, 1) * count
        raw = body[12 * k + 8 : 12 * k + 8 + size] if size <= 4 else fetch(struct.unpack_from(order + "I", body, 12 * k + 8)[0], size)
        tags[tag] = [raw.rstrip(b"\0").decode(errors="replace")] if kind == 2 else list(struct.unpack(order + str(count) + {1: "B", 3: "H", 4: "I"}.get(kind, "B"), raw)) if kind in (1, 3, 4) else [raw]
    return tags, struct.unpack_from(order + "I", body, 12 * n)[0]


def of_bytes(data: bytes) -> Fetch:
    return lambda at, n: data[at : at + n]


@dataclass(frozen=True)
class Page:
    """Where a page's strips are and how they are packed."""

    dtype: str
    height: int
    width: int
    code: int
    predictor: int
    offsets: list[int]
    counts: list[int]

    def decode(self, fetch: Fetch) -> np.ndarray:
        raw = b"".join(zlib.decompress(s) if self.code != 1 else s for s in (fetch(o, n) for o, n in zip(self.offsets, self.counts)))
        page = np.frombuffer(raw, self.dtype).reshape(self.height, self.width)
        return np.cumsum(page, axis=1, dtype=page.dtype) if self.predictor == 2 else page


_PAGE_TAGS = frozenset((256, 257, 258, 259, 273, 279, 317, 339))


def directory(fetch: Fetch) -> Iterator[tuple[Page, str]]:
    """The pages of a file, and with the first one its description: only directories are fetched, no pixels."""
    head = fetch(0, 8)
    order = {b"II": "<", b"MM": ">"}[head[:2]]
    at, first = struct.unpack_from(order + "I", head, 4)[0], True
    while at:
        tags, at = _tags(fetch, at, order, _PAGE_TAGS | {270} if first else _PAGE_TAGS)
        bits, kind = tags.get(258, [1])[0], tags.get(339, [1])[0]
        code = tags.get(259, [1])[0]
        if code not in (1, 8, 32946):
            raise ValueError(f"TIFF compression {code} is not supported")
        yield Page(order + {1: "u", 2: "i", 3: "f"}[kind] + str(bits // 8), tags[257][0], tags[256][0], code, tags.get(317, [1])[0], tags[273], tags[279]), tags.get(270, [""])[0]
        first = False


def pages(data: bytes) -> tuple[list[np.ndarray], str]:
    """The pages of a file and its description."""
    found = list(directory(of_bytes(data)))
    return [page.decode(of_bytes(data)) for page, _ in found], found[0][1] if found else ""


def write(path: str, stack: np.ndarray, axes: str, compress: bool = False, metadata: dict | None = None) -> None:
    files.write_bytes(path, encode(stack, axes, compress, metadata))


def encode(stack: np.ndarray, axes: str, compress: bool = False, metadata: dict | None = None) -> bytes:
    """A stack as pages with an OME description, and acquisition metadata as JSON; compressed pages take the horizontal
    predictor."""
    import json

    sizes = dict(zip(axes, stack.shape))
    kind = "float" if stack.dtype.kind == "f" else f"uint{8 * stack.dtype.itemsize}"
    ome = "".join(f' Size{a}="{sizes.get(a, 1)}"' for a in "XYZCT")
    text = f'<?xml version="1.0"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels ID="Pixels:0" DimensionOrder="XYZCT" Type="{kind}"{ome}><TiffData/></Pixels></Image></OME>'.encode() + b"\0"
    flat = stack.reshape(-1, *stack.shape[-2:])
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for n, page in enumerate(flat):
        page = np.ascontiguousarray(page)
        if compress and page.dtype.kind == "u":
            page = np.concatenate([page[:, :1], np.diff(page, axis=1)], 1)
        body = zlib.compress(page.tobytes(), 8) if compress else page.tobytes()
        place = len(out)
        out += body
        note = len(out)
        out += text if n == 0 else b""
        words = json.dumps(metadata).encode() + b"\0" if n == 0 and metadata else b""
        said = len(out)
        out += words
        out += b"\0" * (len(out) % 2)
        tags = [(256, 4, 1, page.shape[1]), (257, 4, 1, page.shape[0]), (258, 3, 1, 8 * page.dtype.itemsize), (259, 3, 1, 8 if compress else 1), (262, 3, 1, 1)]
        tags += [(270, 2, len(text), note)] if n == 0 else []
        tags += [(273, 4, 1, place), (277, 3, 1, 1), (278, 4, 1, page.shape[0]), (279, 4, 1, len(body))]
        tags += [(317, 3, 1, 2)] if compress and page.dtype.kind == "u" else []
        tags += [(339, 3, 1, 3 if page.dtype.kind == "f" else 1)]
        tags += [(51123, 2, len(words), said)] if words else []
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


PAGES = "path string, at array<int>, dtype string, height int, width int, code int, predictor int, offsets array<long>, counts array<long>"


def page_index(spark: SparkSession, path: str, axes: str) -> DataFrame:
    """One row for each page of the TIFF files at ``path``, whose pages run over ``axes`` (of t, p, c, z; y and x last), row-major:
    its place (t, p, c, z) and where its strips are. The axes' sizes come from the OME description, axes that are not there
    are 0. Directories are fetched by ranges; a file's pixels are not read."""
    lead = [a for a in axes.lower() if a not in "yx"]
    names = [c.split()[0] for c in PAGES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, root = files.place(name)
                with system.open_input_file(root) as f:
                    found = list(directory(lambda at, n: f.read_at(n, at)))
                size = {a.lower(): int(n) for a, n in re.findall(r'Size([XYZCT])="(\d+)"', found[0][1] if found else "")}
                shape = [size.get(a, 1) for a in lead]
                if int(np.prod(shape)) != len(found):
                    shape = [len(found)] if len(lead) == 1 else shape
                for low in range(0, len(found), 1024):
                    own = found[low : low + 1024]
                    at = [dict(zip(lead, map(int, np.unravel_index(low + n, shape)))) if lead else {} for n in range(len(own))]
                    columns = [[name] * len(own), [[x.get(a, 0) for a in "tpcz"] for x in at], *([getattr(page, c) for page, _ in own] for c in names[2:])]
                    kinds = [pa.string(), pa.list_(pa.int32()), pa.string(), *[pa.int32()] * 4, *[pa.list_(pa.int64())] * 2]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, PAGES)


#: Bytes of packed pages that a task is given.
TASK_BYTES = 16 << 20


def read_blocks(spark: SparkSession, path: str, axes: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The pages of TIFF files as blocks (see ``operators.arrays``), one a page. Pages of one file are dealt to as many tasks as
    their bytes ask for, which read their strips by ranges."""
    total = spark.read.format("binaryFile").load(path).agg({"length": "sum"}).first()[0] or 0
    dealt = page_index(spark, path, axes).repartition(max(1, -(-total // task_bytes)))
    names = ["origin", "shape", "dtype", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Any] | None = None
        for batch in batches:
            for row in batch.to_pylist():
                name, at = row.pop("path"), row.pop("at")
                if held is None or held[0] != name:
                    system, root = files.place(name)
                    held = name, system.open_input_file(root)
                page = Page(**row).decode(lambda o, n: held[1].read_at(n, o))
                page = page.astype(page.dtype.newbyteorder("<"))
                yield pa.RecordBatch.from_arrays([pa.array([[*at, 0, 0]], pa.list_(pa.int32())), pa.array([[1, 1, 1, 1, *page.shape]], pa.list_(pa.int32())), pa.array([page.dtype.str]), pa.array([page.tobytes()], pa.binary())], names)

    return dealt.mapInArrow(run, zarr.CHUNKS)


def read(spark: SparkSession, path: str, axes: str) -> DataFrame:
    """Voxels of TIFF files whose pages run over ``axes``, see ``page_index``."""
    whole = (1 << 30,) * 6
    return zarr.voxels(read_blocks(spark, path, axes), "tpczyx", whole, "double")


def write_raw(path: str, stack: np.ndarray) -> None:
    """A raw dump and a YAML note of its layout, in any file system."""
    files.write_bytes(path, np.ascontiguousarray(stack).tobytes())
    order = "little" if stack.dtype.byteorder in "<=|" else "big"
    note = f"Frames: {stack.shape[0]}\nData Type: {stack.dtype.name}\nHeight: {stack.shape[1]}\nWidth: {stack.shape[2]}\nByte Order: {order}\n"
    files.write_bytes(path + ".yaml", note.encode())


def write_planes(frame: DataFrame, folder: str, axes: str, sizes: dict[str, int], dtype: str = "uint16", compress: bool = True) -> DataFrame:
    """Write an image as one TIFF for each value of the axes before ``axes`` (y and x last), each by the task that holds it;
    returns the names. A file holds one stack of ``axes``, which is what a task is given; absent voxels are 0."""
    import pandas as pd

    own = axes.lower()
    keys = [k for k in ("t", "p", "c", "z") if k not in own]
    shape = [sizes[a] for a in own]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        stack = np.zeros(shape, dtype)
        stack[tuple(group[a].to_numpy() for a in own)] = group.v.to_numpy().astype(dtype)
        name = "_".join(f"{k}{int(group[k].iloc[0]):04d}" for k in keys) + ".tif"
        files.write_bytes(f"{folder}/{name}", encode(stack, axes.upper(), compress))
        return pd.DataFrame({"name": [name]})

    inside = frame
    for a in own:
        inside = inside.where((inside[a] >= 0) & (inside[a] < sizes[a]))
    return inside.groupBy(*keys).applyInPandas(run, "name string")


def frame_array(frame: DataFrame, axes: tuple[str, ...], dtype: str = "uint16", limit: int = 1 << 28) -> np.ndarray:
    """One image of at most ``limit`` pixels, put together on the driver for a single-file format; ValueError for a larger
    one (see ``write_planes``)."""
    from pyspark.sql import functions as F

    high = frame.agg(*[F.max(a).alias(a) for a in axes]).first()
    size = [int(high[a] if high[a] is not None else -1) + 1 for a in axes]
    if int(np.prod([float(s) for s in size])) > limit:
        raise ValueError(f"an image of {size} is not collected")
    rows = frame.select(*axes, "v").toPandas()
    out = np.zeros(size, dtype)
    out[tuple(rows[a].to_numpy() for a in axes)] = rows.v.to_numpy().astype(dtype)
    return out


def instrument(data: bytes) -> dict:
    """The first page's acquisition metadata: the JSON in tag 51123; empty where there is none."""
    import json

    order = {b"II": "<", b"MM": ">"}[data[:2]]
    tags, _ = _tags(of_bytes(data), struct.unpack_from(order + "I", data, 4)[0], order)
    return json.loads(tags[51123][0]) if 51123 in tags else {}


def camera(metadata: dict) -> tuple[float, float]:
    """The camera's offset and gain, by the port's name; ValueError where a port is unknown."""
    from ..functions.metadata import PORT_GAINS

    port = str(metadata["pvcam-Port"])
    for name, gain in PORT_GAINS:
        if name in port:
            return float(metadata["pvcam-Offset"]), gain
    raise ValueError(f"unknown camera port {port}")
