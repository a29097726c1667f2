"""What the text operators share: the shared folder, Arrow text batches, and numpy kernels over their bytes."""

from __future__ import annotations

import atexit
import contextlib
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Stands for a null doc_id where ids are numbers: nulls sort before every id.
NULL_ID = -(2**63)
#: Bytes of text that the numpy kernels take at once; their temporaries are about 8 to 40 times this.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_text(col: str) -> Column:
    """crc32 of an id as decimal text, which deals rows to folds."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


# ---------------------------------------------------------------------------------------------- shared folder


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session gets one of its
    own; a cluster is refused, as its executors would not see each other's files."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="voxelspark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        sc = spark.sparkContext
        hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the driver ends."""
    path = f"{shared_root(spark)}/voxelspark/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, and outlives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that no plan reads any more."""
    for table_ in tables:
        if path := getattr(table_, "_written_at", None):
            _remove(table_.sparkSession, path)


def filesystem(uri: str) -> tuple[Any, str]:
    """A pyarrow file system and the path in it, for executors that read or write plain files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by a Python worker over all its tasks. Functions of this package come to a worker by value,
    task by task, so it is kept in a module of its own; there is one object at a time, the last one used."""
    home = sys.modules.setdefault("_voxelspark_worker", types.ModuleType("_voxelspark_worker"))
    if home.__dict__.get("key") != key:
        home.key, home.value = key, make()
    return home.value


# ---------------------------------------------------------------------------------------------- Arrow batches


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; one longer text makes a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            base = int(sizes[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def lengths(array: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes, one after another, and the offsets of each (n + 1). A null is an empty text."""
    import pyarrow.compute as pc

    if array.null_count:
        array = pc.fill_null(array, "" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def id_array(array: pa.Array) -> np.ndarray:
    """Ids as int64, NULL_ID for null."""
    import pyarrow.compute as pc

    return pc.fill_null(array.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


# ---------------------------------------------------------------------------------------------- numpy kernels

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Byte classes: True where the byte is in a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM_OR_HIGH = np.ones(256, bool)
ALNUM_OR_HIGH[0x00:0x30] = ALNUM_OR_HIGH[0x3A:0x61] = ALNUM_OR_HIGH[0x7B:0x80] = False


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the maximal runs of ``inside`` bytes; no run crosses documents."""
    mask = np.zeros(len(buf) + 1, bool)
    mask[:-1] = inside[buf]
    begins = mask[:-1].copy()
    begins[1:] &= ~mask[:-2]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = mask[first]
    starts = np.flatnonzero(begins)
    ends_at = mask[:-1] & ~mask[1:]
    last = first_last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends_at[last] = mask[first_last]
    ends = np.flatnonzero(ends_at) + 1
    docs = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, docs


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


class SpanHash:
    """64-bit polynomial hashes of any spans of a buffer, from one running sum.

    sum of value[byte] * base^-i is taken once; the hash of [s, e) is the difference times base^e, which depends on the
    bytes of the span alone. Such sums modulo 2^64 are equal for some long strings of one pattern (Thue-Morse words) whatever
    the base is, so spans of ``LONG`` bytes or more, which are few, are hashed by XXH64.
    """

    LONG = 64

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.base = int(rng.integers(2**62, 2**63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.seed = mix64(np.array([seed + 1], np.uint64))[0]
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, buf: np.ndarray) -> "SpanHash":
        n = len(buf) + 1
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate([[U64(1)], np.full(n - 1, b, np.uint64)])) for b in (self.base, self.inverse))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.values[buf] * self.down[: len(buf)], out=self.sums[1:])
        self.data = memoryview(np.ascontiguousarray(buf))
        return self

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.up[ends]
        out = mix64(raw ^ mix64((ends - starts).astype(np.uint64) + self.seed))
        long = np.flatnonzero(ends - starts >= self.LONG)
        if len(long):
            seed, data = int(self.seed), self.data
            out[long] = [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        return out


def hash_words(hasher: SpanHash, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """Hashes of ascending spans that don't overlap, some ``limit`` bytes of the buffer at a time."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + limit, "right")))
        high = int(ends[b - 1])
        if high - low > limit:  # one long span, of which no sums are needed
            out[a] = xxhash.xxh64_intdigest(memoryview(np.ascontiguousarray(buf[low:high])), int(hasher.seed))
        else:
            out[a:b] = hasher.load(buf[low:high]).spans(starts[a:b] - low, ends[a:b] - low)
        a = b
    return out


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then the same for the others."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return shift + np.arange(total)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in arrays that are sorted by those keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


# ---------------------------------------------------------------------------------------------- row numbers, clean-up


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that no live plan needs: it does so when the driver's garbage is collected."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_row_ids(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Whether ids are unique, and docs(doc_id, text) with ``rid``, a long that orders the distinct rows by doc_id (nulls first) and then by text hash.

    Where ids are unique, which is checked, rid is the id. Else the distinct (id, text hash) pairs are numbered in order;
    wholly equal rows share a number.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    if not docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return docs.withColumn("rid", key), True
    keyed = docs.withColumn("k", key).withColumn("h", F.xxhash64("text", F.length("text")))
    pairs = keyed.select("k", "h").distinct().repartitionByRange("k", "h").sortWithinPartitions("k", "h")
    pairs = materialize(pairs.select("k", "h", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("n")), "row-ids")
    sizes = {r["part"]: r["count"] for r in pairs.groupBy("part").count().collect()}  # one row for each partition
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    offsets = docs.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "part int, base long")
    numbered = pairs.join(F.broadcast(offsets), "part").select("k", "h", (F.col("base") + F.col("n")).alias("rid"))
    return keyed.join(numbered, ["k", "h"]).select("doc_id", "text", "rid"), False
