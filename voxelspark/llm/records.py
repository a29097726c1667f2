"""Token ids in length-delimited binary records, with masked checksums and a separate offset index.

A file is a run of records in ascending doc_id order. A record is

    length   8 bytes, little-endian: bytes of the payload
    check    4 bytes: masked CRC-32 of those 8 bytes
    payload  1 byte of flags (1: the id is null), 8 bytes doc_id, then the token ids, 2 bytes each where the vocabulary
             has no more than 65,536 entries and 4 bytes otherwise (flag 2), little-endian
    check    4 bytes: masked CRC-32 of the payload

The mask is ((crc >> 15 | crc << 17) + 0xa282ead8) mod 2^32, so that a checksum over data that holds checksums stays
sound. The index is a Parquet table beside the files: (shard, number in the shard, offset, bytes, doc_id, n_tokens), by
which any record can be read alone, in any order. Shards follow each other in the order of their numbers.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, SLICE_BYTES, filesystem, id_array, ids_back, kept, materialize, ranges, shared_path, text_bytes, text_slices

END_ID = 2


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at ``at``, and where the next one begins; ValueError if a checksum is wrong."""
    size, check = struct.unpack_from("<QI", data, at)
    if masked_crc(data[at : at + 8]) != check:
        raise ValueError(f"record length at {at} is damaged")
    payload = data[at + 12 : at + 12 + size]
    if len(payload) != size or struct.unpack_from("<I", data, at + 12 + size)[0] != masked_crc(payload):
        raise ValueError(f"record at {at} is damaged")
    return payload, at + 16 + size


def payload_of(doc_id: int, ids: bytes | memoryview, wide: bool) -> bytes:
    null = doc_id == NULL_ID
    return b"".join((struct.pack("<Bq", null | wide << 1, 0 if null else doc_id), ids))


def read_payload(payload: memoryview) -> tuple[int, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return NULL_ID if flags & 1 else doc_id, np.frombuffer(payload[9:], "<u4" if flags & 2 else "<u2")


class Encoder:
    """Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

    No pre-token of the byte-level pattern goes on from a character that is not white space into white space, nor from a
    letter into a punctuation mark, so texts are cut at such borders. The pieces of a batch are numbered by their bytes, each distinct piece goes through the
    library once, and the ids of all texts are gathered from those of the pieces. Pieces recur, so their ids are kept, in a
    cache of bounded size that never changes a result. Texts that hold an added token, and all texts of another kind of
    model, go through the library whole.
    """

    def __init__(self, path: str, cache: int = 500_000):
        import json

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        made = json.loads(self.whole.to_str())
        pre = made.get("pre_tokenizer") or {}
        self.cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not made.get("normalizer") and not made.get("post_processor") and made["model"]["type"] == "BPE" and not made["model"].get("dropout")
        self.added = [t["content"].encode() for t in made.get("added_tokens", [])]
        self.wide = self.whole.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        # a byte-level token has a letter for each of its bytes
        self.n_bytes = np.zeros(max(made["model"]["vocab"].values(), default=0) + 1, np.int64) if self.cuts else None
        if self.cuts:
            for token, number in made["model"]["vocab"].items():
                self.n_bytes[number] = len(token)
        self.limit = cache
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, self.kind)
        self.used = 0

    def learn(self, pieces: list[bytes]) -> None:
        """Put the ids of pieces that are not known yet into the pool. Those that begin with white space and end in other
        ASCII are encoded as one text, which tokenizes as each alone does, and told apart by their bytes' number."""
        joined = [p for p in pieces if p[0] < 0x80 and _WHITE[p[0]] and p[-1] < 0x80 and not _WHITE[p[-1]]]
        alone = list(set(pieces).difference(joined))
        for found in (joined[i : i + 20_000] for i in range(0, len(joined), 20_000)):
            data = b"".join(found)
            if any(t in data for t in self.added):
                alone += found
                continue
            ids = np.array(self.whole.encode_batch_fast([data.decode()], add_special_tokens=False)[0].ids, self.kind)
            ends = np.cumsum(self.n_bytes[ids])
            self.store(found, ids, np.diff(np.searchsorted(ends, np.cumsum([len(p) for p in found])) + 1, prepend=0))
        for found in (alone[i : i + 4096] for i in range(0, len(alone), 4096)):
            lists = [e.ids for e in self.whole.encode_batch_fast([p.decode() for p in found], add_special_tokens=False)]
            self.store(found, np.array([i for x in lists for i in x], self.kind), np.array([len(x) for x in lists], np.int64))

    def store(self, found: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, total = len(self.number), self.used + len(ids)
        self.number.update(zip(found, range(first, first + len(found))))
        if len(self.number) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(max(len(x), len(found)), np.int64)]) for x in (self.starts, self.sizes))
        if total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), self.kind)])
        self.starts[first : first + len(found)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first : first + len(found)] = sizes
        self.pool[self.used : total] = ids
        self.used = total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and the number of each text's ids. A null text has none."""
        buf, offsets = text_bytes(texts)
        if not len(buf):
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        if not self.cuts:
            return self.by_text(texts, range(len(texts)), np.zeros(0, self.kind), np.zeros(len(texts), np.int64))
        starts = piece_starts(buf, offsets)
        ends = np.append(starts, len(buf)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf))]).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.number) > self.limit or self.used > 16 * self.limit:
            self.forget()
        self.learn(list(filterfalse(self.number.__contains__, pieces)))
        number = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))[coded.indices.to_numpy()]
        sizes = self.sizes[number]
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(before[np.searchsorted(starts, offsets)])
        ids = self.pool[ranges(self.starts[number], sizes)]
        data = buf.tobytes()
        if any(t in data for t in self.added):
            whole = [i for i, t in enumerate(texts.to_pylist()) if t and any(a in t.encode() for a in self.added)]
            return self.by_text(texts, whole, ids, counts)
        return ids, counts

    def by_text(self, texts: pa.Array, whole: Iterable[int], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same ids and numbers, where the texts at ``whole`` are encoded whole instead."""
        parts = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
        for i in whole:
            parts[i] = np.array(self.whole.encode(texts[i].as_py() or "", add_special_tokens=False).ids, self.kind)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[list(b".,;:!?")] = True


def piece_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each text's first byte, at every ASCII white space that follows something else, and at a mark
    that follows an ASCII letter. Behind bytes that may end a white space beyond ASCII no piece begins: a longer piece is as good."""
    white = _WHITE[buf]
    spacy = white.copy()
    high = np.flatnonzero(buf >= 0x80)
    high = high[high >= 1]
    one = buf[high - 1]
    spacy[high[one == 0xC2]] = True
    spacy[high[((one == 0x80) | (one == 0x81) | (one == 0x9A) | (one == 0xA0)) & (high >= 2) & np.isin(buf[high - 2], (0xE1, 0xE2, 0xE3))]] = True
    begins = white
    begins[1:] &= ~spacy[:-1]
    begins[1:] |= _MARK[buf[1:]] & _LETTER[buf[:-1]]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


INDEX = "shard int, number long, offset long, bytes long, doc_id long, n_tokens long"


def write_records(docs: DataFrame, tokenizer: str | Callable[[], str], path: str, end_id: int = END_ID) -> DataFrame:
    """Encode docs(doc_id, text) to record files under ``path``, in ascending doc_id order, and return the index.

    The rows are dealt to shards by ranges of (doc_id, text hash), so a shard is a bounded part of the order even where an
    id repeats. ``tokenizer`` is the vocabulary file's path, or a function that finds it on an executor. A null text is
    empty and gives the end id alone; null ids come first. A task writes its shard under a name of its own and then
    renames it, so a task that runs again leaves the same file.
    """
    names = ["shard", "number", "offset", "bytes", "doc_id", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        fs, folder = filesystem(path)
        own = f"{folder}/.{shard:06d}-{task.taskAttemptId()}"
        encoder = None
        offset = number = 0
        out = None
        for batch in text_slices(batches, limit=2 * SLICE_BYTES):
            if encoder is None:
                vocabulary = tokenizer if isinstance(tokenizer, str) else tokenizer()
                encoder = kept(("encoder", vocabulary), lambda: Encoder(vocabulary))
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(own)
            ids = id_array(batch.column(0))
            tokens, counts = encoder.encode(batch.column(1))
            ends = np.cumsum(counts + 1)
            whole = np.full(int(ends[-1]), end_id, encoder.kind)
            inside = np.ones(len(whole), bool)
            inside[ends - 1] = False
            whole[inside] = tokens
            sizes, data, item = [], memoryview(whole.tobytes()), whole.itemsize
            for doc_id, a, b in zip(ids.tolist(), (item * (ends - counts - 1)).tolist(), (item * ends).tolist()):
                record = frame(payload_of(doc_id, data[a:b], encoder.wide))
                out.write(record)
                sizes.append(len(record))
            counts = counts + 1
            n = len(sizes)
            at = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(number, number + n)), pa.array(offset + at[:-1]), pa.array(sizes, pa.int64()), ids_back(ids), pa.array(counts)], names)
            offset, number = offset + int(at[-1]), number + n
        if out is not None:
            out.close()
            fs.move(own, f"{folder}/shard-{shard:06d}.rec")

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    return materialize(ordered.mapInArrow(run, INDEX), "record-index")


RECORDS = "shard int, number long, doc_id long, ids array<int>"


def _payloads(data: memoryview) -> Iterator[tuple[int, np.ndarray]]:
    at = 0
    while at < len(data):
        payload, at = unframe(data, at)
        yield read_payload(payload)


def _streamed(stream, size: int = 8 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """The records of a file, read in parts of ``size`` bytes or of one longer record."""
    held = b""
    while part := stream.read(size):
        held += part
        view, at = memoryview(held), 0
        while at + 12 <= len(view) and at + 16 + (n := struct.unpack_from("<Q", view, at)[0]) <= len(view):
            payload, at = unframe(view, at)
            yield read_payload(payload)
        held = held[at:]
    if held:
        raise ValueError("the file ends inside a record")


def shard_table(index: DataFrame) -> DataFrame:
    """(shard, start): the ids of all shards before each; one row for each file, put together on the driver."""
    sizes = sorted((r["shard"], r["n"]) for r in index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    rows, total = [], 0
    for shard, n in sizes:
        rows.append((shard, total))
        total += n
    return index.sparkSession.createDataFrame(rows, "shard int, start long").repartition(max(1, len(rows)), "shard") if rows else index.sparkSession.createDataFrame([], "shard int, start long")


DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_digests(index: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read from the files one after another with all checksums
    verified; start counts the ids of all records before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with fs.open_input_stream(f"{folder}/shard-{shard:06d}.rec") as stream:
                    for doc_id, ids in _streamed(stream):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _digests(rows)
                            rows = []
                if rows:
                    yield _digests(rows)

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        doc_id, *others = (np.array(c, np.int64) for c in zip(*rows))
        return pa.RecordBatch.from_arrays([ids_back(doc_id), *map(pa.array, others)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shard_table(index).mapInArrow(run, DIGEST)


def read_shuffled(index: DataFrame, path: str, seed: int) -> DataFrame:
    """(doc_id, ids) of all records in a seeded random order, each read alone through the offset index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        files: dict = {}
        for batch in batches:
            ids, tokens = [], []
            for shard, offset, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if shard not in files:
                    if len(files) >= 64:
                        files.popitem()[1].close()
                    files[shard] = fs.open_input_file(f"{folder}/shard-{shard:06d}.rec")
                payload, _ = unframe(memoryview(files[shard].read_at(size, offset)), 0)
                doc_id, own = read_payload(payload)
                ids.append(doc_id)
                tokens.append(own.astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids_back(np.array(ids, np.int64)), pa.array(tokens, pa.list_(pa.int32()))], ["doc_id", "ids"])

    order = F.xxhash64(F.lit(seed), "shard", "number")
    return index.repartitionByRange(order).sortWithinPartitions(order).select("shard", "offset", "bytes").mapInArrow(run, "doc_id long, ids array<int>")


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_records(docs: DataFrame, tokenizer: str | Callable[[], str] = public_tokenizer, path: str | None = None) -> DataFrame:
    """Write docs(doc_id, text) as records and read them back: (doc_id, start, n_tokens, ids_crc32) for every row. A null text
    is the end id alone; null ids come first; rows that share an id follow each other in the order of their texts' hashes;
    an empty table gives no rows."""
    path = path or shared_path(docs.sparkSession, "records")
    return read_digests(write_records(docs, tokenizer, path), path)
