"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of blocks. A block holds whole documents (about two megabytes of text): the sorted distinct term
hashes, and for each term its postings, the ascending word positions in the block, where each document's positions begin
after those of the one before. All postings of a document are in one block, so a phrase is resolved inside a block: take
the window's terms that are rarest in the block first and intersect their lists, each shifted by the term's offset.

The test items' windows are made by tasks too, as files of bounded size in the shared folder. A task that reads index
blocks goes through these files one after another, so neither the driver nor any one task holds all items. Nothing is
dropped for frequent terms: their lists are only probed at the starts that rarer terms left. Terms are told apart by
64-bit hashes, so a phrase of ten words is told apart by 640 bits and one of a single word by 64.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_OR_HIGH, SLICE_BYTES, SpanHash, filesystem, group_starts, hash_words, kept, lower_ascii, materialize, ranges, shared_path, text_bytes, text_slices, word_spans

WINDOW = 10
_SEED = 6
#: Positions between the words of two documents, so that no window and no slack reaches across.
GAP = 1 << 10
#: Bytes of text that are hashed at once.
HASHED_BYTES = 1 << 18


@dataclass
class Block:
    """terms: sorted hashes; at: where each term's postings begin (n + 1); positions: the postings; bases: the position
    of each document's first word; words: the word count of each."""

    terms: np.ndarray
    at: np.ndarray
    positions: np.ndarray
    bases: np.ndarray
    words: np.ndarray

    def pack(self) -> bytes:
        gaps = np.diff(self.positions, prepend=np.int32(0)).astype("<i4")
        body = b"".join(x.tobytes() for x in (np.array([len(self.terms), len(self.positions), len(self.words)], "<i8"), self.terms.astype("<u8"), np.diff(self.at).astype("<i4"), gaps.view(np.uint8).reshape(-1, 4).T.copy(), self.words.astype("<i4")))
        return zstandard.ZstdCompressor(level=1).compress(body)

    @staticmethod
    def unpack(data: bytes) -> "Block":
        body = memoryview(zstandard.ZstdDecompressor().decompress(data))
        t, p, d = np.frombuffer(body[:24], "<i8").tolist()
        cut = np.cumsum([24, 8 * t, 4 * t, 4 * p, 4 * d])
        terms, counts, gaps, words = (np.frombuffer(body[a:b], k) for a, b, k in zip(cut, cut[1:], ("<u8", "<i4", np.uint8, "<i4")))
        positions = np.cumsum(np.ascontiguousarray(gaps.reshape(4, -1).T).view("<i4").ravel(), dtype=np.int32)
        return Block(terms, np.concatenate([[0], np.cumsum(counts)]), positions, _bases(words), words)


def _bases(words: np.ndarray) -> np.ndarray:
    return GAP + np.concatenate([[0], np.cumsum(words.astype(np.int64) + GAP)[:-1]]) if len(words) else np.zeros(0, np.int64)


def word_hashes(buf: np.ndarray, offsets: np.ndarray, hasher: SpanHash) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased words' hashes and document numbers. The sums of 8 bytes for each byte, several times over, are made for
    ``HASHED_BYTES`` of text at a time, however much there is."""
    low = lower_ascii(buf)
    starts, ends, docs = word_spans(low, offsets, ALNUM_OR_HIGH)
    return hash_words(hasher, low, starts, ends, HASHED_BYTES), docs


def build_block(hashes: np.ndarray, docs: np.ndarray, n_docs: int) -> Block:
    words = np.bincount(docs, minlength=n_docs)
    positions = (ranges(_bases(words), words)).astype(np.int32)
    order = np.argsort(hashes, kind="stable")
    terms = hashes[order]
    firsts = group_starts(terms)
    return Block(terms[firsts], np.append(firsts, len(terms)), positions[order], _bases(words), words)


def build_index(docs: DataFrame, block_bytes: int = 2 * SLICE_BYTES) -> DataFrame:
    """(doc_ids array<long>, block binary): the positional index of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(_SEED)
        for batch in text_slices(batches, limit=block_bytes):
            h, d = word_hashes(*text_bytes(batch.column(1)), hasher)
            data = build_block(h, d, batch.num_rows).pack()
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0).cast(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([data], pa.binary())], ["doc_ids", "block"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_ids array<long>, block binary")


@dataclass
class Windows:
    """Distinct windows of some test items. terms: the sorted distinct term hashes; number: the windows' terms as places in
    them, one window after another; firsts: where each window begins; sizes: its length; of: the items (places in names)
    that hold each window; names: the item ids, null where an item has none."""

    terms: np.ndarray
    number: np.ndarray
    firsts: np.ndarray
    sizes: np.ndarray
    of: list[list[int]]
    names: list[str | None]

    @staticmethod
    def make(names: list[str | None], texts: pa.Array, width: int = WINDOW) -> "Windows":
        h, d = word_hashes(*text_bytes(texts), SpanHash(_SEED))
        distinct = sorted(set(names), key=lambda n: (n is not None, n))
        place = {n: i for i, n in enumerate(distinct)}
        found: dict[bytes, set[int]] = {}
        for item in np.unique(d).tolist():
            own = h[d == item]
            for at in range(max(1, len(own) - width + 1)):
                found.setdefault(own[at : at + width].tobytes(), set()).add(place[names[item]])
        sizes = np.array([len(k) // 8 for k in found], np.int64)
        terms, number = np.unique(np.frombuffer(b"".join(found), np.uint64), return_inverse=True)
        return Windows(terms, number, np.cumsum(sizes) - sizes, sizes, [sorted(v) for v in found.values()], distinct)


def _holds(postings: np.ndarray, want: np.ndarray, slack: int) -> np.ndarray:
    """For each wanted position: do the postings hold one within ``slack``?"""
    at = np.searchsorted(postings, want - slack)
    ok = at < len(postings)
    ok[ok] = postings[at[ok]] <= want[ok] + slack
    return ok


class Search:
    """The windows whose terms a block all has, for exact and near searches in it."""

    def __init__(self, block: Block, windows: Windows):
        self.block, self.windows = block, windows
        n = len(block.terms)
        self.place = np.minimum(np.searchsorted(block.terms, windows.terms), max(n - 1, 0))
        known = block.terms[self.place] == windows.terms if n else np.zeros(len(windows.terms), bool)
        self.frequency = np.where(known, block.at[self.place + 1] - block.at[self.place], 0) if n else np.zeros(len(known), np.int64)
        self.likely = np.flatnonzero(np.minimum.reduceat(known[windows.number], windows.firsts)).tolist() if len(windows.firsts) and n else []

    def starts(self, w: int, slack: int) -> np.ndarray:
        """Positions s in the block such that every term k of the window stands within ``slack`` words of s + k. With slack 0
        these are the starts of the exact phrase. Candidates come from the rarest term alone."""
        own = self.windows.number[self.windows.firsts[w] : self.windows.firsts[w] + self.windows.sizes[w]]
        order = np.argsort(self.frequency[own], kind="stable").tolist()
        lists = [self.block.positions[self.block.at[p] : self.block.at[p + 1]] for p in self.place[own].tolist()]
        start = lists[order[0]].astype(np.int64) - order[0]
        if slack:
            start = np.unique(start[:, None] + np.arange(-slack, slack + 1))
        for k in order[1:]:
            if not len(start):
                break
            start = start[_holds(lists[k], start + k, slack)]
        return start


def merged_spans(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


SPANS = "array<struct<start:int,stop:int>>"
HITS = f"doc_id long, n_words long, hit_spans {SPANS}, item_ids array<string>, near_ids array<string>"


def write_windows(items: DataFrame, folder: str, width: int = WINDOW, chunk_bytes: int = 1 << 20) -> list[str]:
    """Write the windows of items(item_id, text) as files of at most ``chunk_bytes`` of text each (or one longer item), and
    return their names, which is all that comes to the driver. A file appears by a rename, so a task may run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        fs, root = filesystem(folder)
        for batch in text_slices(batches, limit=chunk_bytes):
            made = Windows.make(batch.column(0).to_pylist(), batch.column(1), width)
            if not len(made.firsts):
                continue
            name = f"{task.partitionId():06d}-{number:06d}"
            number += 1
            fs.create_dir(root, recursive=True)
            own = f"{root}/.{name}-{task.taskAttemptId()}"
            with fs.open_output_stream(own) as out:
                out.write(pickle.dumps(vars(made)))
            fs.move(own, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    items = items.select(F.col("item_id").cast("string"), "text").distinct()
    return sorted(r["name"] for r in items.mapInArrow(run, "name string").collect())


def read_windows(folder: str, names: list[str]) -> Iterator[Windows]:
    """The files, one after another; the last one read is kept by the worker, so that a single file is read once."""
    fs, root = filesystem(folder)

    def load(name: str) -> dict:
        with fs.open_input_stream(f"{root}/{name}") as f:
            return pickle.loads(f.read())

    for name in names:
        yield Windows(**kept((folder, name), lambda name=name: load(name)))


def match(index: DataFrame, folder: str, names: list[str], slack: int = 2, held_bytes: int = 16 << 20) -> DataFrame:
    """One row for every document of the index: its words, the merged word ranges of exact windows, the ids of the items
    that have exact windows in it, and of those that have near ones (every term within ``slack`` words of its place).

    The files of windows are read once for every ``held_bytes`` of packed blocks."""

    def search_all(held: list[tuple[pa.Array, bytes]]) -> Iterator[pa.RecordBatch]:
        span_kind, text = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.list_(pa.string())
        results = [([[] for _ in ids], [set() for _ in ids], [set() for _ in ids]) for ids, _ in held]
        for windows in read_windows(folder, names):
            for (_, data), (spans, exact, near) in zip(held, results):
                block = Block.unpack(data)
                search = Search(block, windows)
                for w in search.likely:
                    own = search.starts(w, slack)
                    if not len(own):  # an exact phrase is a near one
                        continue
                    items = [windows.names[i] for i in windows.of[w] if windows.names[i] is not None]
                    for d in set((np.searchsorted(block.bases, own + (GAP >> 1), "right") - 1).tolist()):
                        near[d].update(items)
                    own = search.starts(w, 0)
                    doc = np.searchsorted(block.bases, own, "right") - 1
                    for d, s in zip(doc.tolist(), (own - block.bases[doc]).tolist()):
                        spans[d].append((s, s + int(windows.sizes[w])))
                        exact[d].update(items)
        for (ids, data), (spans, exact, near) in zip(held, results):
            words = Block.unpack(data).words.astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array([merged_spans(x) for x in spans], span_kind), *(pa.array([sorted(x) for x in found], text) for found in (exact, near))], ["doc_id", "n_words", "hit_spans", "item_ids", "near_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, bytes]] = []
        size = 0
        for batch in batches:
            for ids, data in zip(batch.column(0), batch.column(1).to_pylist()):
                if held and size + len(data) > held_bytes:
                    yield from search_all(held)
                    held, size = [], 0
                held.append((ids.values, data))
                size += len(data)
        if held:
            yield from search_all(held)

    return index.select("doc_ids", "block").mapInArrow(run, HITS)


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, slack: int = 2, chunk_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_words, hit_spans, item_ids, near_ids) for every row of docs(doc_id, text).

    hit_spans are the word ranges [start, stop) that exact windows of items(item_id, text) cover, merged and ascending;
    item_ids are the items with exact windows and near_ids those with near ones, as sorted distinct strings. A null text has
    no words and an item of no word has no window; an item of fewer than ``width`` words is one window. Items of null id
    count for hit_spans and have no place in the lists of ids; several rows of one item_id are one item. Repeated rows of
    docs are rows of their own; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "benchmark-windows")
    names = write_windows(items, folder, width, chunk_bytes)
    index = materialize(build_index(docs), "positional-index")
    return match(index, folder, names, slack)
