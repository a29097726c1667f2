"""Ranked lexical search over a two-level index.

The index is a table of blocks, each some megabytes of whole documents. Its first level has, for every term of a block, the
documents that hold it and one byte each, the term's impact on the document's score divided by ``STEP`` and rounded up. The
second level has the exact term frequencies and document lengths. For a set of queries

1. the first level gives each document an upper and a lower bound of its score, both by sums of weight times byte;
2. the k-th largest lower bound of all documents is a query's threshold;
3. only documents whose upper bound reaches it are scored exactly, in 64-bit integers, from the second level.

Ranks are thus those of exact scores, however many documents share a score. Queries are dealt in chunks, files of bounded
size in the shared folder, which a task that reads blocks goes through one after another. What a task sends on is k rows a
query. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_OR_HIGH, SpanHash, discard, filesystem, group_starts, hash_words, kept, lower_ascii, materialize, ranges, shared_path, text_bytes, text_slices, word_spans

TOP = 10
#: Impacts are below a million: that many parts of it a byte tells apart.
STEP = -(-1_000_000 // 255)
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 1 << 13
CHUNK_BYTES = 1 << 18
#: Query-document sums that are held at once.
CELLS = 1 << 21
#: Packed bytes of blocks for which a task reads all chunks of queries once.
HELD_BYTES = 24 << 20
_SEED = 11
_LAST = np.iinfo(np.int64).max


# ---------------------------------------------------------------------------------------------- index


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps([(x.dtype.str, np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()) for x in arrays]))


def _expand(data: bytes) -> list[np.ndarray]:
    found = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(k).itemsize, -1).T).view(k).ravel() for k, b in found]


def _terms(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of all terms of texts."""
    low = lower_ascii((found := text_bytes(array))[0])
    starts, ends, docs = word_spans(low, found[1], ALNUM_OR_HIGH)
    return hash_words(SpanHash(_SEED), low, starts, ends), docs


def count_terms(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_ids array<long>, n_docs, n_terms, counts binary) of docs(doc_id, text): blocks with the documents and frequencies of
    each term and the documents' lengths; n_docs counts those with a term. A null id comes after all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in text_slices(batches, limit=block_bytes):
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(at, BLOCK_DOCS)
                h, d = _terms(batch.column(1))
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                pairs = group_starts(h, d)
                tf = np.diff(np.append(pairs, len(h))).astype("<i4")
                h, of = h[pairs], d[pairs].astype("<i4")
                firsts = group_starts(h)
                sizes = np.diff(np.append(firsts, len(h))).astype("<i4")
                n = np.bincount(d, minlength=batch.num_rows).astype("<i4")
                ids = pc.fill_null(batch.column(0), int(_LAST))
                data = _squeeze(h[firsts], sizes, of, tf, n)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), ids), pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]), pa.array([data], pa.binary())], ["doc_ids", "n_docs", "n_terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_ids array<long>, n_docs long, n_terms long, counts binary")


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a unit of weight adds to the score of a document of n terms that holds a term tf times."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n * docs // max(terms, 1)))


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, int]:
    """The index of docs(doc_id, text): (doc_ids, first, second), the number of documents with a term, and of all terms."""
    counted = materialize(count_terms(docs, block_bytes), "term-counts")
    total = counted.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("t")).first()
    n_docs, n_terms = total["d"], total["t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms, sizes, of, tf, n = _expand(batch.column(1)[i].as_py())
                bounds = -(-impacts(tf, n[of], n_docs, n_terms) // STEP)
                first, second = _squeeze(terms, sizes, of, bounds.astype(np.uint8)), _squeeze(tf, n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([first], pa.binary()), pa.array([second], pa.binary())], ["doc_ids", "first", "second"])

    index = materialize(counted.select("doc_ids", "counts").mapInArrow(run, "doc_ids array<long>, first binary, second binary"), "impact-index")
    discard(counted)
    return index, n_docs, n_terms


# ---------------------------------------------------------------------------------------------- queries


def query_terms(items: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, item, term) of items(item, text): the distinct terms of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, limit=chunk_bytes):
            h, d = _terms(batch.column(1))
            order = np.lexsort((h, d))
            h, d = h[order], d[order]
            at = group_starts(d, h)
            item = batch.column(0).to_numpy()[d[at]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(item), pa.array(h[at].view(np.int64))], ["chunk", "item", "term"])
            number += 1

    return items.select("item", "text").mapInArrow(run, "chunk long, item long, term long")


def write_chunks(rows: DataFrame, folder: str) -> list[str]:
    """Write each chunk of rows(chunk, item, term, weight, least) as a file, and return the files' names, which is all that comes
    to the driver. A file appears by a rename, so a task may run again."""

    def run(table: pa.Table) -> pa.Table:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = str(table.column("chunk")[0].as_py())
        item, term, weight, least = (table.column(c).to_numpy() for c in ("item", "term", "weight", "least"))
        order = np.lexsort((term, item))
        own = f"{root}/.{name}-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(own) as out:
            out.write(pickle.dumps([item[order], term[order].view(np.uint64), weight[order], least[order]]))
        fs.move(own, f"{root}/{name}")
        return pa.table({"name": [name]})

    return sorted(r["name"] for r in rows.groupBy("chunk").applyInArrow(run, "name string").collect())


class Chunk:
    """Queries of a chunk: items, and for each row of them its query (place in items), term (place in terms) and weight; least is
    the score that each query asks for."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, least: np.ndarray):
        self.items, firsts, self.of = np.unique(item, return_index=True, return_inverse=True)
        self.terms, self.term = np.unique(term, return_inverse=True)
        self.weight, self.least = weight, least[firsts]


def _read_chunk(folder: str, name: str) -> Chunk:
    fs, root = filesystem(folder)

    def load() -> Chunk:
        with fs.open_input_stream(f"{root}/{name}") as f:
            return Chunk(*pickle.loads(f.read()))

    return kept((folder, name), load)


class Block:
    """A block's first level, and its second where it is given, met with the terms of a chunk."""

    def __init__(self, n_docs: int, first: bytes, second: bytes | None = None):
        self.n_docs = n_docs
        self.terms, self.sizes, self.of, self.bound = _expand(first)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.tf, self.n = _expand(second) if second is not None else (None, None)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Where the terms are in the block, -1 where they are not."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def groups(self, chunk: Chunk) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """A few queries at a time: their slice of the chunk's items, and for each posting of their terms its number, its query
        and document as one place in a table, and its weight."""
        place = self.places(chunk.terms)[chunk.term]
        met = np.flatnonzero(place >= 0)
        place, of, weight = place[met], chunk.of[met], chunk.weight[met]
        many = max(1, CELLS // max(self.n_docs, 1))
        for a in range(0, len(chunk.items), many):
            rows = slice(*np.searchsorted(of, [a, a + many]))
            if rows.start < rows.stop:
                counts = self.sizes[place[rows]].astype(np.int64)
                posting = ranges(self.at[place[rows]].astype(np.int64), counts)
                cell = np.repeat((of[rows] - a) * self.n_docs, counts) + self.of[posting]
                yield slice(a, min(a + many, len(chunk.items))), posting, cell, np.repeat(weight[rows], counts)

    def sums(self, cells: int, cell: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = np.zeros(cells, np.int64)
        np.add.at(out, cell, value)
        return out.reshape(-1, self.n_docs)


def frequencies(index: DataFrame, folder: str, names: list[str]) -> DataFrame:
    """(chunk, term, df): the number of documents that hold each term of the queries."""

    def count(held: list[Block], name: str, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(chunk.terms), np.int64)
        for block in held:
            place = block.places(chunk.terms)
            df[place >= 0] += block.sizes[place[place >= 0]]
        some = df > 0
        yield pa.RecordBatch.from_arrays([pa.array(np.full(int(some.sum()), int(name))), pa.array(chunk.terms[some].view(np.int64)), pa.array(df[some])], ["chunk", "term", "df"])

    parts = index.select(F.size("doc_ids").alias("n"), "first").mapInArrow(_over_chunks(folder, names, count), "chunk long, term long, df long")
    return parts.groupBy("chunk", "term").agg(F.sum("df").alias("df"))


def _over_chunks(folder: str, names: list[str], work: Callable[[list[Block], str, Chunk], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` over blocks (n or doc_ids, first, perhaps second), ``HELD_BYTES`` of them at a time, and all chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name in names:
                yield from work(held, name, _read_chunk(folder, name))

        for batch in batches:
            for i in range(batch.num_rows):
                ids, *data = (batch.column(c)[i] for c in range(batch.num_columns))
                data = [x.as_py() for x in data]
                if held and size + sum(map(len, data)) > HELD_BYTES:
                    yield from flush()
                    held, size = [], 0
                ids = ids.values.to_numpy() if pa.types.is_list(ids.type) else ids.as_py()
                block = Block(ids if isinstance(ids, int) else len(ids), *data)
                block.ids = ids
                held.append(block)
                size += sum(map(len, data))
        if held:
            yield from flush()

    return run


def thresholds(index: DataFrame, folder: str, names: list[str], k: int) -> DataFrame:
    """(item, least): the k-th largest lower bound of a document's score for each query that k documents have a term of."""

    def best(held: list[Block], name: str, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        top = np.full((len(chunk.items), k), -1, np.int64)
        for block in held:
            for own, posting, cell, weight in block.groups(chunk):
                cells = (own.stop - own.start) * block.n_docs
                byte = block.bound[posting].astype(np.int64)
                low = block.sums(cells, cell, weight * np.where(byte > 0, (byte - 1) * STEP + 1, 0))
                seen = np.zeros(cells, bool)
                seen[cell] = True
                low = np.concatenate([np.where(seen.reshape(low.shape), low, -1), top[own]], axis=1)
                top[own] = -np.partition(-low, k - 1, axis=1)[:, :k]
        item, _ = np.nonzero(top >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(chunk.items[item]), pa.array(top[top >= 0])], ["item", "low"])

    lows = index.select(F.size("doc_ids").alias("n"), "first").mapInArrow(_over_chunks(folder, names, best), "item long, low long")
    return _first(lows, [F.desc("low")], k).where(F.col("rank") == k).select("item", F.col("low").alias("least"))


def _first(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The k first rows of each item, ranked: first those of each of 64 parts of the rows, then of these."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k).drop("salt")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def rescored(index: DataFrame, folder: str, names: list[str], k: int, n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score, rank): the k best documents of each query by exact score. Every document whose upper bound reaches
    the query's threshold is scored."""

    def best(held: list[Block], name: str, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for block in held:
            for own, posting, cell, weight in block.groups(chunk):
                high = block.sums((own.stop - own.start) * block.n_docs, cell, weight * block.bound[posting].astype(np.int64) * STEP)
                likely = ((high >= chunk.least[own][:, None]) & (high > 0)).ravel()
                some = likely[cell]
                of = block.of[posting[some]]
                exact = weight[some] * impacts(block.tf[posting[some]], block.n[of], n_docs, n_terms)
                score = block.sums(len(likely), cell[some], exact)
                query, doc = np.nonzero(score)
                found.append(np.stack([query + own.start, -score[query, doc], block.ids[doc]]))
        query, score, doc = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        order = np.lexsort((doc, score, query))
        query, score, doc = query[order], score[order], doc[order]
        at = group_starts(query)
        few = np.arange(len(query)) - np.repeat(at, np.diff(np.append(at, len(query)))) < k
        yield pa.RecordBatch.from_arrays([pa.array(chunk.items[query[few]]), pa.array(doc[few]), pa.array(-score[few])], ["item", "doc_id", "score"])

    rows = index.mapInArrow(_over_chunks(folder, names, best), "item long, doc_id long, score long")
    return _first(rows, [F.desc("score"), "doc_id"], k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of docs(doc_id, text) with a score above 0 for each row of
    items(item_id, text), ranked from 1 by score and ascending doc_id.

    A score is the sum, over a query's distinct terms, of floor(1000 * ln((2N + 2) / (2df + 1))) times the term's impact on
    the document (see ``impacts``); N counts the documents with a term. Null and empty texts have no terms: such a query has
    no rows, such a document is in none. A null doc_id comes after others of its score, and rows of one doc_id are documents
    of their own. Wholly equal rows of items are one query; others of one item_id are queries of their own. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    items = materialize(items.select("item_id", "text").distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "queries")
    index, n_docs, n_terms = build_index(docs, block_bytes)
    wanted = materialize(query_terms(items, chunk_bytes), "query-terms")
    zero = F.lit(0).cast("long")
    folder = shared_path(spark, "query-chunks")
    names = write_chunks(wanted.select("chunk", "item", "term", zero.alias("weight"), zero.alias("least")), folder)
    df = materialize(frequencies(index, folder, names), "frequencies")
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    weighted = materialize(wanted.join(df, ["chunk", "term"]).select("chunk", "item", "term", weight.cast("long").alias("weight")), "weighted-terms")
    folder = shared_path(spark, "query-chunks")
    names = write_chunks(weighted.withColumn("least", zero), folder)
    least = thresholds(index, folder, names, k)
    folder = shared_path(spark, "query-chunks")
    names = write_chunks(weighted.join(least, "item", "left").select("chunk", "item", "term", "weight", F.coalesce("least", zero).alias("least")), folder)
    found = rescored(index, folder, names, k, n_docs, n_terms)
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", F.expr(f"nullif(doc_id, {_LAST})").alias("doc_id"), "score")
