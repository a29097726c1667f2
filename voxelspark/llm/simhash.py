"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join under Manhattan distance.

A fingerprint is cut into 2-bit segments; their bit counts (0, 1 or 2 each) embed it in 32 dimensions, where the
Manhattan distance never exceeds the Hamming distance. Counts are kept in unary (00, 01, 11), so the Manhattan distance
of two embeddings is the number of bits in which the two words differ. The 32 dimensions are split into blocks; two points
at distance r at most agree wholly in all but r of them, so the grid has one table of cells for each choice of that many
blocks, and every pair in range meets in a cell. More fingerprints get more and finer blocks, so that a cell's expected size
stays bounded. Pairs that meet are filtered by the Manhattan bound and then verified by the exact Hamming distance.

A cell gives a spanning forest of its links and not all its pairs: a breadth-first walk compares each point that it
reaches with the points not reached yet, so a cell of K mutual near copies costs K comparisons and K - 1 links. The points
of a cell of more than ``cell_limit`` are dealt into finer cells in the same way, by the bits in which they may still
differ, until all cells are small: distinct fingerprints always come apart.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, group_starts, lower_ascii, materialize, mix64, popcount, text_bytes, text_slices, word_spans
from .components import connected_components

ODD = 0x5555555555555555
SEGMENTS = 32


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every ``width``-word shingle and its document number, in order."""
    low = lower_ascii(buf)
    starts, ends, docs = word_spans(low, offsets, NOT_SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), docs
    keep = NOT_SPACE[low]
    gaps = ends[ends < len(low)]  # one space stays after each word
    keep[gaps] = True
    low[gaps[~NOT_SPACE[low[gaps]]]] = 0x20
    moved = np.concatenate([[0], np.cumsum(keep)])
    data = low[keep].tobytes()
    firsts = group_starts(docs)
    counts = np.diff(np.append(firsts, len(docs)))
    n = np.maximum(counts - width + 1, 1)
    at = np.repeat(firsts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    until = at + np.repeat(np.minimum(counts, width), n) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(data[s:e], seed) for s, e in zip(moved[starts[at]].tolist(), (moved[ends[until] - 1] + 1).tolist())], np.uint64)
    return hashes, docs[at]


def simhash(hashes: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """A bit is 1 if it is set in over half of a document's hashes; documents of no hash get 0."""
    out = np.zeros(n_docs, np.uint64)
    if not len(hashes):
        return out
    firsts = group_starts(docs)
    sizes = np.diff(np.append(firsts, len(docs)))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
    out[docs[firsts]] = np.packbits(2 * sums > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for every row of docs(doc_id, text); fp is the 64-bit fingerprint as a signed long.

    A null or wordless text has fingerprint 0, a text of fewer than ``width`` words one shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            h, d = shingle_hashes(*text_bytes(batch.column(1)), width, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(simhash(h, d, batch.num_rows).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """The 32 segment counts in unary, two bits each."""
    right = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(right).bitwiseAND(F.lit(ODD))
    both = fp.bitwiseAND(right).bitwiseAND(F.lit(ODD))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _embed(fp: np.ndarray) -> np.ndarray:
    one, odd = np.uint64(1), np.uint64(ODD)
    return ((fp | fp >> one) & odd) | ((fp & fp >> one & odd) << one)


def grid_masks(blocks: int, radius: int) -> list[int]:
    """One signed 64-bit mask for each choice of blocks - radius of the blocks."""
    edges = [2 * (SEGMENTS * i // blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    masks = [sum(c) for c in itertools.combinations(parts, blocks - radius)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning forest of the graph that links fingerprints ``radius`` or fewer bits apart."""
    emb = _embed(fp)
    rest = np.arange(len(fp))
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    queue: list[int] = []
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        at = queue.pop()
        near = popcount(emb[rest] ^ emb[at]) <= radius  # the Manhattan bound
        near[near] = popcount(fp[rest[near]] ^ fp[at]) <= radius  # the exact distance
        hit = rest[near]
        if len(hit):
            a.append(np.full(len(hit), at))
            b.append(hit)
            queue += hit.tolist()
            rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _small_links(fp: np.ndarray, emb: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs inside many small groups at once: rows against the row ``lag`` below, lag by lag."""
    size = np.repeat(sizes, sizes)
    place = np.arange(len(fp)) - np.repeat(firsts, sizes)
    a, b = [], []
    at = np.flatnonzero(place + 1 < size)
    lag = 1
    while len(at):
        near = at[popcount(emb[at] ^ emb[at + lag]) <= radius]
        near = near[popcount(fp[near] ^ fp[near + lag]) <= radius]
        a.append(near)
        b.append(near + lag)
        lag += 1
        at = at[place[at] + lag < size[at]]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def n_blocks(count: int, radius: int, cell: int = 2048) -> int:
    """The least number of blocks, three more than the radius at least, at which a cell is expected to hold ``cell`` of
    ``count`` random fingerprints or fewer: a segment's count carries 1.5 bits."""
    return next((b for b in range(radius + 3, SEGMENTS) if count <= cell * 2 ** (1.5 * SEGMENTS * (b - radius) / b)), SEGMENTS)


LINKS = "kind int, a long, b long, fp long, agreed long"
CELLS = "cell long, fp long, agreed long"


def cell_links(cells: DataFrame, radius: int, cell_limit: int, small: int = 8) -> DataFrame:
    """Links inside each cell of cells(cell, fp, agreed), which come sorted by cell: kind 0 rows are links a, b; the rows of
    a cell that is over the limit return as kind 1, with the cell in a."""
    names = [x.split()[0] for x in LINKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none, none], names)

        def over(part: list[np.ndarray]) -> pa.RecordBatch:
            n = len(part[0])
            return pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(part[0]), pa.nulls(n, pa.int64()), pa.array(part[1].view(np.int64)), pa.array(part[2])], names)

        def solve(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Of whole cells."""
            cell, fp, _ = part
            firsts = group_starts(cell)
            sizes = np.diff(np.append(firsts, len(cell)))
            few = np.repeat(sizes <= small, sizes)
            if few.any():
                own = fp[few]
                s = sizes[sizes <= small]
                a, b = _small_links(own, _embed(own), np.concatenate([[0], np.cumsum(s)[:-1]]), s, radius)
                if len(a):
                    yield links(own[a], own[b])
            for at in np.flatnonzero(sizes > small):
                rows = slice(firsts[at], firsts[at] + sizes[at])
                if sizes[at] > cell_limit:
                    yield over([x[rows] for x in part])
                    continue
                a, b = forest(fp[rows], radius)
                if len(a):
                    yield links(fp[rows][a], fp[rows][b])

        held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        large: int | None = None  # the cell that is over the limit already
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()]
            held = [np.concatenate(x) for x in zip(held, new)]
            if large is not None and len(held[0]) and held[0][0] == large:
                k = int(np.searchsorted(held[0], large, "right"))
                yield over([x[:k] for x in held])
                held = [x[k:] for x in held]
            if not len(held[0]):
                continue
            large = None
            cut = int(np.searchsorted(held[0], held[0][-1], "left"))  # the last cell may go on
            if cut:
                yield from solve([x[:cut] for x in held])
                held = [x[cut:] for x in held]
            if len(held[0]) > cell_limit:
                large = int(held[0][0])
                yield over(held)
                held = [x[:0] for x in held]
        if len(held[0]):
            yield from solve(held)

    return cells.select("cell", "fp", "agreed").mapInArrow(run, LINKS)


def finer_masks(agreed: int, radius: int) -> list[int]:
    """Masks of raw fingerprint bits, one for each choice of blocks of the bits outside ``agreed``."""
    free = [b for b in range(64) if not agreed >> b & 1]
    n = min(radius + 3, len(free))
    parts = [sum(1 << b for b in free[len(free) * i // n : len(free) * (i + 1) // n]) for i in range(n)]
    return [sum(c) for c in itertools.combinations(parts, max(1, n - radius))]


def finer_cells(over: DataFrame, radius: int) -> DataFrame:
    """Each point of over(cell, fp, agreed) once for each finer cell. Points of a cell are equal in its agreed bits, and two
    in range are equal in some choice of blocks of the other bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, fp, agreed = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for value in np.unique(agreed).tolist():
                own = agreed == value
                for t, mask in enumerate(finer_masks(value, radius)):
                    deal = mix64(mix64(cell[own] + np.uint64(t)) ^ mix64(fp[own] & np.uint64(mask)))
                    yield pa.RecordBatch.from_arrays([pa.array(deal.view(np.int64)), pa.array(fp[own].view(np.int64)), pa.array(np.full(len(deal), value | mask, np.uint64).view(np.int64))], ["cell", "fp", "agreed"])

    return over.mapInArrow(run, CELLS)


def near_links(ids: DataFrame, radius: int, blocks: int, cell_limit: int) -> DataFrame:
    """Links that join all fingerprints of every component, of the distinct ids(fp)."""
    masks = F.array(*[F.lit(m) for m in grid_masks(blocks, radius)])
    cells = ids.select("fp", embedding(F.col("fp")).alias("emb")).select("fp", "emb", F.posexplode(masks).alias("t", "mask"))
    cells = cells.select(F.xxhash64("t", F.col("emb").bitwiseAND(F.col("mask"))).alias("cell"), "fp", F.lit(0).cast("long").alias("agreed"))
    links = None
    while True:
        found = materialize(cell_links(cells.repartition("cell").sortWithinPartitions("cell", "fp"), radius, cell_limit), "cell-links")
        own = found.where("kind = 0").select("a", "b")
        links = own if links is None else links.unionByName(own)
        over = found.where("kind = 1")
        if not over.limit(1).count():
            return links
        cells = finer_cells(over.select(F.col("a").alias("cell"), "fp", "agreed"), radius)


def near_duplicates(fps: DataFrame, radius: int = 4, blocks: int | None = None, cell_limit: int = 1 << 14) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of fps(doc_id, fp).

    Fingerprints ``radius`` or fewer bits apart are linked, and are themselves the graph's nodes, so that null or repeated
    ids change no component. A component's id is the smallest doc_id of any row in it, null where all its ids are null.
    Exact copies share a fingerprint and enter the grid once. ``blocks`` follows from the number of fingerprints.
    """
    ids = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    links = near_links(ids, radius, blocks or n_blocks(ids.count(), radius), cell_limit)
    parts = connected_components(links)
    placed = ids.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    placed = materialize(placed, "components")
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return placed.join(least, "component").select("fp", "component_id")


def simhash_components(docs: DataFrame, width: int = 4, radius: int = 4, seed: int = 42, **grid) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs(doc_id, text). Null and wordless texts have fingerprint 0 and are
    linked like all others; null and repeated ids are rows of their own; an empty table gives no rows."""
    fps = materialize(fingerprints(docs, width, seed), "simhash")
    return fps.join(near_duplicates(fps, radius, **grid), "fp").select("doc_id", "fp", "component_id")
