"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts of equal sets are one node. Candidate pairs come from two sides, and every one of them is verified on the two whole
sets before it links:

* the SimHash operator: fingerprints of the five-word shingles within four bits of each other, by its grid;
* bands of minima: sets as similar as 0.8 have fingerprints some ten bits apart on average, beyond what a grid can reach,
  so a node also has ``BANDS`` keys, each of the least shingles under ``DEEP`` random orders. Two sets of similarity J share
  a key with probability 1 - (1 - J^6)^34: 0.99997 at 0.8, more above, and 0.02 at 0.3, as texts with a passage in common
  have.

A cell of K nodes is not compared K times K: in each round the nodes of a cell are put in another order and each meets the
``LAGS`` before it, and nodes that verified links join already meet no more. What is left after ``ROUNDS`` rounds, or sooner
where that is little, is compared inside the cells by sizes and bitmaps: rows of a cell lie side by side in a task, and only
pairs that may reach 0.8 leave it, to be verified. A cell of more than ``BLOCK`` nodes is dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, group_starts, materialize, mix64, release, text_bytes, text_slices
from .components import connected_components
from .simhash import n_blocks, near_links, shingle_hashes, simhash

WIDTH, SEED, RADIUS = 5, 42, 4
BANDS, DEEP = 34, 6
#: Bytes of text that are shingled at once: a shingle takes some hundred bytes while fingerprints are counted.
SLICE = 1 << 18
#: Words of 64 bits in a set's bitmap.
MAP = 8
ROUNDS, LAGS = 3, 4
#: Sets up to which their bitmaps, some 100 bytes each, are sent to all tasks.
FEW_SETS = 200_000
#: The cells are gone through once there are this many pairs of nodes or fewer for each row of them.
PAIRS_A_ROW = 4
#: Nodes of a cell that are compared in one task.
BLOCK = 1 << 10
_RNG = np.random.default_rng(SEED)
_FLIPS = _RNG.integers(0, 2**64, BANDS * DEEP, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 2**63, BANDS * DEEP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _distinct(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text and their document numbers, by document and hash."""
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    at = group_starts(d, h)
    return h[at], d[at]


def band_keys(h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """BANDS keys of each set of shingles; sets follow each other and begin at ``firsts``."""
    out = np.zeros((len(firsts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(firsts), band, np.uint64)
        for k in range(band * DEEP, (band + 1) * DEEP):
            least = np.minimum.reduceat(((h ^ _FLIPS[k]) * _FACTORS[k] >> np.uint64(32)).astype(np.uint32), firsts)
            key = mix64(key * _FACTORS[0] ^ least)
        out[:, band] = key
    return out


NODES = "row_key binary, doc_id long, node binary, n int, fp long, bands array<long>"


def text_nodes(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, node, n, fp, bands) for every row of docs(row_key, doc_id, text): the key of the set of its shingles
    (128 bits), the set's size, the fingerprint, and the band keys; a text without words has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            n = batch.num_rows
            h, d = shingle_hashes(*text_bytes(batch.column(2)), WIDTH, SEED)
            fp = simhash(h, d, n)
            h, d = _distinct(h, d)
            edges = np.searchsorted(d, np.arange(n + 1))
            data = h.astype("<u8").tobytes()
            nodes = [xxhash.xxh3_128_digest(data[8 * a : 8 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            firsts = edges[:-1][np.diff(edges) > 0]
            bands = band_keys(h, firsts).view(np.int64) if len(firsts) else np.zeros((0, BANDS), np.int64)
            sizes = np.where(np.diff(edges) > 0, BANDS, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(np.diff(edges), pa.int32()), pa.array(fp.view(np.int64)), lists], [x.split()[0] for x in NODES.split(", ")])

    return docs.select("row_key", F.col("doc_id").cast("long"), "text").mapInArrow(run, NODES)


def shared_cells(nodes: DataFrame) -> DataFrame:
    """(token, node, n) of the band keys of nodes(node, n, bands) that have another node of a size that allows 0.8: if any
    size does, the next smaller or the next larger one does."""
    w = Window.partitionBy("token").orderBy("n", "node")
    cells = nodes.select(F.explode("bands").alias("token"), "node", "n")
    near = cells.withColumns({"below": F.lag("n").over(w), "above": F.lead("n").over(w)})
    return near.where("5 * below >= 4 * n or 5 * n >= 4 * above").select("token", "node", "n")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes(node, n, fp) that the SimHash operator links: a fingerprint is stood for by its least node, to
    which its other nodes are paired, and linked fingerprints' nodes are paired."""
    ids = materialize(nodes.where("n > 0").groupBy("fp").agg(F.min("node").alias("first")), "near-fingerprints")
    links = near_links(ids.select("fp"), RADIUS, n_blocks(ids.count(), RADIUS), 1 << 14).distinct()
    a, b = (ids.select(F.col("fp").alias(k), F.col("first").alias(f"{k}_node")) for k in "ab")
    apart = links.join(a, "a").join(b, "b").select(*_pair("a_node", "b_node"))
    same = nodes.join(ids, "fp").where("node <> first").select(*_pair("node", "first"))
    return apart.unionByName(same).distinct()


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(node, n, tokens, m0, m1, ...) of docs(node, text): all distinct shingles, their number and their bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            h, d = _distinct(*shingle_hashes(*text_bytes(batch.column(1)), WIDTH, SEED))
            edges = np.searchsorted(d, np.arange(batch.num_rows + 1)).astype(np.int32)
            maps = np.zeros((batch.num_rows, MAP), np.uint64)
            np.bitwise_xor.at(maps, (d, (h >> np.uint64(6)).astype(np.int64) % MAP), np.uint64(1) << (h & np.uint64(63)))
            maps = maps.view(np.int64)
            tokens = pa.ListArray.from_arrays(pa.array(edges), pa.array(h.view(np.int64)))
            columns = [batch.column(0), pa.array(np.diff(edges)), tokens, *(pa.array(np.ascontiguousarray(m)) for m in maps.T)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "tokens", *(f"m{i}" for i in range(MAP))])

    return docs.select("node", "text").mapInArrow(run, "node binary, n int, tokens array<long>, " + ", ".join(f"m{i} long" for i in range(MAP)))


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose sets have a Jaccard similarity of 0.8 or more. Two sets differ in at least as many shingles
    as their bitmaps of shingle parities do in bits; whole sets are sent only for the pairs that this leaves."""
    one, two = (sets.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), *[F.col(f"m{i}").alias(f"m{i}{k}") for i in range(MAP)]) for k in "ab")
    if sets.count() <= FEW_SETS:
        one, two = F.broadcast(one), F.broadcast(two)  # pairs then stay where they are
    apart = sum((F.bit_count(F.col(f"m{i}a").bitwiseXOR(F.col(f"m{i}b"))) for i in range(MAP)), F.lit(0))
    likely = materialize(pairs.join(one, "a").join(two, "b").where("5 * least(na, nb) >= 4 * greatest(na, nb)").where(9 * apart <= F.col("na") + F.col("nb")).select("a", "b"), "near-pairs")
    one, two = (sets.join(likely.select(F.col(k).alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias(k), F.col("tokens").alias(f"{k}s")) for k in "ab")
    both = F.size(F.array_intersect("as", "bs")).cast("long")
    out = materialize(likely.join(one, "a").join(two, "b").where(9 * both >= 4 * (F.size("as") + F.size("bs")).cast("long")).select("a", "b"), "near-links")
    release(pairs.sparkSession)
    discard(likely)
    return out


def _pair(a: str, b: str) -> tuple:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def likely_pairs(met: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of nodes of one cell of met(token, node, n, part), with different parts, that may be as similar as 0.8 by their sizes
    and bitmaps. sizes(token, s) has the cells' sizes."""
    maps = [f"m{i}" for i in range(MAP)]
    held = met.join(sizes.select("token", "s"), "token").join(sets.select("node", *maps), "node")
    own = F.pmod(F.xxhash64("node"), F.ceil(F.col("s") / BLOCK)).cast("int")
    dealt = held.select("token", "node", "part", "n", *maps, own.alias("own"), F.explode(F.sequence(F.lit(0), (F.ceil(F.col("s") / BLOCK) - 1).cast("int"))).alias("other"))
    cell = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"))
    rows = dealt.select(cell.alias("cell"), (F.col("own") == F.col("other")).alias("same"), "own", "node", "part", "n", *maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        cell, own, n = (whole.column(c).to_numpy() for c in ("cell", "own", "n"))
        same = whole.column("same").to_numpy(zero_copy_only=False)
        node, part = (text_bytes(whole.column(c).combine_chunks())[0].reshape(-1, 16).copy().view(np.uint64) for c in ("node", "part"))
        bits = np.stack([whole.column(m).to_numpy().view(np.uint64) for m in maps], axis=1)
        ends = np.append(group_starts(cell)[1:], len(cell))
        left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(cell))  # rows of the cell from here on
        at = np.flatnonzero(left > 1)
        lag = 1
        while len(at):
            for own_ in np.array_split(at, -(-len(at) // (1 << 16))):
                to = own_ + lag
                ok = (same[own_] | (own[own_] != own[to])) & (part[own_] != part[to]).any(1) & (5 * np.minimum(n[own_], n[to]) >= 4 * np.maximum(n[own_], n[to]))
                a, b = own_[ok], to[ok]
                apart = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
                ok = 9 * apart <= n[a].astype(np.int64) + n[b]
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in node[k[ok]]], pa.binary()) for k in (a, b)], ["a", "b"])
            lag += 1
            at = at[left[at] > lag]

    found = rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a binary, b binary")
    return found.select(*_pair("a", "b"))


def _links(links: DataFrame, cells: DataFrame, sets: DataFrame) -> DataFrame:
    """With the links that are known, links that join all nodes of every component of the graph of similar sets. A cell whose
    nodes are all in one part stays so, and no later round reads it."""
    close = "5 * least(n, m) >= 4 * greatest(n, m)"
    held: list[DataFrame] = []
    for k in range(ROUNDS + 1):
        parts = connected_components(links, tidy=True)
        own = cells.join(parts, "node", "left").select("token", "node", "n", F.coalesce("component", "node").alias("part"))
        cell = Window.partitionBy("token")
        own = own.withColumns({"low": F.min("part").over(cell), "high": F.max("part").over(cell)})
        met = materialize(own.where("low <> high").select("token", "node", "n", "part"), "near-cells")
        discard(*held)
        release(cells.sparkSession)
        sizes = met.groupBy("token", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("q"), F.count(F.lit(1)).alias("parts"))
        total = sizes.agg(F.sum("s").alias("rows"), (F.sum(F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs")).first()
        if not total["rows"]:
            discard(met)
            break
        last = k == ROUNDS or total["pairs"] <= PAIRS_A_ROW * total["rows"]
        if last:
            pairs = likely_pairs(met, sizes, sets)
        else:
            w = Window.partitionBy("token").orderBy(*(["n", "node"] if k == 0 else [F.xxhash64("node", F.lit(k)), "node"]))
            before = F.collect_list(F.struct(F.col("node").alias("node_2"), F.col("n").alias("m"), F.col("part").alias("part_2"))).over(w.rowsBetween(-LAGS, -1))
            chain = met.select("node", "n", "part", before.alias("before")).select("node", "n", "part", F.explode("before").alias("x")).select("node", "n", "part", "x.*")
            pairs = chain.where("part <> part_2").where(close).select(*_pair("node", "node_2"))
        links = links.unionByName(similar(pairs.distinct(), sets))
        if last:
            discard(met)
            break
        cells, held = met.select("token", "node", "n"), [met]
    return links


def near_copies(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, component) for every row of docs(row_key binary, doc_id, text), where row_key is not null.

    Rows are linked where the sets of their five-word shingles (one of the whole text, if it is shorter) are equal or have a
    Jaccard similarity of 0.8 or more. Null texts and texts without words have equal sets. Rows of one row_key are rows of
    their own; ids may be null; an empty table gives no rows.
    """
    rows = materialize(text_nodes(docs), "near-rows")
    nodes = rows.groupBy("node").agg(F.min(F.struct("row_key", "n", "fp", "bands")).alias("x")).select("node", "x.row_key", "x.n", "x.fp", "x.bands")
    nodes = materialize(nodes, "near-nodes")
    cells = materialize(shared_cells(nodes), "near-cells")
    pairs = materialize(fingerprint_pairs(nodes), "near-pairs")
    release(docs.sparkSession)
    ends = [pairs.select(F.col(k).alias("node")) for k in "ab"]
    chosen = nodes.select("row_key", "node").join(cells.select("node").unionByName(ends[0]).unionByName(ends[1]).distinct(), "node", "left_semi")
    texts = docs.select("row_key", "text").join(chosen, "row_key").dropDuplicates(["row_key"])
    sets = materialize(shingle_sets(texts), "near-sets")
    release(docs.sparkSession)
    links = materialize(_links(similar(pairs, sets), cells, sets), "near-links")
    discard(nodes, cells, pairs, sets)
    parts = connected_components(links, tidy=True)
    return rows.select("row_key", "doc_id", "node").join(parts, "node", "left").select("row_key", "doc_id", F.coalesce("component", "node").alias("component"))
