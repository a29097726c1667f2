"""Language-model scores by deleted interpolation.

A token's probability mixes three maximum-likelihood estimates, p = w2 c(v w) / c(v) + w1 c(w) / N + w0 / (V + 1), where v
is the token before it. The weights depend on how often the context v was seen: contexts fall into buckets by powers of
two, and each bucket's weights are learned by expectation-maximisation on counts that one part of the training texts,
deleted from the counts for this purpose, gives. Every training text is in the counts that score.

Counts are kept by 64-bit hashes of tokens and of token pairs; two that share one count as one, which of ten billion
distinct pairs some three do. Texts are dealt to buckets of a few megabytes. A bucket
sends each distinct token and pair once, with its own counts, into the key space, as one packet for each of ``FAN`` ranges.
Where these ranges are small enough, each is a part: it sums what came and answers every packet with the totals for its
keys, in the same order. In a larger corpus the packets of ``FAN`` buckets for one range are merged into one, which is sent
on into ``FAN`` ranges of that range, and so on; answers come back the same way. So a bucket sends and gets as many packets
at every size of the corpus, a frequent key costs one entry a packet, and no table is sent to all tasks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, SpanHash, crc32_text, group_starts, lower_ascii, materialize, mix64, release, text_bytes, text_slices, word_spans

#: Context-frequency buckets: floor(log2(count + 1)), which no count of 64 bits exceeds.
BUCKETS = 64
#: EM reads the ratios of the estimates in steps of 1/8 octave, so that its table is of bounded size.
STEPS = 8
NONE = -(1 << 15)


def _squeeze(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unsqueeze(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, by byte planes."""
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unsqueeze(data, "<u8"), dtype=np.uint64)


def tokens(buf: np.ndarray, offsets: np.ndarray, hasher: SpanHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token, of the token before it, and document number. Each document ends with the end token, which is
    the hash of no bytes and also stands before a document's first token."""
    low = lower_ascii(buf)
    starts, ends, docs = word_spans(low, offsets, NOT_SPACE)
    n = len(offsets) - 1
    place = np.arange(len(starts)) + docs  # one end token for each document before
    at_end = np.cumsum(np.bincount(docs, minlength=n) + 1) - 1
    hasher.load(low)
    end = hasher.spans(np.array([0]), np.array([0]))[0]
    out = np.full(len(starts) + n, end, np.uint64)
    out[place] = hasher.spans(starts, ends)
    owner = np.empty(len(out), np.int64)
    owner[place] = docs
    owner[at_end] = np.arange(n)
    return out, np.append(end, out[:-1])[: len(out)], owner


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9E3779B97F4A7C15) + mix64(token ^ np.uint64(0x5851F42D4C957F2D)))


def _distinct(keys: np.ndarray, fold: np.ndarray, deleted: int, test: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their training counts, and their counts in the deleted fold."""
    order = np.argsort(keys)
    firsts = group_starts(keys[order])
    if not len(firsts):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    f = fold[order]
    return keys[order][firsts], np.add.reduceat((f != test).astype(np.int64), firsts), np.add.reduceat((f == deleted).astype(np.int64), firsts)


#: Ranges into which packets are sent at each level, as a power of two.
FAN_BITS = 7
REQUESTS = "part long, bucket long, kind int, keys binary, counts binary, deleted binary"
REPLIES = "bucket long, part long, kind int, counts binary, deleted binary, types long, total long, types_kept long, total_kept long"


def _cut(keys: np.ndarray, level: int, parent: int, bits: int) -> np.ndarray:
    """Where each of the ranges of a level that follow from its parent begins in sorted keys of the parent."""
    edges = np.array([(parent << bits | k) << (64 - bits * level) for k in range(1 << bits)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _fields(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _packets(level: int, parent: int, bits: int, bucket: int, kind: int, keys: np.ndarray, counts: np.ndarray, gone: np.ndarray) -> Iterator[tuple]:
    cut = _cut(keys, level, parent, bits)
    for k in range(1 << bits):
        own = slice(cut[k], cut[k + 1])
        if cut[k] < cut[k + 1]:
            yield parent << bits | k, bucket, kind, pack_keys(keys[own]), _squeeze(counts[own].astype("<i8")), _squeeze(gone[own].astype("<i8"))


def _requests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _fields(REQUESTS))


def _by_bucket(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """All rows of one bucket (or part) at a time, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy()
        cuts = [*group_starts(keys).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column(column)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def requests(rows: DataFrame, deleted: int, test: int, bits: int = FAN_BITS) -> DataFrame:
    """One packet for each bucket, range and kind (0: tokens, 1: pairs) from rows(bucket, fold, text) sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(5)
        for table in _by_bucket(batches, "bucket"):
            found: list[list[np.ndarray]] = [[], [], []]
            for batch in text_slices(iter(table.to_batches())):
                token, before, doc = tokens(*text_bytes(batch.column("text")), hasher)
                for x, y in zip(found, (token, pairs(before, token), batch.column("fold").to_numpy()[doc])):
                    x.append(y)
            bucket = table.column("bucket")[0].as_py()
            fold = np.concatenate(found[2])
            for kind in (0, 1):
                yield _requests(list(_packets(1, 0, bits, bucket, kind, *_distinct(np.concatenate(found[kind]), fold, deleted, test))))

    return rows.mapInArrow(run, REQUESTS)


def _merged(packets: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The sorted distinct keys of some packets, the sums of their counts, and where each packet's keys are among them."""
    lists = [unpack_keys(x) for x in packets.column("keys").to_pylist()]
    keys = np.unique(np.concatenate(lists))
    counts, gone = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    places = [np.searchsorted(keys, k) for k in lists]
    for at, c, g in zip(places, packets.column("counts").to_pylist(), packets.column("deleted").to_pylist()):
        counts[at] += _unsqueeze(c, "<i8")
        gone[at] += _unsqueeze(g, "<i8")
    return keys, counts, gone, places


def _node(part: Column, bucket: Column, bits: int) -> Column:
    """A range, and the group of buckets whose packets for it are merged, in one number."""
    return F.shiftleft(part, 32).bitwiseOR(F.shiftright(bucket, bits))


def merge(asked: DataFrame, level: int, bits: int) -> DataFrame:
    """The packets of the next level: those for one range from 2^bits buckets, merged and sent on into its ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches, "node"):
            node, of_kind = table.column("node")[0].as_py(), table.column("kind").to_numpy()
            for kind in (0, 1):
                own = table.filter(pa.array(of_kind == kind))
                if own.num_rows:
                    keys, counts, gone, _ = _merged(own)
                    yield _requests(list(_packets(level + 1, node >> 32, bits, node & 0xFFFFFFFF, kind, keys, counts, gone)))

    dealt = asked.withColumn("node", _node(F.col("part"), F.col("bucket"), bits))
    return dealt.repartition("node").sortWithinPartitions("node", "kind").mapInArrow(run, REQUESTS)


def expand(asked: DataFrame, answers: DataFrame, bits: int) -> DataFrame:
    """The answers to a level's packets from those to the merged packets of the next."""
    names, kinds = _fields(REPLIES), [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches, "node"):
            of_kind, is_asked = table.column("kind").to_numpy(), table.column("keys").is_valid().to_numpy()
            for kind in (0, 1):
                own, got = (table.filter(pa.array((of_kind == kind) & w)) for w in (is_asked, ~is_asked))
                if not own.num_rows:
                    continue
                got = got.sort_by("part")
                totals = [np.concatenate([_unsqueeze(x, "<i8") for x in got.column(c).to_pylist()]) for c in ("counts", "deleted")]
                lists = [unpack_keys(x) for x in own.column("keys").to_pylist()]
                keys = np.unique(np.concatenate(lists))
                for bucket, part, k in zip(own.column("bucket").to_pylist(), own.column("part").to_pylist(), lists):
                    at = np.searchsorted(keys, k)
                    row = (bucket, part, kind, *(_squeeze(t[at]) for t in totals), None, None, None, None)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    node = F.shiftleft(F.shiftright("part", bits), 32).bitwiseOR(F.col("bucket"))
    down = answers.select(node.alias("node"), "part", "bucket", "kind", F.lit(None).cast("binary").alias("keys"), "counts", "deleted")
    up = asked.select(_node(F.col("part"), F.col("bucket"), bits).alias("node"), "part", "bucket", "kind", "keys", "counts", "deleted")
    return up.unionByName(down).repartition("node").sortWithinPartitions("node", "kind").mapInArrow(run, REPLIES)


def replies(asked: DataFrame) -> DataFrame:
    """The totals for every packet, in its order, of the last level's ranges; and for each range one row of bucket -1 with
    the number of training tokens and types, with and without the deleted fold."""
    names, kinds = _fields(REPLIES), [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches, "part"):
            part = table.column("part")[0].as_py()
            of_kind = table.column("kind").to_numpy()
            for kind in (0, 1):
                own = table.filter(pa.array(of_kind == kind))
                if not own.num_rows:
                    continue
                keys, counts, gone, places = _merged(own)
                if kind == 0:
                    left = counts - gone
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((-1, part, 0, None, None, int((counts > 0).sum()), int(counts.sum()), int((left > 0).sum()), int(left.sum())), kinds)], names)
                rows = [(b, part, kind, _squeeze(counts[at]), _squeeze(gone[at]), None, None, None, None) for b, at in zip(own.column("bucket").to_pylist(), places)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return asked.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, REPLIES)


def totals(asked: DataFrame, levels: int, bits: int = FAN_BITS) -> tuple[DataFrame, DataFrame]:
    """The answers to the packets of the first level, and the rows of bucket -1."""
    packets = [asked]
    for level in range(1, levels):
        packets[-1] = materialize(packets[-1], "lm-packets")
        packets.append(merge(packets[-1], level, bits))
    answers = materialize(replies(packets[-1]), "lm-totals")
    release(asked.sparkSession)
    sums, answers = answers.where("bucket = -1"), answers.where("bucket >= 0")
    for own in reversed(packets[:-1]):
        answers = materialize(expand(own, answers, bits), "lm-totals")
        release(asked.sparkSession)
    return answers, sums


class Bucket:
    """A bucket's texts as tokens, and the totals that were sent back for its tokens and pairs."""

    def __init__(self, answers: pa.Table, token: np.ndarray, before: np.ndarray):
        of_kind = answers.column("kind").to_numpy()
        self.places = [np.unique(x, return_inverse=True)[1] for x in (token, pairs(before, token))]
        self.counts, self.gone = [], []
        for kind in (0, 1):
            own = answers.filter(pa.array(of_kind == kind)).sort_by("part")
            self.counts.append(np.concatenate([_unsqueeze(x, "<i8") for x in own.column("counts").to_pylist()]))
            self.gone.append(np.concatenate([_unsqueeze(x, "<i8") for x in own.column("deleted").to_pylist()]))

    def totals(self, kept: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of every token, of the token before it, and of the pair; kept: without the deleted fold."""
        one, two = ((c - g if kept else c)[at] for c, g, at in zip(self.counts, self.gone, self.places))
        # the token before the first is an end token, and so is the last one
        return one, np.append(one[-1:], one[:-1]), two


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, Bucket]]:
    """The texts of each bucket, the document number of each token, and the totals, from rows sorted by bucket that hold
    texts and answers."""
    import pyarrow.compute as pc

    hasher = SpanHash(5)
    for table in _by_bucket(batches, "bucket"):
        is_text = table.column("kind").is_null()
        texts = table.filter(is_text)
        if not texts.num_rows:
            continue
        slices = list(text_slices(iter(texts.to_batches())))
        found = [tokens(*text_bytes(b.column("text")), hasher) for b in slices]
        first = np.cumsum([0, *(b.num_rows for b in slices)])
        doc = np.concatenate([d + at for (_, _, d), at in zip(found, first)])
        yield pa.Table.from_batches(slices), doc, Bucket(table.filter(pc.invert(is_text)), *(np.concatenate([f[k] for f in found]) for k in (0, 1)))


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(count + 1.0)).astype(np.int64)


def held_out_table(rows: DataFrame, types: int, total: int) -> DataFrame:
    """How often each (context bucket, log ratio of the pair estimate and of the token estimate to the uniform one) occurs
    in the texts of rows, which are of the deleted fold, against counts without it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple, int] = {}
        for _, _, bucket in _buckets(batches):
            c1, cv, c2 = bucket.totals(True)
            with np.errstate(divide="ignore", invalid="ignore"):
                r2 = np.where(c2 > 0, np.rint(STEPS * np.log2(c2 / cv * (types + 1))), NONE)
                r1 = np.where(c1 > 0, np.rint(STEPS * np.log2(c1 / max(total, 1) * (types + 1))), NONE)
            packed = context_bucket(cv) << 32 | (r2.astype(np.int64) - NONE) << 16 | (r1.astype(np.int64) - NONE)
            keys, n = np.unique(packed, return_counts=True)
            for k, v in zip(keys.tolist(), n.tolist()):
                k = (k >> 32, (k >> 16 & 0xFFFF) + NONE, (k & 0xFFFF) + NONE)
                cells[k] = cells.get(k, 0) + v
        rows_ = [(*k, v) for k, v in cells.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows_)] if rows_ else [pa.array([], pa.int64())] * 4, ["b", "r2", "r1", "n"])

    return rows.mapInArrow(run, "b long, r2 long, r1 long, n long").groupBy("b", "r2", "r1").agg(F.sum("n").alias("n"))


def learn_weights(cells: np.ndarray, rounds: int = 200) -> np.ndarray:
    """(w2, w1, w0) of each context bucket by EM; a bucket without held-out tokens takes the next lower one's weights."""
    weights = np.tile(np.array([0.4, 0.4, 0.2]), (BUCKETS, 1))
    for b in range(BUCKETS):
        own = cells[cells[:, 0] == b] if len(cells) else cells
        if not len(own):
            if b:
                weights[b] = weights[b - 1]
            continue
        ratio = np.stack([*(np.where(own[:, k] == NONE, 0.0, 2.0 ** (own[:, k] / STEPS)) for k in (1, 2)), np.ones(len(own))], 1)
        n, w = own[:, 3].astype(float), np.array([0.4, 0.4, 0.2])
        for _ in range(rounds):
            share = ratio * w
            share *= (n / share.sum(1))[:, None]
            new = share.sum(0) / n.sum()
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        w = np.maximum(w, 1e-6)  # no token is ever impossible
        weights[b] = w / w.sum()
    return weights


SCORES = "doc_id long, fold int, n_tokens long, n_known long, base_score double, score double"


def scores(rows: DataFrame, weights: np.ndarray, types: int, total: int) -> DataFrame:
    """Base and model log10 probabilities of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, doc, bucket in _buckets(batches):
            n = texts.num_rows
            c1, cv, c2 = bucket.totals(False)
            w = weights[context_bucket(cv)]
            p = w[:, 0] * np.where(cv > 0, c2 / np.maximum(cv, 1), 0) + w[:, 1] * (c1 / max(total, 1)) + w[:, 2] / (types + 1)
            # where nothing follows the context, its share goes to the other two
            p = np.where(cv > 0, p, p / (1 - w[:, 0]))
            base = np.log10((c1 + 0.1) / (total + 0.1 * (types + 1)))
            sums = [np.bincount(doc, weights=x, minlength=n) for x in (np.ones(len(doc)), c1 > 0, base, np.log10(p))]
            yield pa.RecordBatch.from_arrays([texts.column("doc_id").combine_chunks(), texts.column("fold").combine_chunks(), *(pa.array(s.astype(np.int64)) for s in sums[:2]), *map(pa.array, sums[2:])], [x.split()[0] for x in SCORES.split(", ")])

    return rows.mapInArrow(run, SCORES)


def score_texts(docs: DataFrame, fold: Column | None = None, test: int = 0, deleted: int = 9, bucket_bytes: int = 4 << 20, part_bytes: int = 16 << 20, fan_bits: int = FAN_BITS) -> DataFrame:
    """(doc_id, fold, n_tokens, n_known, train_tokens, base_score, score) for every row of docs(doc_id, text).

    ``fold`` deals documents to folds (default: crc32 of the id as text, modulo 10; a null id is in the test fold). The
    test fold is scored and never counted. Null texts are empty: one end token. Repeated rows count as often as they are
    there. An empty table gives no rows.
    """
    spark = docs.sparkSession
    fold = fold if fold is not None else crc32_text("doc_id") % 10
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold, F.lit(test)).cast("int").alias("fold"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_buckets, parts = max(1, math.ceil(size / bucket_bytes)), max(1, math.ceil(size / part_bytes))
    levels = next(n for n in itertools.count(1) if 1 << fan_bits * n >= parts)
    # the deleted fold has buckets of its own, which EM reads alone; the others follow
    n_deleted = math.ceil(n_buckets / 10)
    spread = F.xxhash64("doc_id", "text")
    bucket = F.when(F.col("fold") == deleted, F.pmod(spread, F.lit(n_deleted))).otherwise(n_deleted + F.pmod(spread, F.lit(n_buckets)))
    rows = rows.withColumn("bucket", bucket.cast("long"))
    answers, sums = totals(requests(rows.repartition("bucket").sortWithinPartitions("bucket"), deleted, test, fan_bits), levels, fan_bits)
    own = sums.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "total", "types_kept", "total_kept"))).first()

    def both(texts: DataFrame, buckets: Column) -> DataFrame:
        sent = answers.where(buckets).select("bucket", "part", "kind", "counts", "deleted")
        mixed = texts.unionByName(sent, allowMissingColumns=True)
        return mixed.repartition("bucket").sortWithinPartitions("bucket")

    deleted_rows = both(rows.where(F.col("fold") == deleted), F.col("bucket") < n_deleted)
    cells = held_out_table(deleted_rows, own["types_kept"], own["total_kept"]).toPandas().to_numpy(np.int64)
    release(spark)
    weights = learn_weights(cells)
    return scores(both(rows, F.lit(True)), weights, own["types"], own["total"]).withColumn("train_tokens", F.lit(own["total"]).cast("long"))
