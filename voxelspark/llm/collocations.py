"""Phrases of several words that stand together more often than their parts do, mined by position bitmaps.

A shard holds some megabytes of text. Its words have positions, with one empty position between pieces, and every distinct
word (of one language) has a bitmap of its positions, of which the 64-bit words that are not zero are kept, with their
numbers. A phrase's bitmap marks where its last word stands: shifted by one position and ANDed with a word's bitmap it is
that of the phrase with this word added, and the empty position keeps it inside a piece. Popcounts give a shard's count of
a phrase, and their sum over shards is its frequency.

A phrase can only be frequent if what remains of it without its last word, and that word, are. So lengths are counted one
after another, and a shard grows phrases depth-first, going on only from those whose frequency over all shards sufficed.
Shards are told of these by rows (shard, phrase), which the tasks that add the counts send back: no list of all frequent
words or phrases is held anywhere. Phrases are pairs of the number of a frequent phrase and that of a frequent word, so they
are told apart exactly; words of one shard are told apart by hashes of 64 bits, and over shards by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SpanHash, discard, group_starts, hash_words, lower_ascii, materialize, mix64, ranges, release, text_bytes, text_slices, word_spans

MIN_COUNT, MAX_WORDS, TOP = 30, 4, 2000
#: A candidate goes if a longer one that holds it has this share of its occurrences, in percent.
COVERED = 80
SHARD_BYTES = 4 << 20
#: A shard's words are dealt over rows of so many, some 300 KB each in the JVM.
WORDS_A_ROW = 4096
#: Bytes of text that are hashed at once.
HASH_BYTES = 1 << 18
#: Pairs of 64-bit words that are ANDed at once.
AND_AT_ONCE = 1 << 20
#: Rows that one task adds up.
TASK_ROWS = 1 << 20

_SPLIT = np.zeros(256, bool)
_SPLIT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_SPLIT
_IN_WORD[[0x20, 0x09]] = False
U64 = np.uint64


# ---------------------------------------------------------------------------------------------- bitmaps


def bitmaps(words: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, number, bits): the 64-bit words that are not zero of every word's position bitmap, by word and number."""
    order = np.argsort(words, kind="stable")  # positions ascend
    w, p = words[order], positions[order]
    at = group_starts(w, p >> 6)
    bits = np.bitwise_or.reduceat(U64(1) << (p & 63).astype(np.uint64), at) if len(at) else np.zeros(0, np.uint64)
    return w[at], p[at] >> 6, bits


def pack(words: np.ndarray, numbers: np.ndarray, bits: np.ndarray, n_words: int) -> bytes:
    """The bitmaps, compressed: how many 64-bit words each has, the steps of their numbers, and their bits by byte."""
    counts = np.bincount(words, minlength=n_words).astype("<i4")
    steps = np.diff(numbers, prepend=0).astype("<i4")
    planes = [x.view(np.uint8).reshape(-1, x.itemsize).T.copy().tobytes() for x in (steps, bits.astype("<u8"))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array([n_words, len(bits)], "<i8").tobytes(), counts.tobytes(), *planes]))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, k = body[:16].view("<i8").tolist()
    cut = 16 + 4 * n
    counts = body[16:cut].view("<i4")
    steps = np.ascontiguousarray(body[cut : cut + 4 * k].reshape(4, k).T).view("<i4").ravel()
    bits = np.ascontiguousarray(body[cut + 4 * k :].reshape(8, k).T).view("<u8").ravel()
    return np.repeat(np.arange(n), counts), np.cumsum(steps, dtype=np.int64), bits


def positions_of(starts: np.ndarray, docs: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Positions of words, ascending, one empty one where a piece ends."""
    pieces = np.cumsum(_SPLIT[low], dtype=np.int32 if len(low) < 1 << 31 else np.int64)
    cut = np.zeros(len(starts), np.int64)
    cut[1:] = (docs[1:] != docs[:-1]) | (pieces[starts[1:]] != pieces[starts[:-1]])
    return np.arange(len(starts)) + np.cumsum(cut)


def build_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, place, words array<struct<lang, word, n>>, maps binary) of docs(text, lang): a shard's distinct words by language and
    how often each occurs, ``WORDS_A_ROW`` a row from number ``place`` on, and in its first row their bitmaps in that order."""
    kind = pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = SpanHash(12), TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, limit=shard_bytes):
            buf, offsets = text_bytes(batch.column(0))
            low = lower_ascii(buf)
            starts, ends, d = word_spans(low, offsets, _IN_WORD)
            if not len(starts):
                continue
            langs = batch.column(1).dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[d]
            h = hash_words(hasher, low, starts, ends, HASH_BYTES)
            order = np.lexsort((h, lang))
            firsts = group_starts(lang[order], h[order])
            sizes = np.diff(np.append(firsts, len(order)))
            words = np.empty(len(h), np.int64)
            words[order] = np.repeat(np.arange(len(firsts)), sizes)
            one = order[firsts]
            del h, order
            text = low[ranges(starts[one], ends[one] - starts[one])]
            cuts = np.concatenate([[0], np.cumsum(ends[one] - starts[one])])
            names = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(cuts.astype("<i8")), pa.py_buffer(text)).cast(pa.string())
            rows = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(lang[one])), names, pa.array(sizes, pa.int32())], fields=list(kind))
            maps = pack(*bitmaps(words, positions_of(starts, d, low)), len(one))
            for place in range(0, len(one), WORDS_A_ROW):
                part = rows.slice(place, WORDS_A_ROW)
                lists = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                own = pa.array([None if place else maps], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([place], pa.int32()), lists, own], ["shard", "place", "words", "maps"])
            number += 1

    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    return docs.mapInArrow(run, "shard long, place int, words array<struct<lang:string,word:string,n:int>>, maps binary")


# ---------------------------------------------------------------------------------------------- growing phrases


class Shard:
    """A shard's bitmaps of frequent words, by 64-bit word number, to grow phrases from. ``pairs`` are the numbers of the words
    that frequent pairs begin and end with, where these are known: others need no bitmap at the first or a later place."""

    def __init__(self, data: bytes, local: np.ndarray, ids: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None):
        words, numbers, bits = unpack(data)
        place = np.full(int(max(words.max(initial=-1), local.max(initial=-1))) + 1, -1)
        place[local] = np.arange(len(local))
        kept = place[words] >= 0
        order = np.argsort(numbers[kept], kind="stable")
        self.ids, word, number, bits = ids, place[words[kept]][order], numbers[kept][order], bits[kept][order]
        heads, tails = (np.isin(ids, x)[word] for x in pairs) if pairs else (np.ones(len(word), bool),) * 2
        self.head = word[heads], number[heads], bits[heads]
        self.word, self.number, self.bits = word[tails], number[tails], bits[tails]
        self.at = np.searchsorted(self.number, np.arange(int(number.max(initial=-1)) + 3))

    def extend(self, phrase: np.ndarray, number: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Shift and AND: (phrase, word, number, bits) of what is not zero. A 64-bit word's highest bit goes to the next one."""
        over = bits >> U64(63) != 0
        phrase, number = np.concatenate([phrase, phrase[over]]), np.concatenate([number, number[over] + 1])
        bits = np.concatenate([bits << U64(1), np.ones(int(over.sum()), np.uint64)])
        meet = self.at[number + 1] - self.at[number]
        total = np.cumsum(meet)
        a = 0
        while a < len(meet):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + AND_AT_ONCE, "right")))
            other = ranges(self.at[number[a:b]], meet[a:b])
            of = np.repeat(np.arange(a, b), meet[a:b])
            both = bits[of] & self.bits[other]
            hit = np.flatnonzero(both)
            of = of[hit]
            yield phrase[of], self.word[other[hit]], number[of], both[hit]
            a = b

    def grow(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, count) of all phrases one word longer than the last of ``levels``: a is the number of the phrase without its
        last word, b that word's. A level lists the phrases to go on from as (a, b, number)."""
        tables = []
        before = self.ids
        for a, b, ids in levels:  # phrases in the places of their parts
            first, last = (np.argsort(x, kind="stable") for x in (before, self.ids))
            code = first[np.searchsorted(before, a, sorter=first)] * len(self.ids) + last[np.searchsorted(self.ids, b, sorter=last)]
            order = np.argsort(code)
            tables.append((code[order], order))
            before = ids
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def deeper(depth: int, phrase: np.ndarray, number: np.ndarray, bits: np.ndarray) -> None:
            for p, w, n, x in self.extend(phrase, number, bits):
                code = p * len(self.ids) + w
                if depth == len(tables):
                    found.append(_add(code, np.bitwise_count(x).astype(np.int64)))
                    continue
                codes, order = tables[depth]
                if len(codes):
                    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    ok = np.flatnonzero(codes[at] == code)
                    deeper(depth + 1, order[at[ok]], n[ok], x[ok])

        deeper(0, *self.head)
        code, count = _add(*(np.concatenate(x) for x in zip(*found))) if found else (np.zeros(0, np.int64),) * 2
        return before[code // max(len(self.ids), 1)], self.ids[code % max(len(self.ids), 1)], count


def _add(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their counts."""
    order = np.argsort(code)
    code = code[order]
    at = group_starts(code)
    return code[at], np.add.reduceat(count[order], at) if len(at) else count[:0]


def _packets(group: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Rows by group: each group and its rows' columns as one packet of whole numbers."""
    order = np.argsort(group, kind="stable")
    rows = np.stack([c[order] for c in columns]).astype("<i8")
    at = group_starts(group[order])
    ends = np.append(at[1:], len(order))
    return group[order][at], [np.ascontiguousarray(rows[:, x:y]).tobytes() for x, y in zip(at.tolist(), ends.tolist())]


def _unpacked(packets: list[bytes], columns: int) -> list[np.ndarray]:
    parts = [np.frombuffer(p, "<i8").reshape(columns, -1) for p in packets]
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, np.int64)] * columns


def longer_phrases(shards: DataFrame, alive: DataFrame, depth: int, n_tasks: int) -> DataFrame:
    """(bucket, shard, packet): how often each phrase of ``depth`` words occurs in each shard, of those that grow from the
    frequent ones of alive(shard, k, packet), k words long. Packets hold (a, b, count), by four buckets a task of the phrases'
    hashes: one a phrase at worst."""
    schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("packet", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        of = right.column("k").to_numpy()
        packets = right.column("packet").to_pylist()
        known = [_unpacked([p for p, k in zip(packets, of.tolist()) if k == own], 3) for own in range(1, depth)]
        local, _, ids = known[0]
        own = Shard(left.column("maps")[0].as_py(), local, ids, (known[1][0], known[1][1]) if depth > 2 else None)
        a, b, n = own.grow([tuple(x) for x in known[1:]])
        bucket = (mix64(mix64(a.astype(np.uint64)) ^ b.astype(np.uint64)) % U64(4 * n_tasks)).astype(np.int32)
        buckets, made = _packets(bucket, a, b, n)
        shard = np.full(len(buckets), left.column("shard")[0].as_py())
        return pa.table([pa.array(buckets), pa.array(shard), pa.array(made, pa.binary())], schema=schema)

    return shards.where("maps is not null").select("shard", "maps").groupBy("shard").cogroup(alive.select("shard", "k", "packet").groupBy("shard")).applyInArrow(run, "bucket int, shard long, packet binary")


#: What a task that adds counts gives: rows (shard, k, packet) that tell a shard of its frequent words (place, 0, id) or phrases
#: (a, b, id), and rows (id, a, b, lang, word, f), one for each frequent word or phrase; for words, sums by language (lang, f).
_FOUND = "shard long, k int, packet binary, id long, a long, b long, lang string, word string, f long"
_FOUND_KINDS = {"shard": pa.int64(), "k": pa.int32(), "packet": pa.binary(), "id": pa.int64(), "a": pa.int64(), "b": pa.int64(), "lang": pa.string(), "word": pa.string(), "f": pa.int64()}


def _found(**columns: object) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.nulls(n, t) if columns.get(c) is None else pa.array(columns[c], t) if not isinstance(columns[c], pa.Array) else columns[c] for c, t in _FOUND_KINDS.items()], list(_FOUND_KINDS))


def _told(depth: int, number: np.ndarray, n: np.ndarray, shard: np.ndarray, a: np.ndarray, b: np.ndarray, min_count: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """Packets to the shards that hold what occurs often enough: ``number`` says which rows are equal. With them, which numbers
    are frequent, their ids and their counts."""
    sums = np.bincount(number, n, int(number.max(initial=-1)) + 1).astype(np.int64)  # below 2^53
    enough = np.flatnonzero(sums >= min_count)
    ids = np.full(len(sums), -1)
    ids[enough] = (TaskContext.get().partitionId() << 33) + np.arange(len(enough))
    own = np.flatnonzero(ids[number] >= 0)
    shards, packets = _packets(shard[own], a[own], b[own], ids[number[own]])
    return _found(shard=shards, k=np.full(len(shards), depth), packet=packets), enough, ids[enough], sums[enough]


def frequent_words(shards: DataFrame, min_count: int, n_tasks: int) -> DataFrame:
    """The words of shards(shard, words) that occur ``min_count`` times or more in their language; see ``_FOUND``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        lang, word = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "word"))
        code = lang.indices.to_numpy().astype(np.int64) * len(word.dictionary) + word.indices.to_numpy()
        codes, number = np.unique(code, return_inverse=True)
        shard, place, n = (rows.column(c).to_numpy() for c in ("shard", "place", "n"))
        told, enough, ids, f = _told(1, number, n, shard, place.astype(np.int64), np.zeros(len(place), np.int64), min_count)
        yield told
        of = codes[enough]
        yield _found(id=ids, lang=lang.dictionary.take(pa.array(of // len(word.dictionary))), word=word.dictionary.take(pa.array(of % len(word.dictionary))), f=f)
        totals = np.bincount(lang.indices.to_numpy(), n, len(lang.dictionary)).astype(np.int64)
        yield _found(lang=lang.dictionary, f=totals)

    words = shards.select("shard", "place", F.posexplode("words").alias("more", "w")).select("w.lang", "w.word", "shard", (F.col("place") + F.col("more")).alias("place"), "w.n")
    return words.repartition(n_tasks, "lang", "word").mapInArrow(run, _FOUND)


def frequent(counts: DataFrame, depth: int, min_count: int, n_tasks: int) -> DataFrame:
    """The phrases of counts(bucket, shard, packet) that occur ``min_count`` times or more in all; see ``_FOUND``. Tasks get
    phrases by hash, about ``TASK_ROWS`` counts each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        packets = [p for b in got for p in b.column(1).to_pylist()]
        shard = np.repeat(np.concatenate([b.column(0).to_numpy() for b in got]), [len(p) // 24 for p in packets])
        a, b, n = _unpacked(packets, 3)
        order = np.lexsort((b, a))
        a, b, n, shard = a[order], b[order], n[order], shard[order]
        at = group_starts(a, b)
        number = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(a))))
        told, enough, ids, f = _told(depth, number, n, shard, a, b, min_count)
        yield told
        yield _found(id=ids, a=a[at[enough]], b=b[at[enough]], f=f)

    return counts.repartition(n_tasks, "bucket").select("shard", "packet").mapInArrow(run, _FOUND)


# ---------------------------------------------------------------------------------------------- scores


def _part(first: int | Column, count: int | Column) -> Column:
    """``count`` words of the phrase from word ``first`` (from 1) on."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def scored(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases(lang, phrase, k, a), which hold every part of their phrases: phrases of two words
    or more by their lowest-scoring cut, without those that a longer one covers."""
    many = phrases.where("k > 1")
    cuts = many.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", _part(1, F.col("cut")).alias("head"), _part(F.col("cut") + 1, F.col("k")).alias("tail"))
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(count)), ["lang", part])
    score = F.expr("cast((2000000 * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0)) as bigint)")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    inner = [_part(i, n) for n in range(2, MAX_WORDS) for i in range(1, MAX_WORDS - n + 2)]
    inside = F.filter(F.array_distinct(F.array(*inner)), lambda p: (p != F.col("phrase")) & (F.size(F.split(p, " ")) > 1))
    longer = many.where("k > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    free = lowest.join(longer, ["lang", "phrase"], "left").where(f"most is null or 100 * cast(most as decimal(20, 0)) < {covered} * cast(a as decimal(20, 0))")
    return free.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of 2 to 4 words of each language in docs(text, lang).

    Letters A-Z are lower-cased, texts are split at ``.,;:!?`` and line ends into pieces, and these at spaces and tabs into
    words. A phrase occurs ``a`` >= min_count times; of its cuts in two, which occur l and r times, the one with the least
    floor(2000000 * a / (l + r)) counts, the shortest first part among equals; phrases inside a longer one that has 80 % of
    their occurrences are left out. Ranks go by score, a and phrase; n is the number of the language's words. A null text is
    empty; a null language is ``und``; repeated rows count as often as they are there; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shards = materialize(build_shards(docs.select("text", "lang"), shard_bytes), "shards")
    sizes = shards.select(F.size("words").cast("long").alias("words"), F.aggregate("words", F.lit(0).cast("long"), lambda t, w: t + w["n"]).alias("n")).agg(F.sum("words"), F.sum("n")).first()
    tasks = lambda rows: max(8, -(-(rows or 0) // TASK_ROWS))
    found = [materialize(frequent_words(shards, min_count, tasks(sizes[0])), "words")]
    totals = materialize(found[0].where("id is null and shard is null").groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = found[0].where("id is not null").select("id", "lang", "word", "f")
    named = [materialize(words.select("id", "lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), F.col("f").alias("a")), "phrases-1")]
    for depth in range(2, MAX_WORDS + 1):
        alive = found[0].where("shard is not null")
        for more in found[1:]:
            alive = alive.unionByName(more.where("shard is not null"))
        counts = longer_phrases(shards, alive, depth, tasks(sizes[1]))
        found.append(materialize(frequent(counts, depth, min_count, tasks(sizes[1])), f"found-{depth}"))
        first, last = named[-1].select(F.col("id").alias("a"), "lang", "phrase"), named[0].select(F.col("id").alias("b"), F.col("phrase").alias("word"))
        own = found[-1].where("id is not null").select("id", "a", "b", "f").join(first, "a").join(last, "b")
        named.append(materialize(own.select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.lit(depth).alias("k"), F.col("f").alias("a")), f"phrases-{depth}"))
        release(spark)
    every = named[0]
    for more in named[1:]:
        every = every.unionByName(more)
    best = scored(every.select("lang", "phrase", "k", "a"))
    discard(shards, *found)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(F.broadcast(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
