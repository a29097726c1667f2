"""Exact repeated-substring removal by prefix-free parsing.

A rolling hash over 32 bytes is taken at every position. Each 100-byte string has one trigger, the leftmost least hash
inside it, which its bytes alone determine. Consecutive strings with the same trigger make a phrase: a stretch of text
around the trigger that holds all of them, so that neighbouring phrases overlap by 99 bytes and the parse is prefix-free.
The dictionary is the set of distinct phrases. Of the suffix order of the corpus only the classes of equal 100-byte
prefixes are needed, and the first place of each:

1. Equal phrases give equal strings, so every occurrence of a phrase but the first repeats wholly.
2. Strings of different phrases can be equal only if the phrases share a trigger, at the same distance from the string's
   start. A string is then the end of a phrase's part up to the trigger, and the beginning of what follows in the parse.
   So for the dictionary's phrases that share a trigger two suffix arrays are built with their common prefixes: one of the
   parts before the trigger, read backwards from it, and one of what the text goes on with from the trigger. At each
   distance d, runs of common prefixes of d bytes in the one and of 100 - d in the other combine into the classes of equal
   strings, and all but the first of each class, in corpus order, repeat. Bytes are compared, not hashes.

A trigger with very many different phrases has them cut into pieces of a few strings, which come together by the bytes that
all strings of a piece share; where even these are very many, strings are dealt out by their own 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, group_starts, materialize, ranges, release, text_bytes, text_slices, with_row_ids

LENGTH = 100
TRIGGER = 32
#: Strings of a piece of a phrase whose trigger has very many phrases.
STEP = 9
_PLACE = np.uint64((1 << 20) - 1)
#: Texts of more bytes are parsed in pieces, so that a place fits in 20 bits.
PIECE = (1 << 20) - 1


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        a = np.minimum(a[:-done], a[done:])
        done *= 2
    return np.minimum(a[: len(a) - (width - done)], a[width - done :]) if done < width else a


class Parser:
    """Phrases of a buffer of texts: document number, first string, number of strings, trigger's place, trigger's hash
    and phrase's hash of each."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER):
        self.length, self.trigger = length, trigger
        self.triggers, self.phrases = SpanHash(31), SpanHash(32)

    def parse(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        size, k = self.length, self.trigger
        valid = np.ones(max(len(buf) - size + 1, 0), bool)
        last = np.maximum(offsets[1:] - size + 1, offsets[:-1])
        bad = ranges(last, offsets[1:] - last)
        valid[bad[bad < len(valid)]] = False
        starts = np.flatnonzero(valid)
        if not len(starts):
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
        at = np.arange(len(buf) - k + 1)
        hashes = self.triggers.load(buf).spans(at, at + k)
        least = sliding_min((hashes & ~_PLACE) | at.astype(np.uint64), size - k + 1)
        chosen = (least[starts] & _PLACE).astype(np.int64)
        docs = np.searchsorted(offsets, starts, "right") - 1
        firsts = group_starts(chosen, docs)
        lo, place, docs = starts[firsts], chosen[firsts], docs[firsts]
        n = np.diff(np.append(firsts, len(starts)))
        return docs, lo, n, place, hashes[place], self.phrases.load(buf).spans(lo, lo + n - 1 + size)


def pieces(batches: Iterator[pa.RecordBatch], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row ids, where each piece begins in its text, bytes, offsets) of slices of at most ``size`` bytes. Pieces of one text
    overlap by all but one byte of a string, so each string is in one of them."""
    for batch in text_slices(batches, limit=size):
        ids = batch.column("rid").to_numpy()
        buf, offsets = text_bytes(batch.column("text"))
        if len(buf) <= size:
            yield ids, np.zeros(len(ids), np.int64), buf, offsets
        else:  # one long text
            step = size - LENGTH + 1
            for at in range(0, len(buf), step):
                part = buf[at : at + size]
                yield ids, np.array([at]), part, np.array([0, len(part)])


def pack(lo: np.ndarray, n: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First string, number of strings and the trigger's distance from the first, in one long that sorts by the first."""
    return lo << 16 | n << 8 | off


def _merge(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals that are sorted by start, as disjoint intervals."""
    reach = np.maximum.accumulate(stop)
    new = np.append(True, start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:] - 1, len(start) - 1)]


PHRASES = "trigger long, phrase long, rid long, place long"


def parse(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """The phrases of docs(rid, text), one row for each distinct phrase of a slice; what a slice repeats of itself goes
    along as intervals (phrase: the stop, place: -1 - start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for ids, begin, buf, offsets in pieces(batches, piece):
            d, lo, n, place, trigger, phrase = parser.parse(buf, offsets)
            if not len(d):
                continue
            rid, start = ids[d], lo - offsets[d] + begin[d]
            order = np.lexsort((start, rid, phrase, trigger))
            firsts = group_starts(trigger[order], phrase[order])
            head = np.repeat(order[firsts], np.diff(np.append(firsts, len(order))))
            again = order[head != order]
            own = order[firsts]
            out = [(trigger[own].view(np.int64), phrase[own].view(np.int64), rid[own], pack(start, n, place - lo)[own])]
            if len(again):
                again = again[np.lexsort((start[again], rid[again]))]
                cut = group_starts(rid[again])
                for part in np.split(again, cut[1:]):
                    a, b = _merge(start[part], start[part] + n[part] - 1 + LENGTH)
                    r = np.full(len(a), rid[part[0]])
                    out.append((a ^ r, b, r, -1 - a))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["trigger", "phrase", "rid", "place"])

    return docs.select("rid", "text").mapInArrow(run, PHRASES)


MARKS = "rid long, a long, b long"


def dictionary_marks(phrases: DataFrame) -> DataFrame:
    """From phrases sorted by trigger, phrase, rid and place: (rid, start, stop) of every phrase that has an earlier
    equal, and (rid, place, -1) of every first one whose trigger has other phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int, int] | None = None  # the row before
        lone: tuple[int, int] | None = None  # rid and place of a trigger's only phrase so far
        for batch in batches:
            t, p, r, x = (batch.column(i).to_numpy() for i in range(4))
            out = []
            kept = x < 0
            if kept.any():
                out.append((r[kept], -1 - x[kept], p[kept]))
                t, p, r, x = t[~kept], p[~kept], r[~kept], x[~kept]
            if len(t):
                before = last or (~int(t[0]), 0, 0, 0)
                new_t = np.append(t[0] != before[0], t[1:] != t[:-1])
                new_p = new_t | np.append(p[0] != before[1], p[1:] != p[:-1])
                first = np.flatnonzero(new_p)
                again = np.flatnonzero(~new_p)
                start = x >> 16
                stop = start + ((x >> 8) & 255) - 1 + LENGTH
                out.append((r[again], start[again], stop[again]))
                # phrases of each trigger in this batch; the first trigger may have some from before
                group = np.cumsum(new_t)
                many = np.bincount(group[first], minlength=int(group[-1]) + 1)
                old = not new_t[0]
                if old and many[0] and lone:  # what came before isn't alone any more
                    out.append((np.array([lone[0]]), np.array([lone[1]]), np.array([-1])))
                if old and (many[0] or lone is None):
                    many[0] += 2
                shared = first[many[group[first]] > 1]
                out.append((r[shared], x[shared], np.full(len(shared), -1)))
                g = int(group[-1])
                if g or not old:
                    only = first[group[first] == g]
                    lone = (int(r[only[0]]), int(x[only[0]])) if many[g] == 1 else None
                elif many[0]:
                    lone = None
                last = (int(t[-1]), int(p[-1]), 0, 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["rid", "a", "b"]) if out else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["rid", "a", "b"])

    return phrases.mapInArrow(run, MARKS)


CONTEXTS = "trigger long, rid long, place long, bytes binary"


def contexts(marked: DataFrame) -> DataFrame:
    """The bytes of every marked phrase of marked(rid, text, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(31)
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            lists = batch.column("places")
            counts = np.diff(lists.offsets.to_numpy())
            place = lists.flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), counts)
            lo = (place >> 16) + offsets[doc]
            stop = lo + ((place >> 8) & 255) - 1 + LENGTH
            at = lo + (place & 255)
            trigger = hasher.load(buf).spans(at, at + TRIGGER)
            data = buf[ranges(lo, stop - lo)].tobytes()
            ends = np.concatenate([[0], np.cumsum(stop - lo)]).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(trigger.view(np.int64)), pa.array(batch.column("rid").to_numpy()[doc]), pa.array(place), binary], ["trigger", "rid", "place", "bytes"])

    return marked.mapInArrow(run, CONTEXTS)


def suffix_array(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each row of bytes among all, by group and then by its bytes, and the common prefix that the row of each
    rank has with the one before it; -1 where a group begins."""
    words = np.ascontiguousarray(rows).view(">u8")
    order = np.lexsort([*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group])
    differ = rows[order[1:]] != rows[order[:-1]]
    shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    shared[group[order[1:]] != group[order[:-1]]] = -1
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, np.append(-1, shared)


def repeated_strings(group: np.ndarray, place: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start in the phrase) of every string that an earlier phrase of its group has too, of phrases in the order of
    the corpus, their packed places and bytes."""
    n, off = (place >> 8) & 255, place & 255
    trigger = offsets[:-1] + off
    wide = np.concatenate([np.zeros(LENGTH, np.uint8), buf, np.zeros(LENGTH, np.uint8)])
    step = np.arange(LENGTH + -LENGTH % 8)
    after = wide[np.minimum(trigger[:, None] + step + LENGTH, len(wide) - 1)]
    after[step >= (offsets[1:] - trigger)[:, None]] = 0
    step = np.arange(LENGTH - TRIGGER + 4)
    before = wide[trigger[:, None] - 1 - step + LENGTH]
    before[step >= off[:, None]] = 0
    rank_before, shared_before = suffix_array(group, before)
    rank_after, shared_after = suffix_array(group, after)
    phrases, starts = [], []
    for d in range(int(off.max(initial=-1)) + 1):
        own = np.flatnonzero((off - n < d) & (d <= off))
        if not len(own):
            continue
        left = np.cumsum(shared_before < d)[rank_before[own]]
        right = np.cumsum(shared_after < LENGTH - d)[rank_after[own]]
        key = left * (len(off) + 1) + right
        order = np.argsort(key, kind="stable")
        same = np.append(False, key[order[1:]] == key[order[:-1]])
        later = own[order[same]]
        phrases.append(later)
        starts.append(off[later] - d)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(phrases + none), np.concatenate(starts + none)


STRINGS = "h1 long, h2 long, rid long, start long, later boolean, bytes binary"


def cut_pieces(place: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cuts phrases into pieces of STEP strings at most, by how far the trigger is from a string's start. Equal strings
    have their trigger at the same distance, so they are in pieces of the same number, and all strings of a piece hold the
    same core of LENGTH - STEP + 1 bytes. Returns each piece's phrase, place, first and last byte, and core's first byte."""
    n, off = (place >> 8) & 255, place & 255
    high = off // STEP
    count = high - (off - n + 1) // STEP + 1
    row = np.repeat(np.arange(len(place)), count)
    number = -ranges(-high, count)
    top = np.minimum(off[row], number * STEP + STEP - 1)
    size = top - np.maximum(off[row] - n[row] + 1, number * STEP) + 1
    skip = off[row] - top
    begin = offsets[:-1][row] + skip
    return row, pack((place[row] >> 16) + skip, size, top), begin, begin + size - 1 + LENGTH, begin + top - number * STEP


def suffix_classes(found: DataFrame, group_limit: int, last: bool = False) -> DataFrame:
    """From contexts sorted by trigger: runs of strings that have an earlier equal among the phrases of their trigger, as
    byte ranges (later: true, h1: the stop). A trigger of more than ``group_limit`` phrases returns its phrases' distinct
    pieces instead (h1: the core's hash, start: the place), which group by their cores as phrases do by triggers; with
    ``last``, its distinct strings (h1, h2: their hashes). What repeats inside one batch of it is returned as ranges."""
    names = ["h1", "h2", "rid", "start", "later", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, cores = SpanHash(33), SpanHash(34), SpanHash(35)

        def rows(h1: np.ndarray, h2: np.ndarray | None, rid: np.ndarray, start: np.ndarray, later: bool, data: pa.Array | None = None) -> pa.RecordBatch:
            n = len(rid)
            second = pa.nulls(n, pa.int64()) if h2 is None else pa.array(h2.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), second, pa.array(rid), pa.array(start), pa.array(np.full(n, later)), pa.nulls(n, pa.binary()) if data is None else data], names)

        def classes(h1: np.ndarray, h2: np.ndarray, rid: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The first of each class of equal hashes, and the others."""
            order = np.lexsort((start, rid, h2, h1))
            later = np.ones(len(order), bool)
            later[group_starts(h1[order], h2[order])] = False
            return order[~later], order[later]

        def runs(rid: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((start, rid))
            r, s = rid[order], start[order]
            at = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1))) if len(s) else np.zeros(0, np.int64)
            stop = s[np.append(at[1:] - 1, len(s) - 1)] + LENGTH if len(s) else s
            return rows(stop, None, r[at], s[at], True)

        def strings(part: pa.Table) -> tuple[np.ndarray, ...]:
            part = part.combine_chunks()
            place = part.column("place").to_numpy()
            buf, offsets = text_bytes(part.column("bytes").combine_chunks())
            n = (place >> 8) & 255
            at = ranges(offsets[:-1], n)
            rid = np.repeat(part.column("rid").to_numpy(), n)
            start = ranges(place >> 16, n)
            return one.load(buf).spans(at, at + LENGTH), two.load(buf).spans(at, at + LENGTH), rid, start

        def solved(part: pa.Table) -> Iterator[pa.RecordBatch]:
            """Of whole groups, each sorted by rid and place."""
            part = part.combine_chunks()
            trigger, rid, place = (part.column(c).to_numpy() for c in ("trigger", "rid", "place"))
            at, start = repeated_strings(np.cumsum(np.append(True, trigger[1:] != trigger[:-1])), place, *text_bytes(part.column("bytes").combine_chunks()))
            yield runs(rid[at], (place >> 16)[at] + start)

        def dealt_strings(part: pa.Table) -> Iterator[pa.RecordBatch]:
            h1, h2, rid, start = strings(part)
            first, later = classes(h1, h2, rid, start)
            yield runs(rid[later], start[later])
            yield rows(h1[first], h2[first], rid[first], start[first], False)

        def dealt_pieces(part: pa.Table) -> Iterator[pa.RecordBatch]:
            part = part.combine_chunks()
            buf, offsets = text_bytes(part.column("bytes").combine_chunks())
            row, place, begin, stop, core = cut_pieces(part.column("place").to_numpy(), offsets)
            rid, start = part.column("rid").to_numpy()[row], place >> 16
            first, later = classes(one.load(buf).spans(begin, stop), two.load(buf).spans(begin, stop), rid, start)
            yield rows((start + stop - begin)[later], None, rid[later], start[later], True)
            begin, size = begin[first], (stop - begin)[first]
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(buf[ranges(begin, size)].tobytes())])
            key = cores.load(buf).spans(core[first], core[first] + LENGTH - STEP + 1)
            yield rows(key, None, rid[first], place[first], False, data)

        dealt = dealt_strings if last else dealt_pieces

        held: pa.Table | None = None
        hot: int | None = None  # a trigger over the limit
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            t = held.column("trigger").to_numpy()
            if hot is not None:
                k = int(np.argmax(t != hot)) if (t != hot).any() else len(t)
                if k:
                    yield from dealt(held.slice(0, k))
                if k == len(t):
                    held = None
                    continue
                held, t, hot = held.slice(k), t[k:], None
            cut = int(np.argmax(t == t[-1])) if len(t) else 0
            firsts = group_starts(t[:cut])
            sizes = np.diff(np.append(firsts, cut))
            for a, n in zip(firsts[sizes > group_limit].tolist(), sizes[sizes > group_limit].tolist()):
                yield from dealt(held.slice(a, n))
            few = np.flatnonzero(np.repeat(sizes <= group_limit, sizes))
            if len(few):
                yield from solved(held.take(pa.array(few)) if len(few) < cut else held.slice(0, cut))
            held = held.slice(cut)
            if held.num_rows > group_limit:
                hot = int(t[-1])
                yield from dealt(held)
                held = None
        if held is not None and held.num_rows:
            yield from dealt(held) if hot is not None else solved(held)

    return found.mapInArrow(run, STRINGS)


def later_strings(dealt: DataFrame) -> DataFrame:
    """All but the first of each class of equal strings, from rows sorted by h1, h2, rid and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            h1, h2, rid, start = (batch.column(i).to_numpy() for i in range(4))
            if not len(h1):
                continue
            new = np.append(last != (h1[0], h2[0]), (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            last = (h1[-1], h2[-1])
            yield pa.RecordBatch.from_arrays([pa.array(rid[~new]), pa.array(start[~new])], ["rid", "start"])

    return dealt.select("h1", "h2", "rid", "start").mapInArrow(run, "rid long, start long")


REMOVED = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def cut_out(marked: DataFrame) -> DataFrame:
    """What is left of marked(doc_id, text, starts, stops) without the union of its intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            spans, kept = [], []
            for i, (a, b) in enumerate(zip(batch.column("starts"), batch.column("stops"))):
                own = buf[offsets[i] : offsets[i + 1]]
                if a.values is None or not len(a.values):
                    spans.append([])
                    kept.append(own.tobytes())
                    continue
                start, stop = a.values.to_numpy(), b.values.to_numpy()
                order = np.argsort(start, kind="stable")
                start, stop = _merge(start[order], stop[order])
                spans.append([{"start": s, "stop": e} for s, e in zip(start.tolist(), stop.tolist())])
                left = np.ones(len(own), bool)
                left[ranges(start, stop - start)] = False
                kept.append(own[left].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return marked.mapInArrow(run, REMOVED)


def remove_repeats(docs: DataFrame, group_limit: int = 1 << 13, piece: int = PIECE) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row of docs(doc_id, text): the byte ranges covered by 100-byte strings that
    also start earlier in the corpus (in a smaller doc_id, or before in the same text), and the bytes that are left.

    Texts are whole UTF-8 bytes, null is empty, no string crosses texts. Rows of equal id and different text are ordered
    by a hash of the text; wholly equal rows count once and get the same result. Null ids come before all others.
    """
    spark = docs.sparkSession
    rows, unique = with_row_ids(docs)
    once = rows.select("rid", "text") if unique else rows.select("rid", "text").dropDuplicates(["rid"])
    sorted_phrases = parse(once, piece).repartition("trigger").sortWithinPartitions("trigger", "phrase", "rid", "place")
    marks = materialize(dictionary_marks(sorted_phrases), "phrase-marks")
    release(spark)
    shared = marks.where("b = -1").groupBy("rid").agg(F.collect_list("a").alias("places"))
    found = contexts(once.join(shared.hint("shuffle_hash"), "rid")).repartition("trigger").sortWithinPartitions("trigger", "rid", "place")
    strings = materialize(suffix_classes(found, group_limit), "strings")
    release(spark)
    spans = marks.where("b >= 0").select("rid", F.col("a").alias("start"), F.col("b").alias("stop"))
    spans = spans.unionByName(strings.where("later").select("rid", "start", F.col("h1").alias("stop")))
    pieces_left = strings.where("not later")
    if pieces_left.limit(1).count():
        by_core = pieces_left.select(F.col("h1").alias("trigger"), "rid", F.col("start").alias("place"), "bytes").repartition("trigger").sortWithinPartitions("trigger", "rid", "place")
        strings = materialize(suffix_classes(by_core, group_limit, last=True), "piece-strings")
        release(spark)
        spans = spans.unionByName(strings.where("later").select("rid", "start", F.col("h1").alias("stop")))
        dealt = strings.where("not later")
        if dealt.limit(1).count():
            single = later_strings(dealt.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "rid", "start"))
            spans = spans.unionByName(single.select("rid", "start", (F.col("start") + LENGTH).alias("stop")))
    per_row = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("x")).select("rid", F.col("x.start").alias("starts"), F.col("x.stop").alias("stops"))
    return cut_out(rows.join(per_row.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "starts", "stops"))
