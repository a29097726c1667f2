"""Media columns: animated GIF images as a binary column, and features of the frames that are decoded from it.

The decoder reads any GIF87a or GIF89a image: LZW code streams with growing codes, deferred clears and sub-blocks, global
and local palettes, interlacing, frame offsets, transparency and the four ways of disposal, frame delays. The widths of the
codes between two clear codes depend on their number alone, so the codes of many streams are cut out of their bits at once;
each run of codes is then expanded through its string table.

The encoder stores samples without loss as palette numbers, in frames of 24 x 24, each an LZW stream with a string table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_bytes, text_slices

SIDE = 24
FRAME = SIDE * SIDE
PAD = 255
CLEAR, STOP = 256, 257
#: Hundredths of a second that a frame stays.
DELAY = 10
GRAY = bytes(x for v in range(256) for x in (v, v, v))


def _sub_blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(c)]) + c for c in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


def _widths(least: int, n: int) -> np.ndarray:
    """Bits of the first n codes after a clear code: the k-th code (from 0) is read when the table has as many entries
    as the clear code, the stop code and one for each code after the first give it."""
    entries = (1 << least) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.ceil(np.log2(entries + 0.5)), least + 1, 12).astype(np.int64)


_WIDTHS = _widths(8, 4096)


def lzw_codes(samples: bytes) -> list[int]:
    """The codes of samples, clear and stop codes among them, with a string table that is cleared when it is full."""
    if not samples:
        return [CLEAR, STOP]
    out, table, size = [CLEAR], {}, STOP + 1 << 8
    get, put = table.get, out.append
    word = samples[0] << 8  # codes are kept eight bits up, where a sample makes a string's key of them
    for b in memoryview(samples)[1:]:
        key = word | b
        longer = get(key)
        if longer:
            word = longer
            continue
        put(word >> 8)
        if size < 4096 << 8:
            table[key] = size
            size += 256
        else:
            put(CLEAR)
            table.clear()
            size = STOP + 1 << 8
        word = b << 8
    return [*out, word >> 8, STOP]


def pack_codes(streams: list[list[int]]) -> list[bytes]:
    """The bytes of code streams, each from a byte of its own."""
    codes = np.concatenate([np.array(s, np.int64) for s in streams])
    lengths = np.array([len(s) for s in streams])
    first = np.cumsum(lengths) - lengths
    # a code's number after the last clear code gives its width; a stream's first code is a clear code
    at = np.arange(len(codes))
    clears = np.where(codes == CLEAR, at, -1)
    clears[first] = first
    last = np.maximum.accumulate(np.append(-1, clears[:-1]))
    last[first] = first - 1
    width = _WIDTHS[np.minimum(at - last - 1, 4095)]
    ends = np.cumsum(width)
    begin = ends - width
    bits = np.add.reduceat(width, first)
    size = (bits + 7) >> 3
    base = np.cumsum(size) - size
    place = begin - np.repeat(begin[first], lengths) + 8 * np.repeat(base, lengths)
    value, byte = codes << (place & 7), place >> 3
    out = np.zeros(int(size.sum()) + 2)
    for k in range(3):  # the bits of different codes never meet, so bytes add up
        out += np.bincount(byte + k, value >> 8 * k & 255, len(out))
    data = out.astype(np.uint8).tobytes()
    return [data[a : a + n] for a, n in zip(base.tolist(), size.tolist())]


#: Frames whose string tables are built side by side, and places in the table of each: 4 MB in all, which caches hold.
ABREAST, PLACES = 256, 2048


def frame_codes(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LZW codes of each row of samples (no longer than a string table has room for), as columns of codes, and the number of
    each row's codes. The rows take their steps together. A row's strings are kept by a hash of their code and sample; one
    that meets another's place replaces it, so that a string is sometimes not found again, which costs a code and no more.
    """
    rows, n = samples.shape
    codes, counts = np.zeros((n + 2, rows), np.uint32), np.zeros(rows, np.int64)
    if not rows:
        return codes, counts
    mix, down = np.uint32(0x9E3779B1), np.uint32(32 - PLACES.bit_length() + 1)
    keys, found = np.empty(min(rows, ABREAST) * PLACES, np.uint32), np.empty(min(rows, ABREAST) * PLACES, np.uint32)
    for first in range(0, rows, ABREAST):
        own = np.ascontiguousarray(samples[first : first + ABREAST].T).astype(np.uint32)
        m = own.shape[1]
        keys[:] = 0
        row = np.arange(m)
        base = row * PLACES
        out = np.zeros((n + 2) * m, np.uint32)  # a code is written where the next one goes, and stays when that moves on
        at, number = m + row, np.full(m, STOP + 1, np.uint32)  # the first code learns the first free number
        out[:m] = CLEAR
        word = own[0]
        for sample in own[1:]:
            key = (word << np.uint32(8)) + sample + np.uint32(1)
            place = (key * mix >> down) + base
            new = keys.take(place) != key
            longer = found.take(place)
            out[at] = word
            keys[place] = key
            found[place] = np.where(new, number, longer)
            at += new * m
            number += new
            word = np.where(new, sample, longer)
        out[at] = word
        out[at + m] = STOP
        codes[:, first : first + m] = out.reshape(n + 2, m)
        counts[first : first + m] = at // m + 2
    return codes, counts


def pack_frames(codes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of code streams that are columns of codes, with one clear code at their beginning: the k-th codes of all
    streams stand at the same bits."""
    width = np.concatenate([[9], _WIDTHS[: len(codes) - 1]])
    begin = np.cumsum(width) - width
    out = np.zeros((int(begin[-1] + 12 >> 3) + 3, codes.shape[1]), np.uint8)
    for k in range(int(counts.max(initial=0))):
        value, at = codes[k].astype(np.uint32) << np.uint32(begin[k] & 7), int(begin[k] >> 3)
        for part in range(3):
            out[at + part] |= (value >> np.uint32(8 * part)).astype(np.uint8)
    sizes = (begin[counts - 1] + width[counts - 1] + 7) >> 3
    data = np.ascontiguousarray(out.T)
    return [d[:n].tobytes() for d, n in zip(data, sizes.tolist())]


_HEAD = b"GIF89a" + struct.pack("<HHBBB", SIDE, SIDE, 0xF7, 0, 0) + GRAY + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"
_FRAME_HEAD = b"\x21\xf9\x04\x04" + struct.pack("<H", DELAY) + b"\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, SIDE, 0) + b"\x08"


def frame_blocks(samples: np.ndarray) -> list[bytes]:
    """The image blocks of rows of FRAME samples."""
    return [_FRAME_HEAD + _sub_blocks(d) for d in pack_frames(*frame_codes(samples))]


def pad(data: bytes) -> bytes:
    """The data and bytes 255 up to a positive multiple of FRAME."""
    return data + bytes([PAD]) * (FRAME - len(data) % FRAME if len(data) % FRAME or not data else 0)


def encode_gif(payload: bytes) -> bytes:
    """An animation whose frames, one after another, hold the payload: a positive multiple of FRAME bytes."""
    return _HEAD + b"".join(frame_blocks(np.frombuffer(payload, np.uint8).reshape(-1, FRAME))) + b"\x3b"


@dataclass
class Image:
    """A frame as it stands in the file."""

    left: int
    top: int
    width: int
    height: int
    palette: np.ndarray
    transparent: int
    disposal: int
    delay: int
    interlaced: bool
    least: int
    data: bytes


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while size := data[at]:
        parts.append(data[at + 1 : at + 1 + size])
        if len(parts[-1]) < size:
            raise ValueError("the file ends inside a block")
        at += 1 + size
    return b"".join(parts), at + 1


def parse_gif(data: bytes) -> tuple[int, int, list[Image]]:
    """Screen width and height, and the frames in order; ValueError if the file is broken or ends too early."""
    try:
        return _parse(data)
    except (struct.error, IndexError) as e:
        raise ValueError("the file ends too early") from e


def _parse(data: bytes) -> tuple[int, int, list[Image]]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at = 13
    shared = None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        shared = np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3)
        at += n
    images, disposal, delay, transparent = [], 0, 0, -1
    while at < len(data):
        mark = data[at]
        if mark == 0x3B:
            return width, height, images
        if mark == 0x21:
            label = data[at + 1]
            body, at = _blocks(data, at + 2)
            if label == 0xF9:
                bits, delay, clear = struct.unpack_from("<BHB", body)
                disposal, transparent = bits >> 2 & 7, clear if bits & 1 else -1
        elif mark == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
            at += 10
            palette = shared
            if bits & 0x80:
                n = 3 << (bits & 7) + 1
                palette = np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3)
                at += n
            if palette is None:
                raise ValueError("a frame has no palette")
            least = data[at]
            body, at = _blocks(data, at + 1)
            images.append(Image(left, top, w, h, palette, transparent, disposal, delay, bool(bits & 0x40), least, body))
            disposal, delay, transparent = 0, 0, -1
        else:
            raise ValueError(f"unknown block {mark:#x}")
    raise ValueError("the file has no end")


#: Codes that are first looked for after a clear code, and bits of streams that are cut at once.
SPAN, CUT = 640, 1 << 22


def code_runs(streams: list[bytes], least: int) -> list[list[np.ndarray]]:
    """The codes of each LZW stream with ``least`` bits a literal, in runs between clear codes, without the special codes. A
    stream ends at its stop code, or where its bits end."""
    clear = 1 << least
    sizes = np.array([len(d) for d in streams], np.int64)
    data = np.frombuffer(b"".join(streams) + b"\0\0\0", np.uint8)
    base = 8 * (np.cumsum(sizes) - sizes)
    at, stop = base.copy(), base + 8 * sizes
    head = (data[at >> 3].astype(np.int64) | data[(at >> 3) + 1].astype(np.int64) << 8) & (1 << least + 1) - 1
    at[(head == clear) & (sizes > 1)] += least + 1  # nearly every stream begins with a clear code
    out: list[list[np.ndarray]] = [[] for _ in streams]
    todo, span = np.arange(len(streams)), SPAN
    while len(todo):
        widths = _widths(least, span)
        ends = np.cumsum(widths)
        longer, again = [], []
        step = max(1, CUT // (12 * span))
        for part in (todo[i : i + step] for i in range(0, len(todo), step)):
            place = at[part, None] + (ends - widths)
            there = place + widths <= stop[part, None]
            byte = np.minimum(place >> 3, len(data) - 3)
            value = data[byte].astype(np.int32) | data[byte + 1].astype(np.int32) << 8 | data[byte + 2].astype(np.int32) << 16
            codes = (value >> (place & 7).astype(np.int32)) & ((1 << widths) - 1).astype(np.int32)
            special = ((codes == clear) | (codes == clear + 1)) & there
            first = np.where(special.any(1), special.argmax(1), -1)
            known = there.sum(1)
            for row, (stream, k, n) in enumerate(zip(part.tolist(), first.tolist(), known.tolist())):
                if k < 0 and n == span:  # a longer run
                    longer.append(stream)
                    continue
                if k or n == 0:
                    out[stream].append(codes[row, : k if k >= 0 else n].copy())
                if k >= 0 and codes[row, k] == clear:
                    at[stream] += int(ends[k])
                    again.append(stream)
        todo = np.array(again + longer, np.int64)
        span = 4 * span if longer else SPAN
    return out


def expand(runs: list[np.ndarray], clear: int) -> list[np.ndarray]:
    """The samples of runs of codes that each follow a clear code.

    The i-th string that a run learns is the one of its i-th code and one sample more, so it stands in the run's own
    output, where that code's string does. So strings need not be made: lengths follow code by code, for all runs at once,
    and every sample is then copied from the place that it points to, through as many places as it takes.
    """
    if not runs:
        return []
    counts = np.array([len(r) for r in runs])
    there = np.arange(counts.max()) < counts[:, None]
    codes = np.zeros(there.shape, np.int64)
    codes[there] = np.concatenate(runs)
    learned = np.where(codes > clear + 1, codes - clear - 2, -1)  # the number of the string that a code names
    if (codes[:, :1] >= clear).any() or (learned >= np.minimum(np.arange(there.shape[1]), 4096 - clear - 2)).any():
        raise ValueError("a code is beyond the table")
    steps, row = np.ascontiguousarray(learned.T), np.arange(len(runs))
    size = np.ones(steps.shape, np.int64)
    for k in range(1, len(steps)):
        size[k] = np.where(steps[k] >= 0, size[np.maximum(steps[k], 0), row] + 1, 1)
    size = size.T * there
    ends = np.cumsum(size, 1)
    total = ends[:, -1]
    begin = ends - size + (np.cumsum(total) - total)[:, None]
    source = np.take_along_axis(begin, np.maximum(learned, 0), 1)
    shift = np.where(learned >= 0, source - begin, 0)[there]
    length = size[there]
    points = np.arange(int(total.sum())) + np.repeat(shift, length)
    while True:
        further = points[points]
        if (further == points).all():
            break
        points = further
    out = np.repeat(codes[there].astype(np.uint8), length)[points]
    return np.split(out, np.cumsum(total)[:-1])


def lzw_decode(streams: list[bytes], least: int, counts: list[int], together: int = 2048) -> list[np.ndarray]:
    """Up to ``counts`` palette numbers of each LZW stream, ``together`` streams at a time."""
    out, none = [], [np.zeros(0, np.uint8)]
    for at in range(0, len(streams), together):
        found = [[r for r in runs if len(r)] for runs in code_runs(streams[at : at + together], least)]
        parts = iter(expand([r for runs in found for r in runs], 1 << least))
        out += [np.concatenate([next(parts) for _ in runs] or none)[:n] for runs, n in zip(found, counts[at : at + together])]
    return out


def frame_samples(images: list[Image]) -> list[np.ndarray]:
    """Palette numbers of each frame, in rows from the top."""
    out: list[np.ndarray | None] = [None] * len(images)
    for least in {i.least for i in images}:
        own = [k for k, i in enumerate(images) if i.least == least]
        found = lzw_decode([images[k].data for k in own], least, [images[k].width * images[k].height for k in own])
        for k, samples in zip(own, found):
            i = images[k]
            if len(samples) < i.width * i.height:
                raise ValueError("a frame has too few samples")
            samples = samples.reshape(i.height, i.width)
            if i.interlaced:
                order = np.concatenate([np.arange(a, i.height, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
                rows = np.empty_like(samples)
                rows[order] = samples
                samples = rows
            out[k] = samples
    return out


def screens(width: int, height: int, images: list[Image], samples: list[np.ndarray]) -> Iterator[np.ndarray]:
    """What is shown at each frame, as RGBA pixels."""
    screen = np.zeros((height, width, 4), np.uint8)
    for image, own in zip(images, samples):
        before = screen.copy() if image.disposal == 3 else None
        area = screen[image.top : image.top + image.height, image.left : image.left + image.width]
        own = own[: area.shape[0], : area.shape[1]]
        seen = own != image.transparent
        area[seen, :3] = image.palette[np.minimum(own, len(image.palette) - 1)][seen]
        area[seen, 3] = 255
        yield screen.copy()
        if image.disposal == 2:
            area[:] = 0
        elif before is not None:
            screen = before


def render(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The animation as RGBA screens (frames x height x width x 4) and the delay of each in hundredths of a second."""
    width, height, images = parse_gif(data)
    shown = list(screens(width, height, images, frame_samples(images)))
    return np.array(shown, np.uint8).reshape(-1, height, width, 4), np.array([i.delay for i in images], np.int64)


BINS = 8


def _bins(colours_of: bytes) -> np.ndarray:
    """For each of 256 palette numbers, ones in the bins of its red, green and blue."""
    palette = np.frombuffer(colours_of, np.uint8).reshape(-1, 3)
    colours = palette[np.minimum(np.arange(256), len(palette) - 1)]
    out = np.zeros((256, 3 * BINS), np.int64)
    out[np.arange(256)[:, None], (colours >> 5) + BINS * np.arange(3)] = 1
    return out


def histograms(width: int, height: int, images: list[Image], samples: list[np.ndarray]) -> np.ndarray:
    """Of what is shown at each frame: the pixels by red, green and blue, in 8 equal steps each. Pixels that nothing was
    drawn on do not count."""
    if images and all(not (i.left or i.top) and i.width >= width and i.height >= height and i.transparent < 0 and i.palette is images[0].palette for i in images):
        # every frame covers the screen, so that none shows through
        shown = np.stack([s[:height, :width].ravel() for s in samples]).astype(np.int64)
        counts = np.bincount((shown + 256 * np.arange(len(shown))[:, None]).ravel(), minlength=256 * len(shown))
        return counts.reshape(-1, 256) @ _bins(images[0].palette.tobytes())
    out = [np.bincount(((s[..., :3] >> 5) + BINS * np.arange(3))[s[..., 3] > 0].ravel(), minlength=3 * BINS) for s in screens(width, height, images, samples)]
    return np.array(out, np.int64).reshape(-1, 3 * BINS)


MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, duration long, histogram array<long>"
TIMED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, starts array<long>, delays array<int>, red array<array<int>>, green array<array<int>>, blue array<array<int>>"
FRAMES = "doc_id long, frame int, starts long, delay int, width int, height int, red array<long>, green array<long>, blue array<long>"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every whole text of docs(doc_id, text) as an animation. A null text is an empty one, which
    has one frame of padding. Ids may be null or repeated; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column(1))
            sizes = np.diff(offsets)
            frames = np.maximum(-(-sizes // FRAME), 1)
            ends = np.concatenate([[0], np.cumsum(frames)])
            payload = np.full(int(ends[-1]) * FRAME, PAD, np.uint8)
            payload[np.repeat(ends[:-1] * FRAME - offsets[:-1], sizes) + np.arange(len(buf))] = buf
            blocks = frame_blocks(payload.reshape(-1, FRAME))
            media = [b"".join((_HEAD, *blocks[a:b], b"\x3b")) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes), pa.array(media, pa.binary())], _names(MEDIA))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MEDIA)


Animation = tuple[int, int, list[Image], list[np.ndarray]]


def read_all(media: list[bytes | None]) -> list[Animation | None]:
    """Screen width and height, frames and samples of every image; None for a null or broken one. The streams of all images
    are decoded together; where one is broken, each image by itself."""
    parsed: list[tuple[int, int, list[Image]] | None] = []
    for data in media:
        try:
            parsed.append(parse_gif(data or b""))
        except ValueError:
            parsed.append(None)
    try:
        samples = iter(frame_samples([i for p in parsed if p for i in p[2]]))
        return [p and (*p, [next(samples) for _ in p[2]]) for p in parsed]
    except ValueError:
        out: list[Animation | None] = []
        for p in parsed:
            try:
                out.append(p and (*p, frame_samples(p[2])))
            except ValueError:
                out.append(None)
        return out


def frames(media: DataFrame) -> DataFrame:
    """One row for each frame of media(doc_id, media): its number, when it starts and how long it stays (hundredths of a
    second), the screen's size, and the colour histograms of what it shows. A null or broken image has no frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "media"):
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), read_all(batch.column(1).to_pylist())):
                if found is None:
                    continue
                starts = 0
                for n, (image, own) in enumerate(zip(found[2], histograms(*found).tolist())):
                    rows.append((doc_id, n, starts, image.delay, *found[:2], own[:BINS], own[BINS : 2 * BINS], own[2 * BINS :]))
                    starts += image.delay
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3, *[pa.list_(pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _names(FRAMES))

    return media.select(F.col("doc_id").cast("long"), "media").mapInArrow(run, FRAMES)


def _lists(ends: np.ndarray, values: pa.Array, nulls: np.ndarray) -> pa.Array:
    """Lists that end at ``ends`` of the values, null where ``nulls`` is set."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values, mask=pa.array(nulls))


def timed(media: DataFrame) -> DataFrame:
    """The timed frames of media(doc_id, n_bytes, media), one row an image: when each frame starts and how long it stays
    (hundredths of a second), and the colour histograms of what it shows; beside them what the palette numbers of all
    frames give. Of a null or broken image all but doc_id, n_bytes and what describes its bytes is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "media"):
            stored_media = batch.column(2).to_pylist()
            rows, delays, counts = [], [], []
            for data, found in zip(stored_media, read_all(stored_media)):
                stored = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
                if found is None:
                    rows.append((None, None, None, *stored))
                    delays.append([])
                    counts.append(np.zeros((0, 3 * BINS), np.int64))
                    continue
                payload = b"".join(s.tobytes() for s in found[3])
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), *stored))
                delays.append([i.delay for i in found[2]])
                counts.append(histograms(*found))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            described = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            ends, broken = np.cumsum([len(d) for d in delays]), np.array([r[0] is None for r in rows])
            stay = np.array([x for d in delays for x in d], np.int32)
            starts = np.concatenate([np.cumsum([0, *d[:-1]]) for d in delays if d] or [[]]).astype(np.int64)
            bins = np.concatenate(counts).astype(np.int32)
            colours = [
                _lists(ends, pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1) * BINS, pa.int32()), pa.array(bins[:, i : i + BINS].ravel())), broken)
                for i in (0, BINS, 2 * BINS)
            ]
            own = [_lists(ends, pa.array(starts), broken), _lists(ends, pa.array(stay), broken), *colours]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *described, *own], _names(TIMED))

    return media.select(F.col("doc_id").cast("long"), F.col("n_bytes").cast("long"), "media").mapInArrow(run, TIMED)


def described(timed_frames: DataFrame) -> DataFrame:
    """The features (number of frames, duration, colours over all frames) of a table that ``timed`` gives; equal images give
    equal values."""
    none = F.array(*[F.lit(0).cast("long")] * BINS)
    over = lambda c: F.aggregate(c, none, lambda total, frame: F.zip_with(total, frame, lambda a, b: a + b))
    kept = [x for x in _names(TIMED) if x not in ("starts", "delays", "red", "green", "blue")]
    n, duration = F.when(F.col("delays").isNotNull(), F.size("delays")), F.aggregate("delays", F.lit(0).cast("long"), lambda total, d: total + d)
    rows = timed_frames.select(*kept, n.alias("n_frames"), duration.alias("duration"), F.concat(*[over(c) for c in ("red", "green", "blue")]).alias("histogram"))
    text = [F.lit("frames="), F.col("n_frames").cast("string"), F.lit(";delay="), F.col("duration").cast("string"), F.lit(";hist=")]
    feature = F.concat(*text, F.array_join(F.col("histogram").cast("array<string>"), ","))
    return rows.withColumn("feature", feature).select(*_names(FEATURES))


def features(media: DataFrame) -> DataFrame:
    """What the decoded frames of media(doc_id, n_bytes, media) hold (palette numbers) and show (colours over all frames);
    equal images give equal values. Of a null or broken image all but doc_id, n_bytes and what describes its bytes is null."""
    return described(timed(media))


def media_features(docs: DataFrame) -> DataFrame:
    """``features`` of every row of docs(doc_id, text): the texts are stored as images in the shared folder and read back, and
    so are their timed frames. A null text is an empty one; ids may be null or repeated; an empty table gives no rows."""
    return described(materialize(timed(materialize(store(docs), "media")), "frames"))
