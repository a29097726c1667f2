"""Quality by compression with dictionaries of good and of bad labelled texts.

Two zstandard dictionaries are trained, on pieces of good texts and on pieces of bad ones. A text is compressed piece by
piece with both, whole, and the normalised difference of the two sizes, (bad - good) / (bad + good), says which of the two
collections it shares more strings with. A logistic curve of the difference, fitted on labelled texts that the dictionaries
have not seen, makes it a probability.

Training takes ``per_label`` ids of each label at most (4000), one text an id. Three quarters of them give ``crops`` pieces
each to the dictionaries (6, of random places of the whole text: 24 MB a label at most), and the others' differences, which
tasks find, the curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_text, kept, text_bytes, text_slices
from .sampling import labelled_ids, texts_of

PIECE = 1024
DICTIONARY = 1 << 16
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good texts, and the curve's slope and offset."""

    dictionaries: tuple[bytes, bytes]
    slope: float = 0.0
    offset: float = 0.0

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -30, 30)))


def _compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    """One for each dictionary, digested once a worker; frames have no checksum, size or dictionary number."""

    def make() -> list[zstandard.ZstdCompressor]:
        out = []
        for data in dictionaries:
            own = zstandard.ZstdCompressionDict(data) if data else None
            if own:
                own.precompute_compress(level=LEVEL)
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
            out.append(zstandard.ZstdCompressor(dict_data=own, compression_params=params))
        return out

    return kept(("quality", dictionaries), make)


def differences(texts: pa.Array, dictionaries: tuple[bytes, bytes]) -> np.ndarray:
    """The normalised difference of each text: above 0 where the good dictionary makes it smaller. 0 for a null or empty text."""
    bad, good = _compressors(dictionaries)
    buf, offsets = text_bytes(texts)
    data, out = memoryview(buf), np.zeros(len(texts))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        one = two = 0
        for at in range(a, b, PIECE):
            piece = data[at : min(at + PIECE, b)]
            one += len(bad.compress(piece))
            two += len(good.compress(piece))
        out[i] = (one - two) / (one + two) if b > a else 0.0
    return out


def crop_pieces(sample: DataFrame, crops: int, seed: int) -> DataFrame:
    """(doc_id, label, piece): ``crops`` pieces at random places of each text, all of a text of fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = []
            for doc_id, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))):
                data = (text or "").encode()
                starts = np.arange(0, len(data), PIECE)
                if len(starts) > crops:
                    starts = np.sort(np.random.default_rng([seed, doc_id & 0xFFFFFFFFFFFFFFFF]).integers(0, len(data) - PIECE + 1, crops))
                rows += [(doc_id, label, data[s : s + PIECE]) for s in starts.tolist()]
            ids, labels, pieces = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(pieces, pa.binary())], ["doc_id", "label", "piece"])

    return sample.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(run, "doc_id long, label int, piece binary")


def make_dictionary(pieces: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary of at most ``size`` bytes. Where there are too few pieces to train one, they are its content."""
    pieces = [p for p in pieces if len(p) >= 8]
    total = sum(map(len, pieces))
    if len(pieces) >= 16 and total >= 1 << 14:
        try:
            return zstandard.train_dictionary(min(size, max(1 << 12, total // 4)), pieces, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # pieces without a string in common
            pass
    return b"\n".join(pieces)[:size]


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the logistic curve by Newton steps; x is scaled by its deviation meanwhile."""
    scale = float(x.std()) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2), z.T @ (p - y) + ridge * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]) / scale, float(w[1])


def train_on(docs: DataFrame, labels: DataFrame, per_label: int = 4000, crops: int = 6, seed: int = 13) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, quality), of rows where crc32(id) mod 5 is not 0. Ids whose labels
    disagree are left out. Where a label has no text every score is the share of good texts among those that there are, 0.5
    without any."""
    keep = crc32_text("doc_id") % 5 != 0
    known = labels.where(keep & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    chosen = labelled_ids(known, per_label, seed)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    last = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4)) == 0
    rows = crop_pieces(texts_of(docs, chosen.where(~last)), crops, seed).toArrow().sort_by([("doc_id", "ascending"), ("piece", "ascending")])
    label, pieces = np.array(rows.column("label").to_pylist(), np.int64), rows.column("piece").to_pylist()
    dictionaries = tuple(make_dictionary([p for p, k in zip(pieces, label.tolist()) if k == own]) for own in (0, 1))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(differences(batch.column(1), dictionaries))], ["label", "x"])

    held = texts_of(docs, chosen.where(last)).select("label", "text").mapInArrow(compare, "label int, x double").toArrow()
    y, x = np.array(held.column("label").to_pylist(), float), np.array(held.column("x").to_pylist())
    if not all(dictionaries) or len(set(y.tolist())) < 2:
        every = np.concatenate([y, label.astype(float)])
        share = min(max(float(every.mean()), 1e-6), 1 - 1e-6) if len(every) else 0.5
        return Model(dictionaries, 0.0, float(np.log(share / (1 - share))))
    return Model(dictionaries, *fit_curve(x, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = model.probability(differences(batch.column(1), model.dictionaries))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, limit: float = 0.3, **training) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs(doc_id, text); predicted is 1 from ``limit`` on.

    Null ids are not held out and train nothing; null and empty texts get the score of no difference; repeated rows are
    rows of their own; labels of one kind or none give every text one score; an empty table gives no rows.
    """
    model = train_on(docs, labels, **training)
    held = F.coalesce(crc32_text("doc_id") % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
