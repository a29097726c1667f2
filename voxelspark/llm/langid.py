"""Language identification by a byte convolutional network, trained and applied in numpy.

A text is cut into fixed windows of bytes, the last one padded with zeros. Filters of several widths slide over the bytes
of a window (a byte is one-hot, so a filter is a table of 256 weights for each of its places), each keeps its maximum, and
a softmax layer over those gives the window's language probabilities. A text's probabilities are the mean over its
windows, weighted by their bytes. Whole texts are read.

Training takes ``per_language`` ids of each language at most (600), one text an id, and ``crops`` windows of each (6), of
random place and length, so that short texts are known too: about a megabyte a language comes to the driver, however long
the texts are. Ids that have
rows of several languages are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_text, text_bytes, text_slices
from .sampling import labelled_sample

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Letters and, as the class of words goes, number signs such as fractions, which are told apart by ``has_letter``.
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text or ""))


@dataclass
class Network:
    """tables[w]: for each place of a filter of width w, the weights of each byte (256 x FILTERS)."""

    labels: list[str]
    tables: list[list[np.ndarray]]
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    @staticmethod
    def random(labels: list[str], rng: np.random.Generator) -> "Network":
        f = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        total = FILTERS * len(WIDTHS)
        return Network(labels, [[f(256, FILTERS) for _ in range(w)] for w in WIDTHS], np.zeros(total, np.float32), f(total, len(labels)), np.zeros(len(labels), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*(t for places in self.tables for t in places), self.bias, self.dense, self.out]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maximum of every filter over each window (n x WINDOW bytes), and where it is."""
        tops, places = [], []
        for w, tables in zip(WIDTHS, self.tables):
            n = windows.shape[1] - w + 1
            acc = tables[0][windows[:, :n]]
            for j in range(1, w):
                acc += tables[j][windows[:, j : j + n]]
            at = acc.argmax(1)
            places.append(at)
            tops.append(np.take_along_axis(acc, at[:, None], 1)[:, 0])
        return np.concatenate(tops, 1) + self.bias, places

    def probabilities(self, hidden: np.ndarray) -> np.ndarray:
        logits = np.maximum(hidden, 0) @ self.dense + self.out
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fast(self) -> "Pooler":
        return Pooler(self)


class Pooler:
    """The same pooling with two neighbouring bytes looked up at once."""

    def __init__(self, net: Network):
        self.net = net
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        self.tables = []
        for tables in net.tables:
            steps = [(j, pair(tables[j], tables[j + 1])) for j in range(0, len(tables) - 1, 2)]
            if len(tables) % 2:
                steps.append((len(tables) - 1, tables[-1]))
            self.tables.append((len(tables), steps))

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        tops = []
        for w, steps in self.tables:
            n = windows.shape[1] - w + 1
            acc = None
            for j, table in steps:
                got = np.take(table, pairs[:, j : j + n] if len(table) > 256 else windows[:, j : j + n], axis=0)
                acc = got if acc is None else np.add(acc, got, out=acc)
            tops.append(acc.max(1))
        return self.net.probabilities(np.concatenate(tops, 1) + self.net.bias)


def train(windows: np.ndarray, labels: np.ndarray, names: list[str], seed: int = 7, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> Network:
    """Softmax cross-entropy by Adam. A maximum passes its gradient to the bytes under it alone."""
    rng = np.random.default_rng(seed)
    net = Network.random(names, rng)
    params = net.parameters()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            x, y = windows[own], labels[own]
            hidden, places = net.pooled(x)
            p = net.probabilities(hidden)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ net.dense.T) * (hidden > 0)
            grads = []
            for k, (w, at_max) in enumerate(zip(WIDTHS, places)):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                column = np.broadcast_to(np.arange(FILTERS), at_max.shape)
                for j in range(w):
                    g = np.zeros((256, FILTERS), np.float32)
                    np.add.at(g, (np.take_along_axis(x, at_max + j, 1), column), part)
                    grads.append(g)
            grads += [back.sum(0), np.maximum(hidden, 0).T @ p, p.sum(0)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= (rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def crop_windows(sample: DataFrame, crops: int, seed: int) -> DataFrame:
    """(label, window): random stretches of the sampled texts, half of them whole windows and half shorter ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            labels, out = [], []
            for doc_id, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))):
                data = (text or "").encode()
                if not has_letter(text):
                    continue
                rng = np.random.default_rng([seed, doc_id & 0xFFFFFFFFFFFFFFFF])
                for k in range(crops):
                    size = WINDOW if k % 2 == 0 else int(rng.integers(12, WINDOW))
                    at = int(rng.integers(0, max(1, len(data) - size + 1)))
                    labels.append(label)
                    out.append(data[at : at + size].ljust(WINDOW, b"\0"))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(out, pa.binary())], ["label", "window"])

    return sample.select("doc_id", "label", "text").mapInArrow(run, "label string, window binary")


def train_on(docs: DataFrame, per_language: int = 600, crops: int = 6, seed: int = 7) -> Network | None:
    """A network for the languages of docs(doc_id, text, lang), learned where crc32(id) mod 5 is not 0."""
    sample = labelled_sample(docs, F.col("lang"), crc32_text("doc_id") % 5 != 0, per_language, seed)
    rows = crop_windows(sample, crops, seed).toArrow().sort_by([("label", "ascending"), ("window", "ascending")])
    if not rows.num_rows:
        return None
    names = sorted(set(rows.column("label").to_pylist()))
    windows = np.frombuffer(b"".join(rows.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([names.index(x) for x in rows.column("label").to_pylist()]), names, seed)


def predict(docs: DataFrame, net: Network | None, chunk: int = 256) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs(doc_id, text). A text that is null or has no letter is ``und`` with
    score 1; so is every text where nothing could be learned, with score 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = net.fast() if net else None
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column(1))
            letters = np.array([has_letter(t) for t in batch.column(1).to_pylist()])
            n = len(letters)
            best, score = np.full(n, "und", object), letters.__invert__().astype(float)
            if pool is not None and letters.any():
                sizes = np.diff(offsets) * letters
                count = -(-sizes // WINDOW)
                doc = np.repeat(np.arange(n), count)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = offsets[:-1][doc] + number * WINDOW
                size = np.minimum(WINDOW, offsets[1:][doc] - start)
                padded = np.append(buf, np.zeros(WINDOW, np.uint8))
                sums = np.zeros((n, len(net.labels)))
                for at in range(0, len(doc), chunk):
                    own = slice(at, at + chunk)
                    windows = padded[start[own, None] + np.arange(WINDOW)]
                    windows[np.arange(WINDOW) >= size[own, None]] = 0
                    np.add.at(sums, doc[own], pool(windows) * size[own, None])
                sums /= np.maximum(sizes, 1)[:, None]
                top = sums.argmax(1)
                best[letters] = np.array(net.labels, object)[top[letters]]
                score[letters] = np.clip(sums[np.arange(n), top], 0, 1)[letters]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(best, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, **training) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of docs(doc_id, text, lang). Null ids are held out of training and
    are not marked as held out; null and letterless texts are ``und``; repeated rows are rows of their own; an empty table
    gives no rows."""
    net = train_on(docs.select("doc_id", "text", "lang"), **training)
    held = F.coalesce(crc32_text("doc_id") % 5 == 0, F.lit(False))
    return predict(docs, net).select("doc_id", held.alias("held_out"), "lang_pred", "score")
