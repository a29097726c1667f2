"""Ranked search, phrase mining and quality against brute force; long words, number signs and long labelled texts."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.test_text import prose
from voxelspark.llm import collocations, decontaminate, interpolation, langid, quality, queries, ranked_search, toxicity

TABLES = "/root/testdata/sf0.01"


# ---------------------------------------------------------------------------------------------- ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_search(docs, items, k):
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in items:
        rows = []
        for i, c, n in counts:
            m = 10 + (90 * n * n_docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 8 * m)) for w in set(terms(text)) if w in c)
            if score > 0:
                rows.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,chunk", [(1 << 20, 1 << 18), (300, 40)])
def test_search_against_brute_force(spark, monkeypatch, block, chunk):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["É", "Zug", "ß1"]
    share = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(150)] + [(200 + i, "w3 w9 w9 copy") for i in range(60)]
    docs += [(None, "w1 w50"), (7, "w50"), (7, "w50"), (400, None), (401, ""), (402, "--- ..."), (403, "w2 " * 4000)]
    items = [(1, "w9 copy"), (1, "W50 w50 W1"), (2, None), (3, "..."), (None, "zug É w2"), (5, "nowhere"), (6, text(40)), (6, "w9 copy")]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, item string").repartition(5)
    queries_ = spark.createDataFrame(items + items[:1], "item_id long, text string").repartition(2)
    monkeypatch.setattr(ranked_search, "CELLS", 400)
    got = ranked_search.search(table, queries_, 7, block, chunk).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == brute_search(docs, items, 7)


def test_bounds_hold_the_exact_impact():
    rng = np.random.default_rng(1)
    tf, n = rng.integers(1, 1000, 5000), rng.integers(1, 10**6, 5000)
    exact = ranked_search.impacts(tf, n, 10**6, 10**9)
    byte = -(-exact // ranked_search.STEP)
    assert byte.max() <= 255 and (byte * ranked_search.STEP >= exact).all() and ((byte - 1) * ranked_search.STEP < exact).all()


# ---------------------------------------------------------------------------------------------- phrases


def brute_phrases(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard,at_once,rows", [(8 << 20, 1 << 21, 1 << 20), (700, 50, 300)])
def test_phrases_against_brute_force(spark, monkeypatch, shard, at_once, rows):
    rng = np.random.default_rng(3)
    words = np.array(["a", "B", "c", "d.", "e,", "f\t", "É", "zz", "it's", "x\ny", "\x00", "longer-word"])
    docs = [(" ".join(rng.choice(words, int(rng.integers(0, 90)))), ["en", "de", None][int(rng.integers(0, 3))]) for _ in range(150)]
    docs += [(None, "en"), ("", None), ("new york city hall " * 40, "en"), ("q " * 200, "fr"), (" . ".join(["new york"] * 30), "en")]
    docs += [("same same row here", "de")] * 12
    monkeypatch.setattr(collocations, "AND_AT_ONCE", at_once)
    monkeypatch.setattr(collocations, "TASK_ROWS", rows)
    table = spark.createDataFrame([(*d, 1, "k") for d in docs], "text string, lang string, n int, phrase string").repartition(4)
    got = collocations.collocations(table, 8, 90, shard)
    want = brute_phrases(docs, 8, 90)
    assert len(want) > 100 and sorted(tuple(r) for r in got.collect()) == want


def test_bitmaps_survive_packing_and_shift_over_their_words():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 5, 3000)
    positions = np.cumsum(rng.integers(1, 3, 3000))
    maps = collocations.bitmaps(words, positions)
    back = collocations.unpack(collocations.pack(*maps, 5))
    assert all((x == y).all() for x, y in zip(maps, back))
    shard = collocations.Shard(collocations.pack(*maps, 5), np.arange(5), np.arange(5) * 10)
    a, b, n = shard.grow([])
    step = np.flatnonzero(np.diff(positions) == 1)
    want = Counter(zip((words[step] * 10).tolist(), (words[step + 1] * 10).tolist()))
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want


# ---------------------------------------------------------------------------------------------- quality


def labelled(spark, n=200):
    good = [(i, prose(80, i), 1) for i in range(n)]
    bad = [(n + i, " | ".join(prose(40, i).upper().split()) + " && $$ ##", 0) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "extra", 0.5) for i, t, _ in good + bad], "doc_id long, text string, label string, score double")
    return docs, spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int")


def test_quality_against_plain_scoring(spark):
    docs, labels = labelled(spark)
    more = [(900, None), (901, ""), (902, prose(9000, 3)), (None, prose(50, 4)), (3, prose(80, 3)), (903, "é")]
    docs = docs.unionByName(spark.createDataFrame([(*m, "z", 1.0) for m in more], docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (902, None), (7, 0)], labels.schema))
    model = quality.train_on(docs, labels)
    made = [zstandard.ZstdCompressionDict(d) for d in model.dictionaries]
    for d in made:
        d.precompute_compress(level=3)
    bad, good = (zstandard.ZstdCompressor(dict_data=d, compression_params=zstandard.ZstdCompressionParameters.from_level(3, write_content_size=0, write_dict_id=0)) for d in made)
    want = defaultdict(list)
    for r in docs.collect():
        data = (r["text"] or "").encode()
        one, two = (sum(len(c.compress(data[a : a + quality.PIECE])) for a in range(0, len(data), quality.PIECE)) for c in (bad, good))
        x = (one - two) / (one + two) if data else 0.0
        want[r["doc_id"]].append(round(1 / (1 + math.exp(-min(max(model.slope * x + model.offset, -30), 30))), 9))
    got = defaultdict(list)
    for r in quality.quality(docs, labels).collect():
        got[r["doc_id"]].append(round(r["score"], 9))
        assert r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    held = [r for r in quality.quality(docs, labels).where("held_out").collect() if r["doc_id"] < 400]
    assert len(held) > 50 and np.mean([r["predicted"] == (r["doc_id"] < 200) for r in held]) > 0.97


def test_quality_of_one_label_and_of_none(spark):
    docs, labels = labelled(spark, 20)
    assert {r["predicted"] for r in quality.quality(docs, labels.where("quality = 1")).collect()} == {1}
    assert {r["score"] for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the synthetic tables")
def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").where("quality is not null").select("doc_id", "quality")
    rows = queries.op13_quality(spark, TABLES).where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.9


# ---------------------------------------------------------------------------------------------- long words and texts


def thue_morse(n, a, b):
    word = a
    for _ in range(n):
        word += word.translate(str.maketrans(a + b, b + a))
    return word


def test_long_words_of_one_pattern_are_told_apart(spark):
    one, two = thue_morse(11, "a", "b"), thue_morse(11, "b", "a")
    docs = spark.createDataFrame([(i, one) for i in range(200)] + [(i, two) for i in range(200, 400)], "doc_id long, text string")
    train = docs.where((F.col("doc_id") < 200) | (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0))
    rows = interpolation.score_texts(train).where("doc_id >= 200").collect()
    assert len(rows) > 5 and {(r["n_tokens"], r["n_known"]) for r in rows} == {(2, 1)}
    found = decontaminate.contamination(docs.where("doc_id % 100 = 0"), spark.createDataFrame([("x", one)], "item_id string, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in found} == {0: ["x"], 100: ["x"], 200: [], 300: []}


def test_number_signs_are_no_letters(spark):
    docs = [(i, prose(60, i), "aa") for i in range(30)] + [(30 + i, prose(60, i).upper(), "bb") for i in range(30)]
    docs += [(100 + i, t, None) for i, t in enumerate(["½", "²²", "Ⅷ", "१२", "3 ½!"])]
    rows = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).where("doc_id >= 100").collect()
    assert {r["lang_pred"] for r in rows} == {"und"}


def test_labels_of_long_texts_alone_are_learned(spark):
    """A language and a label whose texts all have some 90 kB."""
    long = lambda i: " ".join(w[::-1] for w in prose(14000, 500 + i).split())
    docs = [(i, prose(60, i), "aa") for i in range(40)] + [(100 + i, long(i), "bb") for i in range(25)]
    assert len(docs[-1][1]) > 80_000
    rows = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).where("doc_id >= 100").collect()
    assert {r["lang_pred"] for r in rows} == {"bb"}
    rng = np.random.default_rng(8)
    mean = lambda i: " ".join(w + (" zorbel you." if rng.random() < 0.02 else "") for w in prose(14000, 900 + i).split())
    rows = [(i, prose(14000, i), 0) for i in range(20)] + [(100 + i, mean(i), 1) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert "zorbel" in model.lexicon.words and model.score("you zorbel, you are a zorbel") > 0.5
