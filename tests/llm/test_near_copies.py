"""Near copies inside cells: crowded ones are compared by blocks, and few pairs leave them."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelspark.llm import near_copies
from voxelspark.llm.common import materialize

WORDS = [f"w{i}" for i in range(5000)]


def shingles(text):
    w = text.split()
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs.select(F.unhex(F.md5(F.col("doc_id").cast("string").cast("binary"))).alias("row_key"), "doc_id", "text")


def template(n, own, seed=1, length=140):
    """Pages of one template: the same words but for ``own`` words of each, in one place."""
    rng = np.random.default_rng(seed)
    base = list(rng.choice(WORDS, length))
    return [" ".join(base[:100] + list(rng.choice(WORDS, own)) + base[100:]) for _ in range(n)]


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(bytes(r["component"]), set()).add(r["doc_id"])
    return sorted(map(sorted, out.values()))


def brute(texts):
    sets = [shingles(t) for t in texts]
    part = list(range(len(texts)))
    find = lambda i: i if part[i] == i else find(part[i])
    for i, j in itertools.combinations(range(len(texts)), 2):
        if jaccard(sets[i], sets[j]) >= 0.8:
            part[find(j)] = find(i)
    out = {}
    for i in range(len(texts)):
        out.setdefault(find(i), []).append(i)
    return sorted(out.values())


@pytest.mark.parametrize("block,rounds", [(1 << 10, 3), (7, 0)])
def test_groups_against_brute_force(spark, monkeypatch, block, rounds):
    """Templates whose pages lie on both sides of 0.8, with copies of some; also where every cell is dealt out as blocks."""
    texts = template(40, 14) + template(30, 9, 2) + template(25, 24, 3)
    rng = np.random.default_rng(4)
    for k in range(20):
        w = texts[k].split()
        for i in rng.integers(0, len(w), 1 + k % 3):
            w[i] = "changed"
        texts.append(" ".join(w))
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    assert groups(near_copies.near_copies(of(spark, texts)).collect()) == brute(texts)


def test_few_pairs_leave_a_crowded_cell(spark):
    """Pages whose similarities are near 0.7, so that none links: what leaves the cells grows with the pages and not with their
    square."""
    left = {}
    for n in (300, 1200):
        texts = template(n, 23, 5)
        assert 0.66 < jaccard(shingles(texts[0]), shingles(texts[1])) < 0.74
        docs = of(spark, texts)
        rows = materialize(near_copies.text_nodes(docs), "test-rows")
        nodes = rows.select("node", "row_key", "n", "fp", "bands")
        cells = near_copies.shared_cells(nodes)
        sets = near_copies.shingle_sets(docs.join(nodes.select("row_key", "node"), "row_key"))
        met = cells.withColumn("part", F.col("node"))
        sizes = cells.groupBy("token").agg(F.count(F.lit(1)).alias("s"))
        assert sizes.agg(F.max("s")).first()[0] > n / 2
        left[n] = near_copies.likely_pairs(met, sizes, sets).distinct().count()
    assert left[1200] < 20 * 1200 and left[1200] <= max(16 * left[300], 5000)


def test_rounds_read_only_cells_that_are_open(spark, monkeypatch):
    """Copies that the first rounds join are not read by later ones, whose cells are those of pages that do not link."""
    texts = template(60, 4) + template(40, 24, 3)
    read = []

    def counted(table, name):
        out = materialize(table, name)
        if name == "near-cells":
            read.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "PAIRS_A_ROW", 0)
    monkeypatch.setattr(near_copies, "materialize", counted)
    assert groups(near_copies.near_copies(of(spark, texts)).collect()) == brute(texts)
    assert len(read) > 3 and 0 < read[-1] < read[1]
