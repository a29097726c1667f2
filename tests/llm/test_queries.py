"""The registered queries themselves, on small whole tables with awkward rows, against brute force or their SQL."""

import hashlib
import itertools
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_text import SECRET, brute_repeats, low, plain_lzw, prose
from voxelspark.llm import common, decontaminate, interpolation, langid, media, mixing, oracle, queries, records, sampling, secret_ledger, simhash, substrings, toxicity

LONG = " ".join(f"{w}{i % 97}" for i, w in enumerate(prose(9000, 44).split()))
TEXTS = [None, "", " \t\n", "One", prose(60, 1), prose(60, 1), prose(60, 1) + " end", "x" * 700, prose(400, 2), prose(200, 3) + prose(60, 1), "é" * 90 + "ß" * 40, SECRET, "you idiot, he said \"you are not an idiot\".\nI will kill you", "漢字 and more", LONG, prose(80, 7), prose(80, 8)]
TEXTS += [prose(50, 100 + i) + (" zorbel zorban zorbist you" if i % 4 == 0 else "") for i in range(120)]
TEXTS += [" ".join(w[::-1].upper() for w in prose(50, 300 + i).split()) for i in range(80)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents (one id null, extra columns with names that operators use themselves), labels, benchmark with repeats."""
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(None if i == 15 else i, t, None if i < 12 else "aa" if i < 137 else "bb", f"s{i % 3}" if i % 4 else None, "kept", 7.5, 99) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row_key string, copy double, tokens int").repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(i, int(i % 4 == 1), None) for i in range(17, 137)] + [(18, None, None), (None, 1, None), (17, 1, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{d}/labels.parquet")
    items = [(7, prose(60, 1)), (7, prose(60, 1)), (7, prose(30, 8)), (8, "One"), (9, None), (10, "never seen words"), (11, TEXTS[8][:300]), (None, prose(80, 7)), (12, " ".join(w + "x" * (n % 9 == 4) for n, w in enumerate(prose(40, 105).split())))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{d}/{name}.parquet")
    return d


def ids():
    return [None if i == 15 else i for i in range(len(TEXTS))]


def by_id(rows):
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows) == len(TEXTS)
    return out


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_queries_with_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    cursor = con.execute(oracle.SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    at = [[c[0] for c in cursor.description].index(c) for c in columns]
    plain = lambda v: round(v, 8) if isinstance(v, float) else v
    want = sorted((tuple(plain(r[k]) for k in at) for r in cursor.fetchall()), key=str)
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == columns
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str) == want


def test_op2(spark, folder):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(records.public_tokenizer())
    got = by_id(queries.op2_token_records(spark, folder).collect())
    start = 0
    for i in sorted(range(len(TEXTS)), key=lambda i: -1 if i == 15 else i):
        own = whole.encode(TEXTS[i] or "", add_special_tokens=False).ids + [2]
        r = got[ids()[i]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def brute_spans(texts):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(b[s : s + 100])
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_op3(spark, folder):
    order = sorted(range(len(TEXTS)), key=lambda i: -1 if i == 15 else i)
    want = dict(zip(order, brute_spans([TEXTS[i] for i in order])))
    got = by_id(queries.op3_substring_dedup(spark, folder).collect())
    for i in range(len(TEXTS)):
        r = got[ids()[i]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[i]


def test_op3_long_texts_are_parsed_in_pieces(spark):
    text = LONG[:6000] + prose(300, 5) + LONG[:6000]
    rows = spark.createDataFrame([(1, text), (2, text[500:9000]), (3, "a" * 3000)], "doc_id long, text string")
    out = {r["doc_id"]: bytes(r["kept"]) for r in substrings.remove_repeats(rows, piece=1000).collect()}
    assert [out[i] for i in (1, 2, 3)] == brute_repeats([text, text[500:9000], "a" * 3000])


def test_suffix_arrays_combine_into_classes_in_corpus_order():
    rng = np.random.default_rng(0)
    for _ in range(150):
        m, trigger = int(rng.integers(1, 12)), rng.integers(0, 2, 32).astype(np.uint8)
        group, places, data, want, seen = np.sort(rng.integers(0, 2, m)), [], [], [], set()
        for i in range(m):
            off = int(rng.integers(0, 69))
            n = int(rng.integers(1, off + 2))
            b = np.zeros(n + 99, np.uint8)
            b[rng.integers(0, len(b), int(rng.integers(0, 3)))] = 1
            b[off : off + 32] = trigger
            places.append((1000 * i) << 16 | n << 8 | off)
            data.append(b)
            for s in range(n):
                key = (group[i], off - s, b[s : s + 100].tobytes())
                want += [(i, s)] * (key in seen)
                seen.add(key)
        at, start = substrings.repeated_strings(group, np.array(places), np.concatenate(data), np.cumsum([0, *map(len, data)]))
        assert sorted(zip(at.tolist(), start.tolist())) == sorted(want)


def enumerate_paths(kind, unaimed, clause):
    """Every path through the four machines, one machine after another."""
    found = [([], 1.0)]
    machine = toxicity.choice(kind)
    outputs = [((), 1.0, machine.start)]
    for symbol, word in clause:
        outputs = [(o + (w2,), p * w * (word if w2 == toxicity.HEAD else 1.0), s2) for o, p, s in outputs for w2, w, s2 in machine.arcs.get((s, symbol), ())]
    found = [(o, p) for o, p, s in outputs if s in machine.final]
    for machine in (toxicity.report(), toxicity.negation(), toxicity.target(unaimed)):
        new = []
        for out, p in found:
            states = [((), p, machine.start)]
            for symbol in out:
                states = [(o + (w2,), q * w, s2) for o, q, s in states for w2, w, s2 in machine.arcs.get((s, symbol), ())]
            new += [(o, q) for o, q, s in states if s in machine.final]
        found = new
    return max((p for _, p in found), default=0.0), sum(p for _, p in found)


def test_composed_machine_equals_path_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(300):
        clause = [(int(rng.choice(toxicity.READ)), float(rng.choice([1.0, 0.5]))) for _ in range(int(rng.integers(0, 11)))]
        for machine, kind, unaimed in ((toxicity.INSULTS, toxicity.INSULT, 1.0), (toxicity.THREATS, toxicity.THREAT, toxicity.UNAIMED_THREAT)):
            assert toxicity.paths(machine, clause) == pytest.approx(enumerate_paths(kind, unaimed, clause))


def test_scopes_of_the_grammar():
    """The best path, as the rules say it word by word."""
    rng = np.random.default_rng(2)
    T = toxicity
    for _ in range(300):
        kinds = [int(k) for k in rng.choice(T.READ, int(rng.integers(1, 14)))]
        weights = []
        for i, k in enumerate(kinds):
            if k == T.INSULT:
                quoted = kinds[:i].count(T.QUOTE) % 2
                w = T.REPORTED if quoted or T.REPORT in kinds[:i] else 1.0
                w *= T.NEGATED if T.NEGATION in kinds[max(0, i - T.NEGATION_REACH) : i] else 1.0
                w *= T.AIMED if T.TARGET in kinds[max(0, i - T.TARGET_REACH) : i + T.TARGET_REACH + 1] else 1.0
                weights.append(w)
        assert T.paths(T.INSULTS, [(k, 1.0) for k in kinds]) == pytest.approx((max(weights, default=0.0), sum(weights)))


def test_op4(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train_on(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    got = by_id(queries.op4_toxicity(spark, folder).collect())
    for i, t in zip(ids(), TEXTS):
        r = got[i]
        assert r["held_out"] == (i is not None and crc(i) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5)
        known = [model.lexicon.look(w) for w in toxicity._TOKEN.findall((t or "").lower())]
        clauses = list(toxicity.clauses(toxicity._TOKEN.findall((t or "").lower()), known))
        pairs = [(enumerate_paths(toxicity.INSULT, 1.0, c), enumerate_paths(toxicity.THREAT, toxicity.UNAIMED_THREAT, c)) for c in clauses] if len(clauses) < 50 else None
        if pairs is not None:
            best, total = ([p[k][j] for p in pairs] for k, j in ((0, 0), (0, 1)))
            tbest, ttotal = ([p[1][j] for p in pairs] for j in (0, 1))
            x = [min(sum(total), 4), min(max(best, default=0), 3), min(sum(ttotal), 4), min(max(tbest, default=0), 3), min(sum(max(a, b) >= 0.5 for a, b in zip(best, tbest)), 4), math.log1p(len(known))]
            assert r["score"] == pytest.approx(1 / (1 + math.exp(-float(np.clip(np.dot(x, model.weights[:-1]) + model.weights[-1], -30, 30)))))
    toxic = [i for i in range(17, 137) if (i - 17) % 4 == 0]
    assert np.mean([got[i]["predicted"] for i in toxic]) > 0.9 and not any(got[i]["predicted"] for i in range(17, 137) if i not in toxic)


def brute_interpolation(texts, folds):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", low((t or "").encode())) + [b""] for t in texts]
    pairs = [list(zip([b"", *ws], ws)) for ws in split]

    def count(keep):
        one, two = Counter(), Counter()
        for ws, ps, f in zip(split, pairs, folds):
            if keep(f):
                one.update(ws)
                two.update(ps)
        return one, two

    one, two = count(lambda f: f not in (0, 9))
    n, v = sum(one.values()), len(one)
    cells = Counter()
    level = lambda c: int(math.floor(math.log2(c + 1)))
    for ps, f in zip(pairs, folds):
        if f == 9:
            for a, b in ps:
                r2 = round(8 * math.log2(two[a, b] / one[a] * (v + 1))) if two[a, b] else interpolation.NONE
                r1 = round(8 * math.log2(one[b] / n * (v + 1))) if one[b] else interpolation.NONE
                cells[level(one[a]), r2, r1] += 1
    weights = interpolation.learn_weights(np.array([(*k, c) for k, c in sorted(cells.items())]).reshape(-1, 4))
    one, two = count(lambda f: f != 0)
    n, v = sum(one.values()), len(one)
    out = []
    for ps in pairs:
        total = 0.0
        for a, b in ps:
            w = weights[level(one[a])]
            p = w[1] * one[b] / n + w[2] / (v + 1)
            total += math.log10(p + w[0] * two[a, b] / one[a] if one[a] else p / (1 - w[0]))
        out.append(total)
    return out


def test_op5(spark, folder):
    rows = queries.op5_interpolation(spark, folder).collect()
    got = by_id(rows)
    folds = [0 if i is None else crc(i) % 10 for i in ids()]
    split = [re.findall(rb"[^\x20\x09-\x0D]+", low((t or "").encode())) + [b""] for t in TEXTS]
    counts = Counter(w for ws, f in zip(split, folds) if f for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws, fold, score in zip(ids(), split, folds, brute_interpolation(TEXTS, folds)):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold == 0, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r["score"] == pytest.approx(score)


@pytest.mark.parametrize("bits", [1, 2])
def test_op5_packets_go_through_several_levels(spark, folder, bits):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    one, many = ({r["doc_id"]: [round(r[c], 6) for c in columns[1:]] for r in interpolation.score_texts(docs, **sizes).collect()} for sizes in ({}, {"bucket_bytes": 9000, "part_bytes": 12000, "fan_bits": bits}))
    assert one == many


def test_op7(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    net = langid.train_on(docs)
    got = by_id(queries.op7_language(spark, folder).collect())
    for i, t in zip(ids(), TEXTS):
        r = got[i]
        assert r["held_out"] == (i is not None and crc(i) % 5 == 0)
        if not t or not any(c.isalpha() for c in t):
            assert (r["lang_pred"], r["score"]) == ("und", 1.0)
            continue
        b = t.encode()
        parts = [b[a : a + langid.WINDOW] for a in range(0, len(b), langid.WINDOW)]
        total = sum(len(p) * net.probabilities(net.pooled(np.frombuffer(p.ljust(langid.WINDOW, b"\0"), np.uint8)[None])[0])[0] for p in parts) / len(b)
        assert r["lang_pred"] == net.labels[int(total.argmax())] and r["score"] == pytest.approx(float(total.max()), abs=1e-5)
    assert np.mean([got[i]["lang_pred"] == ("aa" if i < 137 else "bb") for i in range(17, len(TEXTS))]) > 0.95


def test_op8(spark, folder):
    got = by_id(queries.op8_simhash(spark, folder).collect())
    fps = []
    for t in TEXTS:
        w = re.findall(rb"[^\x20\x09-\x0D]+", low((t or "").encode()))
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else [], np.uint64)
        fps.append(sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h)))
    a = np.array(fps, np.uint64)
    part = np.arange(len(a))
    near = np.bitwise_count(a[:, None] ^ a) <= 4
    for _ in range(len(a)):
        part = np.where(near, part, len(a)).min(1)
    least = {p: min(i for i in np.flatnonzero(part == p).tolist() if i != 15) if (part == p).sum() > 1 or p != 15 else None for p in set(part.tolist())}
    for i in range(len(TEXTS)):
        r = got[ids()[i]]
        assert (r["fingerprint"], r["component_id"]) == (f"{fps[i]:016x}", least[int(part[i])])


def test_op9(spark, folder):
    got = by_id(queries.op9_gif(spark, folder).collect())
    for i, t in zip(ids(), TEXTS):
        r, b = got[i], (t or "").encode()
        payload = media.pad(b)
        gif = media.encode_gif(payload)
        _, _, images = media.parse_gif(gif)
        if len(images) < 20:
            assert b"".join(plain_lzw(x.data, 8) for x in images) == payload
        grey = np.bincount(np.frombuffer(payload, np.uint8) >> 5, minlength=8).tolist()
        feature = f"frames={len(images)};delay={10 * len(images)};hist=" + ",".join(map(str, grey * 3))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r["media_bytes"], r["media_sha256"], r["feature"], r["histogram"]) == (len(gif), hashlib.sha256(gif).hexdigest(), feature, grey * 3)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    out = queries.QUERIES[name](spark, empty)
    assert out.count() == 0 and {"doc_id", "phrase"} & set(out.columns)


def test_pipeline_with_awkward_rows(spark, folder, empty):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = docs.dtypes
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, folder), f"test-{name}")
        assert docs.dtypes == schema
        rows = docs.collect()
        assert all((r["row_key"], r["copy"], r["tokens"]) == ("kept", 7.5, 99) for r in rows)
        seen.append({r["doc_id"] for r in rows})
    assert 12 not in seen[0] and None in seen[0]
    assert seen[1] & {0, 1, 2} == {0} and seen[1] & {4, 5} == {4}  # wordless texts and exact copies
    assert not seen[2] & {3, 4, 8, None}  # passages of items 8, 7 and 11, and of the item without an id
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} == seen[3]
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_several_rows_of_an_item_are_one_in_every_chunking(spark):
    docs = spark.createDataFrame([(1, prose(60, 1)), (1, prose(60, 1)), (None, prose(60, 1))], "doc_id long, text string")
    items = spark.createDataFrame([(7, prose(60, 1)), (7, prose(60, 1) + " more"), (8, prose(40, 1)), (None, prose(60, 1))], "item_id long, text string")
    for chunk in (1 << 20, 10):
        out = decontaminate.contamination(docs, items, chunk_bytes=chunk).collect()
        assert len(out) == 3 and all(r["item_ids"] == ["7", "8"] == r["near_ids"] and r["hit_spans"][0]["stop"] == 60 for r in out)


def test_near_matches_against_brute_force(spark):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 40)))) for _ in range(30)]
    items = [" ".join(rng.choice(vocabulary, int(rng.integers(1, 6)))) for _ in range(25)]
    want = []
    for t in texts:
        w = t.split()
        near = {str(k) for k, item in enumerate(items) for s in range(-3, len(w) + 3) for q in [item.split()] if all(x in w[max(0, s + j - 2) : max(0, s + j + 3)] for j, x in enumerate(q))}
        want.append(sorted(near))
    found = decontaminate.contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert [r["near_ids"] for r in sorted(found, key=lambda r: r["doc_id"])] == want


def test_samples_stay_bounded(spark):
    """One id on many rows, ids of two labels, texts that are too long: one row an id, bounded in number and bytes."""
    rows = [(1, f"copy {i}", "a") for i in range(500)] + [(i, f"text {i}", "ab"[i % 2]) for i in range(2, 200)] + [(300, "x", "a"), (300, "x", "b"), (301, "y" * 5000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = sampling.labelled_sample(docs, F.col("lang"), F.lit(True), 1000, 3, text_bytes=1000).collect()
    assert len(out) == len({r["doc_id"] for r in out}) == 200 and max(len(r["text"]) for r in out) <= 1000 and {r["text"] for r in out if r["doc_id"] == 1} == {"copy 0"}
    small = sampling.labelled_sample(docs, F.col("lang"), F.lit(True), 2, 3).collect()
    assert Counter(r["label"] for r in small) == {"a": 2, "b": 2}


@pytest.mark.parametrize("many", [False, True])
def test_mixing_deals_rows_without_ids(spark, monkeypatch, many):
    if many:
        monkeypatch.setattr(mixing, "MANY_SOURCES", 0)
    rows = spark.createDataFrame([(None if i % 2 else 5, "s" if i % 3 else None, f"word {i}") for i in range(2000)], "doc_id long, source string, text string")
    out = mixing.mixture(rows, mixing.Target(entropy=None, repeats=None, block_rows=100))
    assert out.groupBy("source", "block").count().agg(F.max("count")).first()[0] < 200
    assert out.count() == pytest.approx(2000, abs=60) and out.where("source = ''").count() > 500


def test_exponents_meet_their_targets(spark):
    shares = spark.createDataFrame([(p,) for p in (0.7, 0.2, 0.06, 0.04)], "p double")
    p = np.array([0.7, 0.2, 0.06, 0.04])

    def entropy(m):
        w = p**m / (p**m).sum()
        return -(w * np.log(w)).sum()

    [m] = mixing.least_exponents(shares, [lambda t: math.log(t["z"]) - t["m"] * t["e"] / t["z"] <= 0.8 * math.log(t["n"])])
    assert entropy(m) == pytest.approx(0.8 * math.log(4), abs=1e-6)


def test_history_joins_findings_back_to_all_paths(spark, tmp_path):
    path = f"file://{tmp_path}/scan"
    rows = lambda *r: spark.createDataFrame(r, "path string, version string, text string")
    secret_ledger.scan_history(spark, rows(("a", "1", SECRET), ("b", "1", "clean"), ("b", "1", "clean")), path)
    out = {(r["path"], r["version"]): len(r["findings"]) for r in secret_ledger.scan_history(spark, rows(("a", "2", "clean"), (None, "1", None)), path).collect()}
    assert out == {("a", "1"): 4, ("b", "1"): 0, ("a", "2"): 0, (None, "1"): 0}


def test_places_of_many_matches(spark):
    text = "é " + (SECRET + " ") * 400
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secret_ledger.scan_documents(docs).first()["findings"]
    assert len(found) == 1600 and all(re.fullmatch("[0-9a-f]{32,}", text[f["start"] : f["stop"]]) for f in found if f["kind"] == "hex")


def test_crowded_cells_are_dealt_by_more_bits(spark):
    """A ball of fingerprints that overfills its cells at several levels."""
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ sum(1 << b for b in c) for n in (0, 1, 2) for c in itertools.combinations(range(0, 64, 2), n)} | {base ^ 0xFFFFF00000000000, base ^ 0xFFFFF00000000001})
    df = spark.createDataFrame([(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    part = np.arange(len(fps))
    a = np.array(fps, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a) <= 4
    for _ in range(9):
        part = np.where(near, part, len(a)).min(1)
    got = {r["fp"] % 2**64: r["component_id"] for r in simhash.near_duplicates(df, cell_limit=100).collect()}
    assert [got[f] for f in fps] == part.tolist()
    assert simhash.n_blocks(10, 4) == 7 and simhash.n_blocks(4 * 10**10, 4) > 7


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        common.shared_root(Session())


def test_kept_objects_are_made_once():
    made = []
    assert common.kept("one", lambda: made.append(1) or len(made)) == common.kept("one", lambda: made.append(1) or len(made)) == 1


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the synthetic tables")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    rows = queries.op4_toxicity(spark, TABLES).where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.95
    langs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    rows = queries.op7_language(spark, TABLES).where("held_out and lang_pred <> 'und'").join(langs, "doc_id").where("lang is not null").collect()
    assert len(rows) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.97
