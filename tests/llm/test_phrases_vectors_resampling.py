"""Phrase collocations, near-duplicate vectors and importance resampling against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from sheafline.llm import collocations as c
from sheafline.llm import resampling as r
from sheafline.llm import vector_dedup as v

SF = "/root/testdata/sf0.001"


def lower(s):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in s)


# ---- phrases ---------------------------------------------------------------------------------------


def grams(text):
    """Counts of runs of one to three words within pieces."""
    out = Counter()
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
        w = re.findall(r"[^\x20\x09]+", piece)
        out.update(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return out


def brute_collocations(rows, least=10, within=50, first=2000):
    by_lang = defaultdict(Counter)
    for text, lang in rows:
        by_lang["und" if lang is None else lang].update(grams(text))
    out = []
    for lang, f in by_lang.items():
        n = sum(a for p, a in f.items() if " " not in p)
        often = {p: a for p, a in f.items() if " " in p and a >= least}
        inside = {q for p, a in often.items() if p.count(" ") == 2 for q in (p.rsplit(" ", 1)[0], p.split(" ", 1)[1]) if 100 * a >= within * often[q]}
        found = []
        for p, a in often.items():
            w = p.split(" ")
            cuts = [(10**6 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            if p not in inside:
                found.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def phrases(df):
    return sorted(tuple(x[k] for k in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in df.collect())


def test_collocations_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute_collocations([(x["text"], x["lang"]) for x in docs.select("text", "lang").collect()])
    assert expected and phrases(c.collocations(docs.repartition(5))) == expected


def test_collocations_of_odd_rows(spark, odd_documents, no_documents):
    rows = [(x["text"], x["lang"]) for x in odd_documents.collect()]
    for least in (2, 3):
        assert phrases(c.collocations(odd_documents, least=least)) == brute_collocations(rows, least)
    assert c.collocations(no_documents).count() == 0 and c.collocations(no_documents).columns[:3] == ["lang", "rank", "phrase"]


def test_pieces_ties_and_dropped_phrases(spark):
    texts = ["new york city. NEW york\tcity, new york", "a a a a;b\x0bb b", "new york", "x y z x y z", "À À à", None, "", "...", "one two three"]
    rows = [(t, None if i % 2 else "en") for i, t in enumerate(texts)] * 3
    docs = spark.createDataFrame([(i, *x, 1) for i, x in enumerate(rows)], "doc_id long, text string, lang string, n int")
    for least, first in ((3, 2000), (6, 2), (2, 1)):
        assert phrases(c.collocations(docs, least=least, first=first)) == brute_collocations(rows, least, first=first)
    two = phrases(c.collocations(docs, least=3, longest=2))
    assert two and all(x[2].count(" ") == 1 for x in two)


def test_no_task_ranks_a_whole_language(spark, monkeypatch):
    monkeypatch.setattr(c, "RANKED", 50)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute_collocations([(x["text"], x["lang"]) for x in docs.select("text", "lang").collect()], 3, first=12)
    assert phrases(c.collocations(docs, least=3, first=12)) == expected


def test_segments_and_stretches_change_no_count(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a ", "b ", "cc ", ". ", "\n", "d"]) for _ in range(rnd.randint(0, 400))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"en"] * len(texts)), pa.array([t.encode() for t in texts])], ["lang", "text"])

    class All:
        value = np.full(c.FILTER_BITS // 8 + 8, 255, np.uint8)

    def counted():
        out = Counter()
        for level in (1, 2, 3):
            for b in c._level(level, All, All)(iter([batch])):
                for p, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    out[p] += n
        return out

    expected = sum((grams(t) for t in texts), Counter())
    assert counted() == expected
    monkeypatch.setattr(c, "SEGMENT_WORDS", 50)
    monkeypatch.setattr(c, "RUN_BYTES", 30)
    assert counted() == expected


def test_filters_let_every_frequent_phrase_through(spark):
    words = [f"w{i}é" for i in range(300)]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    sums = {w: crc32(w.encode()) for w in words}
    one = c.phrase_filter(spark.createDataFrame([("fr", w) for w in words], "lang string, phrase string"), 1)
    two = c.phrase_filter(spark.createDataFrame([("fr", p) for p in pairs], "lang string, phrase string"), 2)
    every = np.array([sums[w] for w in words], np.int64)
    assert c.in_filter(one, b"fr", every).all() and c.in_filter(two, b"fr", every[:-1], every[1:]).all()
    assert c.in_filter(one, b"de", every).sum() < 5 and c.in_filter(two, b"fr", every[1:], every[:-1]).sum() < 5


# ---- vectors ---------------------------------------------------------------------------------------


def brute_links(rows, cosine=0.93):
    """(id, links, component) of (id, vector, label) rows; equal rows are one vector."""
    good = {}
    for i, x, label in rows:
        if i is not None and x is not None and label is not None and len(x) and all(y is not None and math.isfinite(y) for y in x) and any(x):
            y = np.array(x) / max(map(abs, x))
            good[i, tuple(x), label] = y / np.linalg.norm(y)
    keys, root = list(good), {k: k for k in good}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    n = Counter()
    for label, size in {(k[2], len(k[1])) for k in keys}:
        own = [k for k in keys if k[2] == label and len(k[1]) == size]
        x = np.array([good[k] for k in own])
        met = x @ x.T >= cosine
        np.fill_diagonal(met, False)
        for a, k in enumerate(own):
            n[k] = int(met[a].sum())
            for b in np.flatnonzero(met[a]):
                root[find(k)] = find(own[b])
    least = {}
    for k in keys:
        least[find(k)] = min(least.get(find(k), k[0]), k[0])
    named = [(i, tuple(x), label) if x is not None else None for i, x, label in rows]
    return Counter((i, n[k], least[find(k)]) if k in good else (i, 0, i) for (i, _, _), k in zip(rows, named, strict=True))


def links(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, y, "clash", 7) for i, x, y in rows], "vec_id long, embedding array<double>, label int, kept string, n_links int")
    got = v.vector_links(df, **kw).collect()
    assert all(x["kept"] == (None if x["vec_id"] is None else x["vec_id"] == x["component_id"]) for x in got)
    return Counter((x["vec_id"], x["n_links"], x["component_id"]) for x in got)


def near(rng, centre, n, spread):
    return (centre + spread * rng.normal(size=(n, len(centre))) / math.sqrt(len(centre))).tolist()


def test_links_of_clusters_at_all_distances(spark):
    rng, vectors = np.random.default_rng(4), []
    for spread in (0.02, 0.1, 0.2, 0.26, 0.3, 0.36):
        for _ in range(4):
            x = rng.normal(size=40)
            vectors += near(rng, x / np.linalg.norm(x), 25, spread)
    vectors += rng.normal(size=(300, 40)).tolist()
    rows = [(int(i) * 3 + 1, x, k % 3) for k, (i, x) in enumerate(zip(rng.permutation(len(vectors)), vectors, strict=True))]
    expected = brute_links(rows)
    assert sum(n for _, n, _ in expected) > 1000 and links(spark, rows) == expected


def test_links_within_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=64)
    rows = [(i, y, 1) for i, y in enumerate(near(rng, x / np.linalg.norm(x), 700, 0.15) + near(rng, x / np.linalg.norm(x), 60, 0.27) + [x.tolist()] * 150 + rng.normal(size=(100, 64)).tolist())]
    assert links(spark, rows) == brute_links(rows)


def test_odd_vectors(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -2.0, 1.0]
    rows = [(1, a, 1), (2, a, 1), (2, a, 1), (3, [2.0, 4.0, 6.0], 1), (4, [1e300, 2e300, 3e300], 1), (5, [1e-300, 2e-300, 3e-300], 1), (6, a, 2), (7, a, None), (8, None, 1), (9, [], 1), (10, [0.0, -0.0, 0.0], 1)]
    rows += [(11, [1.0, None, 3.0], 1), (12, [1.0, float("nan"), 3.0], 1), (13, [1.0, float("inf"), 3.0], 1), (None, a, 1), (14, [*a, 0.0], 1), (15, [x / 7 for x in range(130)], 1), (16, [x / 7 for x in range(130)], 1), (20, b, 1), (0, b, 1), (20, a, 1)]
    assert links(spark, rows) == brute_links(rows)
    assert links(spark, []) == Counter()


def test_tables_miss_no_pair_at_the_threshold():
    for width, rows in ((64, 1000), (64, 10**6), (256, 5000)):
        hashes, probes, tables = v.plan_tables(width, rows, 0.93)
        rng = np.random.default_rng(9)
        x, y = (z / np.linalg.norm(z, axis=1, keepdims=True) for z in rng.normal(size=(2, 3000, width)))
        y -= (x * y).sum(1, keepdims=True) * x
        y = 0.93 * x + math.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
        met = np.zeros(len(x), bool)
        for t in range(tables):
            p, q = v.table_keys(x, t, hashes, probes), v.table_keys(y, t, hashes, probes)
            met |= (p == q[:, :1]).any(1) | (q == p[:, :1]).any(1)
        assert met.all()
        differ = [bin(int(m)).count("1") for m in np.bitwise_xor(v.signatures(x), v.signatures(y)).view(np.uint64).ravel()]
        assert max(differ[i] + differ[i + 1] for i in range(0, len(differ), 2)) <= v.signature_limit(math.acos(0.93))


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(20, 128))
    assert np.allclose(np.linalg.norm(v.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1)) and np.allclose(v.hadamard(v.hadamard(x)), x)
    with pytest.raises(ValueError, match="cosine"):
        v.vector_links(None, cosine=1.5)


# ---- resampling ------------------------------------------------------------------------------------


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return len(w), [crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(docs, target, percent=5):
    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(h for _, _, f in own for h in f), Counter(h for x in target for h in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (n_s + 10_000) / ((s[k] + 1) * (n_t + 10_000)))) for k in range(10_000)]
    out = []
    for i, n, f in own:
        weight = sum(gain[k] for k in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(f), weight, score, None])
    able = sorted((x for x in out if x[0] is not None and x[1] >= 20), key=lambda x: (-x[4], x[0], -x[3], -x[2]))
    for k, x in enumerate(able[: percent * len(able) // 100], 1):
        x[5] = k
    return Counter(map(tuple, out))


def resampled(df):
    return Counter(tuple(x[k] for k in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for x in df.collect())


def test_resampling_documents(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute_resample([(x["doc_id"], x["text"]) for x in docs.collect()], [x["text"] for x in target.collect()])
    assert sum(x[5] is not None for x in expected) > 5 and resampled(r.importance_resample(docs.repartition(7), target)) == expected


def test_resampling_odd_rows(spark, odd_documents, no_documents):
    target = spark.createDataFrame([("the river Stone word3",), (None,), ("",)], "text string")
    rows = [(x["doc_id"], x["text"]) for x in odd_documents.collect()]
    for percent in (5, 50, 100):
        assert resampled(r.importance_resample(odd_documents, target, percent)) == brute_resample(rows, ["the river Stone word3"], percent)
    assert resampled(r.importance_resample(odd_documents, target.limit(0), 40)) == brute_resample(rows, [], 40)
    assert r.importance_resample(no_documents, target).count() == 0


def test_long_texts_are_read_in_stretches(monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["Ab", "é", "7", " ", "-", "日本", "x" * 30]) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    for size in (1_000_000, 1, 7, 40):
        monkeypatch.setattr(r, "RUN_BYTES", size)
        for t in texts:
            n, hashes = r.feature_hashes(t.encode(), 3)
            assert (n, sorted(h % 10_000 for h in hashes)) == (features(t)[0], sorted(features(t)[1]))
