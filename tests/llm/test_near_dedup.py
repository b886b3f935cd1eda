import random

from sheafline.llm.components import components
from sheafline.llm.near_dedup import near_duplicates, sketches


def shingles(text, width):
    w = text.encode().lower().split() if text else []
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets, root = {i: shingles(x, width) for i, x in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_every_bin_fills_and_similarity_is_estimated():
    import numpy as np

    one = np.arange(1, 400, dtype=np.uint64) * np.uint64(7919)
    two = np.concatenate([one[:-40], one[-40:] + np.uint64(3)])
    s = sketches([one, two, one[:1], one[:0]], 256)
    assert (s[:3] != np.iinfo(np.uint64).max).all() and (s[3] == np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 359 / 439) < 0.1


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 14)):  # copies with more and less changed words
            copy = [rng.choice(words) if rng.random() < 0.03 else w for w in text]
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    for width in (4, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()}
        assert got == brute(rows, width, 80)


def test_large_group_in_blocks(spark, monkeypatch):
    import sheafline.llm.near_dedup as nd

    monkeypatch.setattr(nd, "BLOCK", 3)
    monkeypatch.setattr(nd, "BROADCAST_IDS", 0)
    rng = random.Random(5)
    text = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice("xyz") + w if rng.random() < 0.02 else w for w in text)) for i in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert got == brute(rows, 4, 80)


def test_odd_rows(odd_documents, no_documents):
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(odd_documents, width=4).collect()]
    assert len(got) == 15
    by = {d: (c, k) for d, c, k in got if d is not None}
    assert by[1] == (1, True) and by[2] == (1, False) and by[3] == (1, False)
    assert all(by[i] == (i, True) for i in (4, 5, 6, 7, 12)) and by[13] == (12, False)
    assert near_duplicates(no_documents).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bucket_of_many_dissimilar_members(spark):
    """3,000 documents share a passage of 60 words and differ in 30 more: most stay apart, a few pairs are linked, no hub links them."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(3000):
        own = [f"o{rng.randrange(4000)}" for _ in range(30)]
        rows.append((i, " ".join(passage + own)))
        if i % 300 == 7:  # the same document with two other words, also far from everybody else
            rows.append((10_000 + i, " ".join([*passage, "x", "y", *own[2:]])))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    linked = {i: i - 10_000 for i, _ in rows if i >= 10_000}
    assert len(linked) == 10 and got == {i: linked.get(i, i) for i, _ in rows}


def test_repeated_ids_of_different_texts(spark):
    base = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(base)), (1, "quite another text of ten words in one line here"), (2, " ".join([*base[:-1], "z"])), (3, "quite another text of ten words in one line here now")]
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
