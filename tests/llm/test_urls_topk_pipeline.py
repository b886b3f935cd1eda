import math

import numpy as np
from pyspark.sql import functions as F

from sheafline.llm.topk import exact_top_k
from sheafline.llm.url_filter import RULES, host, judge_urls, path

URLS = "page_id long, url string, verdict string"


def test_url_parts(spark):
    rows = spark.createDataFrame([("http://A.b/c/d?x#y",), ("x://H",), ("no scheme/a",), (None,), ("s://h?q/r",), ("a://b://c/d",)], "u string")
    assert [(r[0], r[1]) for r in rows.select(host(F.col("u")), path(F.col("u"))).collect()] == [("a.b", "/c/d"), ("h", ""), ("", ""), ("", ""), ("h", ""), ("b:", "//c/d")]


def test_rules(spark):
    urls = ["https://x.net/a", "https://y.example.net/en/1", "https://example.com/de/", "http://q.org/fr/1", "http://example.org/en/1", None, "https://xexample.com/de/1", "https://z.net"]
    got = [(r["rule"], r["verdict"]) for r in judge_urls(spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], URLS), RULES).orderBy("page_id").collect()]
    assert got == [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert judge_urls(spark.createDataFrame([], URLS), RULES).count() == 0


def test_templates_learn_from_labelled_pages(spark):
    """On one host /a/<number> is blocked by rules on single pages, /b/<number> is not: other pages follow their template."""
    urls = [f"http://h.com/a/{i}" for i in range(80)] + [f"http://h.com/b/{i}" for i in range(80)]
    rules = [("block", "h.com", f"/a/{i}") for i in (1, 2, 3, 4, 5, 6, 7)] + [("allow", "h.com", f"/b/{i}") for i in (1, 2, 3, 4, 5, 6, 7)]
    got = judge_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], URLS), rules)
    seen = {(r["url"][13], r["verdict"], r["rule"] is None) for r in got.collect()}
    assert ("a", "block", True) in seen and ("b", "allow", True) in seen and ("a", "allow", True) not in seen and ("b", "block", True) not in seen


def test_width_of_a_node_changes_no_verdict(spark):
    """A host with two blocked sections beside 150 or 400 sections without labels: only the blocked ones are blocked."""
    names = ["".join("abcdefghij"[int(c)] for c in str(i)) for i in range(1000, 1400)]
    for width in (150, 400):
        urls = [f"https://w.example.com/{s}/{page}" for s in ("de", "xx") for page in ("a", "b") for _ in range(50)] + [f"https://w.example.com/{s}/{page}" for s in names[:width] for page in ("a", "b")]
        got = judge_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], URLS), [*RULES, ("block", "example.com", "/xx/")]).collect()
        assert {r["path"].split("/")[1] for r in got if r["verdict"] == "block"} == {"de", "xx"} and len(got) == len(urls)


def brute(rows, k, every):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for q, a in sorted(fine):
        if q % every or q in done:
            continue
        done.add(q)
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in fine if i != q and len(b) == len(a))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    import sheafline.llm.topk as topk

    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.1 * rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]  # ties
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] + [0.0] * 7), (403, [float("inf")] + [0.0] * 7), (None, rows[0][1]), (450, [1e4] * 8)]
    got = exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, every=10, pivots=8)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 10)


def test_top_k_of_huge_components_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4) * scale]) for i, scale in enumerate([1.0] * 20 + [3e7] * 20 + [1e16] * 10 + [1e200] * 3 + [1e-3] * 7)]
    rows += [(10, [9.0, 9.0, 9.0, 9.0]), (20, rows[20][1]), (30, []), (31, []), (32, [1e16] * 4), (40, [float("inf")] * 4), (50, [1.0, None, 2.0, 3.0])]
    got = sorted(tuple(r) for r in exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=10, pivots=5).collect())
    held = lambda x: max(-(2**63), min(2**63 - 1, x))
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if all(x is not None and math.isfinite(256 * x) for x in v)]
    expected = []
    for q in sorted({i for i, _ in fine if i % 10 == 0}):
        a = min(([float(x) for x in v], v) for i, v in fine if i == q)[1]
        scores = sorted((-held(sum(x * y for x, y in zip(a, b, strict=True))), i) for i, b in fine if i != q and len(b) == len(a))
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(expected) and any(abs(s) > 2**62 for *_, s in got)


def test_top_k_of_few(spark):
    schema = "vec_id long, embedding array<float>, score long"
    two = spark.createDataFrame([(0, [1.0, 0.5], 9), (7, [0.25, 2.0], 9)], schema)
    assert [tuple(r) for r in exact_top_k(two).collect()] == [(0, 1, 7, 256 * 64 + 128 * 512)]
    assert exact_top_k(spark.createDataFrame([], schema)).count() == 0 and exact_top_k(two.limit(1)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = docs
    counts = []
    for _, f in p.STAGES[:-1]:
        stage = spark.createDataFrame(f(spark, stage, sf).collect(), docs.schema)
        assert stage.columns == docs.columns
        counts.append(stage.count())
    last = p.STAGES[-1][1](spark, stage, sf)
    assert counts[0] < docs.count() and counts[1] == counts[0] and counts[2] < counts[1] and last.count() == counts[3]
    assert sorted(r["doc_id"] for r in p.run(spark, sf).collect()) == sorted(r["doc_id"] for r in last.collect())
