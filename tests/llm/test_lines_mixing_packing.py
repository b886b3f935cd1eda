import itertools
import math
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafline.llm.line_dedup import dedup_lines
from sheafline.llm.mixing import mix_sources
from sheafline.llm.packing import optimal_boundaries, pack

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def test_lines_against_brute_force(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_documents.collect()]
    holders = {}
    for d, text in rows:
        for line in text.split("\n"):
            if d is not None and len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(d)
    expected = Counter()
    for d, text in rows:
        kept = [x for x in text.split("\n") if d is None or not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and d < max(holders[key(x)]))]
        expected[(d, len(text.split("\n")), len(text.split("\n")) - len(kept), "\n".join(kept))] += 1
    out = dedup_lines(odd_documents)
    assert out.columns[:7] == odd_documents.columns
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == expected
    assert any(k[2] for k in expected)
    assert dedup_lines(no_documents).count() == 0


def test_mixture_follows_the_distribution(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, None).otherwise("c").alias("source"))
    got = mix_sources(docs, {"a": 3.0, "": 1.0}, total=20_000)
    n = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert set(n) == {"a", None} and abs(n["a"] - 15_000) < 500 and abs(n[None] - 5_000) < 300
    times = Counter(got.where("source = 'a'").groupBy("doc_id").count().groupBy("count").agg(F.count("*").alias("n")).rdd.map(lambda r: (r[0], r[1])).collectAsMap())
    for k in (1, 2, 3, 4):  # rate 3 over 5,000 documents
        assert abs(times[k] / 5_000 - math.exp(-3) * 3**k / math.factorial(k)) < 0.03
    again = mix_sources(docs.repartition(7), {"a": 3.0, "": 1.0}, total=20_000)
    pairs = lambda d: sorted((r["doc_id"], r["copy"]) for r in d.select("doc_id", "copy").collect())
    assert pairs(got) == pairs(again)
    order = [r["order_key"] for r in got.collect()]
    assert order == sorted(order)


def test_mixture_of_a_source_of_few_rows(spark):
    """Ten of 20,000 rows are to make up half of the result: 1,000 repetitions each."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 10, "few").otherwise("many").alias("source"))
    got = mix_sources(docs)
    times = {r["doc_id"]: r["n"] for r in got.where("source = 'few'").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("d"), F.max("copy").alias("m")).where("n = d and m = n - 1").collect()}
    assert len(times) == 10 and all(abs(n - 1_000) < 6 * math.sqrt(1_000) for n in times.values()) and len(set(times.values())) > 5
    assert abs(sum(times.values()) - 10_000) < 500 and abs(got.count() - 20_000) < 1_000
    assert got.where("source = 'few' and abs(rate - 1000) > 1e-6").count() == 0
    held = mix_sources(docs, max_rate=64.0).where("source = 'few'").count()
    assert abs(held - 640) < 6 * math.sqrt(640)


def test_mixture_of_odd_rows(odd_documents, no_documents):
    got = mix_sources(odd_documents)
    assert set(odd_documents.columns) <= set(got.columns) and got.count() > 0
    assert mix_sources(odd_documents, {}).count() == 0 and mix_sources(odd_documents, {"nowhere": 1.0}).count() == 0
    assert mix_sources(no_documents).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 20)), min_size=1, max_size=8, unique_by=lambda x: x[0]), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    lengths, counts = map(list, zip(*sorted(histogram), strict=True))

    def cost(ends):
        return sum(c * min(e for e in ends if e >= n) for n, c in zip(lengths, counts, strict=True))

    best = min(cost([*c, lengths[-1]]) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k))
    ends = optimal_boundaries(lengths, counts, buckets)
    assert len(ends) <= buckets and cost(ends) == best


def test_long_documents_get_exact_boundaries(spark):
    lengths = [1, 2050, 2051, 99_999, 100_003, 100_003]
    rows = pack(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long"), length=F.col("n"), buckets=3, budget=200_000).collect()
    assert {(r["n_tokens"], r["padded"]) for r in rows} == {(1, 1), (2050, 2051), (2051, 2051), (99_999, 100_003), (100_003, 100_003)}


def test_hot_lines_and_clashing_names(spark):
    """One line in every document, and a column named like a result."""
    rows = [(i, f"the same long line stands in all of them\nown line {i}", 5) for i in range(3000)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines int")).orderBy("doc_id").collect()
    assert all(r["text"] == f"own line {r['doc_id']}" and (r["n_lines"], r["n_dropped"]) == (2, 1) for r in got[:-1])
    assert got[-1]["text"] == rows[-1][1] and got[-1]["n_dropped"] == 0


def test_mixture_of_many_sources_by_shuffle(spark, monkeypatch):
    import sheafline.llm.mixing as m

    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2000)).alias("source"), F.lit(7).alias("rate"))
    pairs = lambda d: sorted((r["doc_id"], r["copy"], r["rate"]) for r in d.select("doc_id", "copy", "rate").collect())
    expected = pairs(mix_sources(docs))
    monkeypatch.setattr(m, "BROADCAST_SOURCES", 10)
    assert pairs(mix_sources(docs)) == expected and len(expected) > 4_000


def test_packing(odd_documents, no_documents, monkeypatch):
    import sheafline.llm.packing as p

    monkeypatch.setattr(p, "SPAN", 2)
    rows = pack(odd_documents, length=F.length("text"), buckets=3, budget=1000).collect()
    assert len(rows) == 15
    for b in {r["bucket"] for r in rows}:
        own = [r for r in rows if r["bucket"] == b]
        assert sorted(r["rank"] for r in own) == list(range(len(own)))
        fit = max(1, 1000 // max(1, own[0]["padded"]))
        assert all(r["n_tokens"] <= r["padded"] and r["batch"] == r["rank"] // fit for r in own)
    assert pack(no_documents).count() == 0


def test_packing_by_exact_token_counts(spark, odd_documents):
    import corpus_pipeline
    from sheafline.llm.queries import op3_length_buckets
    from sheafline.llm.token_counts import token_counts

    sf = "/root/testdata/sf0.001"
    for docs, got in ((spark.read.parquet(f"{sf}/documents.parquet"), op3_length_buckets(spark, sf)), (odd_documents, corpus_pipeline.packing(spark, odd_documents, sf))):
        true = Counter((r["doc_id"], r["n_tokens"]) for r in token_counts(docs.select("doc_id", "text")).collect())
        rows = got.collect()
        assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == true
        held = Counter()
        for r in rows:
            assert r["n_tokens"] <= r["padded"]
            held[r["bucket"], r["batch"], r["padded"]] += 1
        assert all(n == 1 or n * padded <= 65536 for (_, _, padded), n in held.items() if padded)
