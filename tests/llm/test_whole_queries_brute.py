"""Whole operators and pipeline stages against brute force."""

import base64
import math
from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from test_lines_mixing_packing import key
from test_near_dedup import brute

from sheafline.llm.fertility import BYTE_RANKS, METRICS, fertility
from sheafline.llm.pieces import PIECE_MODEL
from sheafline.llm.quality import fit, score_quality
from sheafline.llm.token_counts import token_counts
from sheafline.llm.url_filter import judge_urls

SF = "/root/testdata/sf0.001"


def base_figures(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def tokenizers():
    import public_tokenizers
    import sentencepiece
    import tiktoken

    ranks = dict((base64.b64decode(a), int(b)) for a, b in (x.split() for x in open(BYTE_RANKS, "rb")))
    byte_level = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), byte_level


def test_fertility_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    model, byte_level = tokenizers()
    measured = {}
    for r in rows:
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        ids = [i for w in words for i in model.encode(w)]
        chars, n = sum(map(len, words)), max(1, len(ids))
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
        byte_tokens = max(1, sum(len(byte_level.encode_ordinary(" " + w)) for w in words))
        fallback = sum(model.is_byte(i) or model.is_unknown(i) for i in ids) / n
        figures = (chars / n, chars / byte_tokens, fallback, entropy / math.log2(n) if n > 1 else 1.0)
        measured[r["doc_id"]] = (r["lang"], len(ids), dict(zip(METRICS, figures, strict=True)) if words else {})
    bands = {}
    for lang in {r["lang"] for r in rows}:
        for m in METRICS:
            values = sorted(f[m] for own, n, f in measured.values() if own == lang and n >= 80)
            if values:
                low, middle, high = (values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75))
                bands[lang, m] = middle, 5 * max((high - low) / 1.349, 0.02 * middle, 0.002)
    rejected = 0
    got = {r["doc_id"]: r for r in fertility(docs).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g, (lang, n, figures) = got[r["doc_id"]], measured[r["doc_id"]]
        n_words, *_, repeated = base = base_figures(r["text"])
        assert tuple(g[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base
        assert g["n_pieces"] == n and all(math.isclose(g[m], v, abs_tol=1e-9) for m, v in figures.items())
        failed = n_words < 10 or 100 * repeated > 20 * n_words
        beyond = {m: (v - bands[lang, m][0]) * (1 if m == "fallback_share" else -1) - bands[lang, m][1] * math.sqrt(1 + 400 / max(1, n)) for m, v in figures.items() if (lang, m) in bands}
        if all(abs(x) > 1e-9 for x in beyond.values()):
            assert (g["base_failed"], g["kept"]) == (failed, not failed and all(x < 0 for x in beyond.values()))
        rejected += not failed and not g["kept"]
    assert rejected


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def quality_stage(spark, docs):
    model = fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = score_quality(docs.withColumnRenamed("score", "kept_aside") if "score" in docs.columns else docs, model)
    return Counter(tuple(r)[:-1] for r in scored.collect() if r["score"] >= 0.7)


def lines_stage(rows):
    holders = {}
    for r in rows:
        for k in map(key, (r["text"] or "").split("\n")):
            if r["doc_id"] is not None and len(k) >= 20:
                holders.setdefault(k, set()).add(r["doc_id"])
    out = Counter()
    for r in rows:
        lost = [k for k in holders if len(holders[k]) >= 3 and r["doc_id"] is not None and r["doc_id"] < max(holders[k])]
        text = "\n".join(x for x in (r["text"] or "").split("\n") if key(x) not in lost)
        out[r["doc_id"], text, r["lang"], r["source"], len(text)] += 1
    return out


def near_stage(rows):
    found = brute([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None], 5, 80)
    return Counter(tuple(r) for r in rows if r["doc_id"] is None or found[r["doc_id"]][1] == r["doc_id"])


def check_stages(spark, docs):
    """Runs the stages one after another, each judged on its own input; gives the number of rows after each."""
    schema, counts = docs.schema, []

    def take(stage):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        counts.append(out.count())
        return out

    out = take(pipeline.quality_classifier)
    assert rows_of(out) == quality_stage(spark, docs)
    docs = spark.createDataFrame(out.collect(), schema)
    out = take(pipeline.line_dedup)
    assert rows_of(out.select("doc_id", "text", "lang", "source", "n_chars")) == lines_stage(docs.collect())
    docs = spark.createDataFrame(out.collect(), schema)
    out = take(pipeline.near_dedup)
    assert rows_of(out) == near_stage(docs.collect())
    docs = spark.createDataFrame(out.collect(), schema)
    out = take(pipeline.mixing)
    assert set(rows_of(out)) <= set(rows_of(docs)) and rows_of(out) == rows_of(pipeline.mixing(spark, docs, SF))
    docs = spark.createDataFrame(out.collect(), schema)
    packed = pipeline.packing(spark, docs, SF).collect()
    counts.append(len(packed))
    assert Counter((r["doc_id"], r["source"], r["n_tokens"]) for r in packed) == rows_of(token_counts(docs).select("doc_id", "source", "n_tokens"))
    batches = Counter((r["bucket"], r["batch"], r["padded"]) for r in packed)
    assert all(r["n_tokens"] <= r["padded"] for r in packed) and all(n == 1 or n * width <= 65536 for (_, _, width), n in batches.items())
    return counts


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged, lined, single, mixed, packed = check_stages(spark, docs)
    assert docs.count() > judged == lined > single and packed == mixed > 0


def test_stages_on_odd_rows_with_clashing_names(spark, odd_documents):
    judged, lined, single, mixed, packed = check_stages(spark, odd_documents)
    assert odd_documents.count() >= judged == lined >= single and packed == mixed


def test_stages_on_no_rows(spark, no_documents):
    assert check_stages(spark, no_documents) == [0] * 5


def test_repeated_pages_and_a_very_long_url(spark):
    long = "http://b.org/" + "/".join(f"seg{i}" for i in range(400)) + "x" * 20_000
    urls = ["http://a.org/x", "http://a.org/x", long, None, "no host"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in judge_urls(pages, [("block", "a.org", "/")]).collect()}
    assert len(got) == 5 and got[0]["verdict"] == got[1]["verdict"] and got[2]["path"] == long[len("http://b.org") :]
    assert (got[3]["host"], got[4]["path"]) == ("", "") and {r["verdict"] for r in got.values()} <= {"allow", "block"}


def test_token_counts_replace_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, "the river", "old"), (1, "the river", "old"), (2, "the river " * 20_000, None)], "doc_id long, text string, n_tokens string")
    rows = token_counts(docs).orderBy("doc_id").collect()
    assert rows[0] == rows[1] and rows[2]["n_tokens"] == 20_000 * rows[0]["n_tokens"]
    assert token_counts(docs).where(F.lit(False)).count() == 0
