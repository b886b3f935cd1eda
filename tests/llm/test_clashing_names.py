"""Columns whose names begin like the operators' own temporary ones keep their values."""

import pytest
from pyspark.sql import functions as F

from sheafline.llm import language_id
from sheafline.llm.line_dedup import dedup_lines
from sheafline.llm.mixing import mix_sources
from sheafline.llm.packing import pack
from sheafline.llm.quality import fit, score_quality
from sheafline.llm.token_counts import token_counts
from sheafline.llm.url_filter import RULES, judge_urls

CLASH = ["_d", "_s", "_bytes", "_h", "_segs", "_label", "_ruled", "_span", "_before", "_r", "_n", "_t", "_pos", "_a", "_b", "_last", "_gone", "_text", "_w", "_rows", "_draws", "_cdf", "own0"]
LINE = "this line stands in several documents of the set"


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame([(i, f"{LINE}\nown line {i}", "en", f"s{i % 2}", f"http://h{i % 2}.org/a/{i}") for i in range(6)], "doc_id long, text string, lang string, source string, url string")
    return docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in CLASH])


OPERATORS = {
    "dedup_lines": lambda d, spark: dedup_lines(d),
    "mix_sources": lambda d, spark: mix_sources(d, total=60.0),
    "token_counts": lambda d, spark: token_counts(d),
    "pack": lambda d, spark: pack(d),
    "judge_urls": lambda d, spark: judge_urls(d, RULES),
    "identify": lambda d, spark: language_id.identify(d, language_id.fit(d.select("doc_id", "text", "lang"))),
    "score_quality": lambda d, spark: score_quality(d, fit(d.select("doc_id", "text"), spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_values_are_kept(spark, rows, name):
    got = OPERATORS[name](rows, spark).collect()
    assert got and all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in CLASH)


def test_a_clashing_column_may_be_worked_on(spark, rows):
    named = rows.withColumnRenamed("doc_id", "_id").withColumnRenamed("text", "_body")
    out = {r["_id"]: r["n_dropped"] for r in dedup_lines(named, 20, 3, doc_id="_id", text="_body").collect()}
    assert out == {i: int(i < 5) for i in range(6)}
