"""The registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import language_id, quality
from sheafline.llm.collocations import collocations
from sheafline.llm.common import fold
from sheafline.llm.fertility import fertility
from sheafline.llm.line_dedup import dedup_lines
from sheafline.llm.mixing import mix_sources
from sheafline.llm.near_dedup import near_duplicates
from sheafline.llm.packing import counted, pack
from sheafline.llm.resampling import importance_resample
from sheafline.llm.token_counts import token_counts
from sheafline.llm.topk import exact_top_k
from sheafline.llm.url_filter import RULES, judge_urls
from sheafline.llm.vector_dedup import vector_links


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = counted(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pack(docs, length=F.col("n_tokens"), buckets=16, budget=65536).select("doc_id", "n_tokens", "bucket", "padded", "rank", "batch")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_table(spark, sf_dir, "documents"), least_chars=20, least_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"), weights=None).select("doc_id", "source", "lang", "text", "copy", "rate", "order_key")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict", F.concat_ws("/", "template").alias("template"), "purity")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def op9_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs.select("doc_id", "text"), quality.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), least=10, longest=3, within=50, first=2000)


def op12_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=5, least_words=20)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_tokeniser_fertility,
        op2_near_duplicates,
        op3_length_buckets,
        op4_line_dedup,
        op5_poisson_mixture,
        op6_language_id,
        op7_url_templates,
        op8_token_counts,
        op9_neighbour_quality,
        op10_top_k,
        op11_phrase_collocations,
        op12_embedding_duplicates,
        op13_importance_resampling,
    )
    return {f.__name__: f for f in (*ops, pipeline)}


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_UNIFORM = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) / 4503599627370496.0"

ORACLE = {
    "op4_line_dedup": f"""WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM s),
 k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM l),
 f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
 j AS (SELECT k.*, coalesce(doc_id < last, false) AS gone FROM k LEFT JOIN f USING (key))
 SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id""",
    "op5_poisson_mixture": f"""WITH RECURSIVE n AS (SELECT coalesce(source, '') AS s, count(*) AS k FROM documents GROUP BY 1),
 q AS (SELECT s, CAST((SELECT sum(k) FROM n) AS DOUBLE) * 1.0 / CAST((SELECT count(*) FROM n) AS DOUBLE) / k AS rate FROM n),
 r AS (SELECT s, rate, greatest(1, CAST(ceil(rate / 64.0) AS BIGINT)) AS draws FROM q),
 c(s, one, i, p, c) AS (SELECT s, rate / draws, 0, exp(-(rate / draws)), exp(-(rate / draws)) FROM r UNION ALL SELECT s, one, i + 1, p * one / (i + 1), c + p * one / (i + 1) FROM c WHERE i < 161),
 d AS (SELECT doc_id, s, rate, unnest(range(draws)) AS j FROM documents JOIN r ON coalesce(source, '') = s),
 u AS (SELECT *, CASE WHEN j = 0 THEN {_UNIFORM.format("doc_id || ':mix-1'")} ELSE {_UNIFORM.format("doc_id || ':' || j || ':mix-1-draw'")} END AS u FROM d),
 m AS (SELECT u.doc_id, any_value(u.rate) AS rate, count(*) FILTER (WHERE c.c <= u.u) AS k FROM u JOIN c USING (s) GROUP BY u.doc_id),
 e AS (SELECT doc_id, rate, CAST(unnest(range(k)) AS INTEGER) AS copy FROM m WHERE k > 0)
 SELECT doc_id, source, lang, text, copy, rate, {_UNIFORM.format("doc_id || ':' || copy || ':mix-1-order'")} AS order_key FROM e JOIN documents USING (doc_id)""",
    "op10_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
 k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
 SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5""",
    "op11_phrase_collocations": rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
 p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM d),
 g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM p
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM p
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM p),
 f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
 n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
 c AS (SELECT *, split_part(phrase, ' ', 1) AS x, split_part(phrase, ' ', 2) AS y, split_part(phrase, ' ', 3) AS z FROM f WHERE k > 1 AND a >= 10),
 o AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, x || ' ' || y AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, y || ' ' || z, a FROM c WHERE k = 3) GROUP BY lang, phrase),
 q AS (SELECT c.*, 1 AS cut, x AS one, CASE WHEN k = 2 THEN y ELSE y || ' ' || z END AS two FROM c UNION ALL SELECT c.*, 2, x || ' ' || y, z FROM c WHERE k = 3),
 s AS (SELECT q.lang, q.k, q.phrase, q.a, cut, i.a AS l, j.a AS r, CAST(1000000 * CAST(q.a AS HUGEINT) * q.a // (CAST(i.a AS HUGEINT) * j.a) AS BIGINT) AS score
  FROM q JOIN f AS i ON i.lang = q.lang AND i.phrase = one JOIN f AS j ON j.lang = q.lang AND j.phrase = two),
 b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS least FROM s),
 t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN o ON b.k = 2 AND o.lang = b.lang AND o.phrase = b.phrase
  WHERE least = 1 AND coalesce(100 * longer < 50 * a, true))
 SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_embedding_duplicates": """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v AS x JOIN v AS y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
 r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
 n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
 c AS (SELECT a, min(b) AS least FROM r GROUP BY a)
 SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id, vec_id <= coalesce(c.least, vec_id) AS kept
 FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
