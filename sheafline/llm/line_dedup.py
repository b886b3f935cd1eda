"""Corpus-wide line de-duplication in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import join_with_hot, neutral_names, stored

#: White space that is stripped from a line's ends: tab, line feed, vertical tab, form feed, return, space.
BLANKS = " \t\n\u000b\f\r"


def line_keys(text: Column) -> Column:
    """array<string>: the key of each line, stripped at both ends and A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.split(lower, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))


def _hashed(text: Column, least: int) -> Column:
    """array<struct<a,b>>: 128-bit hash of each line's key; null where the key is shorter than ``least``."""
    pair = lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))
    return F.transform(line_keys(text), lambda k: F.when(F.char_length(k) >= least, pair(k)))


@neutral_names
def dedup_lines(documents: DataFrame, least_chars: int = 20, least_docs: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with its text reduced, and n_lines and n_dropped (long) added.

    A line whose key (stripped, lower-cased) has at least ``least_chars`` code points and
    stands in at least ``least_docs`` documents stays only in the largest id that holds it.
    Other lines stay and are joined by \\n in their order.

    Lines become 16-byte hashes, written once with their positions before anything is shuffled. Documents per hash are counted
    by two map-side combined aggregations (first a row for each hash and document), so no
    hash brings its documents together; frequent hashes are joined back to their positions, by a broadcast where
    they hold a thousandth of all such lines or more (so at most 1000 hashes); texts move once, and the
    kept stretches between dropped positions are put together again in order. Very long texts are split whole in their own row.

    Null texts give '' and count as one empty line. Rows with a null id keep all lines.
    Rows that share an id count as one document, and lose or keep a line together. Extra
    columns pass through; columns n_lines and n_dropped are replaced. An empty table gives no rows.
    """
    docs = documents.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))
    own, whole = F.col(doc_id), F.col(text)
    seen = docs.where(own.isNotNull()).select(own.alias("_d"), F.xxhash64(whole).alias("_t"), F.posexplode(_hashed(whole, least_chars)).alias("_pos", "_h")).where("_h is not null")
    seen = stored(seen.select("_d", "_t", "_pos", F.col("_h.a").alias("_a"), F.col("_h.b").alias("_b")), "lines")
    frequent = seen.select("_d", "_a", "_b").distinct().groupBy("_a", "_b").agg(F.count("*").alias("_n"), F.max("_d").alias("_last")).where(F.col("_n") >= least_docs)
    frequent = stored(frequent, "frequent-lines")
    dropped = join_with_hot(seen, frequent, ["_a", "_b"], F.col("_n") * 1000 >= seen.count()).where("_d < _last")
    dropped = dropped.groupBy("_d", "_t").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))  # at most the lines of one document
    out = docs.withColumn("_text", whole).join(dropped, (own == F.col("_d")) & (F.xxhash64(whole) == F.col("_t")), "left").drop("_d", "_t")
    lines, gone = F.split(F.col("_text"), "\n", -1), F.coalesce("_gone", F.array().cast("array<int>"))
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    stretches = F.zip_with(starts, F.concat(gone, F.array(F.size(lines))), lambda a, b: F.slice(lines, a + 1, b - a))
    out = out.withColumn("n_lines", F.size(lines).cast("long")).withColumn("n_dropped", F.size(gone).cast("long"))
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.flatten(stretches), "\n")))
    return out.drop("_gone", "_text")
