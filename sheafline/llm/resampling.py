"""Importance resampling towards a target distribution of hashed word runs."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import slices, stored, text_bytes

#: A-Z become lower case; bytes that belong to no word become spaces. Bytes from 0x80 on (all characters beyond ASCII) are of words.
CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of a text whose words are held at once.
RUN_BYTES = 1_000_000


def word_runs(text: bytes | None, before: int) -> Iterator[tuple[list[bytes], int]]:
    """(words, how many of them were given before): the words of a text, a stretch at a time, each after the ``before`` last ones of the stretch in front."""
    text, at, words = text or b"", 0, []
    while at < len(text):
        clean = text[at : at + RUN_BYTES].translate(CLEAN)
        end = len(clean)
        if at + end < len(text):  # a word goes on: the next stretch begins with it, unless it fills this one
            end = clean.rfind(b" ") + 1
            if not end:
                rest = text[at:].translate(CLEAN)
                clean, end = rest, rest.find(b" ") + 1 or len(rest)
        kept = words[max(0, len(words) - before) :]
        words = kept + clean[:end].split()
        at += end
        if len(words) > len(kept):
            yield words, len(kept)


def feature_hashes(text: bytes | None, orders: int) -> tuple[int, list[int]]:
    """How many words a text has, and the crc32 of each run of 1 to ``orders`` of its words joined by one space, repeats included."""
    n, out = 0, []
    for words, old in word_runs(text, orders - 1):
        n += len(words) - old
        spaced = [b" " + w for w in words]
        runs = list(map(crc32, words))
        out += runs[old:]
        for k in range(1, orders):  # a run's checksum goes on from that of the run without its last word
            runs = list(map(crc32, spaced[k:], runs[: len(words) - k]))
            out += runs[max(0, old - k) :]
    return n, out


def _hashed(batch: pa.RecordBatch, at: int, orders: int, buckets: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words of each text, features of each text, and the bucket of every feature, text after text."""
    n_words, n_features, chunks = [], [], []
    for text in batch.column(at).to_pylist():
        n, hashes = feature_hashes(text, orders)
        n_words.append(n)
        n_features.append(len(hashes))
        chunks.append((np.array(hashes, np.uint32) % np.uint32(buckets)).astype(np.int32))
    return n_words, np.array(n_features, np.int64), np.concatenate(chunks) if chunks else np.empty(0, np.int32)


def bucket_counts(texts: DataFrame, orders: int = 3, buckets: int = 10_000, text: str = "text") -> np.ndarray:
    """Features in each bucket over all texts (int64): every partition gives one np.bincount vector, a tree of tasks adds them up.

    The driver receives about as many vectors as the square root of the number of partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            total += np.bincount(_hashed(batch, 0, orders, buckets)[2], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    context = texts.sparkSession.sparkContext
    vectors = texts.select(text_bytes(text).alias("text")).mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(r[0], np.int64))
    none = context.parallelize([0], 1).map(lambda _: np.zeros(buckets, np.int64))  # there may be no partition at all
    return context.union([vectors, none]).treeReduce(np.add)


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier a bucket is in the target), with one feature more in every bucket of either, in doubles."""
    s, t, n = own.sum() + len(own), target.sum() + len(target), len(own)
    return np.array([math.floor(1000 * math.log((float(target[i]) + 1) * float(s) / ((float(own[i]) + 1) * float(t)))) for i in range(n)], np.float64)


def noise(doc_id: Column, seed: int) -> Column:
    """floor of 1000 times a Gumbel number that sha256 of seed and id gives."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(
    documents: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, orders: int = 3, buckets: int = 10_000, seed: int = 42, doc_id: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``documents``, all long.

    Features are runs of 1 to ``orders`` words, hashed into ``buckets``. A bucket's gain tells how much likelier it is in ``target``
    than in ``documents``; a document's weight is the sum of its features' gains, its score that weight plus hashed
    Gumbel noise, so that the highest scores are a draw without replacement in proportion to exp(weight / 1000). Of the
    documents with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are drawn; rank counts them from 1, the others have null.

    Two Arrow passes over the texts: one counts (:func:`bucket_counts`), one sums gains, broadcast as one vector of ``buckets``
    numbers. Ranks come from a sort by ranges of (score, doc_id), whose partitions are numbered inside and shifted by the
    sizes of those before: no task sees more than its range, the broadcast has a row for each range.

    Null and empty texts have no words, features or weight. Rows without an id have null score and rank and
    don't count among those drawn from. Rows that share an id share their noise and are drawn each; ties go to the smaller id, and
    among rows of one id and score to the greater weight and more features. Very long texts are read whole, a stretch at a
    time. Further columns are ignored. An empty table gives no rows; an empty target has one feature in every bucket.
    """
    gains = bucket_gains(bucket_counts(documents, orders, buckets, text), bucket_counts(target, orders, buckets, target_text))
    shared = documents.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, features, hashed = _hashed(batch, 1, orders, buckets)
            owner = np.repeat(np.arange(batch.num_rows), features)
            weights = np.bincount(owner, weights=shared.value[hashed], minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weights))], ["doc_id", "n_words", "n_features", "weight"])

    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    weighted = docs.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    scored = stored(weighted.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    able = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features")]
    numbered = scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    numbered = stored(numbered, "numbered")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each range
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    drawn = numbered.count() * percent // 100
    ranked = numbered.withColumn("part", part).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + place + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
