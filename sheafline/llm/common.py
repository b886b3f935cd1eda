"""What the corpus operators share: written intermediate tables, folds, batches and fast word hashing."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of an Arrow operator works on; longer single texts form a step of their own.
STEP_BYTES = 2_000_000


#: Application id -> the folder of a local session that names none (tests), and the tables that it holds or that were written for it.
_LOCAL: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a session in local mode may leave it unset: it gets a temporary folder, one for each application."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not found and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="sheafline-")
        found = _LOCAL[context.applicationId]
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors. :func:`discard` and :func:`clean_up` delete it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`stored` that nothing reads any more; others are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            _TABLES[df.sparkSession.sparkContext.applicationId].remove(path)
            _delete(df.sparkSession, path)


def clean_up(spark: SparkSession) -> int:
    """Deletes what this application's operators still hold in the shared folder, once its results have been written. How many tables that were."""
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def join_with_hot(left: DataFrame, right: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """An inner join where ``hot`` marks those rows of ``right`` that may meet a great part of ``left``: they are broadcast, so
    no task gathers a hot key; the others are joined as Spark sees fit. The caller's condition bounds the hot rows, such as "a thousandth of all rows or more".
    Keys are not null; ``right`` has each key once.
    """
    heavy = F.broadcast(right.where(hot))
    return left.join(heavy, on).unionByName(left.join(F.broadcast(right.where(hot).select(*on)), on, "left_anti").join(right.where(~hot), on))


def neutral_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators whose own temporary columns begin with '_': columns of the caller's table that do so bear neutral names inside
    and their own again in the result. Tables without such columns are left as they are."""

    @functools.wraps(operator)
    def run(table: DataFrame, *args, **kwargs) -> DataFrame:
        own = [c for c in table.columns if c.startswith("_")]
        if not own:
            return operator(table, *args, **kwargs)
        lead = "own"
        while any(c.startswith(lead) for c in table.columns):
            lead += "x"
        inside = {c: f"{lead}{i}" for i, c in enumerate(own)}
        named = lambda x: inside.get(x, x) if isinstance(x, str) else x
        out = operator(table.withColumnsRenamed(inside), *map(named, args), **{k: named(v) for k, v in kwargs.items()})
        return out.withColumnsRenamed({v: k for k, v in inside.items()})

    return run


def fold(doc_id: str | Column = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as ''."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % parts


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null. Python then works on bytes without decoding twice."""
    return F.col(text).cast("string").cast("binary")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``step`` bytes of text, which bounds a worker's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + step, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * _K1
    x = (x ^ (x >> np.uint64(29))) * _K2
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased. Fewer words than ``width``: the whole sequence is one shingle; no words: empty."""
    words = word_hashes(text.lower().split()) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        out = mix(out + words[k : k + n] + np.uint64(k + 1))
    if len(words) < width:  # a short sequence never equals a full shingle
        out = mix(out + np.uint64(977 + len(words)))
    return np.unique(out)
