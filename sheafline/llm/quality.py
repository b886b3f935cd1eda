"""Text quality by nearest-neighbour voting over latent-semantic vectors of words and word shapes."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import fold, mix, neutral_names, slices, text_bytes

#: A byte's class: white space, digit, upper case, letter (and every non-ASCII byte), or itself.
SHAPES = bytes(32 if c in b" \t\n\r\x0b\x0c" else 97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
#: Documents whose term counts are held at a time, however short they are.
ROWS = 256
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


class _Words(dict):
    """Two hashes of a word in one integer: of its shape with runs collapsed (upper half) and of its lower-cased letters; at most 200,000 are remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = zlib.crc32(_RUNS.sub(rb"\1", word.translate(SHAPES))) << 32 | zlib.crc32(word.lower())
        return found


def term_counts(text: bytes | None, terms: int, cache: dict[bytes, int]) -> np.ndarray:
    """``terms`` hashed counts of word shapes, of pairs of neighbouring shapes and of words that repeat the one before; then ``terms`` of whole words."""
    words = text.split() if text else []
    if not words:
        return np.zeros(2 * terms)
    both = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    shape, word = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    pairs = mix(shape[:-1] * np.uint64(31) + shape[1:])
    binned = lambda h: np.bincount((h % np.uint64(terms)).astype(np.int64), minlength=terms)
    shapes = binned(mix(shape)) + binned(pairs)
    shapes[zlib.crc32(b"repeats") % terms] += int((word[:-1] == word[1:]).sum())
    return np.concatenate([shapes, binned(mix(word))]).astype(np.float64)


def _counted(terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in slices(batches):
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                rows = [zlib.compress(term_counts(x, terms, cache).astype(np.float32).tobytes(), 1) for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column(1)], ["counts", "label"])

    return run


@dataclass
class QualityModel:
    """Labelled latent vectors (bounded by ``sample`` of fit) and what maps a text to one."""

    idf: np.ndarray
    axes: np.ndarray  # terms x dims
    vectors: np.ndarray  # labelled x dims, unit length
    labels: np.ndarray
    prior: float
    neighbours: int
    power: float
    rest: float

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Square roots of shares, of shapes and of words each, times the inverse document frequency; unit length."""
        a = counts.copy()
        for half in np.hsplit(a, 2):  # views
            half /= np.maximum(1, half.sum(axis=1, keepdims=True))
        np.sqrt(a, out=a)
        a *= self.idf.astype(a.dtype)
        a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
        return a

    def latent(self, counts: np.ndarray) -> np.ndarray:
        z = self.weighted(counts) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Exact cosines in blocks; every label as near as the last neighbour votes with cosine ** power."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        out, z = np.empty(len(counts)), self.latent(counts)
        k = min(self.neighbours, len(self.labels))
        for i in range(0, len(z), 256):
            cos = np.round(z[i : i + 256] @ self.vectors.T, 9)
            edge = -np.partition(-cos, k - 1, axis=1)[:, k - 1 : k]
            weight = np.where(cos >= edge, np.clip(cos, 0, 1) ** self.power, 0.0)
            out[i : i + 256] = (weight @ self.labels + self.rest * self.prior) / (weight.sum(axis=1) + self.rest)
        return np.clip(out, 0.0, 1.0)


def strongest_axes(a: np.ndarray, dims: int, rounds: int = 12) -> np.ndarray:
    """The first right singular vectors of ``a`` by subspace iteration with a fixed start: (terms, dims), never a terms x terms matrix."""
    q = np.random.default_rng(7).normal(size=(a.shape[1], min(a.shape[1], 2 * dims)))
    for _ in range(rounds):
        q = np.linalg.qr(a.T @ (a @ q))[0]
    b = a @ q
    return q @ np.linalg.eigh(b.T @ b)[1][:, ::-1][:, :dims]


def fit(documents: DataFrame, labels: DataFrame, sample: int = 4000, terms: int = 1024, dims: int = 32, neighbours: int = 15, power: float = 8.0, rest: float = 0.01) -> QualityModel:
    """Learns from labelled rows outside the held-out fold (crc32 of the id mod 4 is 2).

    About ``sample`` labelled rows at most, chosen by hashed id, are used; their term
    counts (2 * terms * 4 bytes each, sent compressed) are all that reaches the driver, which holds one matrix of them.
    """
    known = labels.where((fold("doc_id") != 2) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).join(F.broadcast(chosen), "doc_id").select("text", F.col("label").cast("double").alias("label"))
    seen = rows.mapInArrow(_counted(terms), "counts binary, label double").toArrow()
    if not seen.num_rows:
        return QualityModel(np.ones(2 * terms), np.zeros((2 * terms, 1)), np.empty((0, 1)), np.empty(0), 1.0, neighbours, power, rest)
    pairs = sorted(zip(seen["counts"].to_pylist(), seen["label"].to_pylist(), strict=True))  # the same model whatever order rows come in
    x, y = np.empty((len(pairs), 2 * terms), np.float32), np.array([p[1] for p in pairs])
    for i, (counts, _) in enumerate(pairs):
        x[i] = np.frombuffer(zlib.decompress(counts), np.float32)
    model = QualityModel(np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1, np.empty(0), np.empty(0), y, float(y.mean()), neighbours, power, rest)
    for i in range(0, len(x), ROWS):  # in place, without a second matrix
        x[i : i + ROWS] = model.weighted(x[i : i + ROWS])
    model.axes = strongest_axes(x, dims)
    z = x @ model.axes
    model.vectors = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    return model


@neutral_names
def score_quality(documents: DataFrame, model: QualityModel, terms: int = 1024) -> DataFrame:
    """``documents`` with a score column (double, 0 to 1; higher: label 1 likelier).

    A text's vector lies in the space of the labelled texts' strongest axes; its terms are hashed whole words and word shapes. Every whole text is scored. Null, empty and wordless texts have no neighbours and get
    the share of label 1 among the labels; without any label every score is 1. Repeated
    rows score alike; very long texts are counted whole; an empty table gives no rows. Other columns pass through; a column named score is replaced.
    """
    spark, kept = documents.sparkSession, [c for c in documents.columns if c != "score"]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in slices(batches, "_bytes"):
            at = batch.schema.get_field_index("_bytes")
            texts, score = batch.column(at).to_pylist(), np.full(batch.num_rows, shared.value.prior)
            for i in range(0, len(texts), ROWS):
                counts = np.array([term_counts(x, terms, cache) for x in texts[i : i + ROWS]], np.float32)
                score[i : i + ROWS] = np.where(counts.any(axis=1), shared.value.score(counts), shared.value.prior)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), pa.array(score, pa.float64())], [*(n for n in batch.schema.names if n != "_bytes"), "score"])

    rows = documents.select(*kept, text_bytes().alias("_bytes"))
    schema = documents.select(*kept).schema.add("score", "double")
    return rows.mapInArrow(run, schema)
