"""Tokeniser fertility: how well public vocabularies fit a text, and rejection bands per language."""

from __future__ import annotations

import base64
import functools
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import mix, slices, stored, text_bytes, word_hashes
from sheafline.llm.pieces import MARK, PIECE_MODEL, TOKENIZERS

BYTE_RANKS = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
SYMBOLS = b"#*$%&|<>"
#: Metrics that have bands.
METRICS = ("chars_per_piece", "chars_per_byte_token", "fallback_share", "entropy_ratio")
#: Words that a worker remembers.
REMEMBERED = 400_000


@functools.lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    bytes_ = [model.is_byte(i) or model.is_unknown(i) for i in range(model.get_piece_size())]
    return model, bytes_


@functools.lru_cache(maxsize=2)
def _byte_bpe(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Words(dict):
    """word -> (piece ids as bytes, pieces, byte pieces, byte-level tokens, characters)."""

    def __init__(self, pieces: str, ranks: str) -> None:
        super().__init__()
        self.pieces, self.ranks = pieces, ranks

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(words)
        if not new:
            return
        model, is_byte = _pieces(self.pieces)
        plain = [w.decode("utf-8", "replace") for w in new]
        ids, byte_level = model.encode(plain, num_threads=1), _byte_bpe(self.ranks).encode_ordinary
        for w, p, i in zip(new, plain, ids, strict=True):
            self[w] = (array("i", i).tobytes(), len(i), sum(map(is_byte.__getitem__, i)), len(byte_level(" " + p)), len(p))


@functools.lru_cache(maxsize=2)
def _words(pieces: str, ranks: str) -> _Words:
    return _Words(pieces, ranks)


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words that lie in a window of ``window`` words which the text holds at least twice, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = word_hashes(words)
    w = np.zeros(n, np.uint64)
    for k in range(window):
        w = mix(w + h[k : k + n] + np.uint64(k + 1))
    _, inverse, counts = np.unique(w, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measure(text: bytes | None, known: _Words) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_pieces, metrics...)."""
    words = text.split() if text else []
    if not words:
        return 0, 0, sum(text.count(bytes([c])) for c in SYMBOLS) if text else 0, 0, 0, 0, None, None, None, None
    counts = Counter(words)
    rows, times = [known[w] for w in counts], np.fromiter(counts.values(), np.int64, len(counts))
    sizes, fallback, byte_tokens, chars = np.array([r[1:] for r in rows], np.int64).T
    ids = np.frombuffer(b"".join(r[0] for r in rows), np.int32)
    hist = np.bincount(ids, np.repeat(times, sizes))
    n, word_chars = int(times @ sizes), int(times @ chars)
    p = hist[hist > 0] / n
    entropy = float(-(p * np.log2(p)).sum())
    ratio = entropy / np.log2(n) if n > 1 else 1.0
    return len(words), word_chars, sum(text.count(bytes([c])) for c in SYMBOLS), duplicate_lines(text), repeated_words(words), n, word_chars / max(1, n), word_chars / max(1, int(times @ byte_tokens)), int(times @ fallback) / max(1, n), float(ratio)


_SCHEMA = "doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_pieces long, " + ", ".join(f"{m} double" for m in METRICS)


def _measured(pieces: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words(pieces, ranks)
        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            known.learn({w for t in texts if t for w in t.split()})
            cols = list(zip(*(measure(t, known) for t in texts), strict=True))
            kinds = [pa.int64()] * 6 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [x.split()[0] for x in _SCHEMA.split(", ")])

    return run


def fertility(documents: DataFrame, pieces: str = PIECE_MODEL, ranks: str = BYTE_RANKS, width: float = 5.0, least_pieces: int = 80, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base figures, fertility metrics, bands and verdict for every row of ``documents``.

    Words are runs without ASCII white space; each is encoded by two public vocabularies
    (pieces with byte fallback; byte-level BPE), each distinct word of a worker once while it is remembered.
    chars_per_piece and chars_per_byte_token are code points per token, fallback_share the
    share of byte pieces, entropy_ratio the token entropy over its maximum log2(n_pieces).

    Each language's bands are its median plus and minus ``width`` robust standard
    deviations (quartile distance / 1.349, with a floor of 2 % of the median), from all its
    documents with at least ``least_pieces`` pieces; null languages form their own group. A text
    is rejected where its metric lies outside the band by more than sampling explains: the band widens by
    sqrt(1 + 400 / n_pieces). Only the direction that speaks against a text counts:
    few characters per token, much byte fallback, little entropy.

    base_failed: fewer than 10 words, or more than 20 % of words in repeated 5-word windows.
    kept: neither base_failed nor out of band. Null or blank texts have zero figures, null metrics, and
    fail the base. Repeated rows fare alike; very long texts are encoded whole, word by word; an empty table gives no rows; extra columns are ignored.
    The metrics are written once and read again; the only other exchange is the bands' (a few rows for each language).
    """
    group = F.col(lang).cast("string") if lang in documents.columns else F.lit(None).cast("string")
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), group.alias("grp"), text_bytes(text).alias("text"))
    rows = stored(rows.mapInArrow(_measured(pieces, ranks), _SCHEMA), "fertility")
    quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in METRICS]
    bands = rows.where(F.col("n_pieces") >= least_pieces).groupBy("grp").agg(*quartiles)
    for m in METRICS:
        spread = F.greatest((F.col(m)[2] - F.col(m)[0]) / 1.349, 0.02 * F.col(m)[1], F.lit(0.002))
        bands = bands.withColumn(f"{m}_edge", F.col(m)[1] + (1 if m == "fallback_share" else -1) * width * spread).withColumn(f"{m}_mid", F.col(m)[1])
    bands = bands.drop(*METRICS).withColumnRenamed("grp", "band_grp")
    out = rows.join(bands, F.col("grp").eqNullSafe(F.col("band_grp")), "left")
    wider = F.sqrt(1 + 400 / F.greatest("n_pieces", F.lit(1)))
    outside = F.lit(False)
    for m in METRICS:
        edge = F.col(f"{m}_mid") + (F.col(f"{m}_edge") - F.col(f"{m}_mid")) * wider
        outside = outside | F.coalesce(F.col(m) > edge if m == "fallback_share" else F.col(m) < edge, F.lit(False))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~outside).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_pieces", *METRICS)
