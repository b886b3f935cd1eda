"""Language identification by unigram piece models, summed over all segmentations."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import fold, neutral_names, slices, text_bytes
from sheafline.llm.pieces import MARK, PIECE_MODEL, vocabulary

#: Runs of letters (Unicode category L); digits, numerals, marks and punctuation tell no language.
LETTERS = regex.compile(r"\p{L}+")
#: Words that a worker remembers.
REMEMBERED = 400_000
#: Positions of words whose lattices are worked on at a time; a longer word forms a step of its own.
CELLS = 200_000
#: Parts into which each power of two of document hashes is cut where documents are sampled.
PARTS = 16


def letter_words(text: str) -> list[str]:
    """Marked lower-case runs of letters."""
    return [MARK + w for w in LETTERS.findall(text.lower())]


def steps(words: list[str]) -> Iterator[np.ndarray]:
    """Numbers of words of similar lengths whose lattices together have about CELLS positions."""
    sizes = np.array([len(w) + 1 for w in words])
    order, start = np.argsort(sizes, kind="stable"), 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * sizes[order[stop]] <= CELLS:
            stop += 1
        yield order[start:stop]
        start = stop


@functools.lru_cache(maxsize=2)
def _automaton(path: str):
    """Pieces, with an automaton that gives (length, number)."""
    import ahocorasick

    found, pieces = ahocorasick.Automaton(), vocabulary(path)[0]
    for i, p in enumerate(pieces):
        found.add_word(p, (len(p), i))
    found.make_automaton()
    return found, frozenset(p for p in pieces if len(p) == 1), len(pieces)


def _log_sums(rows: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct number in ``rows`` (sorted) and, per column, the log of the sum of exp over its rows of ``x``."""
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    top = np.maximum.reduceat(x, first, axis=0)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        total = np.log(np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.r_[first, len(rows)]), axis=0)), first, axis=0))
    return rows[first], top + total


@dataclass
class Lattice:
    """All piece matches of many words: (word, start, end, piece). Piece V stands for any unknown character. Sums run over logarithms, so no length underflows."""

    lengths: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, words: list[str], path: str) -> Lattice:
        automaton, singles, unknown = _automaton(path)
        word, start, end, piece = [], [], [], []
        for i, w in enumerate(words):
            found = [(e + 1, n, p) for e, (n, p) in automaton.iter(w)]
            if not singles.issuperset(w):
                found += [(j + 1, 1, unknown) for j, c in enumerate(w) if c not in singles]
            e, n, p = zip(*found, strict=True) if found else ((), (), ())
            word += [i] * len(e)
            end += e
            start += n
            piece += p
        e = np.array(end, np.int64)
        return cls(np.array([len(w) for w in words], np.int64), np.array(word, np.int64), e - np.array(start, np.int64), e, np.array(piece, np.int64))

    def _by(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matches ordered by a position, then by word; where each position's begin."""
        order = np.lexsort((self.word, at))
        return order, np.searchsorted(at[order], np.arange(self.lengths.max(initial=0) + 2))

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """alpha[word, position, language]: log of the probability of all segmentations up to a position."""
        order, cuts = self._by(self.end)
        alpha = np.full((len(self.lengths), int(self.lengths.max(initial=0)) + 1, logp.shape[1]), -np.inf)
        alpha[:, 0] = 0
        for k in range(1, alpha.shape[1]):
            at = order[cuts[k] : cuts[k + 1]]
            if len(at):
                words, sums = _log_sums(self.word[at], alpha[self.word[at], self.start[at]] + logp[self.piece[at]])
                alpha[words, k] = sums
        return alpha

    def whole(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[np.arange(len(self.lengths)), self.lengths]

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of each piece per language, summed over the words with their counts (words x languages)."""
        alpha = self.forward(logp)
        order, cuts = self._by(self.start)
        beta = np.full_like(alpha, -np.inf)
        beta[np.arange(len(self.lengths)), self.lengths] = 0
        for k in range(alpha.shape[1] - 2, -1, -1):
            at = order[cuts[k] : cuts[k + 1]]
            if len(at):
                words, sums = _log_sums(self.word[at], beta[self.word[at], self.end[at]] + logp[self.piece[at]])
                beta[words, k] = sums
        share = alpha[self.word, self.start] + logp[self.piece] + beta[self.word, self.end] - self.whole(alpha)[self.word]
        out = np.zeros_like(logp)
        np.add.at(out, self.piece, np.exp(share) * counts[self.word])
        return out


@dataclass
class LanguageModel:
    """Piece probabilities of each language: (pieces + 1, languages)."""

    languages: list[str]
    p: np.ndarray
    path: str

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """(words, languages), by the forward algorithm."""
        out, logp = np.empty((len(words), len(self.languages))), np.log(self.p)
        for at in steps(words):
            lattice = Lattice.of([words[i] for i in at], self.path)
            out[at] = lattice.whole(lattice.forward(logp))
        return out


def train(words: dict[str, dict[str, int]], path: str = PIECE_MODEL, rounds: int = 4, smoothing: float = 0.02) -> LanguageModel:
    """Expectation maximisation from {word: {language: count}}; the vocabulary itself stays fixed.

    Every piece keeps ``smoothing`` expected occurrences more, in each language alike.
    """
    langs = sorted({lang for c in words.values() for lang in c})
    unknown = _automaton(path)[2]
    p = np.full((unknown + 1, len(langs)), 1.0 / (unknown + 1))
    names, at = sorted(words), {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((len(names), len(langs)))
    for i, w in enumerate(names):
        for lang, n in words[w].items():
            counts[i, at[lang]] = n
    for _ in range(rounds if langs else 0):
        total, logp = np.full_like(p, smoothing), np.log(p)
        for some in steps(names):
            total += Lattice.of([names[i] for i in some], path).expected(logp, counts[some])
        p = total / total.sum(axis=0)
    return LanguageModel(langs, p, path)


def fit(documents: DataFrame, sample_bytes: int = 1_000_000, path: str = PIECE_MODEL, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learns from documents outside the held-out fold with a language.

    Each language's documents are taken in the order of their hashed ids until they make up ``sample_bytes`` of text: the
    cluster sums the bytes of PARTS ranges of hashes within each power of two, and the driver chooses a language's last range. So a sample holds
    at least the range with the first document, and at most a PARTS-th and a document more than asked, whatever the lengths and the size of the corpus.
    The cluster counts the words, and the counts reach the driver.
    """
    rows = documents.where((fold(doc_id) != 2) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("id"), text_bytes(text).alias("text"))
    order = F.shiftrightunsigned(F.xxhash64("id"), 3).cast("double") + 1  # 1 to 2**61
    rows = rows.withColumn("part", F.floor(F.log2(order) * PARTS).cast("int"))
    last: dict[str, tuple[int, int]] = {}
    for r in sorted(rows.groupBy("lang", "part").agg(F.sum(F.octet_length("text")).alias("n")).collect()):  # 61 * PARTS rows a language at most
        held, _ = last.get(r["lang"], (0, 0))
        if held < sample_bytes:
            last[r["lang"]] = held + r["n"], r["part"]
    if not last:
        return train({}, path)
    ends = F.create_map(*[F.lit(x) for k, (_, part) in last.items() for x in (k, part)])
    some = rows.where(F.col("part") <= ends[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: Counter = Counter()
            for of, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((of, w) for w in letter_words(x.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    words: dict[str, dict[str, int]] = {}
    for r in some.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        words.setdefault(r["word"], {})[r["lang"]] = r["n"]
    return train(words, path)


class _Known(dict):
    """word -> row of a growing matrix of log probabilities."""

    def __init__(self, model: LanguageModel) -> None:
        super().__init__()
        self.model, self.rows = model, np.empty((1024, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(words)
        if not new:
            return
        n = len(self)
        while len(self.rows) < n + len(new):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[n : n + len(new)] = self.model.log_probabilities(new)
        self.update(zip(new, range(n, n + len(new)), strict=True))


_MEMORY: dict[str, _Known] = {}


@neutral_names
def identify(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``documents`` with lang_pred (string) and score (double: the posterior of that language under equal priors).

    A text's probability in a language is the product over its words (whole runs of letters of Unicode's category L,
    lower-cased and marked) of the sum over all their segmentations into vocabulary pieces.
    Whole texts are scored, each distinct word of a worker once while it is remembered.

    Null texts and texts without a letter give 'und' with score 0, as does everything if no
    language was learned. Equal posteriors: the language first in alphabetical order.
    Repeated rows fare alike, very long texts and words are scored whole, an empty table gives no rows.
    Other columns pass through; columns with these two names are replaced. No shuffle.
    """
    import uuid

    kept, name = [c for c in documents.columns if c not in ("lang_pred", "score")], uuid.uuid4().hex
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def one(words: list[str], known: _Known) -> tuple[str, float]:
        if not words or not known.model.languages:
            return "und", 0.0
        counts = Counter(words)
        rows = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        total = np.fromiter(counts.values(), np.float64, len(counts)) @ known.rows[rows]
        best = int(np.argmax(total))
        return known.model.languages[best], float(1 / np.exp(total - total[best]).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MEMORY:
            _MEMORY.clear()
            _MEMORY[name] = _Known(shared.value)
        known = _MEMORY[name]
        for batch in slices(batches, "_bytes"):
            at = batch.schema.get_field_index("_bytes")
            words = [letter_words(x.decode("utf-8", "replace")) if x else [] for x in batch.column(at).to_pylist()]
            if known.model.languages:
                known.learn({w for ws in words for w in ws})
            found = [one(ws, known) for ws in words]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*(n for n in batch.schema.names if n != "_bytes"), "lang_pred", "score"])

    rows = documents.select(*kept, text_bytes(text).alias("_bytes"))
    return rows.mapInArrow(run, documents.select(*kept).schema.add("lang_pred", "string").add("score", "double"))
