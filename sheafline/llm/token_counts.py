"""Token counts of a unigram tokenizer without building tokens: matches, best scores and counts only."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sheafline.llm.common import neutral_names, slices, text_bytes
from sheafline.llm.pieces import MARK, PIECE_MODEL, Remembered, vocabulary

#: What an unknown character scores below the vocabulary's least piece (the unigram tokenizer's rule).
UNKNOWN_PENALTY = 10.0
#: Unicode White_Space, where the tokenizer splits words.
SPACES = re.compile("[\u0009-\u000d \u0085   -     　]+")


@functools.lru_cache(maxsize=4)
def _automaton(path: str):
    """The automaton over the pieces, the characters that are pieces, and an unknown character's score."""
    import ahocorasick

    found = ahocorasick.Automaton()
    pieces, scores = vocabulary(path)
    for piece, score in zip(pieces, scores, strict=True):
        found.add_word(piece, (len(piece), score))
    found.make_automaton()
    return found, frozenset(p for p in pieces if len(p) == 1), min(scores) - UNKNOWN_PENALTY


def count_pieces(word: str, path: str = PIECE_MODEL) -> int:
    """Pieces of one marked word in its best segmentation.

    The automaton lists all pieces that end at each character, the longest first, so a
    strictly better score is needed to replace an earlier start: among equal scores the
    longest last piece wins, as in the tokenizer. A character that is no piece itself may
    stand alone as unknown, starts later than any match, and counts as its UTF-8 bytes (byte fallback).
    """
    automaton, singles, unknown = _automaton(path)
    strange = {i for i, c in enumerate(word) if c not in singles} if not singles.issuperset(word) else None
    best, count, at = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1), 0

    def alone(stop: int, at: int) -> None:
        for i in range(at, stop):
            if i in strange and best[i] + unknown > best[i + 1]:
                best[i + 1], count[i + 1] = best[i] + unknown, count[i] + len(word[i].encode("utf-8", "surrogatepass"))

    for end, (length, score) in automaton.iter(word):
        if strange and at < end:
            alone(end, at)
            at = end
        end += 1
        score += best[end - length]
        if score > best[end]:
            best[end], count[end] = score, count[end - length] + 1
    if strange:
        alone(len(word), at)
    return count[-1]


def count_word(word: str, path: str = PIECE_MODEL) -> int:
    """Pieces of a word between white space: it gets a mark in front, and marks inside start further words."""
    if MARK not in word:
        return count_pieces(MARK + word, path)
    head, *tail = word.split(MARK)
    return (count_pieces(MARK + head, path) if head else 0) + sum(count_pieces(MARK + x, path) for x in tail)


@functools.lru_cache(maxsize=4)
def word_counts(path: str = PIECE_MODEL) -> Remembered:
    """The counts that a worker remembers from task to task."""
    return Remembered(lambda w: count_word(w, path))


def text_tokens(text: str, counts: dict[str, int]) -> int:
    return sum(n * counts[w] for w, n in Counter(SPACES.split(text)).items() if w)


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(path)
        for batch in slices(batches, "_bytes"):
            at = batch.schema.get_field_index("_bytes")
            found = [text_tokens(x.decode("utf-8", "replace"), counts) if x else 0 for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), pa.array(found, pa.int64())], [*(n for n in batch.schema.names if n != "_bytes"), "n_tokens"])

    return run


@neutral_names
def token_counts(documents: DataFrame, path: str = PIECE_MODEL) -> DataFrame:
    """``documents`` with n_tokens (long): how many tokens the unigram tokenizer over the vocabulary at ``path`` makes of each whole text.

    Words (between Unicode white space) are marked and counted on their own, each distinct word of a worker
    once while it is remembered. The result equals that tokenizer's own count, ties included.
    Null, empty and blank texts have 0 tokens. Repeated rows count alike, very long texts are counted whole, an empty
    table gives no rows. No shuffle; other columns pass through, n_tokens is replaced.
    """
    kept = [c for c in documents.columns if c != "n_tokens"]
    return documents.select(*kept, text_bytes().alias("_bytes")).mapInArrow(_counted(path), documents.select(*kept).schema.add("n_tokens", "long"))
