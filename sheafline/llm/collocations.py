"""Phrase collocations from vertical positional inverted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import slices, stored, text_bytes

#: Characters that end a piece; the byte they are all read as is free, as A-Z are lower-cased.
ENDS, END = b".,;:!?\n\x0b\x0c\r", b"A"
CLEAN = bytes(END[0] if c in ENDS else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256))
#: Words whose inverted lists a task holds at once, about; a text's stretch between two piece ends is never divided.
SEGMENT_WORDS = 1_000_000
#: Bytes of one text that are split into words at once.
RUN_BYTES = 2_000_000
#: Bits of the filter that tells which phrases of one level can be extended (8 MB, whatever the corpus): a prime just below 2**26.
FILTER_BITS = 67_108_859
#: What a language's and a phrase's words add to its bit, times their crc32; products stay below 2**62.
LANG_FACTOR, WORD_FACTORS = 998_244_353, (776_531_401, 1_004_535_809)
#: Rows of a batch that goes back to Spark.
BATCH = 100_000
#: Candidates of a language that one task ranks, about.
RANKED = 65_536

_COUNTED = "lang string, phrase string, n long"


class Postings:
    """The inverted lists of a segment of one language, merged: which word stands at each position.

    A word's list are the positions where it stands, ascending; words of a piece have consecutive positions, pieces are one position
    apart. :meth:`lists` gives the lists of some words merged in order of positions, ready for :func:`merge_join`.
    """

    def __init__(self) -> None:
        self._runs: list[bytes] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        if words := text.replace(END, b" A ").split():
            self._runs.append(b" ".join(words))
            self.size += len(words) + 1

    def close(self) -> None:
        data = b"A " + b" A ".join([*self._runs, b""])
        self._runs.clear()
        ends = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1)  # each word with the space after it
        offsets = pa.array(ends, pa.int32()).buffers()[1]
        coded = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        self._at = coded.indices.to_numpy()
        self.names = [w[:-1] for w in coded.dictionary.to_pylist()]  # the first is the piece end
        self.lengths = np.bincount(self._at, minlength=len(self.names))

    def lists(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, words) of the lists of the words marked in ``some``."""
        positions = np.flatnonzero(some[self._at])
        return positions, self._at[positions].astype(np.int64)


def merge_join(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two ascending lists of positions, each without repeats, agree: indices into either."""
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    met = right[at] == left if len(right) else np.zeros(len(left), bool)
    return np.flatnonzero(met), at[met]


def in_filter(bits: np.ndarray, lang: bytes, *words: np.ndarray) -> np.ndarray:
    """Which phrases a level's filter lets through, by the crc32 of their words: all frequent ones, and some others that share a bit with one."""
    h = crc32(lang) * LANG_FACTOR + sum(w * f % FILTER_BITS for w, f in zip(words, WORD_FACTORS, strict=False))
    h %= FILTER_BITS
    return (bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1


def _joined(left: pa.Array, right: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(left, right, pa.scalar(b" ", pa.binary()))


def _lists(postings: Postings, lang: bytes, level: int, word_bits, pair_bits) -> tuple[pa.Array, np.ndarray]:
    """(phrases of ``level`` words, lengths of their occurrence lists) in one segment."""
    names, n = pa.array(postings.names, pa.binary()), len(postings.names)
    if level == 1:
        return names[1:], postings.lengths[1:]
    sums = np.fromiter(map(crc32, postings.names), np.int64, n)
    some = in_filter(word_bits, lang, sums)
    some[0] = False  # piece ends are no words
    positions, words = postings.lists(some)
    # occurrences of words, extended by the lists of the words one position on
    first, second = merge_join(positions + 1, positions)
    named = lambda x: names.take(pa.array(x))
    if level == 2:
        pairs, lengths = np.unique(words[first] * n + words[second], return_counts=True)
        return _joined(named(pairs // n), named(pairs % n)), lengths
    fine = in_filter(pair_bits, lang, sums[words[first]], sums[words[second]])
    first, second = first[fine], second[fine]
    # occurrences of frequent pairs, extended by the lists of the words two positions on; the last two words must be a frequent pair as well
    head, tail = merge_join(positions[second], positions[first])
    pairs, pair = np.unique(words[first[head]] * n + words[second[head]], return_inverse=True)
    triples, lengths = np.unique(pair * n + words[second[tail]], return_counts=True)
    front = pairs[triples // n]
    return _joined(_joined(named(front // n), named(front % n)), named(triples % n)), lengths


def _stretches(text: bytes) -> Iterator[bytes]:
    """A cleaned text, a stretch at a time; only piece ends divide it."""
    at = 0
    while at < len(text):
        end = text.find(END, at + RUN_BYTES) + 1 or len(text)
        yield text[at:end]
        at = end


def _level(level: int, word_bits=None, pair_bits=None):
    def rows(lang: bytes, postings: Postings) -> Iterator[pa.RecordBatch]:
        postings.close()
        phrases, lengths = _lists(postings, lang, level, word_bits and word_bits.value, pair_bits and pair_bits.value)
        phrases = phrases.cast(pa.string())
        for k in range(0, len(phrases), BATCH):
            some = phrases[k : k + BATCH]
            yield pa.RecordBatch.from_arrays([pa.array([lang.decode()] * len(some)), some, pa.array(lengths[k : k + BATCH], pa.int64())], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[bytes, Postings] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for stretch in _stretches((text or b"").translate(CLEAN)):
                    open_.setdefault(lang, Postings()).add(stretch)
                    if sum(p.size for p in open_.values()) >= SEGMENT_WORDS:
                        most = max(open_, key=lambda x: open_[x].size)
                        yield from rows(most, open_.pop(most))
        while open_:
            yield from rows(*open_.popitem())

    return run


def frequencies(texts: DataFrame, level: int, word_bits=None, pair_bits=None) -> DataFrame:
    """(lang, phrase, n): list lengths of all segments added up, combined on the map side first."""
    return texts.mapInArrow(_level(level, word_bits, pair_bits), _COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_filter(phrases: DataFrame, words: int) -> np.ndarray:
    """The bits of phrases of one or two words, as bytes: the driver gets one number for each 32 bits at most, whatever the number of phrases."""
    term = lambda x, factor: F.crc32(x.cast("binary")) * factor
    of = [F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)][:words]
    bit = F.pmod(term(F.col("lang"), LANG_FACTOR) + sum((F.pmod(term(w, f), F.lit(FILTER_BITS)) for w, f in zip(of, WORD_FACTORS, strict=False)), F.lit(0)), F.lit(FILTER_BITS))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(32)).cast("int"))).alias("bits")
    found = phrases.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("at")).agg(bits).toArrow()
    out = np.zeros(FILTER_BITS // 32 + 1, np.uint32)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.astype("<u4").view(np.uint8)


def top_per_group(df: DataFrame, group: str, order: list, k: int, rows: int) -> DataFrame:
    """The first ``k`` rows of each group with their rank; ``rows`` bounds a group's rows. Groups are cut into parts of RANKED rows or so,
    whose own first k go on to the next round, so that no task ranks a whole group."""
    parts = math.ceil(rows / RANKED)
    while parts > 1:
        dealt = df.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        best = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order))
        df = dealt.withColumn("rank", best).where(F.col("rank") <= k).drop("rank", "part")
        fewer = math.ceil(parts * k / RANKED)
        parts = fewer if fewer < parts else 1
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def collocations(documents: DataFrame, least: int = 10, longest: int = 3, within: int = 50, first: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of two to three words of each language.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words. a counts a phrase
    within pieces, overlaps included; n counts the language's words. A phrase found ``least`` times is a candidate; its score is the least
    over its cuts of floor(10**6 a a / (l r)), with l and r the counts of the two sides, ties to the earlier cut. A candidate that lies
    inside a longer one with ``within`` % of its count or more is dropped.

    Level by level, as a phrase is no more frequent than its parts: every task builds inverted lists of a segment of the corpus (word
    -> positions), and a list joined by position with those of the adjacent words gives the lists of longer phrases; their lengths,
    added up over segments, are exact counts. Before a level is joined, lists of phrases that cannot be frequent are left out by
    a filter of FILTER_BITS bits over the frequent phrases of the level before: that saves work and changes no count. Texts are
    read once a level, nothing but list lengths is shuffled.

    Null texts are empty, null languages are ``und``. Repeated rows count each time. Equal scores are ordered by a, then by the phrase's
    bytes. Very long texts are read whole, a stretch between piece ends at a time; counts up to 10**15 are exact. Further columns are ignored. An empty table gives no rows.
    """
    if longest not in (2, 3):
        raise ValueError("phrases have two or three words")
    context = documents.sparkSession.sparkContext
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"), text_bytes(text).alias("text"))
    enough = F.col("n") >= least
    words = stored(frequencies(texts, 1), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    word_bits = context.broadcast(phrase_filter(words.where(enough), 1))
    pairs = stored(frequencies(texts, 2, word_bits).where(enough), "pair-counts")
    frequent = words.where(enough)
    cut = lambda i: F.substring_index("phrase", " ", i)
    sides = lambda df, at, n: df.select("lang", F.col("phrase").alias(at), F.col("n").alias(n))
    found = pairs.select("lang", "phrase", F.col("n").alias("a"), cut(1).alias("w1"), cut(-1).alias("w2"))
    found = found.join(sides(frequent, "w1", "l1"), ["lang", "w1"]).join(sides(frequent, "w2", "r1"), ["lang", "w2"]).drop("w1", "w2")
    found = found.withColumns({"l2": F.col("l1"), "r2": F.col("r1")})
    if longest == 3:
        pair_bits = context.broadcast(phrase_filter(pairs, 2))
        triples = stored(frequencies(texts, 3, word_bits, pair_bits).where(enough), "triple-counts")
        longer = triples.select("lang", F.explode(F.array(cut(2), cut(-2))).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
        found = found.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))).drop("longer")
        more = triples.select("lang", "phrase", F.col("n").alias("a"), cut(1).alias("w1"), cut(-2).alias("p2"), cut(2).alias("p1"), cut(-1).alias("w3"))
        for df, at, n in ((frequent, "w1", "l1"), (pairs, "p2", "r1"), (pairs, "p1", "l2"), (frequent, "w3", "r2")):
            more = more.join(sides(df, at, n), ["lang", at])
        found = found.unionByName(more.drop("w1", "p2", "p1", "w3"))
    long = "cast({} as decimal(15,0))"
    score = lambda i: F.expr(f"1000000BD * {long.format('a')} * {long.format('a')} div ({long.format(f'l{i}')} * {long.format(f'r{i}')})")
    found = found.withColumns({"s1": score(1), "s2": score(2)})
    pick = lambda x: F.when(F.col("s1") <= F.col("s2"), F.col(f"{x}1")).otherwise(F.col(f"{x}2")).alias({"s": "score"}.get(x, x))
    found = stored(found.select("lang", "phrase", "a", pick("l"), pick("r"), pick("s")), "candidates")
    best = top_per_group(found, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], first, found.count())
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
