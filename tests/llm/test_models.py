import math
import zlib

import numpy as np
import pytest

from sheafline.llm import language_id, quality
from sheafline.llm.fertility import duplicate_lines, fertility, repeated_words
from sheafline.llm.pieces import MARK, PIECE_MODEL, vocabulary
from sheafline.llm.token_counts import count_word, text_tokens, token_counts, word_counts

SF = "/root/testdata/sf0.001"


def test_base_figures():
    assert repeated_words("a b c d e x a b c d e".split()) == 10
    assert repeated_words("a b c d".split()) == 0 and repeated_words(["w"] * 7) == 7
    assert duplicate_lines(b"x\n\n \nx\nx \ny") == 1


def test_fertility_of_odd_rows(odd_documents, no_documents):
    got = {r["doc_id"]: r for r in fertility(odd_documents).collect()}
    assert len(got) == 14 and got[4]["n_words"] == 0 and got[4]["base_failed"] and not got[4]["kept"] and got[6]["word_chars"] == 0
    assert got[1]["n_words"] == 180 and not got[1]["base_failed"] and got[11]["fallback_share"] > 0
    assert fertility(no_documents).count() == 0 and fertility(odd_documents.drop("lang")).count() == 15


def test_fertility_keeps_good_documents(spark):
    got = fertility(spark.read.parquet(f"{SF}/documents.parquet"))
    good = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 1 and not base_failed").agg({"*": "count", "n_words": "sum"}).first()
    lost = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 1 and not base_failed and not kept").count()
    assert lost <= 0.02 * good[0]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, scores = vocabulary()
    least = min(scores)
    listed = [("<unk>", least), *((f"<0x{i:02X}>", least) for i in range(256)), *zip(pieces, scores, strict=True)]
    t = Tokenizer(models.Unigram(listed, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always", split=True)])
    return t


@pytest.mark.parametrize("text", ["", "  ", "the river", "日本語テスト 🎉🎉 x​x", "a\x1cb", "▁▁ a▁b", "  café ﬁ", "#" * 50, "ᚠᚡ" * 9, "a\x00\n é▁é日 ᚠx"])
def test_counts_equal_the_tokenizer(tokenizer, text):
    assert text_tokens(text, word_counts()) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_on_documents(spark, tokenizer, odd_documents, no_documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).unionByName(odd_documents.select("doc_id", "text"))
    for r in token_counts(docs).collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_counts(no_documents).columns == [*no_documents.columns, "n_tokens"] and count_word("") == count_word(MARK)


def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate(vocabulary(PIECE_MODEL)[0])}
    rng = np.random.default_rng(0)
    model = language_id.LanguageModel(["x", "y"], rng.random((len(pieces) + 1, 2)) * 1e-3, PIECE_MODEL)

    def brute(word, lang):
        alpha = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            alpha[end] = sum(alpha[s] * model.p[pieces[word[s:end]], lang] for s in range(end) if word[s:end] in pieces)
            if word[end - 1] not in pieces:
                alpha[end] += alpha[end - 1] * model.p[len(pieces), lang]
        return math.log(max(alpha[-1], 1e-300))

    words = ["▁the", "▁tionouan", "▁éau日本", "▁x", "▁ᚠ"]
    got = model.log_probabilities(words)
    assert all(abs(got[i, k] - brute(w, k)) < 1e-9 for i, w in enumerate(words) for k in (0, 1))
    assert language_id.letter_words("Ab1c " + "z" * 130) == ["▁ab", "▁c", "▁" + "z" * 130] and language_id.letter_words("² ½ ³ Ⅷ १") == []


def test_forward_of_long_runs_is_exact():
    """A run of 500 letters, whose probability is far below what a double holds, against exact fractions."""
    from fractions import Fraction

    pieces = {p: i for i, p in enumerate(vocabulary(PIECE_MODEL)[0])}
    rng = np.random.default_rng(3)
    model = language_id.LanguageModel(["x", "y"], rng.random((len(pieces) + 1, 2)) * 1e-3, PIECE_MODEL)
    word = MARK + "".join(rng.choice(list("abcdeé日")) for _ in range(500))
    longest = max(map(len, pieces))
    for lang in (0, 1):
        alpha = [Fraction(1)] + [Fraction(0)] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - longest), end):
                if word[start:end] in pieces:
                    alpha[end] += alpha[start] * Fraction(float(model.p[pieces[word[start:end]], lang])).limit_denominator(10**12)
            if word[end - 1] not in pieces:
                alpha[end] += alpha[end - 1] * Fraction(float(model.p[len(pieces), lang])).limit_denominator(10**12)
        true = math.log(alpha[-1].numerator) - math.log(alpha[-1].denominator)
        assert true < -1000 and abs(model.log_probabilities([word, "▁a"])[0, lang] - true) < 1e-3


def test_language_without_letters_or_with_one_document(spark):
    one = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(i, f"stone river bridge number {i}", "en") for i in range(40)] + [(one, "ein sehr langer deutscher text über den fluss " * 3000, "de")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_bytes=200)
    assert model.languages == ["de", "en"]  # the one document is longer than the sample
    odd = spark.createDataFrame([(1, "² ½ ³"), (2, "Ⅷ 12"), (3, "fluss"), (4, "a" * 500)], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in language_id.identify(odd, model).orderBy("doc_id").collect()] == [True, True, False, False]


def test_quality_by_words_alone(spark):
    """Two classes of one shape that differ in their words only; words share their first twelve letters."""
    import random

    rng = random.Random(5)
    stem = "abcdefghijkl"
    make = lambda good: " ".join(stem + rng.choice("mnop" if good else "qrst") * 3 for _ in range(60))
    rows = [(i, make(i % 2), i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = quality.score_quality(docs.drop("quality"), quality.fit(docs.drop("quality"), docs.select("doc_id", "quality"))).join(docs.select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and all((r["score"] >= 0.7) == (r["quality"] == 1) for r in held)


def test_language_of_held_out_documents(spark, odd_documents, no_documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    rows = [r for r in language_id.identify(docs.select("doc_id", "text", "lang"), model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd_documents, model).collect()}
    assert got[4] == got[5] == got[6] == "und" and got[1] in model.languages
    nothing = language_id.fit(no_documents)
    assert {r["lang_pred"] for r in language_id.identify(odd_documents, nothing).collect()} == {"und"} and language_id.identify(no_documents, model).count() == 0


def test_quality_of_held_out_documents(spark, odd_documents, no_documents):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    model = quality.fit(docs, labels)
    got = quality.score_quality(docs.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in held) >= 0.97 * len(held)
    odd = quality.score_quality(odd_documents, model)
    assert odd.count() == 15 and odd.where("score < 0 or score > 1 or score is null").count() == 0
    bare = quality.fit(no_documents, labels)
    assert {r["score"] for r in quality.score_quality(odd_documents, bare).collect()} == {1.0} and quality.score_quality(no_documents, model).count() == 0


def test_votes_are_exact(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(50, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    m = quality.QualityModel(np.ones(6), np.eye(6), vectors, (rng.random(50) > 0.5).astype(float), 0.5, 5, 8.0, 0.01)
    counts = rng.integers(0, 9, (20, 6)).astype(float)
    for c, s in zip(counts, m.score(counts), strict=True):
        z = m.latent(c[None])[0]
        cos = np.round(vectors @ z, 9)
        near = np.argsort(-cos)[:5]
        w = np.clip(cos[near], 0, 1) ** 8
        assert abs(s - (w @ m.labels[near] + 0.005) / (w.sum() + 0.01)) < 1e-9
