"""Sums over all segmentations of words, short and very long, and whole predictions."""

import math
import random

import numpy as np
import pytest

from trailmetrics.llm import language_id
from trailmetrics.runtime import Scratch

LANGUAGES = ["de", "fr"]


@pytest.fixture(scope="module")
def pieces():
    return language_id.load_pieces(language_id.VOCABULARY)


@pytest.fixture(scope="module")
def log_p(pieces):
    rng = np.random.default_rng(7)
    p = rng.random((len(pieces), 2)) ** 8 + 1e-6
    return np.log(p / p.sum(axis=0))


def plain(marked, pieces, log_p, language):
    """The sum over all segmentations, one character after the other, scaled on the way."""
    longest = max(map(len, pieces))
    sums = [0.0]
    for end in range(1, len(marked) + 1):
        spelled = sum(log_p[pieces[f"<0x{b:02X}>"]][language] for b in marked[end - 1].encode())
        terms = [sums[end - 1] + spelled]
        for start in range(max(0, end - longest), end):
            piece = marked[start:end]
            if piece in pieces:
                terms.append(sums[start] + log_p[pieces[piece]][language])
        most = max(terms)
        sums.append(most + math.log(sum(math.exp(t - most) for t in terms)))
    return sums[-1]


def word_of(length, seed):
    random.seed(seed)
    return "".join(random.choice("aeinrstlöéß中") for _ in range(length))


@pytest.mark.parametrize("length", [1, 5, 63, 64, 65, 130, 700])
def test_words_of_every_length(pieces, log_p, length):
    word = word_of(length, length)
    known = language_id._Words(language_id.PieceModel(LANGUAGES, pieces, log_p))
    known.learn({word})
    want = [plain("▁" + word, pieces, log_p, language) for language in range(2)]
    assert known.table[known[word]] == pytest.approx(want, rel=1e-9)


def test_stretches_of_a_long_word(pieces, log_p, monkeypatch):
    word = "▁" + word_of(300, 3)
    table = language_id.Pieces(pieces)
    whole = language_id.long_word(word, table, log_p)
    assert whole == pytest.approx([plain(word, pieces, log_p, k) for k in range(2)], rel=1e-9)
    for stretch in (1, 7, 64, 299):
        monkeypatch.setattr(language_id, "_STRETCH", stretch)
        assert language_id.long_word(word, table, log_p) == pytest.approx(whole, rel=1e-12)


def test_predictions_against_plain_sums(spark, pieces):
    """Fitted as the query does; each text is judged by plain sums over its words."""
    texts = [
        ("en", "the house and the garden of the old man"),
        ("de", "das haus und der garten des alten mannes"),
        ("fr", "la maison et le jardin du vieil homme"),
    ]
    rows = [(i, f"{text} {word_of(3 + i % 90, i)}", lang) for i in range(60) for lang, text in [texts[i % 3]]]
    rows += [(100, None, None), (101, "12 34 !", "en"), (102, "", None), (103, "x" * 5000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tables = Scratch(spark, "predictions")
    model = language_id.fit(frame, tables, sample=15)
    found = {r["doc_id"]: r for r in language_id.predict(frame, model).collect()}
    tables.close()
    assert model.languages == ["de", "en", "fr"]
    for doc_id, text, _ in rows:
        words = [language_id.spelled(word) for word in language_id.words_of(text)]
        if not any(words):
            assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
            continue
        total = [
            sum(plain(word, pieces, model.log_p, k) for word in words if word) for k in range(3)
        ]
        best = max(range(3), key=lambda k: (total[k], -k))
        score = 1 / sum(math.exp(t - total[best]) for t in total)
        assert found[doc_id]["lang_pred"] == model.languages[best]
        assert found[doc_id]["score"] == pytest.approx(score, rel=1e-6)


def test_the_sample_is_the_least_hashes_of_each_language(spark):
    """Cut in parts first, and the same documents."""
    from pyspark.sql import functions as F

    rows = [(i, f"word{i}", "en" if i % 3 else "de") for i in range(900)] + [(None, "w", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tables = Scratch(spark, "sample")
    language_id.fit(frame, tables, sample=40, rounds=0)
    kept = spark.table(tables._tables["language_sample"])
    found = {lang: {r["doc_id"] for r in kept.where(F.col("lang") == lang).collect()} for lang in ("de", "en")}
    hashed = frame.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).collect()
    for lang, ids in found.items():
        order = sorted((r["h"], r["doc_id"] or -1, r["doc_id"]) for r in hashed if r["lang"] == lang)
        assert ids == {doc_id for _, _, doc_id in order[:40]}
    tables.close()
