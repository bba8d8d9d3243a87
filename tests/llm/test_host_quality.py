"""Quality rules by document and by host."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from trailmetrics.llm import host_quality

SCHEMA = "doc_id long, text string, source string, n_words string, __own string"


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = brute.spaced(text)
    lines = [line for line in text.split("\n") if brute.spaced(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {
        i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "a b c d e",
    "a b c d e a b c d e",
    "a a a a a a a a a a a a",
    "x\x85y z w é€\U0001f600 #*$%&|<> end of ten words here",
    "one line here\none line here\n\n\none line here \n \n \nlast\nlast",
    " ".join(f"w{i}" for i in range(40)) + " " + " ".join(f"w{i}" for i in range(3, 9)),
]


def judged(spark, scratch, rows, **options):
    frame = spark.createDataFrame([(*row, "own", "own") for row in rows], SCHEMA)
    return host_quality.judge(frame, scratch, **options)


def test_measures(spark, scratch):
    rows = [(i, text, "s") for i, text in enumerate(TEXTS)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = judged(spark, scratch, rows).select("doc_id", *[f"__llm_{n}" for n in names])
    want = [(i, *plain(text)) for i, text, _ in rows]
    assert sorted(map(tuple, found.collect())) == want


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(60))


def test_hosts_that_mostly_fail_take_their_documents_with_them(spark, scratch):
    rows = [(i, good(i), f"good{i % 8}") for i in range(240)]
    rows += [(1000 + i, "short" if i % 10 else good(i), "bad") for i in range(100)]
    # One bad document is not enough to judge a host by.
    rows += [(2000, "short", "tiny"), (2001, None, None), (2002, good(2), None)]
    rows += [(3000, good(3), "tiny")]
    found = {
        row["doc_id"]: row
        for row in judged(spark, scratch, rows).collect()
    }
    assert len(found) == len(rows)
    for doc_id, text, source in rows:
        row = found[doc_id]
        assert row["__llm_base_failed"] == (text is None or text == "short")
        assert row["__llm_host_failed"] == (source == "bad")
        assert row["__llm_kept"] == (text not in (None, "short") and source != "bad")


def test_shrunk_rates(spark):
    """The prior from numpy, for hosts of many sizes."""
    random = np.random.default_rng(5)
    rows = [
        (host, bool(failed))
        for host, (n, p) in enumerate(zip(random.integers(1, 60, 30), random.beta(2, 6, 30)))
        for failed in random.random(n) < p
    ]
    frame = spark.createDataFrame(rows, "host int, failed boolean")
    found = host_quality.host_rates(frame, "host", {"r": F.col("failed")}).collect()
    n = np.bincount([host for host, _ in rows])
    f = np.bincount([host for host, _ in rows], [failed for _, failed in rows])
    total, mean = n.sum(), f.sum() / n.sum()
    spread = (n * (f / n - mean) ** 2).sum() - (len(n) - 1) * mean * (1 - mean)
    alike = spread / (total - (n**2).sum() / total) / (mean * (1 - mean))
    strength = 1 / min(max(alike, 1 / (total + 1)), 0.5) - 1
    assert 1 < strength < total
    for row in found:
        h = row["__llm_host"]
        want = (f[h] + mean * strength) / (n[h] + strength)
        assert row["rate_r"] == pytest.approx(want)


def test_rows_are_kept_whole(spark, scratch):
    rows = [(i, good(i), f"good{i % 4}") for i in range(40)]
    rows += [(None, good(1), "good1")] * 2 + [(7, "short", "good1"), (8, good(9), None)]
    frame = spark.createDataFrame([(*row, "own", "own") for row in rows], SCHEMA)
    kept = host_quality.drop_low_quality(frame, scratch)
    assert kept.columns == frame.columns
    want = [(*row, "own", "own") for row in rows if row[1] != "short"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_a_very_long_text(spark, scratch):
    assert judged(spark, scratch, []).count() == 0
    long = " ".join(str(i) for i in range(300_000)) + " 0 1 2 3 4"
    (row,) = judged(spark, scratch, [(1, long, "s")]).collect()
    assert row["__llm_n_words"] == 300_005 and row["__llm_n_repeat_words"] == 10
    assert row["__llm_kept"]
