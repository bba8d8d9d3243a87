"""Each stage of the corpus pipeline against a plain version, on the small tables."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
import corpus_pipeline
from trailmetrics.llm import queries, toxicity
from trailmetrics.runtime import Scratch

SMALL = "/root/testdata/sf0.001"
NAMES = [
    "toxicity",
    "line dedup",
    "MinHash near-dedup",
    "benchmark decontamination",
    "mixing sources",
]


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what comes out, as rows."""
    tables = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        kept = tables.write(stage(spark, docs, SMALL), "kept")
        seen.append((name, docs, kept))
        docs = kept
    yield seen
    tables.close()


def texts(frame):
    return [tuple(row) for row in frame.select("doc_id", "text").collect()]


def test_order_and_columns(stages, spark):
    assert [name for name, *_ in stages] == NAMES
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    for name, given, kept in stages[:-1]:
        assert given.columns == kept.columns == columns
        # Every filter removes some documents and keeps most.
        assert given.count() * 0.6 < kept.count() <= given.count()
    assert stages[-1][2].columns == [*columns, "copy"]


def test_toxicity(stages, spark):
    _, given, kept = stages[0]
    tables = Scratch(spark, "plain")
    model = toxicity.fit(given, spark.read.parquet(f"{SMALL}/labels.parquet"), tables)
    tables.close()
    features = toxicity.Features()
    rows = texts(given)
    scores = []
    for _, text in rows:
        numbers, rates = features.of(text)
        scores.append(sum(model.weights[n] * r for n, r in zip(numbers, rates)))
    odds = 1 / (1 + np.exp(model.limits[0] - np.array(scores)))
    clean = [row for row, p in zip(rows, odds) if p < 0.3]
    assert sorted(texts(kept)) == sorted(clean)
    assert len(clean) < len(rows)


def test_line_dedup(stages):
    _, given, kept = stages[1]
    want = [(row[0], row[3]) for row in brute.line_dedup(texts(given))]
    assert sorted(texts(kept)) == sorted(want)
    assert sorted(texts(given)) != sorted(want)


def test_near_duplicates(stages):
    _, given, kept = stages[2]
    stay = {row[0] for row in brute.near_duplicates(texts(given)) if row[0] == row[2]}
    assert sorted(texts(kept)) == sorted(row for row in texts(given) if row[0] in stay)


def test_decontamination(stages, spark):
    _, given, kept = stages[3]
    items = texts_of_items(spark)
    dirty = {r[0] for r in brute.contamination(texts(given), items) if brute.contaminated(r)}
    assert sorted(texts(kept)) == sorted(row for row in texts(given) if row[0] not in dirty)


def texts_of_items(spark):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    return [tuple(row) for row in benchmark.select("item_id", "text").collect()]


def test_mixing(stages):
    _, given, kept = stages[4]
    sources = {row["doc_id"]: row["source"] for row in given.collect()}
    size = {doc_id: len(brute.spaced(text)) for doc_id, text in texts(given)}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for doc_id, words in size.items():
        sizes[sources[doc_id]] += words
        largest[sources[doc_id]] = max(words, largest[sources[doc_id]])
    copies = Counter(row["doc_id"] for row in kept.collect())
    assert set(copies) <= set(size) and max(copies.values()) == 2
    for doc_id, count in copies.items():
        taken[sources[doc_id]] += count * size[doc_id]
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1


def test_the_run_is_the_chain_of_stages(stages, spark):
    result = corpus_pipeline.run(spark, SMALL)
    names = ("doc_id", "text", "copy")
    chain = [tuple(row) for row in stages[-1][2].select(*names).collect()]
    assert sorted(tuple(row) for row in result.select(*names).collect()) == sorted(chain)
    assert corpus_pipeline.ORACLE_SQL is None
    assert len(queries.QUERIES) == 13


def test_a_run_leaves_its_result_only(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    corpus_pipeline.run(spark, SMALL)
    (new,) = set(os.listdir(shared)) - before
    assert os.listdir(f"{shared}/{new}") == ["stage_4_5"]
