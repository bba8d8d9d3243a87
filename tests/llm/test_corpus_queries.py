"""The registered corpus queries against DuckDB, or against plain versions."""

from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR, same

import __spark_entry__ as entry_point
import brute
from trailmetrics.llm import lm_score, queries
from trailmetrics.runtime import Scratch

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    """Rows of a small table, as tuples of some columns."""

    def rows(name, *columns):
        frame = spark.read.parquet(f"{SMALL}/{name}.parquet").select(*columns)
        return [tuple(row) for row in frame.collect()]

    return rows


def found(spark, name, *columns):
    return sorted(tuple(r) for r in queries.QUERIES[name](spark, SMALL).select(*columns).collect())


def test_queries_are_registered():
    assert queries.QUERIES.keys() <= entry_point.queries().keys()
    assert queries.ORACLE_SQL.keys() <= entry_point.oracle_sql().keys()
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry_point.queries()


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_against_sql(name, spark, duck):
    assert same(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLE_SQL[name]) > 200


def test_op1(spark, table):
    sources = dict(table("documents", "doc_id", "source"))
    texts = dict(table("documents", "doc_id", "text"))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    names = ("doc_id", "size", "source_size", "target", "taken")
    result = found(spark, "op1_mixing", *names)
    for doc_id, size, *_, words in result:
        source = sources[doc_id]
        assert size == len(brute.spaced(texts[doc_id])) and words in (0, size, 2 * size)
        sizes[source] += size
        taken[source] += words
        largest[source] = max(largest[source], size)
    targets = brute.targets(sizes)
    for doc_id, _, source_size, target, _ in result:
        assert source_size == sizes[sources[doc_id]]
        assert target == pytest.approx(targets[sources[doc_id]])
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, words in taken.items():
        assert abs(words - targets[source]) <= largest[source] / 2 + 1
    assert found(spark, "op1_mixing", *names) == result


def test_op3(spark, table):
    want = brute.near_duplicates(table("documents", "doc_id", "text"))
    result = found(spark, "op3_minhash", "doc_id", "n_shingles", "component_id", "kept")
    assert result == [(*row, row[0] == row[2]) for row in want]
    assert any(not row[3] for row in result)


def test_op5(spark, table):
    want = brute.cosine_links(table("embeddings", "vec_id", "embedding", "label"))
    result = found(spark, "op5_embeddings", "vec_id", "n_links", "component_id", "kept")
    assert result == sorted((*row, row[0] == row[2]) for row in want)


def test_op6(spark, table):
    want = brute.passages(table("documents", "doc_id", "text"))
    result = found(spark, "op6_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert result == [(*row[:3], brute.sha256(row[3])) for row in want]
    assert any(row[2] for row in result)


def test_op8(spark, table):
    result = found(
        spark, "op8_url_filter", "page_id", "host", "path", "rule", "verdict", "template", "purity"
    )
    parts = {page_id: brute.url_parts(url) for page_id, url in table("pages", "page_id", "url")}
    want = brute.url_verdicts(list(parts.values()), queries.URL_RULES)
    assert len(result) == len(parts)
    for page_id, host, path, *judged in result:
        assert (host, path) == parts[page_id]
        *wanted, purity = want[host, path]
        assert judged[:3] == wanted and judged[3] == pytest.approx(purity)


def test_op4_finds_toxic_documents_that_it_was_not_fitted_on(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    from trailmetrics.llm import toxicity

    known = labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 0")
    tables = Scratch(spark, "held_out")
    scores = toxicity.score(documents, toxicity.fit(documents, known, tables))
    held_out = labels.join(known, "doc_id", "left_anti").select(
        "doc_id", labels["toxic"].alias("label")
    )
    pairs = [(r["label"], r["toxic"]) for r in scores.join(held_out, "doc_id").collect()]
    tables.close()
    toxic = [said for label, said in pairs if label]
    clean = [said for label, said in pairs if not label]
    # Some labels are wrong on purpose.
    assert np.mean(toxic) > 0.9
    assert np.mean(clean) < 0.01


def test_op9_tells_good_documents_from_bad(spark, table):
    labels = dict(table("labels", "doc_id", "quality"))
    scores = found(spark, "op9_lm_scoring", "doc_id", "score")
    good = [score for doc_id, score in scores if labels.get(doc_id) == 1 and score is not None]
    bad = [score for doc_id, score in scores if labels.get(doc_id) == 0 and score is not None]
    ranked = np.mean([g < b for g in good for b in bad])
    assert ranked > 0.95


def test_op9_ranks_documents_that_taught_it_nothing(spark):
    """Half of the good documents are the target; the others rank like them, and below bad ones."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.select("doc_id", "quality").collect()}
    good = sorted(i for i, label in quality.items() if label == 1)
    target = spark.createDataFrame([(i,) for i in good[::2]], "doc_id long")
    tables = Scratch(spark, "left_out")
    found = lm_score.score(documents, target, tables, slices=2).where("n_words > 0").collect()
    tables.close()
    scores = {row["doc_id"]: row["score"] for row in found}

    def below(some, others):
        some, others = (np.array([scores[i] for i in ids if i in scores]) for ids in (some, others))
        return np.mean(some[:, None] < others[None, :])

    bad = [i for i, label in quality.items() if label == 0]
    assert below(good[1::2], bad) > 0.95
    assert abs(below(good[::2], good[1::2]) - 0.5) < 0.05


def test_op9_does_not_tell_who_was_a_target(spark):
    """Of documents that are targets by chance, half rank below the others."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    chosen = documents.where("pmod(xxhash64(doc_id, 5), 10) = 0").select("doc_id")
    tables = Scratch(spark, "by_chance")
    found = lm_score.score(documents, chosen, tables, slices=2).where("n_words > 20").collect()
    targets = {row["doc_id"] for row in chosen.collect()}
    tables.close()
    inside = np.array([row["score"] for row in found if row["doc_id"] in targets])
    others = np.array([row["score"] for row in found if row["doc_id"] not in targets])
    assert abs(np.mean(inside[:, None] < others[None, :]) - 0.5) < 0.05


def test_op10_predicts_held_out_languages(spark, table):
    langs = dict(table("documents", "doc_id", "lang"))
    result = found(spark, "op10_language_id", "doc_id", "held_out", "lang_pred", "score")
    assert len(result) == len(langs)
    held_out = [langs[doc_id] == lang for doc_id, held, lang, _ in result if held]
    assert np.mean(held_out) > 0.95 and len(held_out) > 20
    assert all(0 <= score <= 1 for *_, score in result)
