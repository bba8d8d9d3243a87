"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from trailmetrics.llm import (
    decontaminate,
    embeddings,
    language_id,
    line_dedup,
    lm_score,
    minhash,
    mixing,
    substrings,
    toxicity,
    url_filter,
)
from trailmetrics.runtime import Scratch

LINE = "This line stands in many of the documents, as licences do."
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(80))
ITEM = "Which of these thirteen words of the item will be found in a document again"

# doc_id, text, lang, source
DOCUMENTS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\x0b\x0c\r ", "en", "a"),
    (4, LONG, "en", "b"),
    (5, LONG + " and an end", "en", "b"),
    (6, PASSAGE + "\n" + LINE, "fr", "c"),
    (6, PASSAGE + "\n" + LINE, "fr", "c"),
    (7, "Before it.\n" + PASSAGE + "\n" + LINE, "fr", "c"),
    (8, "Uno dos tres.\n  " + LINE.upper() + "\t\n" + ITEM, "es", "c"),
    (9, LINE + "\r\n" + LINE + "\n\n", "en", None),
    (10, "A tie of equals", "en", "a"),
    (11, "a TIE of equals", "en", "a"),
    (12, "ÄÖÜ groß É " * 40 + "\n" + LINE, "de", "d"),
    (None, "A text without an id.\n" + PASSAGE, "en", "d"),
    (None, LINE, None, None),
]
CLASHING = "size copies n_lines kept component_id node band anchor rank start key h1 toxic".split()


def clashing():
    """Columns that an operator might mistake for its own."""
    return {name: F.lit(f"own {name}") for name in CLASHING}


@pytest.fixture(scope="module")
def documents(spark):
    frame = spark.createDataFrame(DOCUMENTS, "doc_id long, text string, lang string, source string")
    return frame.withColumns({"n_chars": F.length("text").cast("long")} | clashing())


@pytest.fixture
def keep(spark):
    tables = Scratch(spark, "awkward")
    yield tables
    tables.close()


def rows(frame, *names):
    found = [tuple(row) for row in frame.select(*names).collect()]
    return sorted(found, key=repr)


def expected(found):
    return sorted((tuple(row) for row in found), key=repr)


def with_ids(lowest):
    """(doc_id, text) with a number in place of the null id."""
    return [(lowest if doc_id is None else doc_id, text) for doc_id, text, *_ in DOCUMENTS]


def test_line_dedup(documents, keep):
    left = line_dedup.dedup_lines(documents, keep, min_documents=3, counts=("lines", "dropped"))
    assert left.columns == [*documents.columns, "lines", "dropped"]
    want = brute.line_dedup(with_ids(-1), documents=3)
    got = rows(left.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))), "doc_id", "lines", "dropped", "text")
    assert got == expected(want)
    assert {row[0] for row in rows(left, "size")} == {"own size"}


def test_near_duplicates(documents, keep):
    found = rows(minhash.near_duplicates(documents, keep), "doc_id", "n_shingles", "component_id", "kept")
    distinct = {doc_id: text for doc_id, text, *_ in DOCUMENTS if doc_id is not None}
    want = {row[0]: row for row in brute.near_duplicates(distinct.items())}
    assert len(found) == len(DOCUMENTS)
    for doc_id, size, component, kept in found:
        if doc_id is None:
            assert (component, kept) == (None, True)
        else:
            assert (doc_id, size, component) == want[doc_id]
            assert kept == (doc_id == component)
    assert {row[0] for row in found if not row[3]} == {5, 7, 11}


def test_near_duplicates_are_dropped_row_by_row(spark, documents, keep):
    left = minhash.drop_near_duplicates(documents, keep)
    assert left.columns == documents.columns
    # Without an id, a text is judged like any other; it is a copy of document 6.
    gone = [(5, LONG + " and an end"), (7, DOCUMENTS[7][1]), (11, "a TIE of equals")]
    gone.append((None, "A text without an id.\n" + PASSAGE))
    want = expected(d[:2] for d in DOCUMENTS if d[:2] not in gone)
    assert rows(left, "doc_id", "text") == want
    end = " and two more"
    rows_ = [
        *[(None, PASSAGE)] * 2,
        (None, PASSAGE + end),
        (2, PASSAGE + " and an end"),
        # A clean text with the id of a copy.
        (2, ITEM),
        (1, PASSAGE.upper()),
        (None, None),
        (None, None),
        (3, ""),
    ]
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    want = [(2, ITEM), (1, PASSAGE.upper()), (None, None), (None, None), (3, "")]
    assert rows(minhash.drop_near_duplicates(frame, keep), "doc_id", "text") == expected(want)
    nameless = spark.createDataFrame([(None, PASSAGE), (None, PASSAGE + end)], frame.schema)
    assert minhash.drop_near_duplicates(nameless, keep).count() == 1


def test_near_duplicates_of_ids_with_empty_rows(spark, keep):
    rows_ = [(1, PASSAGE), (1, None), (1, " "), (2, PASSAGE + " and an end"), (3, None), (3, "")]
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    found = rows(minhash.near_duplicates(frame, keep), "doc_id", "component_id", "kept")
    assert found == [(1, 1, True)] * 3 + [(2, 1, False)] + [(3, 3, True)] * 2


def test_passages(documents, keep):
    found = rows(
        substrings.dedup_passages(documents, keep), "doc_id", "n_words", "n_removed", "kept_sha256"
    )
    distinct = {doc_id: text for doc_id, text, *_ in DOCUMENTS if doc_id is not None}
    want = {
        doc_id: (doc_id, words, removed, brute.sha256(text))
        for doc_id, words, removed, text in brute.passages(distinct.items())
    }
    by_null = [
        (None, len(brute.spaced(d[1])), 0, brute.sha256(" ".join(brute.spaced(d[1]))))
        for d in DOCUMENTS
        if d[0] is None
    ]
    assert found == expected([want[d[0]] for d in DOCUMENTS if d[0] is not None] + by_null)
    assert want[5][2] > 29_000 and want[7][2] == 91


def test_contamination(spark, documents, keep):
    items = [(1, ITEM), (2, "groß"), (3, None), (4, "..."), (None, "tie OF equals"), (10, ITEM)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    judged = decontaminate.contamination(documents, benchmark, keep, broadcast_rows=2)
    want = brute.contamination(
        [(d[0], d[1]) for d in DOCUMENTS], [item for item in items if item[0] is not None]
    )
    hits = brute.contamination([(d[0], d[1]) for d in DOCUMENTS], items)
    want = [(d, n, h[2], found) for (d, n, _, found), h in zip(want, hits)]
    got = rows(judged, "doc_id", "__llm_n_words", "__llm_n_hit", "__llm_items")
    assert got == expected(want)
    kept = decontaminate.decontaminate(documents, benchmark, keep)
    assert kept.columns == documents.columns
    clean = [row[:1] for row in hits if not brute.contaminated(row)]
    assert rows(kept, "doc_id") == expected(clean)


def test_mixing(spark, documents, keep):
    mix = mixing.mix(documents, keep)
    assert mix.columns[: len(documents.columns)] == documents.columns
    found = mix.select("source", "text", "__llm_size", "__llm_source_size", "__llm_target", "__llm_copies").collect()
    assert len(found) == len(DOCUMENTS)
    sizes, taken = {}, {}
    for source, text, size, *_, copies in found:
        assert size == len(brute.spaced(text)) and copies in (0, 1, 2)
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + copies * size
    targets = brute.targets(sizes)
    largest = {}
    for source, _, size, source_size, target, _ in found:
        assert source_size == sizes[source]
        assert target == pytest.approx(targets[source])
        largest[source] = max(size, largest.get(source, 0))
    for source, words in taken.items():
        assert abs(words - targets[source]) <= largest[source] / 2 + 1
    # Rows of one size without ids, in any order.
    alike = spark.createDataFrame([(None, f"text {i}", "s") for i in range(200)], "doc_id long, text string, source string")
    taken = [
        rows(mixing.mix(alike.repartition(n).sortWithinPartitions(F.rand(n)), keep), "text", "__llm_copies")
        for n in (1, 5)
    ]
    assert taken[0] == taken[1]
    again = rows(mixing.mix(documents, keep), "doc_id", "__llm_copies")
    assert rows(mix, "doc_id", "__llm_copies") == again
    mixed = mixing.mixed(documents.withColumn("copy", F.lit(0)), keep)
    assert mixed.columns == [*documents.columns, "copy"]
    assert mixed.count() == sum(row["__llm_copies"] for row in found)


def test_a_mix_that_misses_its_targets_is_an_error(spark, keep):
    rows_ = [(i % 40 + 1, "a" * (1 + i % 2), 1) for i in range(400)]
    histogram = spark.createDataFrame(rows_, "__llm_size long, __llm_source string, __llm_n long")
    sizes = histogram.groupBy("__llm_source").agg(
        F.sum(F.col("__llm_n") * F.col("__llm_size")).alias("__llm_source_size")
    )
    targets = mixing.source_targets(sizes).drop("weight")
    assert mixing.balanced(histogram, targets, keep).count() == 2
    with pytest.raises(RuntimeError, match="misses a target"):
        mixing.balanced(histogram, targets, keep, tolerance=-1.0)


def labels_of(spark):
    found = [(doc_id, 1, int(doc_id in (8, 9))) for doc_id in range(1, 13)]
    return spark.createDataFrame(
        [*found, (None, None, None), (2, 0, None), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )


def test_toxicity(spark, documents, keep):
    model = toxicity.fit(documents, labels_of(spark), keep, parts=2)
    scores = toxicity.score(documents, model)
    assert scores.columns == ["doc_id", "severity", "p_toxic", "grade", "toxic"]
    found = rows(scores, "doc_id", "severity", "p_toxic", "toxic")
    assert len(found) == len(DOCUMENTS)
    assert all(0 <= row[1] <= 2 and 0 <= row[2] <= 1 for row in found)
    kept = toxicity.drop_toxic(documents, labels_of(spark), keep)
    assert kept.columns == documents.columns
    one_kind = labels_of(spark).withColumn("toxic", F.lit(0))
    assert toxicity.fit(documents, one_kind, keep) is None
    assert {row[0] for row in rows(toxicity.score(documents, None), "severity")} == {0.0}


def test_each_row_is_judged_by_its_own_text(spark, keep, monkeypatch):
    given = [spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels")]
    model = toxicity.fit(*given, keep)
    judged = toxicity.score(given[0].withColumn("doc_id", F.monotonically_increasing_id()), model)
    texts = given[0].withColumn("doc_id", F.monotonically_increasing_id()).join(judged, "doc_id")
    toxic, clean = (texts.where(kind).orderBy("doc_id").first()["text"] for kind in ("toxic", "not toxic"))
    monkeypatch.setattr(toxicity, "fit", lambda *_: model)
    found = [(None, toxic), (None, clean), (1, toxic), (1, clean), (1, clean), (2, toxic)]
    frame = spark.createDataFrame(found, "doc_id long, text string")
    kept = toxicity.drop_toxic(frame, given[1], keep)
    assert rows(kept, "doc_id", "text") == expected([(None, clean), (1, clean), (1, clean)])


def test_language(documents, keep):
    model = language_id.fit(documents, keep, rounds=1)
    assert model.languages == ["de", "en", "es", "fr"]
    found = {
        row["doc_id"]: row for row in language_id.predict(documents, model).collect()
    }
    assert len(found) == 13
    for doc_id in (1, 2, 3):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    assert found[12]["lang_pred"] == "de" and 0 < found[12]["score"] <= 1
    untaught = language_id.fit(documents.withColumn("lang", F.lit(None).cast("string")), keep)
    assert {r["lang_pred"] for r in language_id.predict(documents, untaught).collect()} == {"und"}


def test_language_model_scores(spark, documents, keep):
    good = spark.createDataFrame([(6,), (6,), (None,), (77,)], "doc_id long")
    found = rows(lm_score.score(documents, good, keep), "doc_id", "n_words", "score")
    assert len(found) == len(DOCUMENTS)
    by_id = {row[0]: row for row in found}
    assert by_id[1][1:] == (0, None) and by_id[3][1:] == (0, None)
    # Document 7 is a copy of 6, the target; nothing else is nearer.
    assert by_id[7][2] < min(row[2] for row in found if row[0] not in (6, 7, None) and row[1])
    want = brute.bigram_losses([d[:2] for d in DOCUMENTS], [6, 77])
    scores = [(d, n, target - background if n else None) for d, n, target, background in want]
    for got, wanted in zip(found, expected(scores)):
        assert got[:2] == wanted[:2] and got[2] == pytest.approx(wanted[2], abs=1e-9)
    none = lm_score.score(documents, good.where("false"), keep)
    assert none.where("score IS NOT NULL").count() == len([d for d in DOCUMENTS if brute.spaced(d[1])])


def test_embeddings(spark, keep):
    unit = [1.0, 0.0, 0.0]
    near = [0.99, 0.14, 0.0]
    vectors = [
        (1, unit, 1),
        (2, unit, 1),
        (2, unit, 1),
        (3, near, 1),
        (4, near, 2),
        (5, None, 1),
        (6, [0.0, 0.0, 0.0], 1),
        (7, [1.0, None, 0.0], 1),
        (8, [float("nan"), 0.0, 0.0], 1),
        (9, [float("inf"), 0.0, 0.0], 1),
        (10, unit, None),
        (11, [], 1),
        (12, [1.0, 0.0], 1),
        (13, [3e38, 0.0, 0.0], 1),
        (None, unit, 1),
    ]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    frame = frame.withColumns(clashing())
    found = rows(embeddings.near_duplicates(frame, keep), "vec_id", "n_links", "component_id", "kept")
    able = {row[0]: row for row in vectors if row[0] in (1, 2, 3, 4, 12, 13)}
    want = {row[0]: (*row, row[0] == row[2]) for row in brute.cosine_links(able.values())}
    for row in vectors:
        want.setdefault(row[0], (row[0], 0, row[0], True))
    assert found == expected(want[row[0]] for row in vectors)
    assert want[1][1] == 3


def test_urls(spark, keep):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "x://a.example.org/es/1?q#f"]
    urls += ["http://b.com/de/1", "http://B.com/de/2", "http://b.com/de", "http://c.net/?/org/"]
    urls += ["http://org/", "http://xorg/", "a://b://c/d", "http://b.com/de/\nx", "http://b.com/" + "y/" * 5000]
    urls += [f"http://n.net/de/{i}" for i in range(4)] * 2
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    pages = pages.withColumns(clashing())
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
    found = {row["page_id"]: row for row in url_filter.filter_urls(pages, table, keep).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path = brute.url_parts(url)
        rule, verdict = brute.url_rule(host, path, rules)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == (verdict or found[i]["verdict"])
    assert found[len(urls) - 1]["template"] == "/de/*"


def test_templates_that_rules_block_are_rejected(spark, keep):
    rules = [("x.net", "/offer/1", "block"), ("x.net", "/news/1", "allow")]
    urls = [f"http://x.net/{kind}/{i}" for kind in ("offer", "news") for i in range(100, 300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
    found = url_filter.filter_urls(pages, table, keep).where("rule IS NULL").collect()
    assert {(row["template"], row["verdict"]) for row in found} == {
        ("/offer/*", "block"),
        ("/news/*", "allow"),
    }


def test_segments_of_many_shapes_are_variable(spark, keep):
    names = [f"{chr(97 + i % 26)}{i}{chr(97 + i // 26)}{'x' * (i % 7)}{i}" for i in range(100)]
    urls = [f"http://y.net/{kind}/{name}" for kind in ("offer", "news") for name in names]
    rules = [("y.net", "/offer/a", "block"), ("y.net", "/offer/b", "allow"), ("y.net", "/news/a", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
    # No later merging of branches whose labels differ.
    found = url_filter.filter_urls(pages, table, keep, deviation=-1.0).collect()
    assert {row["template"] for row in found} == {"/offer/*", "/news/*"}


def test_empty_tables(spark, documents, keep):
    none = documents.where("false")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = labels_of(spark)
    rules = spark.createDataFrame([], "rule_host string, rule_path string, verdict string")
    pages = spark.createDataFrame([], "page_id long, url string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for frame in (
        line_dedup.dedup_lines(none, keep),
        minhash.near_duplicates(none, keep),
        substrings.dedup_passages(none, keep),
        decontaminate.contamination(none, benchmark, keep),
        mixing.mix(none, keep),
        mixing.mixed(none, keep),
        toxicity.score(none, toxicity.fit(none, labels, keep)),
        toxicity.drop_toxic(none, labels, keep),
        language_id.predict(none, language_id.fit(none, keep)),
        lm_score.score(none, labels.select("doc_id"), keep),
        url_filter.filter_urls(pages, rules, keep),
        embeddings.near_duplicates(vectors, keep),
    ):
        assert frame.collect() == []
    assert decontaminate.decontaminate(documents, benchmark, keep).count() == len(DOCUMENTS)


def test_every_stage_takes_awkward_documents(spark, documents, tmp_path):
    labels_of(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for frame in (documents, documents.where("false")):
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, str(tmp_path))
            last = number == len(corpus_pipeline.STAGES) - 1
            assert out.columns == documents.columns + ["copy"] * last, name
            assert out.count() <= 2 * frame.count()
