"""What happens to large groups, with bounds made small enough to reach."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from trailmetrics.llm import decontaminate, embeddings, language_id, lm_score, minhash, substrings
from trailmetrics.llm.graph import components
from trailmetrics.llm.toxicity import fit, grade_odds, loss_and_gradient, thresholds
from trailmetrics.llm.words import WordHashes, runs
from trailmetrics.runtime import Scratch


@pytest.fixture
def keep(spark):
    tables = Scratch(spark, "large")
    yield tables
    tables.close()


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, keep, kind):
    rng = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(300)],
        "star": [(0, i) for i in range(1, 400)] + [(5, 5)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)],
        "none": [],
    }[kind]
    frame = spark.createDataFrame(edges, "u long, v long")
    union = brute.Union({node for edge in edges for node in edge})
    for a, b in edges:
        union.join(a, b)
    want = {node: union.find(node) for a, b in edges if a != b for node in (a, b)}
    assert {tuple(r) for r in components(frame, keep, "g").collect()} == set(want.items())


def copies(count, words, changed, seed):
    """Texts that differ from one another in some words each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    texts = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randrange(changed + 1)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    return texts


@pytest.fixture(scope="module")
def crowd():
    texts = copies(150, 120, 12, 1) + copies(20, 30, 2, 2) + ["alone " + t for t in copies(30, 8, 8, 3)]
    texts += [texts[0]] * 40
    random.Random(5).shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [10**6, 2000])
def test_near_duplicates_in_blocks(spark, keep, crowd, block):
    frame = spark.createDataFrame(crowd, "doc_id long, text string")
    found = minhash.near_duplicates(frame, keep, block_shingles=block, pivots=3)
    got = sorted(tuple(row) for row in found.select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute.near_duplicates(crowd)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for size, same in ((5, 4), (400, 300), (3000, 1000)):
        pool = rng.integers(0, 2**63, 2 * size, dtype=np.uint64)
        a, b = pool[:size], np.concatenate([pool[:same], pool[size : 2 * size - same]])
        sketches = [minhash.sketch(np.unique(values)) for values in (a, b)]
        assert all(s.max() < np.iinfo(np.uint64).max for s in sketches)
        alike = np.mean(sketches[0] == sketches[1])
        assert abs(alike - same / (2 * size - same)) < 0.17


def test_runs_tell_orders_apart():
    hashes = WordHashes()
    seen = {}
    for words in ("a a a b b", "b b b b a", "a b a b a", "b a a a b", "a a a a b", "b b a a a"):
        value = runs(hashes.of(words.encode().split()), 5)[0]
        assert seen.setdefault(value, words) == words


@pytest.mark.parametrize(("phrases", "words"), [(10**6, 10**6), (20, 500)])
def test_passages_in_shards(spark, keep, crowd, phrases, words):
    frame = spark.createDataFrame(crowd, "doc_id long, text string")
    found = substrings.dedup_passages(frame, keep, shard_phrases=phrases, shard_words=words)
    got = sorted(
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect()
    )
    want = [(*row[:3], brute.sha256(row[3])) for row in brute.passages(crowd)]
    assert got == want
    assert sum(row[2] > 0 for row in want) > 50


def test_contamination_in_parts(spark, keep):
    items = [(i, text) for i, text in enumerate(copies(12, 20, 5, 7))] + [(99, "one two")]
    documents = [(i, f"before {text.upper()}, after") for i, (_, text) in enumerate(items)]
    documents.append((50, "one two one two three"))
    found = decontaminate.contamination(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        keep,
        broadcast_rows=7,
    )
    names = ("doc_id", "__llm_n_words", "__llm_n_hit", "__llm_items", "__llm_contaminated")
    want = brute.contamination(documents, items)
    got = [tuple(row) for row in found.select(*names).orderBy("doc_id").collect()]
    assert got == [(*row, brute.contaminated(row)) for row in sorted(want)]


def vectors(seed=2):
    """Background vectors, and groups of near copies around and below the threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    for size, noise in ((400, 0), (200, 0.02), (25, 0.016), (2, 0.01), (60, 0.03)):
        centre = rng.standard_normal(32)
        for _ in range(size):
            if noise == 0:
                rows.append(rng.standard_normal(32))
            else:
                rows.append(centre + noise * np.linalg.norm(centre) * rng.standard_normal(32))
    rows += [rows[450]] * 5
    labels = [int(i % 2) if i < 400 else 0 for i in range(len(rows))]
    return [(i, [float(x) for x in row], labels[i]) for i, row in enumerate(rows)]


@pytest.mark.parametrize(("block", "neighbours"), [(1024, 10), (64, 5)])
def test_embeddings_in_blocks(spark, keep, block, neighbours):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embeddings.near_duplicates(frame, keep, block=block, neighbours=neighbours)
    got = sorted(tuple(row) for row in found.collect())
    want = [(*row, row[0] == row[2]) for row in brute.cosine_links(rows)]
    assert got == sorted(want)
    assert max(row[1] for row in want) > 50


def test_the_forward_sum_covers_all_segmentations():
    pieces = language_id.load_pieces(language_id.VOCABULARY)
    table = language_id.Pieces(pieces)
    rng = np.random.default_rng(0)
    log_p = np.log(rng.dirichlet(np.ones(len(pieces)), 2).T + 1e-12)

    def plain(word, language):
        total = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            spelled = sum(log_p[pieces[f"<0x{b:02X}>"], language] for b in word[end - 1].encode())
            total[end] = total[end - 1] * math.exp(spelled)
            for start in range(end):
                if word[start:end] in pieces:
                    total[end] += total[start] * math.exp(log_p[pieces[word[start:end]], language])
        return math.log(total[-1])

    words = ["▁hello", "▁großx", "▁été̀1", "▁thing"]
    summed = language_id.Lattice(words, table).forward(log_p)[-1]
    for word, row in zip(words, summed):
        assert row == pytest.approx([plain(word, 0), plain(word, 1)])
    # Expected uses of pieces and bytes spell the word's characters.
    uses = np.zeros_like(log_p)
    language_id.Lattice(["▁thing"], table).expected(log_p, np.ones((1, 2)), uses)
    lengths = np.array([len(p) for p in pieces])
    for byte in range(256):
        lengths[pieces[f"<0x{byte:02X}>"]] = 1
    # The mark of a word's start has three bytes.
    assert 6 <= (uses[:, 0] @ lengths) <= 8


def test_gradient_of_the_ordinal_loss():
    rng = np.random.default_rng(4)
    owner = np.sort(rng.integers(0, 30, 120))
    numbers, rates = rng.integers(0, 9, 120), rng.random(120)
    grades = rng.integers(0, 3, 30)
    x = np.concatenate([rng.standard_normal(9), [-0.3, 0.2]])

    def both(x):
        return loss_and_gradient(owner, numbers, rates, grades, x[:9], x[9:])

    def loss(x):
        return both(x)[0]

    _, by_weight, by_free = both(x)
    for i, slope in enumerate([*by_weight, *by_free]):
        step = np.zeros(11)
        step[i] = 1e-5
        assert slope == pytest.approx((loss(x + step) - loss(x - step)) / 2e-5, abs=1e-5)
    odds = grade_odds(np.array([-1.0, 0.0, 50.0]), thresholds(x[9:]))
    assert odds.sum(axis=1) == pytest.approx(1) and (odds >= 0).all()


def test_one_gradient_reaches_the_driver(spark, keep, monkeypatch):
    """Tasks' gradients are added up before the driver gets them, so that more tasks send no more."""
    rng = random.Random(3)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    texts = [(i, " ".join(rng.choices(words[(i % 2) * 100 :], k=60))) for i in range(240)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    labels = frame.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    kind, held = type(frame), []
    collect = kind.collect

    def watched(self):
        found = collect(self)
        if "sums" in self.columns:
            held.append(sum(len(row["sums"]) for row in found))
        return found

    monkeypatch.setattr(kind, "collect", watched)
    models = []
    for parts in (1, 6):
        models.append(fit(frame, labels, keep, parts=parts, steps=4))
    assert len(held) > 2 and len(set(held)) == 1
    assert models[0].weights == pytest.approx(models[1].weights, abs=1e-6)


def test_models_are_matched_and_words_are_known_by_count(spark, keep):
    rows = [(i, "the cat sat on the mat " * 3) for i in range(20)]
    rows += [(100 + i, f"zz{i} qq{i} the " * 4) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.range(20).withColumnRenamed("id", "doc_id")
    scores = {r["doc_id"]: r for r in lm_score.score(frame, target, keep, vocabulary=50).collect()}
    assert scores[0]["score"] < -0.3 and scores[120]["score"] > 0
    assert scores[0]["n_words"] == 18
    again = lm_score.score(frame.repartition(5), target, keep, vocabulary=50, words_at_once=3).collect()
    for row in again:
        assert row["score"] == pytest.approx(scores[row["doc_id"]]["score"])
    assert frame.where(F.col("doc_id") < 0).count() == 0


@pytest.mark.parametrize(("frequent", "slices"), [(0, 3), (300, 1), (10**6, 2)])
def test_every_word_and_pair_has_its_own_count(spark, keep, crowd, frequent, slices):
    # More words than a fixed vocabulary of 30,000 knew, each seen twice.
    rare = [" ".join(f"rare{i}x{k % 350}" for k in range(700)) for i in range(100)]
    rows = crowd + [(1000 + i, text) for i, text in enumerate(rare)] + [(2000, rare[0]), (2001, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    good = [*range(0, 100, 2), *range(1000, 1010)]
    target = spark.createDataFrame([(i,) for i in good], "doc_id long")
    found = lm_score.score(
        frame, target, keep, words_at_once=5000, frequent=frequent, slices=slices
    ).collect()
    got = {row["doc_id"]: tuple(row) for row in found}
    want = brute.bigram_losses(rows, good)
    assert len(found) == len(want)
    for doc_id, words, *losses in want:
        assert got[doc_id][1] == words
        if words:
            assert got[doc_id][2:4] == pytest.approx(losses)
            assert got[doc_id][4] == pytest.approx(losses[0] - losses[1], abs=1e-9)
        else:
            assert got[doc_id][2:] == (None, None, None)


def test_pairs_travel_packed(spark, keep, monkeypatch):
    """Spark moves some rows for each batch of texts, not one for each word or pair."""
    texts = [(i, " ".join(f"word{i}x{k}" for k in range(700))) for i in range(50)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    moved, kind = [], type(frame)
    group_by = kind.groupBy

    def counted(self, *columns):
        moved.append(self.count())
        return group_by(self, *columns)

    monkeypatch.setattr(kind, "groupBy", counted)
    scores = lm_score.score(frame, spark.range(20).toDF("doc_id"), keep, slices=2)
    assert moved and sum(moved) < 50 * 700 / 20
    assert scores.where("score IS NOT NULL").count() == 50


@pytest.mark.parametrize("block", [1024, 100])
def test_tight_groups_that_are_linked_to_each_other(spark, keep, block):
    # Lists of 10 are full of a group's own members; groups 0 and 1, and 1 and 2, are linked.
    rng = np.random.default_rng(6)
    rows = []
    for group, size in enumerate((200, 200, 30)):
        centre = np.zeros(32)
        centre[:2] = np.cos(0.1735 * group), np.sin(0.1735 * group)
        rows += [centre + 0.001 * rng.standard_normal(32) for _ in range(size)]
    rows += list(rng.standard_normal((50, 32)))
    rows = [(i, [float(x) for x in row], 0) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(row) for row in embeddings.near_duplicates(frame, keep, block=block).collect())
    want = [(*row, row[0] == row[2]) for row in brute.cosine_links(rows)]
    assert got == sorted(want)
    assert want[0][1] == 399 and want[429][2] == 0


def test_an_audit_that_fails_is_an_error(spark, keep, monkeypatch):
    frame = spark.createDataFrame(vectors()[:20], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embeddings, "audit", lambda *_: (10, 5))
    with pytest.raises(RuntimeError, match="5 of 10 links"):
        embeddings.near_duplicates(frame, keep, attempts=2)


def test_windows_with_one_common_word(spark, scratch):
    """Windows are looked up by the hash of all their words, so a word that all share costs
    nothing: each place of a text meets the windows that stand there and no others."""
    common = "internationalisation"
    items = [
        (i, " ".join([f"w{i}", common, *(f"x{i}y{j}" for j in range(3, 13)), f"z{i % 7}"]))
        for i in range(400)
    ]
    items += [(400, common), (401, f"{common} of three"), (402, None), (403, "w0 " + common)]
    texts = [
        (i, " ".join([f"{common} a{i}", items[i][1], common, f"{common} of three or w0", items[-i - 5][1]]))
        for i in range(60)
    ]
    texts += [(60, common), (61, None), (62, "w0"), (63, items[5][1][:-1])]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(texts, items)
    for broadcast_rows in (10**6, 1):
        judged = decontaminate.contamination(
            documents, benchmark, scratch, broadcast_rows=broadcast_rows
        )
        names = ("doc_id", "__llm_n_words", "__llm_n_hit", "__llm_items")
        assert sorted(tuple(r) for r in judged.select(*names).collect()) == sorted(want)
    lookup = decontaminate.named_windows(decontaminate.item_windows(benchmark, 13))
    hits = decontaminate.occurrences(documents, scratch.write(lookup, "lookup"), 10**6)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    # The texts are read once, also for windows of several lengths.
    assert plan.count("Scan ExistingRDD") == 1
    assert lookup.count() == 403


def test_the_audit_in_blocks_counts_the_same(spark, keep, monkeypatch):
    """Groups that lack some links: all of them are found missing, whatever the blocks hold."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((4, 16))
    rows = [(i, (centres[i % 4] + 0.02 * rng.standard_normal(16)).tolist(), 0) for i in range(80)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    nodes = keep.write(embeddings.usable(frame).withColumnRenamed("vec_id", "node"), "audited")
    # Every group is cut in two.
    groups = nodes.select("node", (F.col("node") % 8).alias("cluster"))
    whole = embeddings.audit(nodes, groups, keep, 100, 0.98)
    assert whole == (80 * 19, 80 * 10)
    monkeypatch.setattr(embeddings, "_BLOCK_BYTES", 16 * 8 * 7)
    assert embeddings.audit(nodes, groups, keep, 100, 0.98) == whole
    assert embeddings.audit(nodes.limit(0), groups, keep, 100, 0.98) == (0, 0)
