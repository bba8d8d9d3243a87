import pytest
from conftest import SF_DIR, rows

from trailmetrics.sources import star
from trailmetrics.streaming import ad_clicks

LINES = [
    "1700000000000 P1 C1 5 9",
    "1700000000001 P1 C1 6 9",
    "1700000000002 P1 C1 7",
    "1700000000003 P1 C1 7 9 x",
    "1700000000004 P1 C1 seven 9",
    "",
    "1700000000005 P2 C2 5 8",
]
GOOD = [(1700000000000, 5), (1700000000001, 6), (1700000000005, 5)]


def batch(spark, lines=LINES):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def keys(df):
    return sorted((r["timestamp"], r["userid"]) for r in df.collect())


def blacklist(spark, *users):
    return spark.createDataFrame([(u,) for u in users], "userid long")


def test_parse(spark):
    parsed = ad_clicks.ad_click_parse(batch(spark))
    assert keys(parsed) == GOOD
    assert parsed.dtypes == [
        ("timestamp", "bigint"),
        ("province", "string"),
        ("city", "string"),
        ("userid", "bigint"),
        ("adid", "bigint"),
    ]


def test_parse_of_binary_values(spark):
    lines = batch(spark).selectExpr("cast(value AS binary) AS value")
    assert keys(ad_clicks.ad_click_parse(lines)) == GOOD


@pytest.mark.parametrize(
    ("users", "kept"), [((5,), GOOD[1:2]), ((), GOOD), ((5, 5, 6), [])]
)
def test_blacklist(spark, users, kept):
    found = ad_clicks.ad_click_filter(batch(spark), blacklist(spark, *users))
    assert keys(found) == kept


def test_spread_keeps_the_rows(spark):
    found = ad_clicks.ad_click_filter(batch(spark), blacklist(spark, 6), partitions=4)
    assert keys(found) == [GOOD[0], GOOD[2]]
    assert ad_clicks.spread(batch(spark), 4).rdd.getNumPartitions() == 4


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def add_file(folder, name, lines):
    (folder / "in" / name).write_text("".join(line + "\n" for line in lines))


def stream(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder / "in"))


def test_stream_equals_batch_also_after_a_restart(spark, folder):
    def run():
        clicks = ad_clicks.ad_click_filter(stream(spark, folder), blacklist(spark, 6))
        ad_clicks.write_stream(
            clicks, str(folder / "out"), str(folder / "checkpoint"), available_now=True
        ).awaitTermination()
        return keys(spark.read.parquet(str(folder / "out")))

    add_file(folder, "a.txt", LINES[:3])
    add_file(folder, "b.txt", LINES[3:])
    assert run() == [GOOD[0], GOOD[2]]
    add_file(folder, "c.txt", ["1700000000009 P1 C1 8 1"])
    assert run() == [GOOD[0], GOOD[2], (1700000000009, 8)]


def test_blacklist_is_read_again_for_each_batch(spark, folder):
    banned = iter([(5,), (6,)])

    def run(lines, name):
        add_file(folder, name, lines)
        ad_clicks.write_filtered_stream(
            stream(spark, folder),
            lambda: blacklist(spark, *next(banned)),
            str(folder / "out"),
            str(folder / "checkpoint"),
            partitions=2,
            available_now=True,
        ).awaitTermination()

    run(LINES[:2], "a.txt")
    run(LINES[:2], "b.txt")
    found = ad_clicks.read_written(spark, str(folder / "out"))
    assert found.columns == [name for name, _ in ad_clicks.AD_FIELDS]
    assert sorted(r.userid for r in found.collect()) == [5, 6]


def test_a_catalog_blacklist_is_fresh_in_each_batch(spark, folder):
    spark.sql("DROP TABLE IF EXISTS banned")
    blacklist(spark, 5).write.option("path", str(folder / "banned")).saveAsTable("banned")

    def run(name):
        add_file(folder, name, LINES[:2])
        ad_clicks.write_filtered_stream(
            stream(spark, folder),
            lambda: ad_clicks.fresh_table(spark, "banned"),
            str(folder / "out"),
            str(folder / "checkpoint"),
            available_now=True,
        ).awaitTermination()
        return [r.userid for r in ad_clicks.read_written(spark, str(folder / "out")).collect()]

    assert spark.table("banned").count() == 1
    assert run("a.txt") == [6]
    # Another writer adds a file behind the catalog's back.
    blacklist(spark, 6).write.mode("append").parquet(str(folder / "banned"))
    assert run("b.txt") == [6]
    spark.sql("DROP TABLE banned")


def test_a_finished_block_becomes_one_folder(spark, folder, scratch, monkeypatch):
    monkeypatch.setattr(ad_clicks, "BLOCK", 2)
    out = str(folder / "out")
    for number in range(5):
        add_file(folder, f"{number}.txt", [f"170000000000{number} P1 C1 {number} 9"])
    ad_clicks.write_filtered_stream(
        stream(spark, folder),
        lambda: blacklist(spark, 3),
        out,
        str(folder / "checkpoint"),
        available_now=True,
    ).awaitTermination()
    before = keys(ad_clicks.read_written(spark, out))
    assert [user for _, user in before] == [0, 1, 2, 4]
    for block in (0, 1):
        ad_clicks.merge_block(spark, out, block, scratch)
    assert keys(ad_clicks.read_written(spark, out)) == before
    first = folder / "out" / "block-000000"
    assert len(list(first.glob("*.parquet"))) == 1
    assert not [f for f in first.iterdir() if f.is_dir()]


def test_default_trigger_is_five_seconds():
    assert ad_clicks._trigger(False) == {"processingTime": "5 seconds"}


def test_whole_events_table_as_a_stream(spark, folder):
    lines = star.ad_lines(spark, spark.read.parquet(f"{SF_DIR}/events.parquet"))
    expected = ad_clicks.ad_click_filter(lines, star.blacklist(spark, SF_DIR))
    clicks = ad_clicks.ad_click_filter(
        star.ad_lines_stream(spark, SF_DIR), star.blacklist(spark, SF_DIR), partitions=3
    )
    ad_clicks.write_stream(
        clicks, str(folder / "out"), str(folder / "checkpoint"), available_now=True
    ).awaitTermination()
    assert rows(spark.read.parquet(str(folder / "out"))) == rows(expected)


def versioned(spark, folder, lines=None, name="a.txt"):
    if lines:
        add_file(folder, name, lines)
    query = ad_clicks.write_versioned_stream(
        stream(spark, folder),
        str(folder / "blacklist"),
        str(folder / "out"),
        str(folder / "checkpoint"),
        available_now=True,
    )
    query.awaitTermination()
    found = ad_clicks.read_written(spark, str(folder / "out"))
    return [user for _, user in keys(found)]


def test_a_user_passes_one_batch_and_is_dropped_in_the_next(spark, folder):
    lists = str(folder / "blacklist")
    assert versioned(spark, folder, LINES[:2], "a.txt") == [5, 6]
    ad_clicks.publish_version(blacklist(spark, 5), lists, 1)
    assert versioned(spark, folder, LINES[:2], "b.txt") == [5, 6, 6]
    ad_clicks.publish_version(blacklist(spark), lists, 2)
    assert versioned(spark, folder, LINES[:2], "c.txt") == [5, 5, 6, 6, 6]
    assert ad_clicks.latest_version(spark, lists) == 2
    with pytest.raises(ValueError, match="published already"):
        ad_clicks.publish_version(blacklist(spark, 9), lists, 2)


def test_a_repeated_batch_sees_the_version_that_it_began_with(spark, folder, monkeypatch):
    """The first attempt ends after the version is chosen; then a longer list is published."""
    lists = str(folder / "blacklist")
    ad_clicks.publish_version(blacklist(spark, 5), lists, 1)
    real = ad_clicks.ad_click_filter

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(ad_clicks, "ad_click_filter", lost)
    with pytest.raises(Exception, match="lost"):
        versioned(spark, folder, LINES[:2], "a.txt")
    monkeypatch.setattr(ad_clicks, "ad_click_filter", real)
    ad_clicks.publish_version(blacklist(spark, 5, 6), lists, 2)
    assert versioned(spark, folder) == [6]
    # The next batch has the longer list.
    assert versioned(spark, folder, LINES[:2], "b.txt") == [6]


def test_a_version_that_is_not_complete_does_not_count(spark, folder):
    lists = str(folder / "blacklist")
    ad_clicks.publish_version(blacklist(spark, 5), lists, 1)
    blacklist(spark, 5, 6).write.parquet(f"{lists}/users/2")
    assert ad_clicks.latest_version(spark, lists) == 1
    assert versioned(spark, folder, LINES[:2], "a.txt") == [6]
