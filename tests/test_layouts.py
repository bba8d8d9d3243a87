"""Bloom filters and buckets: what is shuffled, and the same results."""

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trailmetrics.operators import bloom, sessions
from trailmetrics.plans import session_job
from trailmetrics.sinks import bucket_table
from trailmetrics.sources import star, tables

BUCKETS = 16


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sizes_of_filters():
    assert bloom.bits_for(0) == bloom.bits_for(1) == 64
    assert bloom.bits_for(1000) == 16384
    assert bloom.bits_for(5_000_000) == bloom.MAX_BITS
    assert bloom.bits_for(6_000_000) is None


@pytest.mark.parametrize("chosen", [1, 30, 3000])
def test_few_other_rows_enter_the_shuffle(spark, scratch, no_broadcast, chosen):
    actions = spark.range(0, 100_000, 1, 8).selectExpr(
        "id AS n", "if(id % 500 = 0, null, concat('s', id % 9973)) AS session_id"
    )
    ids = spark.range(chosen).selectExpr("concat('s', id) AS session_id")
    ids = scratch.write(ids.unionAll(spark.sql("SELECT cast(null AS string)")), "chosen")
    exact = sessions.filtered_actions(actions, ids)
    passed = Observation("passed")
    wanted = bloom.prefiltered(actions, ids, "session_id", chosen + 1).observe(
        passed, F.count("*").alias("n")
    )
    found = sessions.filtered_actions(wanted, ids)
    assert "SortMergeJoin" in plan(found)
    assert rows(found) == rows(exact)
    kept = exact.count()
    assert exact.where("session_id IS NULL").count() == 200
    # The ids' own rows, and less than one in a hundred of the others.
    assert kept <= passed.get["n"] <= kept + (100_000 - kept) / 100


def test_without_ids_nothing_passes(spark, scratch):
    actions = spark.createDataFrame([("a",), (None,)], "session_id string")
    none = scratch.write(actions.limit(0), "none")
    assert bloom.prefiltered(actions, none, "session_id", 0).count() == 0
    assert bloom.prefiltered(actions, none, "session_id", 10**9).count() == 2


def test_counts_with_and_without_the_filter(spark, scratch, monkeypatch, no_broadcast):
    actions = entry_point._actions(spark, SF_DIR)
    found = scratch.write(entry_point._sessions(spark, SF_DIR), "sessions")
    count = found.count()
    plain = session_job.matched_counts(actions, found, session_count=count)
    monkeypatch.setattr(session_job, "FEW_SESSIONS", 10)
    filtered = session_job.matched_counts(actions, found, session_count=count)
    assert "Subquery" in plan(filtered) and "Subquery" not in plan(plain)
    assert rows(filtered) == rows(plain)


def stored(spark, scratch, actions):
    name = scratch.table("by_session")
    bucket_table(actions, name, BUCKETS)
    return name


def actions_side(text):
    """The lines of a plan from the scan of the actions up to the join or the result."""
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "by_session" in line)
    depth = lines[scan].index("+-") if "+-" in lines[scan] else lines[scan].index(":-")
    above = []
    for line in reversed(lines[: scan + 1]):
        at = max(line.find("+-"), line.find(":-"))
        if at <= depth:
            above.append(line)
            depth = at
            if "Join" in line:
                break
    return "\n".join(above)


def test_actions_stay_in_their_buckets(spark, scratch, no_broadcast):
    name = stored(spark, scratch, entry_point._actions(spark, SF_DIR))
    params = entry_point.PARAMS
    actions = tables.read_actions(spark, name, params.start_date, params.end_date)
    found = sessions.filtered_sessions(actions, star.user_info(spark, SF_DIR), params)
    rolled_up = sessions._roll_up(sessions.action_parts(actions))
    assert "Exchange" not in plan(rolled_up)
    matched = sessions.bucketed_actions(actions, scratch.write(found, "sessions"))
    text = plan(matched)
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert "Exchange" not in actions_side(text)
    plain = sessions.filtered_actions(entry_point._actions(spark, SF_DIR), found)
    assert rows(matched) == rows(plain)


def test_actions_without_a_session_id(spark, scratch, no_broadcast):
    actions = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "session_id string, n int")
    by_session = spark.table(stored(spark, scratch, actions))
    for chosen, want in (("a", [1]), ("a, null", [1, 2]), ("null", [2])):
        ids = ", ".join(
            "(cast(null AS string))" if i == "null" else f"('{i}')" for i in chosen.split(", ")
        )
        given = scratch.write(spark.sql(f"SELECT * FROM VALUES {ids} AS t(session_id)"), "given")
        found = sessions.bucketed_actions(by_session, given)
        assert sorted(r["n"] for r in found.collect()) == want


def test_a_crowded_session_is_one_task_in_buckets_and_many_when_split(spark, scratch):
    """Its bucket cannot be split; as plain files it can, and then the actions are shuffled."""
    actions = spark.range(0, 400_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id % 997)) AS session_id",
        "id AS user_id",
        "md5(cast(id AS string)) AS search_keyword",
    )
    # Files are split at their row groups.
    spark.conf.set("parquet.block.size", 512 * 1024)
    name = stored(spark, scratch, actions)
    spark.conf.unset("parquet.block.size")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1MB")
    try:

        def largest(df):
            tasks = df.where("session_id = 'hot'").groupBy(F.spark_partition_id().alias("task"))
            return tasks.count().agg(F.max("count")).first()[0]

        # Grouping by session keeps the buckets, so one task has all rows of the session.
        grouped = spark.table(name).groupBy("session_id").agg(F.count("*").alias("n"))
        assert "Exchange" not in plan(grouped)
        hot = grouped.where("session_id = 'hot'").first()["n"]
        assert hot > 400_000 / 3
        split = tables.read_split(spark, name)
        assert split.schema == spark.table(name).schema
        assert largest(split) < hot / 2
        again = split.groupBy("session_id").agg(F.count("*").alias("n"))
        assert "Exchange" in plan(again)
        assert rows(again) == rows(grouped)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_session_job_in_buckets(spark, scratch, tmp_path):
    from trailmetrics.sinks import result_sink

    name = stored(spark, scratch, entry_point._actions(spark, SF_DIR))
    params, users = entry_point.PARAMS, star.user_info(spark, SF_DIR)
    for folder, actions, in_buckets in (
        ("plain", entry_point._actions(spark, SF_DIR), False),
        ("buckets", tables.read_actions(spark, name, params.start_date, params.end_date), True),
    ):
        sink = result_sink({"path": str(tmp_path / folder)}, "parquet")
        session_job.run_session_job(actions, users, params, "t1", sink, 7, None, in_buckets)
    for table in ("session_aggr_stat", "top10_category", "top10_session", "session_detail"):
        plain, buckets = (
            rows(spark.read.parquet(str(tmp_path / folder / table)))
            for folder in ("plain", "buckets")
        )
        assert plain == buckets and plain
