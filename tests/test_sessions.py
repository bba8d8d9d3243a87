import datetime as dt
import os
import subprocess
import sys

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from trailmetrics.operators import sampling, session_days, sessions
from trailmetrics.params import TaskParams
from trailmetrics.plans import session_job

RANGE = {"startDate": "2024-01-01", "endDate": "2024-12-31"}


def params(**values):
    return TaskParams.from_dict({**RANGE, **values})


def visits(lengths):
    """One session per length in seconds, of two actions (one if the length is 0)."""
    items = []
    for i, length in enumerate(lengths):
        items.append({"session_id": f"s{i}", "action_time": at(0)})
        if length:
            items.append({"session_id": f"s{i}", "action_time": at(length)})
    return items


def stat(df):
    return rows(sessions.session_aggr_stat(df))[0]


@pytest.mark.parametrize(
    ("label", "inside", "outside"),
    [
        ("1s_3s", [1, 3], [0, 4]),
        ("4s_6s", [4, 6], [3, 7]),
        ("7s_9s", [7, 9], [6, 10]),
        ("10s_30s", [10, 30], [9, 31]),
        ("30s_60s", [31, 60], [30, 61]),
        ("1m_3m", [61, 180], [60, 181]),
        ("3m_10m", [181, 600], [180, 601]),
        ("10m_30m", [601, 1800], [600, 1801]),
        ("30m", [1801, 9999], [1800, 0]),
    ],
)
def test_duration_classes(actions_of, users_of, label, inside, outside):
    found = sessions.filtered_sessions(
        actions_of(visits(inside + outside)), users_of([{}]), params()
    )
    assert stat(found)[f"visit_length_{label}_ratio"] == 0.5


@pytest.mark.parametrize(
    ("label", "inside", "outside"),
    [
        ("1_3", [1, 3], [4, 61]),
        ("4_6", [4, 6], [3, 7]),
        ("7_9", [7, 9], [6, 10]),
        ("10_30", [10, 30], [9, 31]),
        ("30_60", [31, 60], [30, 61]),
        ("60", [61, 99], [60, 1]),
    ],
)
def test_depth_classes(actions_of, users_of, label, inside, outside):
    items = [
        {"session_id": f"s{i}", "action_time": at(k)}
        for i, steps in enumerate(inside + outside)
        for k in range(steps)
    ]
    found = sessions.filtered_sessions(actions_of(items), users_of([{}]), params())
    assert stat(found)[f"step_length_{label}_ratio"] == 0.5


def test_zero_second_visits_count_but_are_in_no_class(actions_of, users_of):
    found = sessions.filtered_sessions(actions_of(visits([0, 0])), users_of([{}]), params())
    result = stat(found)
    assert result["session_count"] == 2
    assert all(v == 0.0 for k, v in result.items() if k.startswith("visit_length"))


def test_ratio_ties_round_up(actions_of, users_of):
    # 57 of 200 sessions last 2 seconds: 0.285 becomes 0.29; 1 of 8 becomes 0.13.
    found = sessions.filtered_sessions(
        actions_of(visits([2] * 57 + [5] * 25 + [0] * 118)), users_of([{}]), params()
    )
    result = stat(found)
    assert result["visit_length_1s_3s_ratio"] == 0.29
    assert result["visit_length_4s_6s_ratio"] == 0.13


def test_no_session_passes(actions_of, users_of):
    for actions in (actions_of(visits([5])), actions_of([])):
        found = sessions.filtered_sessions(actions, users_of([{"user_id": 99}]), params())
        result = stat(found)
        assert result.pop("session_count") == 0
        assert set(result.values()) == {None}


def test_lists_are_exact_sets(actions_of, users_of):
    items = [
        {"search_keyword": "ab"},
        {"search_keyword": "a"},
        {"search_keyword": "a"},
        {"search_keyword": ""},
        {"click_category_id": 11},
        {"click_category_id": 2},
        {"click_category_id": 1},
        {"click_category_id": None},
    ]
    record = rows(sessions.session_aggregate(actions_of(items), users_of([{}])))[0]
    assert record["search_keywords"] == ["a", "ab"]
    assert record["click_category_ids"] == [1, 2, 11]


def test_session_user_is_the_known_one(actions_of, users_of):
    items = [{"user_id": -1}, {"user_id": 7}, {"session_id": "s2", "user_id": -1}]
    found = sessions.session_aggregate(actions_of(items), users_of([{"user_id": 7}]))
    assert [(r["session_id"], r["user_id"]) for r in rows(found)] == [("s1", 7)]


USERS = [
    {"user_id": 1, "age": 20, "professional": "IT", "city": "c1", "sex": "male"},
    {"user_id": 2, "age": 50, "professional": "IT,art", "city": "c11", "sex": "female"},
    {"user_id": 3, "age": 51, "professional": "-1", "city": None, "sex": None},
    {"user_id": 4, "age": None, "professional": None, "city": "c1", "sex": "male"},
]
SEARCHES = {1: ("kw1", 1), 2: ("kw11", 11), 3: (None, -1), 4: ("kw2,kw1", None)}


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ({}, [1, 2, 3, 4]),
        (dict.fromkeys(["startAge", "endAge", "cities", "sex", "keywords"], ""), [1, 2, 3, 4]),
        ({"startAge": 20, "endAge": 50}, [1, 2]),
        ({"startAge": "30", "endAge": "51"}, [2, 3]),
        ({"startAge": 30}, [1, 2, 3, 4]),
        ({"endAge": 30}, [1, 2, 3, 4]),
        ({"professionals": "art,farm"}, [2]),
        ({"professionals": "IT"}, [1, 2]),
        ({"professionals": "-1"}, []),
        ({"cities": "c1"}, [1, 4]),
        ({"sex": "male"}, [1, 4]),
        ({"sex": "female"}, [2]),
        ({"keywords": "kw1"}, [1, 4]),
        ({"keywords": "kw1,kw11"}, [1, 2, 4]),
        ({"categoryIds": "1"}, [1]),
        ({"categoryIds": "1,11"}, [1, 2]),
        ({"categoryIds": "-1"}, []),
        ({"cities": "c1", "keywords": "kw1", "sex": "male", "startAge": 0, "endAge": 99}, [1]),
    ],
)
def test_filters(actions_of, users_of, values, expected):
    items = [
        {"session_id": f"s{u}", "user_id": u, "search_keyword": word, "click_category_id": category}
        for u, (word, category) in SEARCHES.items()
    ]
    actions, users = actions_of(items), users_of(USERS)
    lean = sessions.filtered_sessions(actions, users, params(**values))
    full = sessions.session_filter(sessions.session_aggregate(actions, users), params(**values))
    assert sorted(r["user_id"] for r in rows(lean)) == expected
    assert sorted(r["user_id"] for r in rows(full)) == expected


def test_keyword_that_is_the_no_value_mark(actions_of, users_of):
    items = [
        {"session_id": "only", "search_keyword": "-1"},
        {"session_id": "only", "search_keyword": ""},
        {"session_id": "with another", "search_keyword": "-1"},
        {"session_id": "with another", "search_keyword": "a"},
        {"session_id": "without", "search_keyword": "a"},
    ]
    actions, users, wanted = actions_of(items), users_of([{}]), params(keywords="-1")
    lean = sessions.filtered_sessions(actions, users, wanted)
    full = sessions.session_filter(sessions.session_aggregate(actions, users), wanted)
    assert [r["session_id"] for r in rows(lean)] == ["with another"]
    assert [r["session_id"] for r in rows(full)] == ["with another"]


def starts(spark, counts):
    """Sessions per (day, hour), as the filter returns them."""
    items = [
        (f"{day}-{hour}-{i}", dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour))
        for (day, hour), n in counts.items()
        for i in range(n)
    ]
    return spark.createDataFrame(items, "session_id string, start_time timestamp_ntz")


def sample_of(found, seed=0, **sizes):
    quotas = sampling.session_extract_quota(sampling.session_hour_count(found), **sizes)
    return quotas, sampling.session_random_extract(found, seed, **sizes)


@pytest.mark.parametrize(
    ("counts", "sizes", "expected"),
    [
        ({(0, 1): 1, (0, 2): 299}, {}, {1: 1, 2: 100}),
        ({(0, 1): 1, (0, 2): 299}, {"extra": 0}, {1: 0, 2: 99}),
        ({(0, 5): 250}, {}, {5: 101}),
        ({(0, 5): 40}, {}, {5: 40}),
        ({(0, 5): 500}, {"sample_size": 300}, {5: 301}),
        ({(0, 1): 30, (0, 2): 10, (1, 3): 90}, {}, {1: 30, 2: 10, 3: 51}),
        ({(0, 1): 30, (0, 2): 10, (1, 3): 90}, {"sample_size": 20}, {1: 8, 2: 3, 3: 11}),
    ],
)
def test_quotas_are_drawn_exactly(spark, counts, sizes, expected):
    quotas, sample = sample_of(starts(spark, counts), **sizes)
    assert {r["hour"]: r["quota"] for r in rows(quotas)} == expected
    drawn = {r["hour"]: r["count"] for r in rows(sample.groupBy("hour").count())}
    assert drawn == {hour: n for hour, n in expected.items() if n}


def test_more_than_a_hundred_days(spark):
    quotas, _ = sample_of(starts(spark, {(day, 3): 2 for day in range(120)}))
    assert [r["quota"] for r in rows(quotas)] == [1] * 120


def test_sample_is_repeatable_and_depends_on_the_seed(spark):
    found = starts(spark, {(0, 5): 300})
    first = rows(sample_of(found, seed=1)[1])
    assert rows(sample_of(found.repartition(13), seed=1)[1]) == first
    assert rows(sample_of(found, seed=2)[1]) != first


def test_sample_columns(actions_of, users_of, scratch):
    items = [
        {"search_keyword": "b", "action_time": at(5)},
        {"search_keyword": "a", "click_category_id": 10, "action_time": at(1)},
        {"click_category_id": 9, "action_time": at(3)},
        {"session_id": "s2"},
    ]
    actions = actions_of(items)
    found = sessions.filtered_sessions(actions, users_of([{}]), params())
    sample = {r["sessionid"]: r for r in rows(session_job.session_sample(found, actions, scratch))}
    assert sample["s1"]["startTime"] == "2024-01-05 10:00:01"
    assert sample["s1"]["searchKeywords"] == "a,b"
    assert sample["s1"]["clickCategoryIds"] == "9,10"
    assert sample["s2"]["searchKeywords"] is None
    assert sample["s2"]["clickCategoryIds"] is None


def test_no_broadcast_is_forced_for_a_large_sample(spark, actions_of, users_of, scratch):
    actions = actions_of([{"session_id": f"s{i}"} for i in range(200)])
    found = sessions.filtered_sessions(actions, users_of([{}]), params())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sample = session_job.session_sample(found, actions, scratch, sample_size=10, extra=10**7)
        detail = session_job.sample_detail(actions, sample)
        for result in (sample, detail):
            assert "Broadcast" not in result._jdf.queryExecution().executedPlan().toString()
            assert result.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_actions_without_a_session_id_are_one_session_everywhere(actions_of, users_of, scratch):
    items = [
        {"session_id": session, "click_category_id": 7, "search_keyword": "a"}
        for session in (None, None, "s2")
    ]
    actions, users = actions_of(items), users_of([{}])
    found = sessions.filtered_sessions(actions, users, params())
    assert {r["session_id"] for r in rows(found)} == {None, "s2"}
    for records in (
        sessions.session_aggregate(actions, users),
        sessions.filtered_records(actions, users, params()),
    ):
        assert [r["search_keywords"] for r in rows(records)] == [["a"], ["a"]]
    quota = sampling.session_extract_quota(sampling.session_hour_count(found))
    sample = scratch.write(session_job.session_sample(found, actions, scratch), "sample")
    assert sample.count() == sum(r["quota"] for r in rows(quota)) == 2
    assert {r["searchKeywords"] for r in rows(sample)} == {"a"}
    assert session_job.sample_detail(actions, sample).count() == 3
    counts = session_job.matched_counts(actions, found)
    top = session_job.top_sessions(actions, found, session_job.top_categories(counts))
    assert sum(r["clickCount"] for r in rows(top)) == rows(counts)[0]["click_count"] == 3
    assert session_job.top_session_detail(actions, top).count() == 3


def test_a_session_with_a_third_of_the_rows_and_many_keywords(spark, users_of):
    actions = spark.range(0, 300_000, 1, 8).selectExpr(
        "1L AS user_id",
        "if(id % 3 = 0, 'hot', concat('s', id % 5000)) AS session_id",
        "timestamp_ntz'2024-01-05 10:00:00' AS action_time",
        "concat('kw', id) AS search_keyword",
        "-1L AS click_category_id",
    )
    records = sessions.session_aggregate(actions, users_of([{}]))
    plan = records._jdf.queryExecution().executedPlan().toString()
    # Only distinct values are gathered into lists.
    objects = [line for line in plan.splitlines() if "ObjectHashAggregate" in line]
    assert objects and all("collect_list" in line for line in objects)
    found = records.select("session_id", F.size("search_keywords").alias("n"))
    assert found.agg(F.max("n")).first()[0] == 100_000


def test_days_that_are_stored_again_or_added(spark, actions_of, users_of, scratch):
    """Sessions that cross midnight, a corrected day, null ids and a day without actions."""
    midnight = dt.datetime(2024, 1, 6)
    late = [
        {"action_time": midnight - dt.timedelta(seconds=9), "search_keyword": "b", "user_id": 2},
        {"action_time": midnight - dt.timedelta(seconds=5), "click_category_id": 7, "user_id": -1},
        {"action_time": midnight - dt.timedelta(seconds=5), "session_id": None},
    ]
    early = [
        {"action_time": midnight, "search_keyword": "a", "user_id": 1},
        {"action_time": midnight + dt.timedelta(seconds=30), "search_keyword": "b"},
        {"action_time": midnight, "session_id": None, "click_category_id": -1},
    ]
    wrong = [{"action_time": midnight, "search_keyword": "wrong", "click_category_id": 99}] * 3
    users = users_of([{"user_id": u} for u in (1, 2)])
    name = scratch.table("session_days")
    assert session_days.store_days(actions_of(late + wrong), name) == []
    (old,) = session_days.store_days(actions_of(early), name)
    assert "session_days" in old
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    parts = session_days.stored_parts(spark, name, first, last)
    want = sessions.session_aggregate(actions_of(late + early), users)
    assert rows(sessions.aggregate_of(parts, users)) == rows(want)
    (crossing, nameless) = sorted(rows(want), key=lambda r: r["session_id"] is None)
    assert (crossing["user_id"], crossing["visit_length"], crossing["step_length"]) == (1, 39, 4)
    assert crossing["search_keywords"] == ["a", "b"] and nameless["visit_length"] == 5
    one_day = session_days.stored_parts(spark, name, last, last)
    assert rows(sessions.aggregate_of(one_day, users)) == rows(
        sessions.session_aggregate(actions_of(early), users)
    )


def test_stored_days_are_read_without_the_others(spark, actions_of, scratch):
    name = scratch.table("session_days")
    items = [{"action_time": dt.datetime(2024, 1, day, 9)} for day in range(1, 9)]
    session_days.store_days(actions_of(items * 50), name)
    day = dt.date(2024, 1, 4)
    parts = session_days.stored_parts(spark, name, day, day)
    assert len({f.rsplit("/", 1)[0] for f in parts.inputFiles()}) == 1
    # Equal actions are one part.
    assert [r["step_length"] for r in rows(parts)] == [50]


def test_observed_counts_are_those_of_the_written_sessions(spark, scratch):
    found = spark.createDataFrame([(i % 90, i % 70) for i in range(5000)], "visit_length long, step_length long")
    seen, counts = sessions.observed(found)
    scratch.write(seen, "sessions")
    assert rows(sessions.observed_stat(spark, counts)) == rows(sessions.session_aggr_stat(found))
    seen, counts = sessions.observed(found.where("step_length > 99"))
    scratch.write(seen, "none")
    assert rows(sessions.observed_stat(spark, counts)) == rows(
        sessions.session_aggr_stat(found.limit(0))
    )


REPEATED = """
import sys
sys.path[:0] = [{root!r}]
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from trailmetrics.operators import session_days, sessions

spark = (
    SparkSession.builder.master("local[2,3]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.warehouse.dir", {folder!r})
    .getOrCreate()
)
found = spark.range(0, 1000, 1, 4).selectExpr("id AS visit_length", "id AS step_length")
seen, counts = sessions.observed(found)

def fail_once(batches):
    # Each task fails after it has counted all its rows, at its first attempt.
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise ValueError("lost")

seen.mapInArrow(fail_once, seen.schema).write.saveAsTable("found")
print("COUNT", sessions.observed_stat(spark, counts).first().session_count, spark.table("found").count())
"""


def test_a_repeated_task_counts_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = REPEATED.format(root=root, folder=str(tmp_path))
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=tmp_path
    )
    assert "lost" in done.stderr
    assert "COUNT 1000 1000" in done.stdout
