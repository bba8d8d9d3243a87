import datetime as dt
from collections import Counter

from conftest import at, rows
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from trailmetrics.operators import pages
from trailmetrics.plans import page_job


def clicks(*visits, session="s1"):
    return [
        {"session_id": session, "page_id": page, "action_time": time} for time, page in visits
    ]


def brute_force(items, flow):
    """Sort each session as a whole and look at neighbours."""
    steps = set(zip(flow, flow[1:]))
    by_session = {}
    for item in items:
        by_session.setdefault(item["session_id"], []).append((item["action_time"], item["page_id"]))
    found = Counter()
    for session, views in by_session.items():
        views.sort()
        for (time, a), (_, b) in zip(views, views[1:]):
            if (a, b) in steps:
                found[session, time, f"{a}_{b}"] += 1
    return found


def pairs(actions, flow):
    return {
        (r["session_id"], r["action_time"], r["page_split"]): r["pairs"]
        for r in pages.page_split_pairs(actions, flow)
        .groupBy("session_id", "action_time", "page_split")
        .agg(F.sum("pairs").alias("pairs"))
        .collect()
    }


def test_steps_cross_midnight_and_whole_days(actions_of):
    midnight = dt.datetime(2024, 1, 6)
    items = clicks(
        (midnight - dt.timedelta(seconds=1), 1),
        (midnight, 2),
        (midnight + dt.timedelta(days=3), 3),
        (midnight + dt.timedelta(days=3), 1),
        (midnight + dt.timedelta(days=9), 2),
    )
    flow = [1, 2, 3]
    assert pairs(actions_of(items), flow) == dict(brute_force(items, flow))
    assert pages.page_split_pv(pages.page_split_pairs(actions_of(items), flow)).count() == 1


def test_times_before_1970(actions_of):
    epoch = dt.datetime(1970, 1, 1)
    items = clicks(*[(epoch + dt.timedelta(hours=h), 1 + h % 3) for h in range(-60, 60, 7)])
    flow = [1, 2, 3, 1]
    assert pairs(actions_of(items), flow) == dict(brute_force(items, flow))


def test_same_second_orders_by_page(actions_of):
    items = clicks((at(0), 2), (at(0), 1), (at(1), 5), (at(1), 3), (at(1), 4))
    assert set(pairs(actions_of(items), [1, 2, 3])) == {
        ("s1", at(0), "1_2"),
        ("s1", at(0), "2_3"),
    }


def test_pages_off_the_flow_break_a_step(actions_of):
    items = clicks((at(0), 1), (at(1), 99), (at(2), 2)) + clicks(
        (at(0), 1), (at(0), 0), (at(0), 2), session="s2"
    )
    assert set(pairs(actions_of(items), [1, 2])) == {("s2", at(0), "1_2")}


def test_page_without_id_breaks_a_step(actions_of):
    items = clicks((at(0), 1), (at(1), None), (at(2), 2))
    assert pairs(actions_of(items), [1, 2]) == {}


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    views=st.lists(
        st.tuples(
            st.sampled_from(["s1", "s2"]),
            st.integers(0, 5),
            st.integers(0, 6),
            st.integers(0, 3),
        ),
        max_size=60,
    ),
    flow=st.lists(st.integers(0, 6), min_size=2, max_size=6),
)
def test_random_views_match_brute_force(actions_of, views, flow):
    items = [
        {"session_id": s, "page_id": page, "action_time": at(second * 9000, day=5 + day)}
        for s, second, page, day in views
    ]
    expected = brute_force(items, flow)
    assert pairs(actions_of(items), flow) == dict(expected)
    by_step = Counter()
    for (_, _, label), n in expected.items():
        by_step[label] += n
    split_pv = pages.page_split_pv(pages.page_split_pairs(actions_of(items), flow))
    assert {r["page_split"]: r["pv"] for r in split_pv.collect()} == by_step


def test_views_without_a_session_id_are_one_session(actions_of):
    items = clicks((at(0), 1), (at(1), 2), session=None) + clicks((at(0), 1), (at(2), 2))
    found = pairs(actions_of(items), [1, 2])
    assert found == {(None, at(0), "1_2"): 1, ("s1", at(0), "1_2"): 1}


def rates(actions, flow):
    return [
        (r["step"], r["page_split"], r["pv"], r["convert_rate"])
        for r in page_job.convert_rates(actions, flow).collect()
    ]


def test_unseen_step_and_what_follows(actions_of):
    items = clicks((at(0), 1), (at(1), 2), (at(2), 9), (at(3), 1), (at(4), 9), (at(5), 1))
    assert rates(actions_of(items), [1, 2, 3, 4]) == [
        (1, "1_2", 1, 0.33),
        (2, "2_3", 0, 0.0),
        (3, "3_4", 0, None),
    ]
    text = page_job.convert_rates_text(actions_of(items), [1, 2, 3, 4]).collect()[0][0]
    assert text == "1_2=0.33|2_3=0.0|3_4="


def test_start_page_never_seen(actions_of):
    items = clicks((at(0), 2), (at(1), 3))
    assert rates(actions_of(items), [1, 2, 3]) == [(1, "1_2", 0, None), (2, "2_3", 1, None)]
    assert rates(actions_of([]), [1, 2]) == [(1, "1_2", 0, None)]


def test_repeated_step_has_a_row_each_time(actions_of):
    items = clicks((at(0), 1), (at(1), 2), (at(2), 1), (at(3), 2))
    assert rates(actions_of(items), [1, 2, 1, 2]) == [
        (1, "1_2", 2, 1.0),
        (2, "2_1", 1, 0.5),
        (3, "1_2", 2, 2.0),
    ]


def test_rates_do_not_depend_on_row_order(actions_of):
    items = [
        {"session_id": f"s{i % 9}", "page_id": i * 7 % 5, "action_time": at(i * 3 % 40)}
        for i in range(300)
    ]
    flow = [0, 1, 2, 3, 4]
    first = rows(page_job.convert_rates(actions_of(items), flow))
    assert rows(page_job.convert_rates(actions_of(items[::-1]).repartition(7), flow)) == first


def test_actions_without_a_time_come_first(actions_of):
    times = [(at(1), 2), (at(2), 3)]
    actions = actions_of(clicks((at(0), 1), (at(0), 5), *times)).withColumn(
        "action_time",
        F.when(F.col("page_id").isin(1, 5), F.lit(None)).otherwise(F.col("action_time")),
    )
    assert pairs(actions, [5, 2, 3]) == {("s1", None, "5_2"): 1, ("s1", at(1), "2_3"): 1}
    assert pairs(actions, [1, 5]) == {("s1", None, "1_5"): 1}


def test_times_have_no_zone(spark, actions_of):
    # New York has no 02:30 on this day.
    views = [(dt.datetime(2024, 3, 10, 2, 30), 1), (dt.datetime(2024, 3, 10, 3, 10), 2)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert pairs(actions_of(clicks(*views)), [1, 2]) == {("s1", views[0][0], "1_2"): 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_times_of_milliseconds(actions_of):
    start = dt.datetime(2024, 1, 5, 10, 59, 59, 990_000)
    items = clicks(*[(start + dt.timedelta(milliseconds=i), i % 3) for i in range(60)])
    assert pairs(actions_of(items), [0, 1, 2]) == dict(brute_force(items, [0, 1, 2]))


@pytest.fixture(scope="module")
def crowd(spark):
    """One session with a third of all rows in one day, others over 16 days."""
    hot = F.col("id") % 3 == 0
    seconds = F.when(hot, F.col("id") % 80_000).otherwise(F.col("id") % 1000)
    return spark.range(60_000).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 97)).alias("session_id"),
        (F.col("id") * 7 % 13).alias("page_id"),
        F.timestamp_add(
            "SECOND",
            seconds,
            F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(cast(id % 16 AS int))"),
        )
        .cast("timestamp_ntz")
        .alias("action_time"),
    )


def test_a_crowded_session_gives_the_same_steps(crowd):
    flow = [1, 2, 3, 3, 7]
    in_time = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    moves = crowd.withColumn("following", F.lead("page_id").over(in_time))
    wanted = moves.select(F.concat_ws("_", "page_id", "following").alias("page_split"))
    labels = [pages.step_label(step) for step in pages.flow_steps(flow)]
    expected = wanted.where(F.col("page_split").isin(labels)).groupBy("page_split").count()
    found = pages.page_split_pv(pages.page_split_pairs(crowd, flow))
    assert rows(found) == rows(expected.withColumnRenamed("count", "pv"))
    assert expected.count() >= 3


def test_no_window_sorts_the_visits_of_a_whole_session(crowd):
    text = pages.flow_views(crowd, [1, 2])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if " Window [" in line]
    # Visits within an hour, hours within a day, days within a session.
    assert len(windows) == 3
    assert [line for line in windows if "action_time" in line and "hour" in line] == windows[2:]


def test_counts_agree_with_the_pairs(crowd):
    flow = [1, 2, 3, 3, 7]
    pairs_pv = pages.page_split_pv(pages.page_split_pairs(crowd, flow))
    start_pv = pages.start_page_pv(crowd, flow)
    assert rows(page_job.convert_rates(crowd, flow)) == rows(
        pages.page_convert_rate(pairs_pv, start_pv, flow)
    )
    assert rows(page_job.convert_rates_text(crowd, flow)) == rows(
        pages.page_convert_rate_string(pairs_pv, start_pv, flow)
    )


def test_planning_runs_no_job_and_writes_nothing(spark, crowd, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        page_job.convert_rates(crowd, [1, 2, 3])
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_steps_and_start_page_share_one_scan(crowd):
    result = page_job.convert_rates(crowd, [1, 2, 3])
    result.collect()
    text = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Range (") == 1


FLOW = [1, 2, 3, 3, 7]


@pytest.fixture(scope="module")
def crowded_hour(spark):
    """One session of 40,000 views in one hour, half of them in one second; others around it."""
    hot = F.col("id") % 3 > 0
    micros = F.expr(
        "CASE WHEN id % 3 = 1 THEN id * 2903 % 3600000000"
        " WHEN id % 3 = 2 THEN id * 7 % 999983 + 1800000000"
        " ELSE id * 59999999 % 7200000000 - 1800000000 END"
    )
    seconds = (micros / 1_000_000).cast("decimal(18,6)")
    return spark.range(0, 60_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("session_id"),
        (F.col("id") * 7 % 13).alias("page_id"),
        (
            F.expr("timestamp_ntz'2024-01-05 10:00:00'")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        ).alias("action_time"),
    )


@pytest.mark.parametrize("most_in_hour", [1, 1000, 30_000, 10**9])
def test_hours_that_are_cut_give_the_same_steps(crowded_hour, most_in_hour):
    in_time = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    moves = crowded_hour.withColumn("following", F.lead("page_id").over(in_time))
    labels = [pages.step_label(step) for step in pages.flow_steps(FLOW)]
    keys = ("session_id", "action_time", "page_split")
    wanted = (
        moves.withColumn("page_split", F.concat_ws("_", "page_id", "following"))
        .where(F.col("page_split").isin(labels))
        .groupBy(*keys)
        .agg(F.count("*").alias("pairs"))
    )
    found = pages.page_split_pairs(crowded_hour, FLOW, most_in_hour)
    assert rows(found.groupBy(*keys).agg(F.sum("pairs").alias("pairs"))) == rows(wanted)
    assert rows(page_job.convert_rates(crowded_hour, FLOW, most_in_hour)) == rows(
        page_job.convert_rates(crowded_hour, FLOW)
    )


def test_no_window_sees_most_visits_of_a_crowded_hour(crowded_hour):
    def largest(frame, keys):
        return frame.groupBy(*keys).count().agg(F.max("count")).first()[0]

    seen, levels = pages._seen_and_levels(crowded_hour, FLOW, 1000)
    assert largest(seen, pages._HOUR) > 15_000
    # Hours of up to 1000 views stay whole; the crowded one is cut into milliseconds.
    assert largest(seen, levels[0][0]) <= 1000
    assert largest(seen.where("milli IS NOT NULL"), levels[0][0]) < 100
    for (inner, _), (outer, _) in zip(levels, levels[1:]):
        assert largest(seen.select(*inner).distinct(), outer) <= 3600
    rates = page_job.convert_rates(crowded_hour, FLOW, 1000)
    text = rates._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert len(windows) == 5
    assert all("milli" in line for line in windows if "action_time" in line)


def test_views_without_a_time_or_a_session_in_cut_hours(actions_of):
    items = clicks((at(0), 1), (at(0), 5), (at(1), 2))
    items += clicks((at(0), 1), (at(0.5), 2), session=None)
    actions = actions_of(items).withColumn(
        "action_time", F.when(F.col("page_id") != 5, F.col("action_time"))
    )
    for most in (None, 0, 1, 100):
        found = pages.page_split_pairs(actions, [5, 1, 2], most).collect()
        assert sorted((r.session_id or "", r.page_split) for r in found) == [
            ("", "1_2"),
            ("s1", "1_2"),
            ("s1", "5_1"),
        ]
