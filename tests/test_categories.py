from conftest import at, rows

from trailmetrics.operators import categories
from trailmetrics.plans import session_job


def all_sessions(actions):
    return actions.select("session_id").distinct()


def top(actions, **options):
    return categories.top10_category(categories.category_counts(actions, **options))


def top_sessions(actions):
    clicks = categories.top_category_clicks(actions, all_sessions(actions), top(actions))
    return categories.top10_session(clicks)


def test_counts_and_joined_counts_agree(actions_of):
    items = [
        {"click_category_id": 1},
        {"click_category_id": 1, "session_id": "s2"},
        {"click_category_id": -1, "order_category_ids": "1,2"},
        {"order_category_ids": "", "pay_category_ids": "1,,2"},
        {"order_category_ids": "x,3", "pay_category_ids": "3"},
        {"click_category_id": None, "pay_category_ids": "3"},
    ]
    actions = actions_of(items)
    expected = [
        {"category_id": 1, "click_count": 2, "order_count": 1, "pay_count": 1},
        {"category_id": 2, "click_count": 0, "order_count": 1, "pay_count": 1},
        {"category_id": 3, "click_count": 0, "order_count": 1, "pay_count": 2},
    ]
    joined = categories.category_counts_joined(
        categories.active_categories(actions),
        categories.category_click_count(actions),
        categories.category_order_count(actions),
        categories.category_pay_count(actions),
    )
    assert rows(categories.category_counts(actions)) == expected
    assert rows(session_job.matched_counts(actions, all_sessions(actions))) == expected
    assert rows(joined) == expected
    assert [r["category_id"] for r in rows(categories.active_categories(actions))] == [1, 2, 3]


def test_only_the_given_sessions_count(spark, actions_of):
    actions = actions_of(
        [{"click_category_id": 1}, {"click_category_id": 1, "session_id": "s2"}]
    )
    given = spark.createDataFrame([("s2",)], "session_id string")
    assert [r["click_count"] for r in rows(session_job.matched_counts(actions, given))] == [1]
    clicks = categories.top_category_clicks(actions, given, top(actions))
    assert [(r["session_id"], r["click_count"]) for r in rows(clicks)] == [("s2", 1)]


def test_sentinel_can_be_kept(actions_of):
    actions = actions_of([{"click_category_id": -1}] * 3 + [{"click_category_id": 5}])
    without, with_it = top(actions), top(actions, keep_sentinel=True)
    assert [r["category_id"] for r in without.collect()] == [5]
    assert [(r["category_id"], r["click_count"]) for r in with_it.collect()] == [(-1, 3), (5, 1)]
    clicks = categories.category_session_click_count(actions, keep_sentinel=True)
    assert {r["category_id"]: r["click_count"] for r in rows(clicks)} == {-1: 0, 5: 1}
    assert [r["category_id"] for r in rows(categories.category_click_count(actions, True))] == [
        -1,
        5,
    ]


def test_top_categories_order_and_ties(actions_of):
    items = []
    for category in range(14, 0, -1):
        items.append({"click_category_id": category})
    items += [
        {"click_category_id": 14},
        {"order_category_ids": "13"},
        {"pay_category_ids": "12"},
    ]
    assert [r["category_id"] for r in top(actions_of(items)).collect()] == [14, 13, 12, 1, 2, 3, 4, 5, 6, 7]


def test_top_sessions_compare_numbers_and_break_ties_by_id(actions_of):
    items = [{"session_id": "nine", "click_category_id": 1}] * 9
    items += [{"session_id": "ten", "click_category_id": 1}] * 10
    items += [{"session_id": f"s{i:02d}", "click_category_id": 1} for i in range(15, 0, -1)]
    ordered = sorted(rows(top_sessions(actions_of(items))), key=lambda r: (-r["click_count"], r["session_id"]))
    assert [r["session_id"] for r in ordered] == ["ten", "nine"] + [
        f"s{i:02d}" for i in range(1, 9)
    ]


def test_sessions_without_a_click_are_on_no_top_list(actions_of):
    actions = actions_of([{"click_category_id": 1}, {"session_id": "s2", "order_category_ids": "1"}])
    assert [r["session_id"] for r in rows(top_sessions(actions))] == ["s1"]


def test_details_repeat_per_list_unless_deduped(spark, actions_of):
    actions = actions_of([{"action_time": at(65)}, {"session_id": "s2"}, {"session_id": "s3"}])
    chosen = spark.createDataFrame([("s1",), ("s1",), ("s2",)], "sessionid string")
    repeated = session_job.top_session_detail(actions, chosen)
    assert sorted(r["sessionid"] for r in rows(repeated)) == ["s1", "s1", "s2"]
    deduped = session_job.top_session_detail(actions, chosen, dedupe=True)
    assert sorted(r["sessionid"] for r in rows(deduped)) == ["s1", "s2"]
    assert rows(repeated)[0]["actionTime"] == "2024-01-05 10:01:05"


def test_equal_sessions_in_any_row_order(actions_of):
    items = [
        {"session_id": f"s{i % 7}", "click_category_id": i % 5, "order_category_ids": f"{i % 3}"}
        for i in range(200)
    ]
    actions, shuffled = actions_of(items), actions_of(items[::-1]).repartition(11)
    assert rows(top(actions)) == rows(top(shuffled))
    assert rows(top_sessions(actions)) == rows(top_sessions(shuffled))
