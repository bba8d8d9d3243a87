"""Session roll-up, session filter and session statistics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trailmetrics.functions import dates, ids, numbers
from trailmetrics.params import TaskParams
from trailmetrics.schemas import NO_CLICK

# The duration classes in seconds and the depth classes in actions,
# both bounds included. A visit of 0 seconds is in no class.
VISIT_LENGTH_CLASSES = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
STEP_LENGTH_CLASSES = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]


# One row for some actions of a session that have one search word and one clicked
# category in common. Rows combine: two of them give the least user, the first start,
# the last end and the sum of the steps.
PART = [
    "session_id",
    "user_id",
    "start_time",
    "end_time",
    "step_length",
    "search_keyword",
    "click_category_id",
]


def action_parts(actions: DataFrame, *keep: str) -> DataFrame:
    """Each action as a part by itself."""
    user = F.col("user_id")
    return actions.select(
        *keep,
        "session_id",
        F.when(user != NO_CLICK, user).alias("user_id"),
        F.col("action_time").alias("start_time"),
        F.col("action_time").alias("end_time"),
        F.lit(1).cast("bigint").alias("step_length"),
        "search_keyword",
        "click_category_id",
    )


def _measures() -> list[Column]:
    return [
        F.min("user_id").alias("user_id"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("step_length").alias("step_length"),
    ]


def combined(parts: DataFrame, *keep: str) -> DataFrame:
    """As few parts as there are distinct words and categories in each session."""
    keys = [*keep, "session_id", "search_keyword", "click_category_id"]
    return parts.groupBy(*keys).agg(*_measures()).select(*keep, *PART)


def _roll_up(parts: DataFrame, *extra: Column) -> DataFrame:
    """One row per session; every measure combines on the map side."""
    return (
        parts.groupBy("session_id")
        .agg(*_measures(), *extra)
        .withColumn(
            "visit_length", dates.minus(F.col("end_time"), F.col("start_time")).cast("bigint")
        )
    )


def _with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's traits; sessions of unknown users drop out."""
    return sessions.join(
        users.select("user_id", "age", "professional", "city", "sex"), "user_id", "inner"
    )


def _lists(parts: DataFrame) -> DataFrame:
    """Distinct search words and clicked categories per session, both sorted.

    Values are made distinct first, by hash aggregates that combine in each task;
    only distinct values are gathered into lists.
    """
    word, category = F.col("search_keyword"), F.col("click_category_id")
    values = parts.select(
        F.col("session_id").alias("list_id"),
        F.stack(
            F.lit(2),
            F.when(word != "", word),
            F.lit(None).cast("bigint"),
            F.lit(None).cast("string"),
            F.when(ids.is_click(category), category),
        ).alias("word", "category"),
    )
    return (
        values.where(F.col("word").isNotNull() | F.col("category").isNotNull())
        .distinct()
        .groupBy("list_id")
        .agg(
            F.array_sort(F.collect_list("word")).alias("search_keywords"),
            F.array_sort(F.collect_list("category")).alias("click_category_ids"),
        )
    )


def with_lists(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Add the keyword and category lists to the sessions of the actions, or of parts.

    Actions without a session id are one session.
    """
    same = F.col("session_id").eqNullSafe(F.col("list_id"))
    nothing = {"search_keywords": "array<string>", "click_category_ids": "array<bigint>"}
    return sessions.join(_lists(actions), same, "left").select(
        *sessions.columns,
        *[
            F.coalesce(F.col(name), F.array().cast(kind)).alias(name)
            for name, kind in nothing.items()
        ],
    )


RECORD = [
    "session_id",
    "user_id",
    "search_keywords",
    "click_category_ids",
    "visit_length",
    "step_length",
    "start_time",
    "age",
    "professional",
    "city",
    "sex",
]


def aggregate_of(parts: DataFrame, users: DataFrame) -> DataFrame:
    """The full session record from parts, with its keyword and category lists."""
    return with_lists(_with_user(_roll_up(parts), users), parts).select(*RECORD)


def session_aggregate(actions: DataFrame, users: DataFrame) -> DataFrame:
    """The full session record, with its keyword and category lists."""
    return aggregate_of(action_parts(actions), users)


def _user_predicates(params: TaskParams) -> list[Column]:
    predicates = []
    if params.start_age is not None and params.end_age is not None:
        in_range = F.col("age").between(params.start_age, params.end_age)
        predicates.append(F.coalesce(in_range, F.lit(False)))
    if params.professionals:
        predicates.append(ids.text_in(F.col("professional"), params.professionals))
    if params.cities:
        predicates.append(ids.text_in(F.col("city"), params.cities))
    if params.sex:
        predicates.append(F.coalesce(F.col("sex") == params.sex, F.lit(False)))
    return predicates


def _all_of(predicates: list[Column]) -> Column:
    return reduce(and_, predicates, F.lit(True))


def session_filter(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Keep the full session records that meet every parameter that is set."""
    predicates = _user_predicates(params)
    if params.keywords:
        # Items of a keyword that itself holds commas count one by one.
        predicates.append(ids.text_in(F.array_join("search_keywords", ","), params.keywords))
    if params.category_ids:
        predicates.append(ids.any_in(F.col("click_category_ids"), params.category_ids))
    return sessions.where(_all_of(predicates))


def _filtered(parts: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions that meet every parameter, with their users' traits.

    Whether a session searched or clicked a wanted value is one flag, so each
    session is a fixed-size record in a hash aggregate however long it is.
    """
    flags = []
    if params.keywords:
        word = F.col("search_keyword")
        hit = F.max(ids.any_in(F.split(word, ","), params.keywords))
        if str(NO_CLICK) in params.keywords:
            # A session whose only keyword is the no-value mark has none.
            hit = hit & F.max(F.coalesce(~word.isin("", str(NO_CLICK)), F.lit(False)))
        flags.append(hit.alias("keyword_hit"))
    if params.category_ids:
        hit = F.coalesce(F.col("click_category_id").isin(*params.category_ids), F.lit(False))
        flags.append(F.max(hit & ids.is_click(F.col("click_category_id"))).alias("category_hit"))
    wanted = [F.col(name) for name in _flag_names(params)]
    sessions = _with_user(_roll_up(parts, *flags).where(_all_of(wanted)), users)
    return sessions.where(_all_of(_user_predicates(params)))


def filtered_of(parts: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions that `session_filter` keeps, without their lists, from parts."""
    return _filtered(parts, users, params).select(
        "session_id", "user_id", "start_time", "visit_length", "step_length"
    )


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions that `session_filter` keeps, without their lists."""
    return filtered_of(action_parts(actions), users, params)


def filtered_records(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """What `session_filter` keeps of all records.

    Lists are gathered only from the actions of the sessions that remain.
    """
    found = _filtered(action_parts(actions), users, params)
    return with_lists(found, filtered_actions(actions, found)).select(*RECORD)


def _flag_names(params: TaskParams) -> list[str]:
    names = []
    if params.keywords:
        names.append("keyword_hit")
    if params.category_ids:
        names.append("category_hit")
    return names


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The actions of the given sessions; actions without a session id are one session.

    The null-safe key also makes Spark shuffle both sides for this join alone, even
    if the sessions are still partitioned by their roll-up. Only then can adaptive
    execution split the partition of a session that holds a large part of all
    actions.
    """
    given = sessions.select(F.col("session_id").alias("given_id"))
    return actions.join(given, F.col("session_id").eqNullSafe(F.col("given_id")), "left_semi")


def bucketed_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """`filtered_actions` of a table that is stored in buckets by session.

    The key is the plain column, so the actions stay in their buckets. Actions
    without a session id, which no plain join matches, are asked for by themselves.
    """
    given = sessions.select(F.col("session_id").alias("given_id"))
    nameless = given.where("given_id IS NULL").agg(F.count("*") > 0).scalar()
    same = F.col("session_id") == F.col("given_id")
    return actions.join(given, same, "left_semi").unionAll(
        actions.where(F.col("session_id").isNull() & nameless)
    )


def _class_count(measure: str, low: int, high: int | None) -> Column:
    value = F.col(measure)
    return F.count_if(value >= low if high is None else value.between(low, high))


def _class_counts() -> list[tuple[str, Column]]:
    """The columns of one row that counts the sessions, all and of each class."""
    return [("session_count", F.count("*"))] + [
        (f"{measure}_{label}", _class_count(measure, low, high))
        for measure, table in (
            ("visit_length", VISIT_LENGTH_CLASSES),
            ("step_length", STEP_LENGTH_CLASSES),
        )
        for label, low, high in table
    ]


def _ratios(counts: DataFrame) -> DataFrame:
    return counts.select(
        "session_count",
        *[
            numbers.ratio(F.col(name), F.col("session_count")).alias(f"{name}_ratio")
            for name, _ in _class_counts()[1:]
        ],
    )


def session_aggr_stat(sessions: DataFrame) -> DataFrame:
    """Number of sessions and the share of each duration and depth class: one row."""
    return _ratios(sessions.agg(*[count.alias(name) for name, count in _class_counts()]))


def observed(sessions: DataFrame) -> tuple[DataFrame, Observation]:
    """The sessions, and their counts once the first action on them has ended.

    Write the sessions as they are returned: each task then counts what it writes.
    The counts of a task come with its result, so a task that is repeated, or runs
    twice, counts once. An operation in between that shuffles would lose that.
    """
    counts = Observation("session counts")
    return sessions.observe(counts, *[n.alias(name) for name, n in _class_counts()]), counts


def observed_stat(spark: SparkSession, counts: Observation) -> DataFrame:
    """`session_aggr_stat` from the counts that were observed, without another scan."""
    found = counts.get
    return _ratios(
        spark.range(1).select(
            *[F.lit(found.get(name, 0)).cast("bigint").alias(name) for name, _ in _class_counts()]
        )
    )
