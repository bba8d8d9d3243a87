"""Session analysis: statistics, sample, top categories and their top sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.functions import dates, strings
from trailmetrics.operators import bloom, categories, details, sampling, sessions
from trailmetrics.params import TaskParams
from trailmetrics.runtime import Scratch, scratch
from trailmetrics.sinks import Sink, result_table


def session_sample(
    found: DataFrame,
    actions: DataFrame,
    tables: Scratch,
    seed: int = 0,
    sample_size: int = sampling.SAMPLE_SIZE,
    extra: int = 1,
) -> DataFrame:
    """The sampled sessions with start time, keywords and categories.

    The chosen sessions are written down first: Spark then knows how many there
    are when it joins them with the actions, or with stored parts of them.
    """
    sample = sampling.session_random_extract(found, seed, sample_size, extra)
    chosen = tables.write(sample.select("session_id", "start_time"), "chosen")
    return _extract_columns(
        sessions.with_lists(chosen, sessions.filtered_actions(actions, chosen))
    )


def _extract_columns(sample: DataFrame) -> DataFrame:
    return sample.select(
        F.col("session_id").alias("sessionid"),
        dates.format_time(F.col("start_time")).alias("startTime"),
        strings.joined_or_null(F.col("search_keywords")).alias("searchKeywords"),
        strings.joined_or_null(F.col("click_category_ids").cast("array<string>")).alias(
            "clickCategoryIds"
        ),
    )


def top_categories(counts: DataFrame) -> DataFrame:
    return categories.top10_category(counts).select(
        F.col("category_id").alias("categoryid"),
        F.col("click_count").alias("clickCount"),
        F.col("order_count").alias("orderCount"),
        F.col("pay_count").alias("payCount"),
    )


# Fewer sessions than these are broadcast.
FEW_SESSIONS = 100_000


def matched_counts(
    actions: DataFrame,
    found: DataFrame,
    keep_sentinel: bool = False,
    session_count: int = 0,
    in_buckets: bool = False,
) -> DataFrame:
    """Click, order and payment counts per category, of the given sessions.

    Only actions with a category are shuffled to meet their session, and only the
    columns that are counted. If there are `session_count` sessions, too many to
    broadcast, a Bloom filter of their ids drops other actions before that. A
    session with a large part of the actions is a skewed partition of the join,
    which adaptive execution splits. Actions that are stored in buckets by session
    are not shuffled.
    """
    active = categories.with_activity(actions, keep_sentinel)
    if in_buckets:
        matched = sessions.bucketed_actions(active, found)
    else:
        if session_count > FEW_SESSIONS:
            active = bloom.prefiltered(active, found, "session_id", session_count)
        matched = sessions.filtered_actions(active, found)
    return categories.category_counts(matched, keep_sentinel)


def top_sessions(
    actions: DataFrame, found: DataFrame, top: DataFrame, keep_sentinel: bool = False
) -> DataFrame:
    """Top sessions of the top categories."""
    top_categories = top.select(F.col("categoryid").alias("category_id"))
    clicks = categories.top_category_clicks(actions, found, top_categories, keep_sentinel)
    return categories.top10_session(clicks).select(
        F.col("category_id").alias("categoryid"),
        F.col("session_id").alias("sessionid"),
        F.col("click_count").alias("clickCount"),
    )


def _session_ids(df: DataFrame) -> DataFrame:
    return df.select(F.col("sessionid").alias("session_id"))


def sample_detail(actions: DataFrame, sample: DataFrame) -> DataFrame:
    return details.session_detail(actions, _session_ids(sample))


def top_session_detail(actions: DataFrame, top: DataFrame, dedupe: bool = False) -> DataFrame:
    """Actions of the top sessions, once per category list that a session is on."""
    chosen = _session_ids(top)
    return details.session_detail(actions, chosen.distinct() if dedupe else chosen, dedupe)


def run_session_job(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: str,
    sink: Sink,
    seed: int = 0,
    parts: DataFrame | None = None,
    in_buckets: bool = False,
) -> None:
    """Write the five result tables.

    The sessions, one short row each, are written once to the shared folder and
    counted as they are written; all results read them, as they do the sample and
    the two top lists. With stored `parts` of the same days (`session_days`), the
    sessions and the sample's lists come from those. The actions are then scanned
    three times, otherwise five times, each time with the columns that are needed:
    the roll-up and the click counts combine them in each task, the category counts
    shuffle those with a category, the sample's lists and the details shuffle none
    as long as the chosen sessions are few enough for Spark to broadcast them.
    `in_buckets` says that the actions are a table of `sinks.bucket_table`: then
    neither the roll-up nor the category counts shuffle them.
    """
    spark = actions.sparkSession
    with scratch(spark, "session_job") as tables:

        def write(df: DataFrame, name: str) -> None:
            sink(result_table(df, name, task_id), name)

        rolled_up = sessions.action_parts(actions) if parts is None else parts
        found, counts = sessions.observed(sessions.filtered_of(rolled_up, users, params))
        found = tables.write(found, "sessions")
        write(sessions.observed_stat(spark, counts), "session_aggr_stat")

        sample = tables.write(session_sample(found, rolled_up, tables, seed), "sample")
        write(sample, "session_random_extract")

        matched = matched_counts(
            actions,
            found,
            session_count=counts.get.get("session_count", 0),
            in_buckets=in_buckets,
        )
        top = tables.write(top_categories(matched), "top_categories")
        write(top, "top10_category")

        top_list = tables.write(top_sessions(actions, found, top), "top_sessions")
        write(top_list, "top10_session")

        chosen = sample.select("sessionid").unionAll(top_list.select("sessionid"))
        write(top_session_detail(actions, tables.write(chosen, "detailed")), "session_detail")
