
from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from trailmetrics.functions import dates, numbers, strings  # noqa: E402
from trailmetrics.operators import (  # noqa: E402
    bloom,
    categories,
    pages,
    products,
    sampling,
    session_days,
    sessions,
)
from trailmetrics.params import TaskParams  # noqa: E402
from trailmetrics.plans import page_job, product_job, session_job  # noqa: E402
from trailmetrics.runtime import Scratch  # noqa: E402
from trailmetrics.sinks import (  # noqa: E402
    bucket_table,
    publish_table,
    read_results,
    replace_partitions,
    replace_table,
    result_sink,
)
from trailmetrics.sources import star, tables, text  # noqa: E402
from trailmetrics.streaming import ad_clicks  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from trailmetrics.llm import queries as corpus_queries  # noqa: E402
except ModuleNotFoundError as missing:
    # The corpus operators may be left out; a fault inside them is not hidden.
    if missing.name not in {"corpus_pipeline", "trailmetrics.llm"}:
        raise
    corpus_pipeline = corpus_queries = None

SEED = 7
PARAMS = TaskParams.from_dict(
    {
        "startDate": "2024-01-01",
        "endDate": "2024-01-31",
        "startAge": 20,
        "endAge": 50,
        "targetPageFlow": "1,2,3,4,5,6,7",
    }
)
FILTER_PARAMS = TaskParams.from_dict(
    {
        "startDate": "2024-01-01",
        "endDate": "2024-01-31",
        "startAge": 20,
        "endAge": 50,
        "keywords": "kw1,kw2,kw3",
    }
)
# All six session filters, each of which leaves sessions out.
ALL_FILTERS = TaskParams.from_dict(
    {
        "startDate": "2024-01-01",
        "endDate": "2024-01-31",
        "startAge": 5,
        "endAge": 55,
        "professionals": "BUILDING,MACHINERY,FURNITURE,AUTOMOBILE",
        "cities": ",".join(f"NATION_{i}" for i in range(1, 21)),
        "sex": "male",
        "keywords": "kw0,kw1,kw2,kw3,kw4,kw5,kw6",
        "categoryIds": "0,1,2,3,4,5,6,7,8,9,10,11,12,13",
    }
)
# Large enough that an hour's share of the sample is more than the added session.
LARGE_SAMPLE = 2000
# The scans are about their date filter, so they leave days out at both ends.
SCAN_PARAMS = TaskParams.from_dict({"startDate": "2024-01-05", "endDate": "2024-01-24"})
REPLACED_DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 12))
FLOW = PARAMS.target_page_flow


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams = PARAMS) -> DataFrame:
    return star.actions_between(spark, sf_dir, params.start_date, params.end_date)


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_sessions(
        _actions(spark, sf_dir), star.user_info(spark, sf_dir), PARAMS
    )


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_actions(_actions(spark, sf_dir), _sessions(spark, sf_dir))


def _clicks(spark: SparkSession, sf_dir: str, params: TaskParams = PARAMS) -> DataFrame:
    return tables.click_scan(
        star.user_visit_action(spark, sf_dir), params.start_date, params.end_date
    )


def _area_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.area_product_click_count(_clicks(spark, sf_dir), tables.city_info(spark))


def action_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, SCAN_PARAMS)


def click_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir, SCAN_PARAMS)


def _checked(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    stored = star.text_actions(spark, sf_dir)
    days = SCAN_PARAMS.start_date, SCAN_PARAMS.end_date
    return tables.checked_scan(stored, *days, Scratch(spark, name))


def checked_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a malformed table that can be read."""
    return _checked(spark, sf_dir, "checked_actions")[0]


def rejected_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The others, with the reason; some of their fields as they are stored."""
    rejects = _checked(spark, sf_dir, "rejected_actions")[1]
    fields = ("date", "user_id", "session_id", "action_time")
    return rejects.select(
        *[F.get_json_object("raw", f"$.{name}").alias(name) for name in fields],
        F.get_json_object("raw", "$.page_id").cast("bigint").alias("page_id"),
        "reason",
    )


def _as_text(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {
            "search_keywords": strings.joined_or_null(F.col("search_keywords")),
            "click_category_ids": strings.joined_or_null(
                F.col("click_category_ids").cast("array<string>")
            ),
        }
    )


def session_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(
        sessions.session_aggregate(_actions(spark, sf_dir), star.user_info(spark, sf_dir))
    )


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(
        sessions.filtered_records(
            _actions(spark, sf_dir), star.user_info(spark, sf_dir), FILTER_PARAMS
        )
    )


def session_filter_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sessions.session_aggregate(_actions(spark, sf_dir), star.user_info(spark, sf_dir))
    return _as_text(sessions.session_filter(records, ALL_FILTERS))


def filtered_sessions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_sessions(
        _actions(spark, sf_dir), star.user_info(spark, sf_dir), ALL_FILTERS
    )


def session_aggr_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_aggr_stat(_sessions(spark, sf_dir))


def session_aggr_stat_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics from counts that are taken while the sessions are written."""
    found, counts = sessions.observed(_sessions(spark, sf_dir))
    Scratch(spark, "observed").write(found, "sessions")
    return sessions.observed_stat(spark, counts)


def _long_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions in sessions of three days, which cross midnight."""
    three_days = F.expr("concat_ws('-', user_id, dayofyear(date) div 3)")
    return _actions(spark, sf_dir).withColumn("session_id", three_days)


def _stored_days(spark: SparkSession, actions: DataFrame, name: str) -> DataFrame:
    """Parts of all days, of which the last was added to those before."""
    table = Scratch(spark, name).table("session_days")
    last = F.col("date") == F.lit(PARAMS.end_date)
    session_days.store_days(actions.where(~last), table)
    session_days.store_days(actions.where(last), table)
    return session_days.stored_parts(spark, table, PARAMS.start_date, PARAMS.end_date)


def session_days_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _stored_days(spark, _long_actions(spark, sf_dir), "session_days_added")
    return _as_text(sessions.aggregate_of(parts, star.user_info(spark, sf_dir)))


def session_days_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _stored_days(spark, _actions(spark, sf_dir), "session_days_filter")
    return sessions.filtered_of(parts, star.user_info(spark, sf_dir), ALL_FILTERS)


def session_hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_hour_count(_sessions(spark, sf_dir))


def session_extract_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_extract_quota(session_hour_count(spark, sf_dir))


def session_extract_quota_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_extract_quota(session_hour_count(spark, sf_dir), LARGE_SAMPLE)


def _sample(spark: SparkSession, sf_dir: str, sample_size: int) -> DataFrame:
    return session_job.session_sample(
        _sessions(spark, sf_dir),
        _actions(spark, sf_dir),
        Scratch(spark, "session_sample"),
        SEED,
        sample_size,
    )


def _sample_detail(spark: SparkSession, sf_dir: str, sample_size: int) -> DataFrame:
    drawn = sampling.session_random_extract(_sessions(spark, sf_dir), SEED, sample_size)
    chosen = Scratch(spark, "sample_detail").write(
        drawn.select(F.col("session_id").alias("sessionid")), "chosen"
    )
    return session_job.sample_detail(_actions(spark, sf_dir), chosen)


def session_random_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir, sampling.SAMPLE_SIZE)


def session_random_extract_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir, LARGE_SAMPLE)


def session_random_extract_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_detail(spark, sf_dir, sampling.SAMPLE_SIZE)


def session_random_extract_large_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_detail(spark, sf_dir, LARGE_SAMPLE)


def category_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_click_count(_matched(spark, sf_dir))


def category_order_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_order_count(_matched(spark, sf_dir))


def category_pay_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_pay_count(_matched(spark, sf_dir))


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_actions(
        categories.with_activity(_actions(spark, sf_dir)), _sessions(spark, sf_dir)
    )


def active_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.active_categories(_active(spark, sf_dir))


def category_counts_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Four results read the counts, at most three rows per category.
    counts = Scratch(spark, "category_counts").write(
        categories.kind_counts(_active(spark, sf_dir)), "counts"
    )
    return categories.category_counts_joined(
        counts.select("category_id").distinct(),
        *[categories.of_kind(counts, kind) for kind in ("click", "order", "pay")],
    )


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_job.matched_counts(_actions(spark, sf_dir), _sessions(spark, sf_dir))


def session_filtered_actions_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions of few sessions, most others dropped before the join shuffles them."""
    found = sessions.filtered_sessions(
        _actions(spark, sf_dir), star.user_info(spark, sf_dir), ALL_FILTERS
    )
    chosen = Scratch(spark, "bloom").write(found.select("session_id"), "chosen")
    wanted = bloom.prefiltered(_actions(spark, sf_dir), chosen, "session_id", chosen.count())
    return sessions.filtered_actions(wanted, chosen)


def category_counts_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts from actions that are stored in buckets by session."""
    name = Scratch(spark, "in_buckets").table("user_visit_action")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_table(star.user_visit_action(spark, sf_dir), name, buckets)
    actions = tables.read_actions(spark, name, PARAMS.start_date, PARAMS.end_date)
    found = sessions.filtered_sessions(actions, star.user_info(spark, sf_dir), PARAMS)
    return session_job.matched_counts(actions, found, in_buckets=True)


def category_session_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_session_click_count(_matched(spark, sf_dir))


def top10_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_job.top_categories(category_counts(spark, sf_dir))


def top10_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The top categories and their sessions read the same sessions.
    actions = _actions(spark, sf_dir)
    scratch = Scratch(spark, "top_session")
    found = scratch.write(_sessions(spark, sf_dir), "sessions")
    top = session_job.top_categories(session_job.matched_counts(actions, found))
    return session_job.top_sessions(actions, found, scratch.write(top, "top_categories"))


def top10_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = Scratch(spark, "top_detail").write(top10_session(spark, sf_dir), "chosen")
    return session_job.top_session_detail(_actions(spark, sf_dir), chosen)


def page_split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_split_pairs(_actions(spark, sf_dir), FLOW)


def page_split_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_split_pv(page_split_pairs(spark, sf_dir))


def start_page_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.start_page_pv(_actions(spark, sf_dir), FLOW)


def page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_job.convert_rates(_actions(spark, sf_dir), FLOW)


def page_convert_rate_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_job.convert_rates_text(_actions(spark, sf_dir), FLOW)


def _crowded_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with microseconds; every third user's views are of one session in one hour."""
    micros = (
        "(user_id * 7919 + dayofyear(date) * 104729 + page_id * 1299709 + city_id * 15485863)"
        " * 17 % 3600000000"
    )
    actions = _actions(spark, sf_dir).withColumn("micros", F.expr(micros))
    after = "make_dt_interval(0, 0, 0, cast({} AS decimal(18, 6)) / 1000000)"
    return actions.withColumns(
        {
            "session_id": F.expr("if(user_id % 3 = 0, 'crowded', session_id)"),
            "action_time": F.expr(
                "if(user_id % 3 = 0,"
                f" timestamp_ntz'2024-01-10 10:00:00' + {after.format('micros')},"
                f" action_time + {after.format('micros % 1000000')})"
            ),
        }
    ).drop("micros")


def page_rates_crowded_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_job.convert_rates(_crowded_hour(spark, sf_dir), FLOW, most_in_hour=500)


def page_pairs_crowded_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_split_pairs(_crowded_hour(spark, sf_dir), FLOW, most_in_hour=500)


def click_product_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.click_product_basic(_clicks(spark, sf_dir), tables.city_info(spark))


def area_full_product_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.area_full_product_click_count(
        _area_counts(spark, sf_dir), star.product_info(spark, sf_dir)
    )


def area_top3_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_job.area_top3(
        star.user_visit_action(spark, sf_dir),
        tables.city_info(spark),
        star.product_info(spark, sf_dir),
        PARAMS,
    )


def _run_stream(spark: SparkSession, clicks: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is and read back what it wrote."""
    path = Scratch(spark, name).folder
    query = ad_clicks.write_stream(clicks, f"{path}/rows", f"{path}/checkpoint", True)
    query.awaitTermination()
    return spark.read.schema(clicks.schema).parquet(f"{path}/rows")


def ad_click_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.ad_lines_stream(spark, sf_dir)
    return _run_stream(spark, ad_clicks.ad_click_parse(lines), "ad_click_parse")


def ad_click_blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ad_clicks.ad_click_filter(
        star.ad_lines_stream(spark, sf_dir), star.blacklist(spark, sf_dir)
    )
    return _run_stream(spark, kept, "ad_click_filter")


def ad_click_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream in two runs from one checkpoint; lines arrive between the runs."""
    path = Scratch(spark, "ad_click_restarted").folder
    lines = star.ad_lines(spark, star.events(spark, sf_dir))
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        lines.where(half == part).write.mode("append").text(f"{path}/lines")
        arriving = spark.readStream.schema("value string").text(f"{path}/lines")
        kept = ad_clicks.ad_click_filter(arriving, star.blacklist(spark, sf_dir), partitions=4)
        ad_clicks.write_stream(
            kept, f"{path}/rows", f"{path}/checkpoint", available_now=True
        ).awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{path}/rows")


def ad_click_changing_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in two runs; between them lines arrive and the blacklist grows."""
    path = Scratch(spark, "ad_click_changing_list").folder
    versions = [star.blacklist(spark, sf_dir), star.longer_blacklist(spark, sf_dir)]
    for part, users in enumerate(versions):
        ad_clicks.publish_version(users, f"{path}/blacklist", part)
        events = star.events(spark, sf_dir).where(F.col("event_id") % 2 == part)
        star.ad_lines(spark, events).write.mode("append").text(f"{path}/lines")
        arriving = spark.readStream.schema("value string").text(f"{path}/lines")
        ad_clicks.write_versioned_stream(
            arriving, f"{path}/blacklist", f"{path}/rows", f"{path}/checkpoint", available_now=True
        ).awaitTermination()
    return ad_clicks.read_written(spark, f"{path}/rows")


def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("action_time")
    noon = F.expr("cast(date AS timestamp_ntz) + INTERVAL 12 HOUR")
    unpadded = F.concat_ws(
        " ", dates.format_date(time), F.concat(F.hour(time), F.date_format(time, ":mm:ss"))
    )
    return star.user_visit_action(spark, sf_dir).select(
        "session_id",
        "page_id",
        dates.before(time, noon).alias("is_before"),
        dates.after(time, noon).alias("is_after"),
        dates.minus(time, noon).alias("seconds"),
        dates.date_hour(time).alias("date_hour"),
        dates.format_date(time).alias("date_text"),
        dates.format_time(time).alias("time_text"),
        dates.parse_time(unpadded).alias("parsed_time"),
        dates.format_date_key(time).alias("date_key"),
        dates.parse_date_key(dates.format_date_key(time)).alias("parsed_date_key"),
        dates.format_time_minute(time).alias("minute_text"),
    )


def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyword = F.col("search_keyword")
    with_commas = F.concat(F.lit(","), F.col("order_category_ids"), F.lit(","))
    return star.user_visit_action(spark, sf_dir).select(
        "session_id",
        "page_id",
        strings.is_empty(keyword).alias("keyword_is_empty"),
        strings.is_not_empty(keyword).alias("keyword_is_not_empty"),
        strings.trim_comma(with_commas).alias("trimmed"),
        strings.pad_two(F.col("user_id").cast("string")).alias("padded"),
        strings.concat_long_string(F.col("city_id"), F.col("session_id")).alias("label"),
    )


def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    midnight = F.col("date").cast("timestamp_ntz")
    part = dates.minus(F.col("action_time"), midnight).cast("bigint")
    whole = F.col("page_id") + 200
    return star.user_visit_action(spark, sf_dir).select(
        "session_id",
        "page_id",
        part.alias("part"),
        whole.alias("whole"),
        numbers.ratio(part, whole).alias("ratio"),
    )


def kv_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = text.record_lines(star.record_lines(spark, sf_dir))
    return records.select(
        "id",
        *[
            strings.get_field(F.col("record"), "|", field).alias(field)
            for field in ("age", "city")
        ],
    )


def kv_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = text.record_lines(star.record_lines(spark, sf_dir))
    return records.select(
        "id",
        strings.set_field(F.col("record"), "|", "sex", F.lit("unknown")).alias("record"),
    )


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field of the record lines of a text file."""
    path = f"{Scratch(spark, 'text_scan').folder}/lines"
    star.record_lines(spark, sf_dir).write.text(path)
    return text.record_field(text.record_lines(text.read_lines(spark, path)), "age")


def replaced_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a table that was replaced, stored by day."""
    name = Scratch(spark, "replaced_actions").table("user_visit_action")
    actions = star.user_visit_action(spark, sf_dir)
    replace_table(actions.limit(0), name)
    replace_table(actions, name, "date")
    return tables.read_actions(spark, name, SCAN_PARAMS.start_date, SCAN_PARAMS.end_date)


def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of which three days were replaced; the others stay."""
    name = Scratch(spark, "replaced_days").table("user_visit_action")
    actions = star.user_visit_action(spark, sf_dir)
    replace_partitions(actions, name, "date")
    three_days = F.col("date").between(*[F.lit(day) for day in REPLACED_DAYS])
    fewer = actions.where(three_days & (F.col("page_id") < 5)).withColumn(
        "city_id", F.lit(0).cast("bigint")
    )
    replace_partitions(fewer, name, "date")
    return tables.read_actions(spark, name, SCAN_PARAMS.start_date, SCAN_PARAMS.end_date)


def published_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a table that was replaced at one stroke."""
    name = Scratch(spark, "published_actions").table("user_visit_action")
    actions = star.user_visit_action(spark, sf_dir)
    publish_table(actions.where("page_id < 3"), name, "date")
    publish_table(actions, name, "date")
    return tables.read_actions(spark, name, SCAN_PARAMS.start_date, SCAN_PARAMS.end_date)


def product_job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two tasks wrote, one of which was run again."""
    name = Scratch(spark, "product_job_rerun").table("results")
    for task_id in ("first", "second", "first"):
        sink = result_sink({}, "table", task_id)
        product_job.run_product_job(
            star.user_visit_action(spark, sf_dir),
            tables.city_info(spark),
            star.product_info(spark, sf_dir),
            PARAMS,
            task_id,
            lambda df, _: sink(df, name),
        )
    return read_results(spark, name, {}, "table")


def product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products of each area, from the job's views by SQL."""
    product_job.register_views(
        star.user_visit_action(spark, sf_dir),
        tables.city_info(spark),
        star.product_info(spark, sf_dir),
        PARAMS,
    )
    return spark.sql(
        f"""
        SELECT area, concat_long_string(product_id, product_name, ':') AS product,
               click_count, product_status
        FROM {product_job.FULL_VIEW}
        """
    )


def entry(spark: SparkSession) -> DataFrame:
    """The top products per sales area on the smallest tables."""
    return area_top3_product(spark, "/root/testdata/sf0.001")


def shop_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The clickstream queries by name; each takes (spark, sf_dir)."""
    return {
        "action_scan": action_scan,
        "click_scan": click_scan,
        "checked_actions": checked_actions,
        "rejected_actions": rejected_actions,
        "session_aggregate": session_aggregate,
        "session_filter": session_filter,
        "session_filter_all": session_filter_all,
        "filtered_sessions_all": filtered_sessions_all,
        "session_aggr_stat": session_aggr_stat,
        "session_aggr_stat_observed": session_aggr_stat_observed,
        "session_days_added": session_days_added,
        "session_days_filter": session_days_filter,
        "session_filtered_actions": _matched,
        "session_filtered_actions_bloom": session_filtered_actions_bloom,
        "session_hour_count": session_hour_count,
        "session_extract_quota": session_extract_quota,
        "session_extract_quota_large": session_extract_quota_large,
        "session_random_extract": session_random_extract,
        "session_random_extract_large": session_random_extract_large,
        "session_random_extract_detail": session_random_extract_detail,
        "session_random_extract_large_detail": session_random_extract_large_detail,
        "category_click_count": category_click_count,
        "category_order_count": category_order_count,
        "category_pay_count": category_pay_count,
        "active_categories": active_categories,
        "category_counts_joined": category_counts_joined,
        "category_counts": category_counts,
        "category_counts_in_buckets": category_counts_in_buckets,
        "category_session_click_count": category_session_click_count,
        "top10_category": top10_category,
        "top10_session": top10_session,
        "top10_session_detail": top10_session_detail,
        "page_split_pairs": page_split_pairs,
        "page_split_pv": page_split_pv,
        "start_page_pv": start_page_pv,
        "page_convert_rate": page_convert_rate,
        "page_rates_crowded_hour": page_rates_crowded_hour,
        "page_pairs_crowded_hour": page_pairs_crowded_hour,
        "page_convert_rate_string": page_convert_rate_string,
        "click_product_basic": click_product_basic,
        "area_product_click_count": _area_counts,
        "area_full_product_click_count": area_full_product_click_count,
        "area_top3_product": area_top3_product,
        "ad_click_parse": ad_click_parse,
        "product_views": product_views,
        "replaced_actions": replaced_actions,
        "replaced_days": replaced_days,
        "published_actions": published_actions,
        "product_job_rerun": product_job_rerun,
        "ad_click_blacklist_filter": ad_click_blacklist_filter,
        "ad_click_restarted": ad_click_restarted,
        "ad_click_changing_list": ad_click_changing_list,
        "scalar_dates": scalar_dates,
        "scalar_strings": scalar_strings,
        "scalar_math": scalar_math,
        "kv_fields": kv_fields,
        "kv_set": kv_set,
        "text_scan": text_scan,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes (spark, sf_dir)."""
    found = shop_queries()
    if corpus_queries is not None:
        found |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def shop_oracles() -> dict[str, str]:
    """The same results in DuckDB SQL, for each key of `shop_queries()`."""
    return oracle_queries.build(
        start=PARAMS.start_date.isoformat(),
        end=PARAMS.end_date.isoformat(),
        scan=(SCAN_PARAMS.start_date.isoformat(), SCAN_PARAMS.end_date.isoformat()),
        ages=(PARAMS.start_age, PARAMS.end_age),
        keywords=FILTER_PARAMS.keywords,
        flow=FLOW,
        seed=SEED,
        large_sample=LARGE_SAMPLE,
        filters=ALL_FILTERS,
        replaced=tuple(day.isoformat() for day in REPLACED_DAYS),
    )


def oracle_sql() -> dict[str, str]:
    """Results in DuckDB SQL, by the keys of `queries()`."""
    found = shop_oracles()
    if corpus_queries is not None:
        found |= corpus_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
