"""DuckDB SQL for each registered query, written independently of the Spark code.

It states each result in the most direct way SQL allows; ratios are rounded half up
in whole numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from trailmetrics.params import TaskParams

# The clickstream tables as views of the star schema, with the fixed values of the
# cities and, further down, of the sales areas' levels.
_VIEWS = """
uva AS (
  SELECT d AS date, user_id,
         concat_ws('-', user_id, strftime(d, '%Y%m%d')) AS session_id,
         k % 10 AS page_id,
         cast(d AS timestamp) + to_hours(user_id % 23) + to_seconds(sod // 40) AS action_time,
         CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN concat_ws(',', k % 20, (k + 7) % 20) END
           AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN concat_ws(',', k, (k + 7) % 100) END
           AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN cast(k % 20 AS varchar) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN cast(k AS varchar) END AS pay_product_ids,
         event_id % 10 AS city_id
  FROM (
    SELECT event_id, user_id, event_type, cast(ts AS date) AS d,
           cast(json_extract_string(props, '$.k') AS bigint) AS k,
           cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS bigint) AS sod
    FROM events
  )
),
ui AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         cast(floor(abs(c_acctbal)) AS int) % 60 AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
pi AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         concat('{"product_status": ', p_size % 2, '}') AS extend_info
  FROM part
),
ci(city_id, city_name, area) AS (
  VALUES (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
         (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
         (8, '成都', '西南'), (9, '哈尔滨', '东北')
),
kv AS (
  SELECT concat(user_id, chr(9), 'userid=', user_id, '|age=',
                CASE WHEN user_id % 10 = 0 THEN '' ELSE cast(age AS varchar) END,
                '|city=', city, '|sex=', sex) AS value
  FROM ui
),
ad_events AS (
  SELECT event_id, epoch_us(ts) // 1000 AS timestamp, concat('P', user_id % 5) AS province,
         concat('C', event_id % 10) AS city, user_id AS userid,
         cast(json_extract_string(props, '$.k') AS bigint) % 20 AS adid
  FROM events
),
ad AS (SELECT * EXCLUDE (event_id) FROM ad_events)"""


def _half_up(part: str, whole: str) -> str:
    return f"(((200 * {part} + {whole}) // (2 * nullif({whole}, 0))) / 100.0)"


def _sessions(start: str, end: str, ages: tuple[int, int], days: int = 1) -> str:
    """Sessions, of one day or of several."""
    session = f"REPLACE (concat_ws('-', user_id, dayofyear(date) // {days}) AS session_id)"
    return f"""
act AS (SELECT * {session if days > 1 else ""} FROM uva WHERE date BETWEEN DATE '{start}' AND DATE '{end}'),
agg AS (
  SELECT a.session_id, a.user_id, search_keywords, click_category_ids, kws,
         visit_length, step_length, start_time, age, professional, city, sex
  FROM (
    SELECT session_id, min(user_id) FILTER (user_id <> -1) AS user_id,
           list_sort(list(DISTINCT search_keyword) FILTER (search_keyword <> '')) AS kws,
           array_to_string(kws, ',') AS search_keywords,
           array_to_string(list_sort(list(DISTINCT click_category_id)
             FILTER (click_category_id <> -1)), ',') AS click_category_ids,
           date_diff('second', min(action_time), max(action_time)) AS visit_length,
           count(*) AS step_length, min(action_time) AS start_time
    FROM act GROUP BY session_id
  ) a JOIN ui USING (user_id)
),
ses AS (SELECT * FROM agg WHERE age BETWEEN {ages[0]} AND {ages[1]}),
det AS (SELECT * FROM act WHERE session_id IN (SELECT session_id FROM ses))"""


# Times with microseconds; every third user's views are of one session in one hour.
_MICROS = """(user_id * 7919 + dayofyear(date) * 104729 + page_id * 1299709
    + city_id * 15485863) * 17 % 3600000000"""
_CROWDED = f"""
act AS (
  SELECT * REPLACE (
    CASE WHEN user_id % 3 = 0 THEN 'crowded' ELSE session_id END AS session_id,
    CASE WHEN user_id % 3 = 0
         THEN TIMESTAMP '2024-01-10 10:00:00' + to_microseconds({_MICROS})
         ELSE action_time + to_microseconds({_MICROS} % 1000000) END AS action_time
  ) FROM days
)"""


_ID_EVENTS = """
ids AS (
  SELECT session_id, click_category_id AS category_id, 'click' AS kind
  FROM det WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, cast(unnest(string_split(order_category_ids, ',')) AS bigint), 'order'
  FROM det WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, cast(unnest(string_split(pay_category_ids, ',')) AS bigint), 'pay'
  FROM det WHERE pay_category_ids IS NOT NULL
),
cat AS (
  SELECT category_id, count(*) FILTER (kind = 'click') AS click_count,
         count(*) FILTER (kind = 'order') AS order_count,
         count(*) FILTER (kind = 'pay') AS pay_count
  FROM ids GROUP BY category_id
),
top10 AS (
  SELECT * FROM cat ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
  LIMIT 10
),
catses AS (
  SELECT category_id, session_id, count(*) AS click_count
  FROM ids WHERE kind = 'click' GROUP BY ALL
),
topses AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id
                                 ORDER BY click_count DESC, session_id) AS rn
    FROM catses WHERE category_id IN (SELECT category_id FROM top10)
  ) WHERE rn <= 10
)"""


def _sample(seed: int, size: int = 100) -> str:
    return f"""
hours AS (
  SELECT cast(start_time AS date) AS date, cast(hour(start_time) AS int) AS hour,
         count(*) AS session_count
  FROM ses GROUP BY ALL
),
quotas AS (
  SELECT h.date, hour, session_count, day_count,
         least(session_count,
               session_count * ({size} // (SELECT count(DISTINCT date) FROM hours)) // day_count + 1)
           AS quota
  FROM hours h
  JOIN (SELECT date, cast(sum(session_count) AS bigint) AS day_count FROM hours GROUP BY date) d
    ON h.date = d.date
),
sample AS (
  SELECT s.* FROM (
    SELECT *, row_number() OVER (PARTITION BY cast(start_time AS date), hour(start_time)
                                 ORDER BY md5(session_id || '|{seed}'), session_id) AS rn
    FROM ses
  ) s JOIN quotas q ON cast(start_time AS date) = q.date AND hour(start_time) = q.hour
  WHERE rn <= quota
)"""


def _pages(flow: Sequence[int]) -> str:
    steps = list(zip(flow, flow[1:]))
    values = ", ".join(f"({i}, {a}, {b}, '{a}_{b}')" for i, (a, b) in enumerate(steps, 1))
    return f"""
steps(step, from_page, to_page, page_split) AS (VALUES {values}),
moves AS (
  SELECT session_id, action_time, page_id,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS next_page
  FROM act
),
pairs AS (
  SELECT session_id, action_time, page_split
  FROM moves JOIN (SELECT DISTINCT from_page, to_page, page_split FROM steps)
    ON page_id = from_page AND next_page = to_page
),
pv AS (SELECT page_split, count(*) AS pv FROM pairs GROUP BY page_split),
start_pv AS (SELECT count(*) AS pv FROM act WHERE page_id = {flow[0]}),
chain AS (
  SELECT step, page_split, coalesce(pv, 0) AS pv,
         lag(coalesce(pv, 0), 1, (SELECT pv FROM start_pv)) OVER (ORDER BY step) AS previous
  FROM steps LEFT JOIN pv USING (page_split)
),
rates AS (
  SELECT cast(step AS int) AS step, page_split, pv, {_half_up("pv", "previous")} AS convert_rate
  FROM chain
)"""


_AREAS = """
clicks AS (
  SELECT city_id, click_product_id FROM act
  WHERE click_product_id IS NOT NULL AND click_product_id <> -1
),
basic AS (
  SELECT city_id, city_name, area, click_product_id AS product_id
  FROM clicks JOIN ci USING (city_id)
),
counts AS (
  SELECT area, product_id, count(*) AS click_count,
         array_to_string(list_sort(list(DISTINCT concat(city_id, ':', city_name))), ',')
           AS city_infos
  FROM basic GROUP BY area, product_id
),
full_counts AS (
  SELECT area, product_id, click_count, city_infos, product_name,
         CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self'
              ELSE 'Third Party' END AS product_status
  FROM counts JOIN pi USING (product_id)
)"""

_DETAIL = """
  user_id AS userid, session_id AS sessionid, page_id AS pageid,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS actionTime, search_keyword AS searchKeyword,
  click_category_id AS clickCategoryId, click_product_id AS clickProductId,
  order_category_ids AS orderCategoryIds, order_product_ids AS orderProductIds,
  pay_category_ids AS payCategoryIds, pay_product_ids AS payProductIds"""

_EXTRACT = """
SELECT session_id AS sessionid, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS startTime,
       nullif(search_keywords, '') AS searchKeywords,
       nullif(click_category_ids, '') AS clickCategoryIds
FROM sample"""


def _all_filters(filters: TaskParams) -> str:
    def texts(values: Sequence) -> str:
        return ", ".join(f"'{value}'" for value in values)

    return f"""age BETWEEN {filters.start_age} AND {filters.end_age}
        AND professional IN ({texts(filters.professionals)})
        AND city IN ({texts(filters.cities)}) AND sex = '{filters.sex}'
        AND list_has_any(kws, [{texts(filters.keywords)}])
        AND list_has_any(string_split(click_category_ids, ','), [{texts(filters.category_ids)}])"""


# The classes of visit duration and depth.
_VISIT = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
          ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600),
          ("10m_30m", 601, 1800), ("30m", 1801, 10**12)]
_STEP = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60),
         ("60", 61, 10**12)]


def _stat() -> str:
    columns = ["count(*) AS session_count"]
    for measure, table in (("visit_length", _VISIT), ("step_length", _STEP)):
        for label, low, high in table:
            part = f"count(*) FILTER ({measure} BETWEEN {low} AND {high})"
            columns.append(f"{_half_up(part, 'count(*)')} AS {measure}_{label}_ratio")
    return "SELECT " + ",\n       ".join(columns) + " FROM ses"


def build(
    start: str,
    end: str,
    scan: tuple[str, str],
    ages: tuple[int, int],
    keywords: Sequence[str],
    flow: Sequence[int],
    seed: int,
    large_sample: int = 100,
    filters: TaskParams | None = None,
    replaced: tuple[str, str] = ("2024-01-10", "2024-01-12"),
) -> dict[str, str]:
    """The SQL per query, for a date range, filters, a page flow and a sample seed."""
    views = f"WITH {_VIEWS}"
    scanned = f"date BETWEEN DATE '{scan[0]}' AND DATE '{scan[1]}'"
    sessions = f"{views},{_sessions(start, end, ages)}"
    category = f"{sessions},{_ID_EVENTS}"
    sample = f"{sessions},{_sample(seed)}"
    pages = f"{sessions},{_pages(flow)}"
    areas = f"{sessions},{_AREAS}"
    record = """session_id, user_id, nullif(search_keywords, '') AS search_keywords,
       nullif(click_category_ids, '') AS click_category_ids, visit_length, step_length,
       start_time, age, professional, city, sex"""
    words = ", ".join(f"'{word}'" for word in keywords)
    large = f"{sessions},{_sample(seed, large_sample)}"
    all_filters = "true" if filters is None else _all_filters(filters)
    days = f"days AS (SELECT * FROM uva WHERE date BETWEEN DATE '{start}' AND DATE '{end}')"
    crowded = f"{views}, {days}, {_CROWDED}, {_pages(flow)}"
    long_sessions = f"{views},{_sessions(start, end, ages, days=3)}"
    replaced_days = f"date BETWEEN DATE '{replaced[0]}' AND DATE '{replaced[1]}'"
    filtered_ads = """SELECT * FROM ad
            WHERE userid NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
    top3 = """SELECT area,
            CASE WHEN area IN ('华东', '华北') THEN 'A Level'
                 WHEN area IN ('华南', '华中') THEN 'B Level'
                 WHEN area IN ('西北', '西南') THEN 'C Level' ELSE 'D Level' END AS areaLevel,
            product_id AS productid, city_infos AS cityInfos, click_count AS clickCount,
            product_name AS productName, product_status AS productStatus
            FROM (SELECT *, row_number() OVER (PARTITION BY area
                    ORDER BY click_count DESC, product_id) AS rn FROM full_counts)
            WHERE rn <= 3"""
    # What text files hold: every 17th, 19th or 23rd row has a malformed field.
    bad_time, bad_date, bad_user = (f"((user_id + page_id) % {n} = 0)" for n in (17, 19, 23))
    noon = "(cast(date AS timestamp) + INTERVAL 12 HOUR)"
    midnight_seconds = "date_diff('second', cast(date AS timestamp), action_time)"
    return {
        "action_scan": f"{views} SELECT * FROM uva WHERE {scanned}",
        "click_scan": f"""{views} SELECT city_id, click_product_id FROM uva
            WHERE {scanned} AND click_product_id IS NOT NULL AND click_product_id <> -1""",
        "checked_actions": f"""{views} SELECT * FROM uva
            WHERE {scanned} AND NOT ({bad_time} OR {bad_date} OR {bad_user})""",
        "rejected_actions": f"""{views} SELECT
            concat(date, CASE WHEN {bad_date} THEN 'x' ELSE '' END) AS date,
            concat(CASE WHEN {bad_user} THEN 'u' ELSE '' END, user_id) AS user_id,
            session_id,
            CASE WHEN {bad_time} THEN concat(date, ' 10:00:61')
                 ELSE concat(date, ' ', hour(action_time), strftime(action_time, ':%M:%S'))
                 END AS action_time,
            page_id,
            CASE WHEN {bad_date} THEN 'date is not a date'
                 WHEN {bad_user} THEN 'user_id is not a bigint'
                 ELSE 'action_time is not a timestamp_ntz' END AS reason
            FROM uva WHERE {bad_date} OR {scanned} AND ({bad_time} OR {bad_user})""",
        "session_aggregate": f"{sessions} SELECT {record} FROM agg",
        "session_filter": f"""{sessions} SELECT {record} FROM ses
            WHERE list_has_any(kws, [{words}])""",
        "session_filter_all": f"{sessions} SELECT {record} FROM agg WHERE {all_filters}",
        "filtered_sessions_all": f"""{sessions} SELECT session_id, user_id, start_time,
            visit_length, step_length FROM agg WHERE {all_filters}""",
        "session_aggr_stat": f"{sessions} {_stat()}",
        "session_filtered_actions": f"{sessions} SELECT * FROM det",
        "session_filtered_actions_bloom": f"""{sessions} SELECT * FROM act
            WHERE session_id IN (SELECT session_id FROM agg WHERE {all_filters})""",
        "session_aggr_stat_observed": f"{sessions} {_stat()}",
        "session_days_added": f"{long_sessions} SELECT {record} FROM agg",
        "session_days_filter": f"""{sessions} SELECT session_id, user_id, start_time,
            visit_length, step_length FROM agg WHERE {all_filters}""",
        "session_hour_count": f"{sample} SELECT date, hour, session_count FROM hours",
        "session_extract_quota": f"""{sample}
            SELECT date, hour, session_count, day_count, quota FROM quotas""",
        "session_extract_quota_large": f"""{large}
            SELECT date, hour, session_count, day_count, quota FROM quotas""",
        "session_random_extract": f"{sample} {_EXTRACT}",
        "session_random_extract_large": f"{large} {_EXTRACT}",
        "session_random_extract_detail": f"""{sample} SELECT {_DETAIL} FROM det
            WHERE session_id IN (SELECT session_id FROM sample)""",
        "session_random_extract_large_detail": f"""{large} SELECT {_DETAIL} FROM det
            WHERE session_id IN (SELECT session_id FROM sample)""",
        "category_click_count": f"""{category} SELECT category_id, click_count FROM cat
            WHERE click_count > 0""",
        "category_order_count": f"""{category} SELECT category_id, order_count FROM cat
            WHERE order_count > 0""",
        "category_pay_count": f"""{category} SELECT category_id, pay_count FROM cat
            WHERE pay_count > 0""",
        "active_categories": f"{category} SELECT DISTINCT category_id FROM ids",
        "category_counts_joined": f"{category} SELECT * FROM cat",
        "category_counts": f"{category} SELECT * FROM cat",
        "category_counts_in_buckets": f"{category} SELECT * FROM cat",
        "category_session_click_count": f"{category} SELECT * FROM catses",
        "top10_category": f"""{category} SELECT category_id AS categoryid,
            click_count AS clickCount, order_count AS orderCount, pay_count AS payCount
            FROM top10""",
        "top10_session": f"""{category} SELECT category_id AS categoryid,
            session_id AS sessionid, click_count AS clickCount FROM topses""",
        "top10_session_detail": f"""{category} SELECT {_DETAIL}
            FROM det JOIN (SELECT session_id FROM topses) USING (session_id)""",
        "page_split_pairs": f"""{pages} SELECT session_id, action_time, page_split,
            count(*) AS pairs FROM pairs GROUP BY ALL""",
        "page_split_pv": f"{pages} SELECT page_split, pv FROM pv",
        "start_page_pv": f"{pages} SELECT pv FROM start_pv",
        "page_convert_rate": f"""{pages}
            SELECT step, page_split, pv, convert_rate FROM rates""",
        "page_rates_crowded_hour": f"""{crowded}
            SELECT step, page_split, pv, convert_rate FROM rates""",
        "page_pairs_crowded_hour": f"""{crowded} SELECT session_id, action_time, page_split,
            count(*) AS pairs FROM pairs GROUP BY ALL""",
        "page_convert_rate_string": f"""{pages} SELECT string_agg(page_split || '=' ||
            coalesce(cast(convert_rate AS varchar), ''), '|' ORDER BY step) AS convertRate
            FROM rates""",
        "click_product_basic": f"{areas} SELECT * FROM basic",
        "area_product_click_count": f"{areas} SELECT * FROM counts",
        "area_full_product_click_count": f"{areas} SELECT * FROM full_counts",
        "area_top3_product": f"{areas} {top3}",
        "product_job_rerun": f"""{areas} SELECT taskid, t.*
            FROM ({top3}) t, (VALUES ('first'), ('second')) tasks(taskid)""",
        "ad_click_parse": f"{views} SELECT * FROM ad",
        "product_views": f"""{areas} SELECT area,
            concat(product_id, ':', product_name) AS product, click_count, product_status
            FROM full_counts""",
        "replaced_actions": f"{views} SELECT * FROM uva WHERE {scanned}",
        "published_actions": f"{views} SELECT * FROM uva WHERE {scanned}",
        "replaced_days": f"""{views}
            SELECT * REPLACE (CASE WHEN {replaced_days} THEN 0 ELSE city_id END AS city_id)
            FROM uva WHERE {scanned} AND NOT ({replaced_days} AND page_id >= 5)""",
        "ad_click_blacklist_filter": f"{views} {filtered_ads}",
        "ad_click_restarted": f"{views} {filtered_ads}",
        "ad_click_changing_list": f"""{views} SELECT * EXCLUDE (event_id) FROM ad_events
            WHERE userid NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
            AND NOT (event_id % 2 = 1 AND userid IN
              (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0))""",
        "scalar_dates": f"""{views} SELECT session_id, page_id,
            action_time < {noon} AS is_before, action_time > {noon} AS is_after,
            cast(date_diff('second', {noon}, action_time) AS int) AS seconds,
            strftime(action_time, '%Y-%m-%d_%H') AS date_hour,
            strftime(action_time, '%Y-%m-%d') AS date_text,
            strftime(action_time, '%Y-%m-%d %H:%M:%S') AS time_text,
            action_time AS parsed_time,
            strftime(action_time, '%Y%m%d') AS date_key,
            cast(action_time AS date) AS parsed_date_key,
            strftime(action_time, '%Y%m%d%H%M') AS minute_text
            FROM uva""",
        "scalar_strings": f"""{views} SELECT session_id, page_id,
            search_keyword IS NULL OR search_keyword = '' AS keyword_is_empty,
            search_keyword IS NOT NULL AND search_keyword <> '' AS keyword_is_not_empty,
            order_category_ids AS trimmed,
            CASE WHEN length(cast(user_id AS varchar)) = 2 THEN cast(user_id AS varchar)
                 ELSE '0' || cast(user_id AS varchar) END AS padded,
            concat(city_id, ':', session_id) AS label
            FROM uva""",
        "scalar_math": f"""{views} SELECT session_id, page_id, {midnight_seconds} AS part,
            200 + page_id AS whole,
            {_half_up(midnight_seconds, "(200 + page_id)")} AS ratio
            FROM uva""",
        "kv_fields": f"""{views} SELECT string_split(value, chr(9))[1] AS id,
            nullif(regexp_extract(value, '\\|age=([^|]*)', 1), '') AS age,
            nullif(regexp_extract(value, '\\|city=([^|]*)', 1), '') AS city
            FROM kv""",
        "kv_set": f"""{views} SELECT string_split(value, chr(9))[1] AS id,
            regexp_replace(string_split(value, chr(9))[2], '\\|sex=[^|]*', '|sex=unknown')
              AS record
            FROM kv""",
        "text_scan": f"""{views} SELECT string_split(value, chr(9))[1] AS id,
            regexp_extract(value, '\\|age=([^|]+)', 1) AS age
            FROM kv WHERE regexp_matches(value, '\\|age=[^|]')""",
    }
