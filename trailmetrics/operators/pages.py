"""Page steps within sessions and the conversion rates of a target page flow.

A session may hold a large part of all actions, so none is sorted as a whole:

1. Pages are reduced to *page classes*: each page of the flow, and each gap
   between two of them. Pages off the flow only break a chain, and which of them
   it is does not matter beyond its place in the order. A flow of K pages has
   2K + 1 classes.
2. Equal (session, time, class) rows become one *visit*, combined on the map side.
3. Each session is cut into the hours of the clock. Steps inside an hour come from
   a window over (session, hour); steps from one hour to the next, and from one day
   to the next, come from the first and last visit of each hour and day, which are
   a row each.
4. Whole seconds bound an hour to 3600 * (2K + 1) visits. Times with fractions of a
   second do not: with `most_in_hour`, an hour of more views than that is cut
   further, into seconds and those into milliseconds, so that no window sees more
   than 1000 * (2K + 1) visits, 1000 milliseconds or 3600 seconds. Other hours stay
   whole and cost one more count of the views per hour.

Times are taken as they stand, without a time zone. Actions without a time come
before all others of their session, as an hour of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import pairwise
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.functions import numbers

_HOUR = ["session_id", "day", "hour"]
_IN_ORDER = ["action_time", "page_class"]
# The windows, from the inside out: what each is over, and what its rows are in order of.
_LEVELS = [(_HOUR, _IN_ORDER), (["session_id", "day"], ["hour"]), (["session_id"], ["day"])]
_CUT_LEVELS = [
    ([*_HOUR, "second", "milli"], _IN_ORDER),
    ([*_HOUR, "second"], ["milli"]),
    (_HOUR, ["second"]),
    *_LEVELS[1:],
]


def flow_steps(flow: Sequence[int]) -> list[tuple[int, int]]:
    return list(pairwise(flow))


def step_label(step: tuple[int, int]) -> str:
    return f"{step[0]}_{step[1]}"


def _flow_pages(flow: Sequence[int]) -> list[int]:
    return sorted(set(flow))


def _class_of(flow: Sequence[int], page: int) -> int:
    return 2 * _flow_pages(flow).index(page) + 1


def _page_class(flow: Sequence[int]) -> Column:
    """1, 3, 5, ... for the flow's pages in id order; even numbers for the gaps."""
    page = F.col("page_id")
    at_or_after = [
        F.when(page == own, 2 * i + 1).when(page > own, 2 * i + 2)
        for i, own in enumerate(_flow_pages(flow))
    ]
    return F.coalesce(*reversed(at_or_after), F.lit(0))


def visits(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Views per session, time and page class, with the hour that they fall into."""
    time = F.col("action_time")
    return (
        actions.select(
            "session_id",
            time.cast("date").alias("day"),
            F.hour(time).alias("hour"),
            "action_time",
            _page_class(flow).alias("page_class"),
        )
        .groupBy(*_HOUR, "action_time", "page_class")
        .agg(F.count("*").alias("views"))
    )


def _with_cuts(seen: DataFrame, actions: DataFrame, most_in_hour: int) -> DataFrame:
    """Add the second and the millisecond of visits in crowded hours, null for all others."""
    time = F.col("action_time")
    crowded = (
        actions.groupBy(
            F.col("session_id").alias("of_session"),
            time.cast("date").alias("of_day"),
            F.hour(time).alias("of_hour"),
        )
        .agg(F.count("*").alias("views_in_hour"))
        .where(F.col("views_in_hour") > most_in_hour)
    )
    same = reduce(
        and_, [F.col(key).eqNullSafe(F.col(f"of_{key.removesuffix('_id')}")) for key in _HOUR]
    )
    is_crowded = F.col("views_in_hour").isNotNull()
    millis = F.expr("cast(extract(SECOND FROM action_time) * 1000 AS int)")
    return seen.join(crowded, same, "left").select(
        *seen.columns,
        F.when(is_crowded, F.minute(time) * 60 + F.second(time)).alias("second"),
        F.when(is_crowded, millis % 1000).alias("milli"),
    )


def _seen_and_levels(
    actions: DataFrame, flow: Sequence[int], most_in_hour: int | None
) -> tuple[DataFrame, list[tuple[list[str], list[str]]]]:
    seen = visits(actions, flow)
    if most_in_hour is None:
        return seen, _LEVELS
    return _with_cuts(seen, actions, most_in_hour), _CUT_LEVELS


def _label(steps: Sequence[tuple[int, int]], is_step: Callable[[int, int], Column]) -> Column:
    """The label of the step that a row is, or null."""
    label = F.when(F.lit(False), "")
    for a, b in dict.fromkeys(steps):
        label = label.when(is_step(a, b), step_label((a, b)))
    return label


def _neighbours(df: DataFrame, keys: list[str], order: list[str], opens: str) -> DataFrame:
    """Add the class that comes next, and whether a row is the first of its group."""
    in_order = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns(
        {"following": F.lead(opens).over(in_order), "before": F.lag(opens).over(in_order)}
    )


def _ends(df: DataFrame, keys: list[str], opens: str, closes: str, *more: Column) -> DataFrame:
    """The first and the last class of each group, and other measures."""
    return df.groupBy(*keys).agg(
        F.max(F.when(F.col("before").isNull(), F.col(opens))).alias("first_class"),
        F.max(F.when(F.col("following").isNull(), F.col(closes))).alias("last_class"),
        *more,
    )


def _moves(seen: DataFrame, levels: list[tuple[list[str], list[str]]]) -> DataFrame:
    """Each visit that has a following one in its session, with that one's class."""
    last_time = F.max("action_time").alias("action_time")
    part, opens, closes = seen, "page_class", "page_class"
    moves = []
    for level, (keys, order) in enumerate(levels):
        part = _neighbours(part, keys, order, opens)
        moves.append(
            part.select(
                "session_id", "action_time", F.col(closes).alias("page_class"), "following"
            )
        )
        if level < len(levels) - 1:
            part = _ends(part, keys, opens, closes, last_time)
            opens, closes = "first_class", "last_class"
    return reduce(DataFrame.unionAll, moves).where(F.col("following").isNotNull())


def _repeats(seen: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Steps from a page to itself at the same time, where the flow has such steps."""
    classes = sorted({_class_of(flow, a) for a, b in flow_steps(flow) if a == b})
    return seen.where(F.col("page_class").isin(classes) & (F.col("views") > 1)).select(
        "session_id",
        "action_time",
        "page_class",
        F.col("page_class").alias("following"),
        (F.col("views") - 1).alias("pairs"),
    )


def page_split_pairs(
    actions: DataFrame, flow: Sequence[int], most_in_hour: int | None = None
) -> DataFrame:
    """Consecutive page views of a session that are a step of the target flow.

    ``pairs`` says for how many such views a row stands. Views at the same time
    count in the order of their page id.
    """
    seen, levels = _seen_and_levels(actions, flow, most_in_hour)
    steps = flow_steps(flow)
    moves = _moves(seen, levels).withColumn("pairs", F.lit(1).cast("bigint"))
    if any(a == b for a, b in steps):
        moves = moves.unionAll(_repeats(seen, flow))
    label = _label(
        steps,
        lambda a, b: (F.col("page_class") == _class_of(flow, a))
        & (F.col("following") == _class_of(flow, b)),
    )
    return moves.select(
        "session_id", "action_time", label.alias("page_split"), "pairs"
    ).where(F.col("page_split").isNotNull())


def page_split_pv(pairs: DataFrame) -> DataFrame:
    """How often each step was taken."""
    return pairs.groupBy("page_split").agg(F.sum("pairs").alias("pv"))


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Views of the flow's first page: one row."""
    return actions.where(F.col("page_id") == flow[0]).agg(F.count("*").alias("pv"))


def _distinct_steps(flow: Sequence[int]) -> list[tuple[int, int]]:
    return list(dict.fromkeys(flow_steps(flow)))


def flow_views(
    actions: DataFrame, flow: Sequence[int], most_in_hour: int | None = None
) -> DataFrame:
    """One row: views of the start page and of each step of the flow.

    What `page_split_pv` and `start_page_pv` count, from one scan: each hour, then
    each day, then each session is a row of counts with its first and last class.
    """
    steps = _distinct_steps(flow)
    names = ["pv_start", *[f"pv_{step_label(step)}" for step in steps]]

    def is_step(closes: str, step: tuple[int, int]) -> Column:
        a, b = (_class_of(flow, page) for page in step)
        return (F.col(closes) == a) & (F.col("following") == b)

    def on(page: int) -> Column:
        return F.col("page_class") == _class_of(flow, page)

    inside = [F.sum(F.when(on(flow[0]), F.col("views")).otherwise(0)).alias(names[0])]
    for name, step in zip(names[1:], steps):
        count = F.count_if(is_step("page_class", step))
        if step[0] == step[1]:
            # Views of one page at the same time are one visit.
            count += F.sum(F.when(on(step[0]), F.col("views") - 1).otherwise(0))
        inside.append(count.alias(name))
    between = [
        F.sum(names[0]).alias(names[0]),
        *[
            (F.sum(name) + F.count_if(is_step("last_class", step))).alias(name)
            for name, step in zip(names[1:], steps)
        ],
    ]
    part, levels = _seen_and_levels(actions, flow, most_in_hour)
    keys, order = levels[0]
    part = _neighbours(part, keys, order, "page_class")
    part = _ends(part, keys, "page_class", "page_class", *inside)
    for keys, order in levels[1:-1]:
        part = _neighbours(part, keys, order, "first_class")
        part = _ends(part, keys, "first_class", "last_class", *between)
    return _neighbours(part, *levels[-1], "first_class").agg(*between).na.fill(0)


def _row_of(split_pv: DataFrame, start_pv: DataFrame, flow: Sequence[int]) -> DataFrame:
    """The same row from the counts of each step and of the start page."""
    counts = split_pv.select("page_split", "pv").unionAll(
        start_pv.select(F.lit("start").alias("page_split"), "pv")
    )
    labels = ["start", *[step_label(step) for step in _distinct_steps(flow)]]
    return counts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("page_split") == label, F.col("pv"))), F.lit(0)).alias(
                f"pv_{label}"
            )
            for label in labels
        ]
    )


def _rates(row: DataFrame, flow: Sequence[int]) -> DataFrame:
    """One row with an array of the flow's steps and their rates.

    The rates are plain arithmetic between the columns of a single row.
    """
    labels = [step_label(step) for step in flow_steps(flow)]
    steps = [
        F.struct(
            F.lit(position).alias("step"),
            F.lit(label).alias("page_split"),
            F.col(f"pv_{label}").alias("pv"),
            numbers.ratio(F.col(f"pv_{label}"), F.col(f"pv_{previous}")).alias("convert_rate"),
        )
        for position, (previous, label) in enumerate(pairwise(["start", *labels]), start=1)
    ]
    schema = "array<struct<step:int,page_split:string,pv:bigint,convert_rate:double>>"
    return row.select(F.array(*steps).cast(schema).alias("steps"))


def flow_rates(row: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Rate of each step: its views over the previous step's, or the start page's.

    A step that was never taken has rate 0; after it the rate is null.
    """
    return _rates(row, flow).select(F.inline("steps"))


def page_convert_rate(
    split_pv: DataFrame, start_pv: DataFrame, flow: Sequence[int]
) -> DataFrame:
    """`flow_rates` of counts that are there already."""
    return flow_rates(_row_of(split_pv, start_pv, flow), flow)


def flow_rates_string(row: DataFrame, flow: Sequence[int]) -> DataFrame:
    """The rates as one text, ``1_2=0.1|2_3=0.25``; a null rate is left empty."""
    pieces = F.transform(
        F.col("steps"),
        lambda s: F.concat(
            s["page_split"],
            F.lit("="),
            F.coalesce(s["convert_rate"].cast("string"), F.lit("")),
        ),
    )
    return _rates(row, flow).select(F.array_join(pieces, "|").alias("convertRate"))


def page_convert_rate_string(
    split_pv: DataFrame, start_pv: DataFrame, flow: Sequence[int]
) -> DataFrame:
    """`flow_rates_string` of counts that are there already."""
    return flow_rates_string(_row_of(split_pv, start_pv, flow), flow)
