"""Run a job with spark-submit.

    spark-submit submit.py session --params '{"startDate": "2024-01-05", "endDate": "2024-01-24"}' \\
        --sink jdbc --option url=jdbc:mysql://host/db --option user=u --option password=p

    spark-submit submit.py days --params '{"startDate": "2024-01-25", "endDate": "2024-01-25"}' \\
        --session-days session_days

    spark-submit submit.py ads --brokers host:9092 --topics ad_log \\
        --blacklist ad_blacklist --output /shared/ads --checkpoint /shared/ads-checkpoint

Tables are catalog names, or parquet paths if they hold a ``/``. ``days`` stores the
daily parts of sessions, which ``session`` then reads with ``--session-days``. With
``--replace`` a job that is run again under its task id replaces what it wrote, with
``--rejects`` malformed actions go to a table instead of stopping the job.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.operators import session_days
from trailmetrics.params import TaskParams
from trailmetrics.plans import page_job, product_job, session_job
from trailmetrics.runtime import scratch
from trailmetrics.sinks import Sink, result_sink
from trailmetrics.sources import kafka, tables
from trailmetrics.streaming import ad_clicks


def arguments(values=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("session", "page", "product"):
        job = jobs.add_parser(name)
        job.add_argument("--params", type=json.loads, required=True, help="JSON object")
        job.add_argument("--actions", default="user_visit_action")
        job.add_argument("--users", default="user_info")
        job.add_argument("--products", default="product_info")
        job.add_argument("--task-id", default=None, help="default: a new UUID")
        job.add_argument("--seed", type=int, default=0)
        job.add_argument("--sink", default="jdbc", help="jdbc, table, or a file format")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
        job.add_argument("--rejects", default=None, help="result table of malformed actions")
        job.add_argument("--replace", action="store_true", help="the task's earlier rows")
        job.add_argument("--most-in-hour", type=int, default=None, help="views, before cutting")
        job.add_argument("--session-days", default=None, help="table of daily parts")
    days = jobs.add_parser("days")
    days.add_argument("--params", type=json.loads, required=True, help="JSON object")
    days.add_argument("--actions", default="user_visit_action")
    days.add_argument("--session-days", default="session_days", help="table of daily parts")
    ads = jobs.add_parser("ads")
    ads.add_argument("--brokers", required=True)
    ads.add_argument("--topics", required=True)
    ads.add_argument("--blacklist", required=True)
    ads.add_argument("--output", required=True)
    ads.add_argument("--checkpoint", required=True)
    ads.add_argument("--partitions", type=int, default=None, help="tasks per batch")
    return parser.parse_args(values)


def run_batch(spark: SparkSession, args: argparse.Namespace) -> str:
    params = TaskParams.from_dict(args.params)
    task_id = args.task_id or str(uuid.uuid4())
    options = dict(option.split("=", 1) for option in args.option)
    sink = result_sink(options, args.sink, task_id if args.replace else None)
    days = params.start_date, params.end_date
    if args.rejects:
        with scratch(spark, "checked") as kept:
            stored = tables.read_table(spark, args.actions)
            actions, rejects = tables.checked_scan(stored, *days, kept)
            sink(rejects.select(F.lit(task_id).alias("taskid"), "raw", "reason"), args.rejects)
            run_job(spark, args, params, actions, task_id, sink)
    else:
        actions = tables.read_actions(spark, args.actions, *days)
        run_job(spark, args, params, actions, task_id, sink)
    return task_id


def run_job(
    spark: SparkSession,
    args: argparse.Namespace,
    params: TaskParams,
    actions: DataFrame,
    task_id: str,
    sink: Sink,
) -> None:
    if args.job == "session":
        users = tables.read_users(spark, args.users)
        parts = args.session_days and session_days.stored_parts(
            spark, args.session_days, params.start_date, params.end_date
        )
        session_job.run_session_job(actions, users, params, task_id, sink, args.seed, parts)
    elif args.job == "page":
        page_job.run_page_job(actions, params, task_id, sink, args.most_in_hour)
    else:
        products = tables.read_products(spark, args.products)
        product_job.run_product_job(
            actions, tables.city_info(spark), products, params, task_id, sink
        )


def run_days(spark: SparkSession, args: argparse.Namespace) -> None:
    params = TaskParams.from_dict(args.params)
    actions = tables.read_actions(spark, args.actions, params.start_date, params.end_date)
    session_days.store_days(actions, args.session_days)


def run_ads(spark: SparkSession, args: argparse.Namespace) -> None:
    ad_clicks.write_filtered_stream(
        kafka.read_kafka(spark, args.brokers, args.topics),
        lambda: ad_clicks.fresh_table(spark, args.blacklist),
        args.output,
        args.checkpoint,
        args.partitions,
    ).awaitTermination()


if __name__ == "__main__":
    parsed = arguments()
    # Sort nothing for a join whose smaller side fits a hash table in each task.
    session = (
        SparkSession.builder.appName(f"trailmetrics-{parsed.job}")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128MB")
        .getOrCreate()
    )
    {"ads": run_ads, "days": run_days}.get(parsed.job, run_batch)(session, parsed)
    session.stop()
