"""Command line of the session job: ``python -m visitlens <task_id> [options]`` (or this file
through ``spark-submit``).

Reads the task's parameters from the task table (any Spark source), runs the job over the action
and user tables and appends the five results to the sink. Example::

    spark-submit --py-files visitlens.zip visitlens/__main__.py 7 --tasks-format jdbc --tasks-option url=jdbc:mysql://db/app \\
        --tasks-option dbtable=task --actions-table user_visit_action --users-table user_info \\
        --sink-format parquet --sink-path hdfs:///results --materialize checkpoint
"""

from __future__ import annotations

import argparse
import json
import sys

from visitlens.params import task_id_from_args
from visitlens.plans.job import SessionJob, SessionPlans, run
from visitlens.schemas import USER_INFO, USER_VISIT_ACTION
from visitlens.session import build_session, scale_conf
from visitlens.sinks import ResultSink
from visitlens.sinks.committed import CommittedSink
from visitlens.sources.actions import catalog_actions, catalog_users
from visitlens.sources.task import load_task_params, read_tasks


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        out[key] = value
    return out


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="visitlens", description="session analysis job")
    p.add_argument("task_id", nargs="?", help="task id (missing or not a number: -1)")
    p.add_argument("--tasks-format", default="jdbc")
    p.add_argument("--tasks-path")
    p.add_argument("--tasks-option", action="append", default=[])
    p.add_argument("--actions-table", default="user_visit_action", help="catalog table or path")
    p.add_argument("--users-table", default="user_info", help="catalog table or path")
    p.add_argument("--input-format", default=None, help="read --actions-table/--users-table as paths of this format")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--sink-path")
    p.add_argument("--sink-mode", default="append")
    p.add_argument("--sink-option", action="append", default=[])
    p.add_argument("--idempotent", action="store_true", help="file sinks: replace this task's partitions on re-run")
    p.add_argument("--committed", action="store_true", help="file sinks: the five tables become visible together, by one commit file")
    p.add_argument("--bucketed", action="store_true", help="--actions-table is a table in buckets by session, with its table of hot sessions")
    p.add_argument("--sample-total", type=int, default=100)
    p.add_argument("--seed", default="42")
    p.add_argument("--materialize", default="persist", choices=["persist", "checkpoint", "none"])
    p.add_argument("--hive", action="store_true")
    p.add_argument("--input-bytes", type=int, help="size of the action data: sizes scan splits and shuffle partitions")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    if args.bucketed and args.input_format:
        raise ValueError("a table in buckets is read from the catalog, not from a path")
    if args.committed and args.idempotent:
        raise ValueError("a committed run replaces the task's earlier one; --idempotent is for the other sink")
    task_id = task_id_from_args([args.task_id] if args.task_id else [])
    spark = spark or build_session(hive=args.hive, conf=scale_conf(args.input_bytes) if args.input_bytes else None)
    tasks = read_tasks(spark, args.tasks_format, args.tasks_path, **_options(args.tasks_option))
    params = load_task_params(tasks, task_id)

    if args.input_format:
        actions = spark.read.format(args.input_format).schema(USER_VISIT_ACTION).load(args.actions_table)
        users = spark.read.format(args.input_format).schema(USER_INFO).load(args.users_table)
    else:
        actions = None if args.bucketed else catalog_actions(spark, args.actions_table)
        users = catalog_users(spark, args.users_table)

    options = _options(args.sink_option)
    if args.committed:  # checked before any work is done
        sink = CommittedSink(fmt=args.sink_format, base=args.sink_path, options=options)
    else:
        sink = ResultSink(fmt=args.sink_format, base=args.sink_path, mode=args.sink_mode, options=options, idempotent=args.idempotent)
    job = SessionJob(params, task_id=task_id, sample_total=args.sample_total, seed=args.seed)
    if args.bucketed:
        plans = SessionPlans.from_bucketed(spark, args.actions_table, users, job, materialize_mode=args.materialize)
    else:
        plans = SessionPlans(job, actions, users, materialize_mode=args.materialize)
    run(plans, sink)
    return {"task_id": task_id, "params": json.loads(params.to_json())}


if __name__ == "__main__":
    print(json.dumps(main()))
