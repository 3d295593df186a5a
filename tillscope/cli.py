"""Command line: ``python -m tillscope -t SALES -m MERCHANTS COMMAND``.

Commands are ``task1`` to ``task5``, ``run-all``, ``load-raw-data`` and ``check`` (input checks
only); ``--task N`` and ``--task all`` do the same without a command. Paths may be on any file system Spark reads.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tillscope.job import REPORTS, TASKS, SparkJob
from tillscope.sinks.catalog import DATABASE


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillscope", description="Merchant sales analytics")
    parser.add_argument("-t", "--transactions", required=True, help="Parquet with the sales")
    parser.add_argument("-m", "--merchants", required=True, help="CSV with the merchants")
    hive = parser.add_mutually_exclusive_group()
    hive.add_argument(
        "--use-hive", action="store_true", default=True, help="also write catalog tables (default)"
    )
    hive.add_argument("--no-hive", dest="use_hive", action="store_false", help="files only")
    parser.add_argument("--database", default=DATABASE, help="catalog database (%(default)s)")
    parser.add_argument(
        "--in-cents", action="store_true", help="amounts have at most two decimals: add them exactly"
    )
    parser.add_argument("--task", choices=[*TASKS, "all"], help="task to run, instead of a command")
    parser.add_argument("-o", "--output", help=f"folder of the results ({REPORTS})")
    parser.add_argument(
        "--totals", metavar="DIR", help="keep totals in this shared folder and read only sales files that are new"
    )
    parser.add_argument("--from-month", type=_month, metavar="YYYY-MM", help="first month of the results")
    parser.add_argument("--to-month", type=_month, metavar="YYYY-MM", help="last month of the results")
    parser.add_argument("--one-file", action="store_true", help="write each result as one CSV file, however large")
    parser.add_argument("--work-dir", help="folder all executors share (spark.checkpoint.dir)")
    parser.add_argument("--spark-master", help="such as local[4] or spark://host:port")
    parser.add_argument("--spark-executor-memory", help="such as 8g (default: the cluster's)")
    parser.add_argument("--spark-executor-cores", help="default: the cluster's")

    commands = parser.add_subparsers(dest="command")
    for number in ("1", "2", "3"):
        command = commands.add_parser(f"task{number}")
        command.add_argument("--output", "-o", dest="path", default=_default(number, 0))
    command = commands.add_parser("task4")
    command.add_argument("--output-merchants", "-om", default=_default("4", 0))
    command.add_argument("--output-categories", "-oc", default=_default("4", 1))
    command = commands.add_parser("task5")
    command.add_argument(
        "--output-dir", "-o", dest="path", default=_default("5", 0).rsplit("/", 1)[0]
    )
    commands.add_parser("run-all")
    command = commands.add_parser("load-raw-data")
    command.add_argument("--buckets", type=int, help="lay the raw tables out in so many buckets by merchant")
    command.add_argument(
        "--replace-months", action="store_true", help="replace only the months that the input has"
    )
    commands.add_parser("check")
    return parser


def _month(text: str) -> tuple[int, int]:
    year, month = (int(part) for part in text.split("-"))
    if not 1 <= month <= 12:
        raise ValueError(text)
    return year, month


def months(args: argparse.Namespace) -> tuple[tuple[int, int], tuple[int, int]] | None:
    """First and last month asked for; an open end takes all months on its side."""
    if not (args.from_month or args.to_month):
        return None
    return args.from_month or (0, 1), args.to_month or (9999, 12)


def _default(task: str, index: int) -> str:
    return f"{REPORTS}/{TASKS[task][index].file}"


def spark_settings(args: argparse.Namespace) -> dict[str, str]:
    given = {
        "spark.checkpoint.dir": args.work_dir,
        "spark.master": args.spark_master,
        "spark.executor.memory": args.spark_executor_memory,
        "spark.executor.cores": args.spark_executor_cores,
    }
    return {key: value for key, value in given.items() if value}


def execute(job: SparkJob, args: argparse.Namespace) -> None:
    if args.command is None:
        job.run_task(args.task, args.output)
    elif args.command == "run-all":
        job.run_all_tasks(args.output)
    elif args.command == "load-raw-data":
        job.load_raw_data(buckets=args.buckets, replace_months=args.replace_months)
    elif args.command == "check":
        job.check()
    elif args.command == "task4":
        job.run_task4(args.output_merchants, args.output_categories)
    else:
        getattr(job, f"run_{args.command}")(args.path)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run and return the exit code; ``spark`` lends a session instead of making one."""
    parser = build_parser()
    args = parser.parse_args(argv)
    if (args.command is None) == (args.task is None):
        parser.error("give either a command or --task")
    job = SparkJob(
        args.transactions,
        args.merchants,
        args.use_hive,
        spark_settings(args),
        database=args.database,
        in_cents=args.in_cents,
        totals_dir=args.totals,
        months=months(args),
        one_file=args.one_file,
        spark=spark,
    )
    try:
        execute(job, args)
    except (AnalysisException, ValueError) as error:
        print(f"Error: {str(error).splitlines()[0]}", file=sys.stderr)
        return 1
    finally:
        job.stop()
    return 0
