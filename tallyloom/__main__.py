"""The whole jobs on the command line: ``spark-submit tallyloom/__main__.py refresh ...``.

Passwords and keys come from the environment, never from an argument.
"""

from __future__ import annotations

import argparse
import os
import sys
from functools import reduce

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.operators import null_rules, require, row_count_rules, scalar_rule  # noqa: E402
from tallyloom.plans import load, local_extract, refresh  # noqa: E402
from tallyloom.session import get_session, object_store_conf  # noqa: E402
from tallyloom.sources import JdbcDatabase  # noqa: E402


def _add_rules(job: argparse.ArgumentParser) -> None:
    job.add_argument(
        "--rule",
        nargs=2,
        action="append",
        default=[],
        metavar=("SQL", "COUNT"),
        help="SQL over {table} whose first cell must be this whole number",
    )


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyloom")
    parser.add_argument("--endpoint", help="object store endpoint for s3a:// paths")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("refresh", help="land CSV files, tally medals, publish the result")
    job.add_argument("--incoming", required=True, nargs="+")
    job.add_argument("--raw", required=True)
    job.add_argument("--fact", required=True)
    job.add_argument("--dim", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--min-rows", type=int, default=0)
    _add_rules(job)
    job.add_argument("--jdbc-url")
    job.add_argument("--jdbc-driver")

    job = jobs.add_parser("extract", help="tally medals into a one-file CSV")
    job.add_argument("--fact", required=True)
    job.add_argument("--dim", required=True)
    job.add_argument("--result", required=True)

    job = jobs.add_parser("load", help="load delimited files into a table")
    job.add_argument("--table", required=True)
    job.add_argument("--paths", required=True, nargs="+")
    job.add_argument("--mode", default="append", choices=["append", "truncate", "keep_latest"])
    job.add_argument("--key", nargs="+", default=[])
    job.add_argument("--order", nargs="+", default=[])
    job.add_argument("--columns", nargs="+")
    job.add_argument("--ties", nargs="+", default=[], help="columns that decide between equals")
    job.add_argument("--options", nargs="+", default=[], help="read options, as name=value")
    job.add_argument("--min-rows", type=int, default=0)
    _add_rules(job)

    job = jobs.add_parser("check", help="check tables, stop when a rule fails")
    job.add_argument("--tables", required=True, nargs="+")
    job.add_argument("--min-rows", type=int, default=0)
    job.add_argument("--not-null", nargs="+", default=[], help="columns of every table")
    _add_rules(job)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    conf = object_store_conf(args.endpoint) if args.endpoint else {}
    spark = get_session(f"tallyloom {args.job}", conf)
    rules = [(sql, int(count)) for sql, count in getattr(args, "rule", [])]
    if args.job == "refresh":
        database = JdbcDatabase(args.jdbc_url, args.jdbc_driver) if args.jdbc_url else None
        refresh(
            spark,
            args.incoming,
            args.raw,
            args.fact,
            args.dim,
            args.table,
            min_rows=args.min_rows,
            rules=rules,
            database=database,
        ).show()
    elif args.job == "extract":
        local_extract(spark, args.fact, args.dim, args.result, single_file=True).show()
    elif args.job == "check":
        tables = {name: spark.table(name) for name in args.tables}
        require(row_count_rules(tables, args.min_rows))
        if args.not_null:
            nulls = [null_rules(df, name, args.not_null) for name, df in tables.items()]
            require(reduce(DataFrame.unionByName, nulls))
        for name in tables:
            for sql, expected in rules:
                require(scalar_rule(spark, name, sql.replace("{table}", name), expected))
    else:
        load(
            spark,
            args.table,
            args.paths,
            mode=args.mode,
            columns=args.columns,
            key=args.key,
            order=args.order,
            ties=args.ties,
            options=dict(option.split("=", 1) for option in args.options),
            min_rows=args.min_rows,
            rules=rules,
        )


if __name__ == "__main__":
    main()
