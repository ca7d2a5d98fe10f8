"""Command line, for spark-submit or ``python -m shopstrata``.

    silver  --table orders --partition_date 2024-01-30 --run_timestamp 2024-01-31T02:00:00
    gold    --silver_database silver --gold_database gold --as_of 2024-01-31
    create  --bronze_database bronze --silver_database silver [--root PATH]
    settings --tables db.a,db.b --property key=value
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from shopstrata.operators.lineage import Run, process_day
from shopstrata.plans.runner import run_gold, run_partition
from shopstrata.plans.silver import CLEAN_TABLES
from shopstrata.session import build_session
from shopstrata.sources.tables import create_tables, set_properties


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shopstrata")
    commands = parser.add_subparsers(dest="command", required=True)

    silver = commands.add_parser("silver", help="one day of a feed into its clean table")
    silver.add_argument("--table", required=True, choices=sorted(CLEAN_TABLES))
    silver.add_argument("--partition_date", type=date.fromisoformat, help="default: the day before")
    silver.add_argument("--run_timestamp", type=datetime.fromisoformat, required=True)
    silver.add_argument("--catalog", help="catalog name, if not the session's own")
    silver.add_argument("--bronze_database", default="bronze")
    silver.add_argument("--silver_database", default="silver")
    silver.add_argument("--bronze_table")
    silver.add_argument("--silver_table")
    silver.add_argument("--newer_by", help="column of a keyed table by which older rows do not replace newer ones")

    gold = commands.add_parser("gold", help="rebuild the star schema")
    gold.add_argument("--silver_database", default="silver")
    gold.add_argument("--gold_database", default="gold")
    gold.add_argument("--as_of", type=date.fromisoformat, required=True)

    create = commands.add_parser("create", help="create feed and clean tables")
    create.add_argument("--bronze_database", default="bronze")
    create.add_argument("--silver_database", default="silver")
    create.add_argument("--provider", default="parquet")
    create.add_argument("--root")

    settings = commands.add_parser("settings", help="set a property on several tables")
    settings.add_argument("--tables", required=True)
    settings.add_argument("--property", required=True, action="append")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"shopstrata-{args.command}")
    if args.command == "silver":
        prefix = f"{args.catalog}." if args.catalog else ""
        outcome = run_partition(
            spark,
            args.table,
            args.partition_date or process_day(args.run_timestamp),
            Run.for_schedule(args.run_timestamp),
            prefix + args.bronze_database,
            prefix + args.silver_database,
            args.bronze_table,
            args.silver_table,
            args.newer_by,
        )
        print(outcome)
    elif args.command == "gold":
        run_gold(spark, args.silver_database, args.gold_database, args.as_of)
    elif args.command == "create":
        for table in create_tables(
            spark, args.bronze_database, args.silver_database, args.provider, args.root
        ):
            print(table)
    else:
        pairs = dict(p.split("=", 1) for p in args.property)
        print(*set_properties(spark, args.tables, pairs), sep="\n")


if __name__ == "__main__":
    main()
