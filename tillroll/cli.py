"""Command line for the layer jobs: ``python -m tillroll <command> ...``.

Commands run on whatever cluster ``spark-submit`` (or the default session
builder) provides; nothing here fixes a path, host or credential.

    split   --extract A.csv --extract B.csv --output DIR   flat extracts -> three CSV datasets
    bronze  --input DIR --output DIR                       CSV datasets -> Parquet (orders by day)
    silver  --bronze DIR [--database DB]                   validate, clean, quarantine -> tables
    gold    [--database DB] [--jdbc-url URL ...]           four marts -> tables or JDBC
    page    --mart NAME [--page N] [--page-size K] [--year Y] [--month M] [--database DB]
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _spark(app: str) -> SparkSession:
    return SparkSession.builder.appName(f"tillroll-{app}").getOrCreate()


def _silver_tables(database: str):
    from tillroll.plans.silver import SilverTables

    return SilverTables(
        products=f"{database}.products_partitioned",
        products_invalid=f"{database}.products_invalid",
        orders=f"{database}.orders_partitioned",
        orders_invalid=f"{database}.orders_invalid",
        lines=f"{database}.orders_line_partitioned",
        lines_invalid=f"{database}.orders_line_invalid",
    )


def cmd_split(args) -> None:
    from tillroll.plans.split import split_job

    split_job(_spark("split"), args.extract, args.output, multi_line=not args.single_line)


def cmd_bronze(args) -> None:
    from tillroll.plans.bronze import ingest, standard_specs

    ingest(_spark("bronze"), standard_specs(args.input, args.output, multi_line=not args.single_line), infer=args.infer)


def cmd_silver(args) -> None:
    from tillroll.plans.silver import layers_from_bronze, write_silver

    b = args.bronze.rstrip("/")
    layers = layers_from_bronze(
        _spark("silver"), f"{b}/products_partitioned", f"{b}/orders_partitioned", f"{b}/orders_line"
    )
    write_silver(layers, _silver_tables(args.database))


def cmd_gold(args) -> None:
    from tillroll.plans import gold

    spark = _spark("gold")
    built = gold.build_marts(
        *gold.layers_from_silver(spark, _silver_tables(args.database)),
        strategy=args.strategy,
    )
    if args.jdbc_url:
        props = {"user": args.jdbc_user or "", "password": os.environ.get(args.jdbc_password_env or "", "")}
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        writer = gold.jdbc_writer(args.jdbc_url, props, truncate=args.jdbc_truncate)
    else:
        writer = gold.table_writer(args.database)
    gold.write_gold(built, writer)


def cmd_page(args) -> None:
    from tillroll.operators.serving import page_response

    spark = _spark("page")
    mart = spark.table(f"{args.database}.{args.mart}")
    out = page_response(mart, args.mart, args.page, args.page_size, args.year, args.month)
    json.dump(out, sys.stdout, default=str)
    sys.stdout.write("\n")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tillroll")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("split")
    s.add_argument("--extract", action="append", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--single-line", action="store_true", help="no line breaks inside quoted text: large files are split over tasks")
    s.set_defaults(fn=cmd_split)

    s = sub.add_parser("bronze")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--infer", action="store_true", help="infer column types instead of the declared schemas")
    s.add_argument("--single-line", action="store_true", help="no line breaks inside quoted text: large files are split over tasks")
    s.set_defaults(fn=cmd_bronze)

    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--database", default="default")
    s.set_defaults(fn=cmd_silver)

    s = sub.add_parser("gold")
    s.add_argument("--database", default="default")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-user")
    s.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    s.add_argument("--jdbc-driver")
    s.add_argument("--jdbc-truncate", action="store_true", help="empty existing mart tables instead of recreating them")
    s.add_argument("--strategy", default="one_pass", choices=["one_pass", "reuse_sales", "recompute"])
    s.set_defaults(fn=cmd_gold)

    s = sub.add_parser("page")
    s.add_argument("--mart", required=True, choices=["sales_per_country", "top_products", "return_products", "sales_by_period"])
    s.add_argument("--page", type=int, default=1)
    s.add_argument("--page-size", type=int, default=10)
    s.add_argument("--year", type=int)
    s.add_argument("--month", type=int)
    s.add_argument("--database", default="default")
    s.set_defaults(fn=cmd_page)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
