"""Loads the statement tables of stored pages into one table.

    spark-submit … pages.py --pages s3a://…/pages --out s3a://…/statements

Each page gives one row per period; rejected table rows and line items outside the list
go beside the output if asked for.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallyline.operators.extract import (
    BALANCE_SHEET,
    PROFIT_LOSS,
    extract_statement,
    load_statements,
    rejected_rows,
)
from tallyline.operators.reshape import unlisted_items
from tallyline.schema import MEASURES
from tallyline.sinks import load_table, write_csv
from tallyline.sources import read_pages


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--pages", required=True)
    parser.add_argument("--pages-format", choices=["parquet", "orc", "json", "text"], default="parquet")
    parser.add_argument("--section", choices=[PROFIT_LOSS, BALANCE_SHEET], default=PROFIT_LOSS)
    parser.add_argument("--items", nargs="+", default=MEASURES, help="column names to keep")
    parser.add_argument("--company", default="url", help="page column that names the company")
    parser.add_argument("--fill", type=float, help="value for missing cells")
    parser.add_argument("--tolerant", action="store_true", help="use the HTML parser")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="parquet folder")
    target.add_argument("--csv", help="CSV folder")
    target.add_argument("--table", help="catalog table")
    parser.add_argument("--rejected", help="parquet folder for rows of another width")
    parser.add_argument("--unlisted", help="parquet folder for cells of line items not in --items")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    pages = read_pages(spark, args.pages, args.pages_format)
    rows = load_statements(
        pages, args.company, args.section, args.items, args.fill, tolerant=args.tolerant
    ).withColumnRenamed(args.company, "company_name")
    if args.csv:
        write_csv(rows, args.csv)
    elif args.table:
        load_table(rows, args.table)
    else:
        rows.write.mode("overwrite").parquet(args.out)
    if args.rejected:
        rejected = rejected_rows(pages, args.section, [args.company], args.tolerant)
        rejected.write.mode("overwrite").parquet(args.rejected)
    if args.unlisted:
        cells = extract_statement(pages, args.section, [args.company], args.tolerant)
        unlisted_items(cells, args.items).write.mode("overwrite").parquet(args.unlisted)


def main(argv: Sequence[str] | None = None) -> None:
    run(SparkSession.builder.getOrCreate(), arguments(argv))


if __name__ == "__main__":
    main()
