"""The jobs, for ``spark-submit``: land, stream, load-addresses, load-table, check, build and retire.

    spark-submit --py-files vinlake.zip vinlake/jobs.py land --drop DIR --landing DIR --audit DIR [--date 20260301]
    spark-submit --py-files vinlake.zip vinlake/jobs.py build --raw DIR --warehouse DIR [--as-of 2026-03-01] [--marts marts]
"""

import argparse
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vinlake.operators import in_folder
from vinlake.plans.models import Models
from vinlake.plans.warehouse import Schemas, build, gate, stored_marts
from vinlake.schemas import RAW_TABLES
from vinlake.session import get_session, remove_folder, work_folder
from vinlake.sources.jdbc import read_table_by_number_key, read_table_by_text_key
from vinlake.sources.landing import land_addresses
from vinlake.sources.raw_load import load_latest_addresses, load_source_table
from vinlake.sources.tables import read_raw
from vinlake.sources.versions import IN_THE_MAKING, KEPT, retire
from vinlake.streaming.address_drop import stream_addresses, stream_once

# Key of each source table, and how to split a read by it.
SOURCE_KEYS = {
    "raw_customers": ("id", read_table_by_number_key),
    "raw_sales": ("vin", read_table_by_text_key),
    "raw_after_sales": ("service_ticket", read_table_by_text_key),
}


@contextmanager
def _models(spark: SparkSession, args: argparse.Namespace) -> Iterator[Models]:
    """The models over the raw tables, with a folder for intermediate tables that goes when the job ends."""
    raw = {name: partial(read_raw, spark, f"{args.raw}/{name}", name) for name in RAW_TABLES}
    as_of = F.lit(args.as_of).cast("date") if args.as_of else None
    folder = work_folder(spark, args.work)
    try:
        yield Models(spark, raw, as_of, in_folder(folder))
    finally:
        remove_folder(spark, folder)


def _land(spark: SparkSession, args: argparse.Namespace) -> None:
    land_addresses(spark, args.drop, args.landing, args.audit, args.date or "*")


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.once:
        stream_once(spark, args.drop, args.landing, args.audit, args.checkpoint)
    else:
        stream_addresses(spark, args.drop, args.landing, args.audit, args.checkpoint, once=False).awaitTermination()


def _load_addresses(spark: SparkSession, args: argparse.Namespace) -> None:
    print(load_latest_addresses(spark, args.drop, args.lake, f"{args.raw}/raw_customer_addresses", args.ingestion_date), "rows")


def _load_table(spark: SparkSession, args: argparse.Namespace) -> None:
    key, read = SOURCE_KEYS[args.table]
    rows = read(spark, args.url, args.source, key, args.parts)
    print(load_source_table(rows, f"{args.raw}/{args.table}", args.ingestion_date), "rows")


def _check(spark: SparkSession, args: argparse.Namespace) -> None:
    with _models(spark, args) as models:
        if args.layer == "marts":
            for name, rows in stored_marts(spark, Schemas(args.warehouse, args.default, args.marts)).items():
                models[name] = rows
        for row in gate(args.layer, models):
            print(row.check_name, row.failures)


def _build(spark: SparkSession, args: argparse.Namespace) -> None:
    with _models(spark, args) as models:
        for row in build(models, Schemas(args.warehouse, args.default, args.marts)):
            print(row.check_name, row.failures)


def _retire(spark: SparkSession, args: argparse.Namespace) -> None:
    folder = Schemas(args.warehouse, args.default, args.marts).marts_folder
    for run in retire(spark, folder, args.keep, args.age_hours * 3600):
        print(run)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vinlake")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required, **optional):
        one = jobs.add_parser(name)
        one.set_defaults(run=run)
        for option in required:
            one.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            one.add_argument(f"--{option.replace('_', '-')}", default=default)
        return one

    job("land", _land, "drop", "landing", "audit", date=None)
    job("stream", _stream, "drop", "landing", "audit", "checkpoint").add_argument("--once", action="store_true")
    job("load-addresses", _load_addresses, "drop", "lake", "raw", ingestion_date=None)
    table = job("load-table", _load_table, "url", "source", "raw", ingestion_date=None)
    table.add_argument("--table", required=True, choices=SOURCE_KEYS)
    table.add_argument("--parts", type=int, default=16)
    check = job("check", _check, "raw", "warehouse", as_of=None, work=None, default="warehouse", marts="marts")
    check.add_argument("--layer", required=True, choices=["staging", "intermediate", "marts"])
    old = job("retire", _retire, "warehouse", default="warehouse", marts="marts")
    old.add_argument("--keep", type=int, default=KEPT)
    old.add_argument("--age-hours", type=float, default=IN_THE_MAKING / 3600)
    job("build", _build, "raw", "warehouse", as_of=None, work=None, default="warehouse", marts="marts")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(get_session(), args)


if __name__ == "__main__":
    main()
