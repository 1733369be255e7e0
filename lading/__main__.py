"""Command line of the jobs, for ``spark-submit`` or ``python -m lading``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lading.operators import address
from lading.operators.address import Rules
from lading.operators.spread import HOT_ROWS, checked_hot_rows
from lading.plans import clean_job, export_job, merge_job, versions, writeback_job
from lading.plans.runlog import LEASE
from lading.session import build_session
from lading.sources import tables


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="lading", description=__doc__)
    main.add_argument("--format", default="parquet", help="format of the input tables, or 'table'")
    main.add_argument("--ignore-case", action="store_true", help="compare text without regard to case")
    jobs = main.add_subparsers(dest="job", required=True)

    export = argparse.ArgumentParser(add_help=False)
    export.add_argument("--root", required=True, help="folder the files go to")
    export.add_argument("--ledger", required=True, help="folder, or table:<name> for a catalog table")
    export.add_argument("--work", required=True, help="folder for manifests, receipts and quarantine")
    export.add_argument("--batch-size", type=int, help="number the files, and record them, in batches of this size")
    export.add_argument("--lease", type=float, default=LEASE, help="seconds without a sign of life that end a run")
    export.add_argument("--shared-mount", action="store_true", help="the folders are mounts that all machines share")

    job = jobs.add_parser("export-attachments", parents=[export])
    job.add_argument("--attachments", required=True)
    job.add_argument("--headers", required=True)

    job = jobs.add_parser("export-signatures", parents=[export])
    job.add_argument("--shipments", required=True)
    job.add_argument("--random-names", action="store_true")

    for name, given in (("attachments", "--attachments"), ("signatures", "--shipments")):
        job = jobs.add_parser(f"write-back-{name}")
        job.add_argument(given, dest="base", required=True)
        job.add_argument("--ledger", required=True, help="folder, or table:<name> for a catalog table")
        job.add_argument("--out", required=True, help="folder for the new version of the table")
        job.add_argument("--shared-mount", action="store_true")
        job.add_argument("--publish", metavar="NAME", help="table or view that shall stand for the new version")

    job = jobs.add_parser("roll-back")
    job.add_argument("name", help="table or view that shall stand for the version before again")

    job = jobs.add_parser("progress")
    job.add_argument("--work", required=True, help="work folder of the export")
    job.add_argument("--kind", choices=["attachments", "signatures"], required=True)

    for name in ("clean-addresses", "merge-customers"):
        job = jobs.add_parser(name)
        job.add_argument("--pickups", required=True)
        job.add_argument("--customers", required=True)
        job.add_argument("--out", required=True)
        job.add_argument("--repaired", action="store_true", help="use the repaired cleaning rules")
        if name == "clean-addresses":
            job.add_argument("--as-of", default=dt.date.today().isoformat())
            job.add_argument("--months", type=int, default=address.REPORT_MONTHS, help="age of reported pickups")
            fields = (address.BUILDING_LIMIT, address.STREET_LIMIT, address.CITY_LIMIT)
            job.add_argument("--limits", type=int, nargs=3, default=fields, metavar=("BUILDING", "STREET", "CITY"))
        default = None if name == "clean-addresses" else HOT_ROWS
        job.add_argument("--hot-rows", type=checked_hot_rows, default=default, help="rows from which a key is salted")
        if name == "merge-customers":
            job.add_argument("--salted", action="store_true", help="count and salt customers with that many mentions")
            job.add_argument(
                "--reference", action="append", nargs=3, default=[], metavar=("NAME", "TABLE", "COLUMNS"),
                help="a further table that refers to customers, with the columns that do, comma-separated",
            )
    return main


def run(spark: SparkSession, arguments: list[str] | None = None):
    args = parser().parse_args(arguments)

    def table(path: str, schema: T.StructType) -> DataFrame:
        return tables.read_table(spark, schema, path, args.format)

    if args.job in ("export-attachments", "export-signatures"):
        paths = export_job.Paths(args.root, args.ledger, args.work, args.shared_mount, args.lease)
        options = {"batch_size": args.batch_size, "case_sensitive": not args.ignore_case}
        if args.job == "export-attachments":
            attachments = table(args.attachments, tables.DETAINED_HAWB_ATCH)
            headers = table(args.headers, tables.DETAINED_HAWB)
            return export_job.export_attachments(spark, attachments, headers, paths, **options)
        shipments = table(args.shipments, tables.SHIPMENT_DELIVERY_COURIER)
        return export_job.export_signatures(spark, shipments, paths, args.random_names, **options)

    if args.job in ("write-back-attachments", "write-back-signatures"):
        attachments = args.job.endswith("attachments")
        schema = tables.DETAINED_HAWB_ATCH if attachments else tables.SHIPMENT_DELIVERY_COURIER
        columns = writeback_job.ATTACHMENTS if attachments else writeback_job.SIGNATURES
        return writeback_job.write_back_to(
            spark, table(args.base, schema), args.ledger, columns, args.out, args.shared_mount, args.publish
        )
    if args.job == "roll-back":
        return versions.roll_back(spark, args.name)
    if args.job == "progress":
        # One row per run.
        return export_job.progress(spark, f"{args.work}/{args.kind}").collect()

    pickups, customers = table(args.pickups, tables.PICKUP), table(args.customers, tables.CUSTOMER)
    rules = Rules(repaired=args.repaired, case_sensitive=not args.ignore_case)
    if args.job == "clean-addresses":
        return clean_job.clean_to(
            spark, pickups, customers, args.out, args.as_of, args.months, rules, args.hot_rows, tuple(args.limits)
        )
    read = spark.table if args.format == "table" else spark.read.format(args.format).load
    references = {name: (read(path), columns.split(",")) for name, path, columns in args.reference}
    return merge_job.merge_to(
        spark, customers, pickups, args.out, rules=rules, hot_rows=args.hot_rows, references=references, salted=args.salted
    )


if __name__ == "__main__":
    print(run(build_session()))
