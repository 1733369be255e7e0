"""The export ledger: which ids are done and under which document name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.session import moved_in
from lading.sources.tables import LEDGER


# A ledger place with this prefix is the name of a catalog table, otherwise a Parquet path.
TABLE = "table:"


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table at ``path``, unless there is something already."""
    empty = spark.createDataFrame([], schema).write.mode("ignore")
    if path.startswith(TABLE):
        empty.saveAsTable(path.removeprefix(TABLE))
    else:
        empty.parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path`` (or ``table:<name>``), created empty on first use."""
    create_if_missing(spark, path, LEDGER)
    if path.startswith(TABLE):
        # Another session may have added files.
        spark.catalog.refreshTable(path.removeprefix(TABLE))
        return spark.table(path.removeprefix(TABLE))
    return spark.read.schema(LEDGER).parquet(path)


def new_entries(written: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows for written files whose id is not recorded yet."""
    return (
        written.filter(F.col("id").isNotNull())
        .select("id", F.col("file_name").alias("document_name"))
        .join(ledger.select("id"), "id", "left_anti")
        .dropDuplicates(["id"])
    )


def append_entries(spark: SparkSession, path: str, written: DataFrame) -> None:
    """Record written files, with the current time, keeping ids unique.

    The entries are written to a folder of their own and their files then renamed into the ledger: two jobs that
    appended to one folder at the same time would clear away each other's unfinished files.
    """
    entries = new_entries(written, read_ledger(spark, path))
    place = location(spark, path)
    staging = f"{place.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    entries.withColumn("migrated_at", F.current_timestamp()).write.parquet(staging)
    moved_in(spark, staging, place)
    if path.startswith(TABLE):
        # The session does not know of the new files.
        spark.catalog.refreshTable(path.removeprefix(TABLE))


def location(spark: SparkSession, path: str) -> str:
    """The folder of a ledger; one in the catalog must be an unpartitioned Parquet table."""
    if not path.startswith(TABLE):
        return path
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {path.removeprefix(TABLE)}").collect()
    details = {row.col_name: row.data_type for row in rows}
    if details["Provider"].lower() != "parquet" or "# Partition Information" in details:
        raise ValueError(f"{path} must be an unpartitioned Parquet table")
    return details["Location"]
