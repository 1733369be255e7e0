"""The address job: the whole cleaned table, and the report of entries that do not fit."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lading.operators import address


@dataclass(frozen=True)
class CleanResult:
    cleaned: str
    report: str
    n_reported: int


def clean_to(
    spark: SparkSession,
    pickups: DataFrame,
    customers: DataFrame,
    out: str,
    as_of: dt.date | str,
    months: int = address.REPORT_MONTHS,
    rules: address.Rules = address.DEFAULT,
    hot_rows: int | None = None,
    limits: tuple[int, int, int] = (address.BUILDING_LIMIT, address.STREET_LIMIT, address.CITY_LIMIT),
) -> CleanResult:
    """Write ``<out>/cleaned`` and ``<out>/report``.

    The report is taken from the written table, so no address is cleaned twice
    and its date range prunes row groups.
    """
    cleaned_path, report_path = f"{out}/cleaned", f"{out}/report"
    source = address.with_customer(address.resolve_source(pickups, customers, hot_rows))
    cleaned = address.clean(source, rules).select(*address.CLEANED_COLUMNS, "created_date")
    cleaned.write.parquet(cleaned_path)

    recent = address.recent_pickups(spark.read.parquet(cleaned_path), as_of, months)
    report = address.tidy_for_report(address.too_long(recent, *limits), rules)
    report.select(*address.CLEANED_COLUMNS).write.parquet(report_path)
    return CleanResult(cleaned_path, report_path, spark.read.parquet(report_path).count())
