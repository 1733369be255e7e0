"""The write-back jobs: a new version of a base table with names in place of exported payloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lading.operators import export, ledger
from lading.plans import versions
from lading.session import qualified

ATTACHMENTS = ("detain_hawb_id", "atchmnt_data")
SIGNATURES = ("cour_delivery_id", "signature")


@dataclass(frozen=True)
class WriteBackResult:
    """``exported`` rows hold a document name now, ``kept`` still their payload.

    ``before`` is the path of the version that the published name stood for.
    """

    table: str
    exported: int
    kept: int
    before: str | None = None


def write_back_to(
    spark: SparkSession,
    base: DataFrame,
    ledger_place: str,
    columns: tuple[str, str],
    out: str,
    shared_mount: bool = False,
    publish: str | None = None,
) -> WriteBackResult:
    """Write ``base`` after the export to ``<out>/table``.

    The keys that are not exported are found in a narrow scan and stored in ``<out>/open``,
    so their true size decides whether the payload scan gets them by broadcast. The files of
    ``base`` are left as they are. With ``publish`` the table or view of that name stands for the new
    version once it is complete, see ``versions``; otherwise that is up to the owner.
    """
    key, payload = columns
    out = qualified(spark, out, shared_mount)
    done = ledger.read_ledger(spark, ledger_place).filter(F.col("id").isNotNull())
    export.open_keys(base, done, key).write.parquet(f"{out}/open")
    open_ = spark.read.parquet(f"{out}/open")
    counts = Observation("exported"), Observation("kept")
    parts = export.written_back(base, done, key, payload, open_)
    exported, kept = (
        part.observe(count, F.count(F.lit(1)).alias("rows")) for part, count in zip(parts, counts, strict=True)
    )
    exported.unionByName(kept).write.parquet(f"{out}/table")
    before = versions.publish(spark, publish, f"{out}/table") if publish else None
    return WriteBackResult(f"{out}/table", counts[0].get["rows"], counts[1].get["rows"], before)
