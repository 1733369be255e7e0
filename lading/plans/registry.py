"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.operators import address, dedup, export, ledger
from lading.operators.numbering import BATCH_SIZE, assign_batches, number_range, number_rows
from lading.plans import export_job, versions, writeback_job
from lading.plans.derived import AS_OF, view
from lading.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.resolve_source(
        view(spark, sf_dir, "pickup_input"), view(spark, sf_dir, "customer_input")
    )


@query
def address_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).select(
        "pickup_id", "customer_id", "customer_name", "address", "town", "customer_found"
    )


def _towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).transform(address.strip_town_zero)


@query
def town_zero_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _towns(spark, sf_dir).select("pickup_id", "town")


def _zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _towns(spark, sf_dir).transform(address.strip_address_zero)


@query
def address_zero_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zeros(spark, sf_dir).select("pickup_id", "address")


def _no_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zeros(spark, sf_dir).transform(address.remove_town)


@query
def remove_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_town(spark, sf_dir).select("pickup_id", "cln_address", "town", "orig_address")


def _no_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_town(spark, sf_dir).transform(address.strip_trailing_commas)


@query
def strip_trailing_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_commas(spark, sf_dir).select("pickup_id", "cln_address")


def _raw_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_commas(spark, sf_dir).transform(address.extract_street)


@query
def street_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_street(spark, sf_dir).select("pickup_id", "cln_address", "street")


def _street(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_street(spark, sf_dir).transform(address.finish_street)


@query
def street_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _street(spark, sf_dir).select("pickup_id", "cln_address", "street", "has_street")


def _prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _street(spark, sf_dir).transform(address.split_prefixes)


@query
def prefix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prefixes(spark, sf_dir).select("pickup_id", "prefix1", "prefix2", "prefix3", "prefix4")


@query
def building_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _prefixes(spark, sf_dir).transform(address.assign_fields)
    return fields.select("pickup_id", "building", "street", "city", "has_street")


@query
def pickup_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.clean_pickups(
        view(spark, sf_dir, "pickup_input"), view(spark, sf_dir, "customer_input")
    )


@query
def overlong_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.overlong_report(
        view(spark, sf_dir, "pickup_input"), view(spark, sf_dir, "customer_input"), AS_OF
    )


def _pdf_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.attachment_candidates(
        view(spark, sf_dir, "attachment_input"),
        view(spark, sf_dir, "header_input"),
        view(spark, sf_dir, "attachment_ledger"),
    )


@query
def pdf_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pdf_candidates(spark, sf_dir).select("id", "folder", "file_name")


def _jpeg_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.signature_candidates(
        view(spark, sf_dir, "shipment_input"), view(spark, sf_dir, "shipment_ledger")
    )


@query
def jpeg_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jpeg_candidates(spark, sf_dir).select("id", "folder", "file_name")


def _all_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "attachment_input").unionAll(view(spark, sf_dir, "attachment_twin_input"))


def _twin_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.attachment_ids(
        _all_attachments(spark, sf_dir),
        view(spark, sf_dir, "header_input"),
        view(spark, sf_dir, "attachment_ledger"),
    )


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, as the jobs do with what several steps use."""
    path = f"{run_folder(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@query
def duplicate_id_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = export.attachment_names(_all_attachments(spark, sf_dir))
    return export.rejected(_stored(_twin_ids(spark, sf_dir), "ids"), names)


@query
def single_id_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.accepted(_twin_ids(spark, sf_dir))


def _jpeg_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.signature_ids(
        view(spark, sf_dir, "shipment_input"), view(spark, sf_dir, "shipment_ledger")
    )


def _signature_run(
    spark: SparkSession, sf_dir: str, batch_size: int | None = None
) -> tuple[export_job.ExportResult, export_job.Paths]:
    """A whole signature export into a fresh folder."""
    base = run_folder(spark, "signatures")
    # The folder all machines share, whatever it is called.
    paths = export_job.Paths(f"{base}/files", f"{base}/ledger", f"{base}/work", shared_mount=True)
    view(spark, sf_dir, "shipment_ledger").write.parquet(paths.ledger)
    shipments = view(spark, sf_dir, "shipment_input")
    return export_job.export_signatures(spark, shipments, paths, batch_size=batch_size), paths


@query
def signature_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a real run held back."""
    result, _ = _signature_run(spark, sf_dir)
    return spark.read.parquet(result.quarantine)


@query
def export_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.folder_counts(export.accepted(_jpeg_ids(spark, sf_dir)))


@query
def candidate_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_rows(_jpeg_candidates(spark, sf_dir).select("id", "folder"), ["id"])


@query
def batch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch, taken by row numbers."""
    numbered = number_rows(_jpeg_candidates(spark, sf_dir).select("id", "folder"), ["id"])
    return number_range(numbered, 1, BATCH_SIZE)


@query
def export_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = export.accepted(_jpeg_ids(spark, sf_dir))
    return manifest.select("id", export.target_path("/exports/").alias("path"))


@query
def export_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_batches(export.accepted(_jpeg_ids(spark, sf_dir)), ["id"])


def _digest(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "folder",
        "file_name",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("md5"),
    )


@query
def pdf_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = export.attachment_ids(
        view(spark, sf_dir, "attachment_input"),
        view(spark, sf_dir, "header_input"),
        view(spark, sf_dir, "attachment_ledger"),
    )
    payload = export.attachment_payload(view(spark, sf_dir, "attachment_input"))
    return _digest(export.with_payload(export.accepted(ids), payload))


@query
def jpeg_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export.signature_rows(view(spark, sf_dir, "shipment_input"))
    ids = _stored(_jpeg_ids(spark, sf_dir), "ids")
    held_back = ids.join(export.accepted(ids), "id", "left_anti").select("id")
    done = view(spark, sf_dir, "shipment_ledger").select("id")
    selected = export.without_ids(rows, done.unionAll(held_back))
    return _digest(selected.filter(F.col("content").isNotNull()))


@query
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a real run reports."""
    result, _ = _signature_run(spark, sf_dir)
    return spark.createDataFrame([(result.files, result.bytes)], "n_files long, n_bytes long")


@query
def export_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a real run."""
    _, paths = _signature_run(spark, sf_dir)
    return ledger.read_ledger(spark, paths.ledger).select("id", "document_name")


@query
def batched_export_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a real run that commits every batch."""
    _, paths = _signature_run(spark, sf_dir, BATCH_SIZE)
    return ledger.read_ledger(spark, paths.ledger).select("id", "document_name")


@query
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a real run got, as any session can ask."""
    _, paths = _signature_run(spark, sf_dir, BATCH_SIZE)
    found = export_job.progress(spark, f"{paths.work}/signatures")
    return found.select("state", "planned", F.col("files").alias("n_files"), F.col("bytes").alias("n_bytes"))


@query
def resume_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after a run that got through the first batch only."""
    done = view(spark, sf_dir, "shipment_ledger").select("id")
    batches = assign_batches(export.accepted(_jpeg_ids(spark, sf_dir)), ["id"])
    first = batches.filter(F.col("batch_id") == 0).select("id")
    left = export.signature_candidates(view(spark, sf_dir, "shipment_input"), done.unionAll(first))
    return left.select("id", "folder", "file_name")


def _written_back(spark: SparkSession, sf_dir: str, kind: str, columns: tuple[str, str]) -> DataFrame:
    base = run_folder(spark, "write-back")
    view(spark, sf_dir, f"{kind}_ledger").write.parquet(f"{base}/ledger")
    result = writeback_job.write_back_to(
        spark, view(spark, sf_dir, f"{kind}_input"), f"{base}/ledger", columns, f"{base}/out", shared_mount=True
    )
    return spark.read.parquet(result.table)


@query
def signature_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _written_back(spark, sf_dir, "shipment", writeback_job.SIGNATURES)
    return changed.select("cour_delivery_id", "rec_status", "signature")


@query
def signature_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of a published name see once it stands for the written-back table."""
    base = run_folder(spark, "publish")
    name = f"lading_{base[-32:]}"
    view(spark, sf_dir, "shipment_ledger").write.parquet(f"{base}/ledger")
    view(spark, sf_dir, "shipment_input").write.parquet(f"{base}/before")
    versions.publish(spark, name, f"{base}/before")
    try:
        writeback_job.write_back_to(
            spark, spark.table(name), f"{base}/ledger", writeback_job.SIGNATURES, f"{base}/out", shared_mount=True, publish=name
        )
        return spark.table(name).select("cour_delivery_id", "rec_status", "signature")
    finally:
        # The frame knows its files already.
        spark.sql(f"DROP VIEW {name}")


@query
def attachment_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _written_back(spark, sf_dir, "attachment", writeback_job.ATTACHMENTS)
    return changed.select(
        "detain_hawb_id", "atchmnt_data", F.md5("atchmnt_data_bytes").alias("remaining_md5")
    )


def _files(spark: SparkSession, root: str) -> DataFrame:
    return export_job.read_files(spark, root).select(
        "folder", "file_name", "n_bytes", F.md5("content").alias("md5")
    )


@query
def blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the attachment export and read its files back."""
    base = run_folder(spark, "attachments")
    paths = export_job.Paths(f"{base}/files", f"{base}/ledger", f"{base}/work", shared_mount=True)
    view(spark, sf_dir, "attachment_ledger").write.parquet(paths.ledger)
    export_job.export_attachments(
        spark, view(spark, sf_dir, "attachment_input"), view(spark, sf_dir, "header_input"), paths
    )
    return _files(spark, paths.root)


@query
def signature_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the signature export and read its files back."""
    _, paths = _signature_run(spark, sf_dir)
    return _files(spark, paths.root)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Addresses are cleaned once; groups and joins work on the stored narrow columns.
    return dedup.with_survivor(_stored(dedup.match_frame(view(spark, sf_dir, "customer_input")), "matches"))


@query
def customer_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.match_frame(view(spark, sf_dir, "customer_input"))


@query
def customer_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.crosswalk(_resolved(spark, sf_dir))


@query
def customer_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.survivors(_resolved(spark, sf_dir))


@query
def pickup_repointed(spark: SparkSession, sf_dir: str) -> DataFrame:
    walk = dedup.crosswalk(_resolved(spark, sf_dir))
    moved = dedup.repoint(view(spark, sf_dir, "pickup_input"), walk)
    return moved.select("pickup_id", "customer_id")


def _references(spark: SparkSession, sf_dir: str) -> dedup.References:
    return {
        "pickups": (view(spark, sf_dir, "pickup_input"), ["customer_id"]),
        "parcels": (view(spark, sf_dir, "parcel_input"), ["sender_id", "receiver_id"]),
    }


@query
def references_repointed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables that refer to customers after the merge, one row per reference."""
    walk = dedup.crosswalk(_resolved(spark, sf_dir))
    moved = dedup.repoint_all(_references(spark, sf_dir), walk)
    pickups = moved["pickups"].select(
        F.lit("pickups").alias("table_name"), F.col("pickup_id").alias("row_id"),
        F.lit("customer_id").alias("column_name"), "customer_id",
    )
    columns = F.create_map(*[c for name in ("sender_id", "receiver_id") for c in (F.lit(name), F.col(name))])
    parcels = moved["parcels"].select(
        F.lit("parcels").alias("table_name"), F.col("parcel_id").alias("row_id"),
        F.explode(columns).alias("column_name", "customer_id"),
    )
    return pickups.unionByName(parcels)


@query
def lost_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without customer had they not been re-pointed, by table and column."""
    walk = dedup.crosswalk(_resolved(spark, sf_dir))
    customers = view(spark, sf_dir, "customer_input")
    remaining = dedup.remove_duplicates(customers, walk).select("customer_id")
    lost = _stored(dedup.lost_customers(customers, walk.filter("false"), remaining), "lost")
    return dedup.lost_references(_references(spark, sf_dir), lost)


@query
def lost_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups without customer after the merge (none), and had they not been re-pointed."""
    walk = dedup.crosswalk(_resolved(spark, sf_dir))
    pickups, customers = view(spark, sf_dir, "pickup_input"), view(spark, sf_dir, "customer_input")
    remaining = dedup.remove_duplicates(customers, walk).select("customer_id")
    lost = [
        dedup.lost_customers(customers, moved, remaining).withColumn("moved", F.lit(moved is walk))
        for moved in (walk, walk.filter("false"))
    ]
    # One row per customer and case at most; the pickups meet both cases in one join.
    return pickups.join(lost[0].unionAll(lost[1]), "customer_id").agg(
        F.count_if("moved").alias("n_lost"), F.count_if(~F.col("moved")).alias("n_lost_unmoved")
    )


@query
def customers_without_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    walk = dedup.crosswalk(_resolved(spark, sf_dir))
    return dedup.remove_duplicates(view(spark, sf_dir, "customer_input"), walk)
