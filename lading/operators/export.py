"""What to export, under which names, and what to hold back.

Attachments (printed documents of detained shipments) and signatures (of
delivered shipments) share one shape: ``id`` plus narrow columns first, the
payload last and only at scan level, so that shuffles carry keys and names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.functions import tsql
from lading.operators.spread import HOT_ROWS, checked_hot_rows

# Status texts of the source tables.
PRINTED = "YES"
DELIVERED = "DE"
# Fixed value: bytes the ledger can hold as a document name.
NAME_LIMIT = 250
# Fixed value: month folders.
FOLDER_FORMAT = "yyyy-MM"

DUPLICATE = "duplicate_id"
UNDATED = "no_created_date"
LONG_NAME = "name_too_long"
NO_PAYLOAD = "no_payload"
NO_ID = "no_id"


def printed_attachments(attachments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """Attachments marked as printed; a missing mark means not printed."""
    return attachments.filter(tsql.equals("atch_is_printed", PRINTED, case_sensitive)).withColumnRenamed(
        "detain_hawb_id", "id"
    )


def delivered_shipments(shipments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    return shipments.filter(tsql.equals("rec_status", DELIVERED, case_sensitive)).withColumnRenamed(
        "cour_delivery_id", "id"
    )


def identified(df: DataFrame) -> DataFrame:
    """Rows that have an ``id``; the others cannot be named or recorded and go to quarantine."""
    return df.filter(F.col("id").isNotNull())


def not_exported(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose ``id`` the ledger does not hold."""
    return df.join(ledger.select("id"), "id", "left_anti")


def open_headers(headers: DataFrame, ledger: DataFrame) -> DataFrame:
    """``id, created_date`` of the headers whose attachments are still to export.

    The ledger is taken off the headers, where an id occurs once, and not off the
    attachments: those then go through one join only.
    """
    return not_exported(headers.select(F.col("detain_hawb_id").alias("id"), "created_date"), ledger)


def attachment_candidates(
    attachments: DataFrame, headers: DataFrame, ledger: DataFrame, case_sensitive: bool = True
) -> DataFrame:
    """``id, created_date, folder, file_name`` of every attachment still to export."""
    printed = printed_attachments(attachments, case_sensitive).select("id", "atchmnt_name")
    return printed.join(open_headers(headers, ledger), "id").select(
        "id", "created_date", month_folder("created_date"), attachment_name("atchmnt_name", "id")
    )


def signature_candidates(shipments: DataFrame, ledger: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, created_date, folder, file_name`` of every signature still to export."""
    delivered = identified(delivered_shipments(shipments, case_sensitive)).select("id", "created_date")
    return not_exported(delivered, ledger).select(
        "id", "created_date", month_folder("created_date"), signature_name("id")
    )


def attachment_ids(
    attachments: DataFrame, headers: DataFrame, ledger: DataFrame, case_sensitive: bool = True
) -> DataFrame:
    """The attachment candidates with one row per id: ``id, n_rows, folder, file_name``.

    Counting comes first: it combines before the shuffle, so an id with very many
    rows reaches the join as a single one. Folder and name mean something only
    where ``n_rows`` is 1.
    """
    printed = (
        identified(printed_attachments(attachments, case_sensitive))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("_attachments"), F.min("atchmnt_name").alias("atchmnt_name"))
    )
    dated = (
        open_headers(headers, ledger)
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("_headers"), F.min("created_date").alias("created_date"))
    )
    return printed.join(dated, "id").select(
        "id",
        (F.col("_attachments") * F.col("_headers")).alias("n_rows"),
        month_folder("created_date"),
        attachment_name("atchmnt_name", "id"),
    )


def signature_ids(
    shipments: DataFrame, ledger: DataFrame, random_names: bool = False, case_sensitive: bool = True
) -> DataFrame:
    """The signature candidates with one row per id: ``id, n_rows, folder, file_name``.

    With ``random_names`` the result must be written once before it is used:
    the names change with every evaluation.
    """
    delivered = (
        identified(delivered_shipments(shipments, case_sensitive))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("created_date").alias("created_date"))
    )
    name = F.concat(F.upper(F.uuid()), F.lit(".jpg")).alias("file_name") if random_names else signature_name("id")
    return not_exported(delivered, ledger).select("id", "n_rows", month_folder("created_date"), name)


def month_folder(created: str) -> Column:
    return F.date_format(created, FOLDER_FORMAT).alias("folder")


def attachment_name(name: str, key: str) -> Column:
    """``<name>-<id>.pdf``; path separators and control characters become underscores.

    File readers take names with a leading underscore or dot for hidden files, so
    those get a dash in front.
    """
    safe = F.regexp_replace(F.regexp_replace(name, "[/\\\\\\x00-\\x1f]", "_"), "^(?=[_.])", "-")
    return tsql.concat_blank(safe, F.lit("-"), F.col(key), F.lit(".pdf")).alias("file_name")


def signature_name(key: str) -> Column:
    """``<guid>.jpg`` with a guid made from the key, so that a retry writes the same file."""
    digest = F.upper(F.md5(F.concat(F.lit("signature-"), F.col(key).cast("string")).cast("binary")))
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    parts = [F.substring(digest, start, length) for start, length in groups]
    # Plain concatenation: without a key there is no name.
    dashed = [c for part in parts for c in (part, F.lit("-"))][:-1]
    return F.concat(*dashed, F.lit(".jpg")).alias("file_name")


def decode_base64(c: str) -> Column:
    """Bytes of a base64 text, NULL when it is not one.

    White space is allowed anywhere; Spark's decoder would also take a text
    whose padding is missing.
    """
    padded = F.octet_length(tsql.delete_chars(c, " \t\r\n")) % 4 == 0
    return F.when(padded, F.try_to_binary(F.col(c), F.lit("base64")))


def attachment_payload(attachments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, content``; the printed filter holds here too, so an unprinted twin is not exported."""
    printed = identified(printed_attachments(attachments, case_sensitive))
    return printed.select("id", F.col("atchmnt_data").alias("content"))


def signature_payload(shipments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, content`` of delivered shipments."""
    delivered = identified(delivered_shipments(shipments, case_sensitive))
    return delivered.select("id", decode_base64("signature").alias("content"))


def attachment_names(attachments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, file_name`` of every printed attachment."""
    printed = printed_attachments(attachments, case_sensitive)
    return printed.select("id", attachment_name("atchmnt_name", "id"))


def signature_names(shipments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, file_name`` of every delivered shipment."""
    return delivered_shipments(shipments, case_sensitive).select("id", signature_name("id"))


def accepted(ids: DataFrame, name_limit: int = NAME_LIMIT) -> DataFrame:
    """``id, folder, file_name`` of the ids that can be written and recorded."""
    fits = F.octet_length("file_name") <= name_limit
    return ids.filter((F.col("n_rows") == 1) & F.col("folder").isNotNull() & fits).drop("n_rows")


def rejected(
    ids: DataFrame,
    names: DataFrame,
    name_limit: int = NAME_LIMIT,
    hot_rows: int = HOT_ROWS,
    random_names: bool = False,
) -> DataFrame:
    """``id, folder, file_name, reason`` of every row held back before reading payloads.

    ``ids`` should be stored: it is read once per kind of reason. Every row of a
    repeated id is listed, with its own name from ``names``; with ``random_names``
    there is no name to list. Rows without an id are listed with neither folder nor
    name. Ids with at least ``hot_rows`` rows, of which N rows have at most
    N / ``hot_rows``, are matched by broadcast, and their rows never shuffled.
    """
    checked_hot_rows(hot_rows)
    reason = F.when(F.col("folder").isNull(), UNDATED).when(F.octet_length("file_name") > name_limit, LONG_NAME)
    single = ids.filter("n_rows = 1").withColumn("reason", reason).filter("reason IS NOT NULL")

    repeated = ids.filter("n_rows > 1").select("id", "n_rows", "folder")
    hot = F.broadcast(repeated.filter(F.col("n_rows") >= hot_rows))
    cold = repeated.filter(F.col("n_rows") < hot_rows)
    known = identified(names)
    rows = known.join(hot, "id").unionByName(without_hot(known, hot).join(cold, "id"))
    duplicates = rows.withColumn("reason", F.lit(DUPLICATE))
    if random_names:
        duplicates = duplicates.withColumn("file_name", F.lit(None).cast("string"))
    nothing = F.lit(None).cast("string")
    unnamed = names.filter(F.col("id").isNull()).select(
        "id", nothing.alias("folder"), nothing.alias("file_name"), F.lit(NO_ID).alias("reason")
    )

    columns = ["id", "folder", "file_name", "reason"]
    return single.select(columns).unionAll(duplicates.select(columns)).unionAll(unnamed)


def without_hot(df: DataFrame, hot: DataFrame) -> DataFrame:
    """``df`` without the ids in ``hot``, which must be few enough to broadcast."""
    return df.join(F.broadcast(hot.select("id")), "id", "left_anti")


def with_payload(manifest: DataFrame, payload: DataFrame) -> DataFrame:
    """Manifest rows with their ``content``.

    ``payload`` is the left side: its rows are wide, and a manifest below the
    broadcast threshold then costs no shuffle of them.
    """
    return payload.join(manifest, "id").select(*manifest.columns, "content")


def signature_rows(shipments: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``id, folder, file_name, content`` of every delivered shipment, exported or not."""
    return identified(delivered_shipments(shipments, case_sensitive)).select(
        "id",
        month_folder("created_date"),
        signature_name("id"),
        decode_base64("signature").alias("content"),
    )


def without_ids(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows whose ``id`` is not excluded: the short way when few are."""
    return rows.join(excluded.select("id"), "id", "left_anti")


def folder_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"))


def target_path(root: str) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.col("folder"), F.col("file_name"))


def open_keys(base: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """The keys of ``base`` that the ledger does not hold, once each; a narrow scan."""
    return base.select(key).filter(F.col(key).isNotNull()).join(
        ledger.select(F.col("id").alias(key)), key, "left_anti"
    ).distinct()


def write_back(base: DataFrame, ledger: DataFrame, key: str, payload: str, open_: DataFrame) -> DataFrame:
    """The two parts of ``written_back`` as one table."""
    exported, kept = written_back(base, ledger, key, payload, open_)
    return exported.unionByName(kept)


def written_back(
    base: DataFrame, ledger: DataFrame, key: str, payload: str, open_: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``base`` with ``payload`` replaced by the document name for every id in the ledger.

    ``open_`` are the stored ``open_keys``. Exported rows are read without the payload
    column and joined to the ledger; the others keep their payload, and while their list is short
    it is broadcast, so that no payload is shuffled. Rows without a key keep their
    payload. A binary payload becomes a text column that holds only names: rows not
    exported keep their bytes in ``<payload>_bytes``.
    """
    names = ledger.select(F.col("id").alias("_ledger_id"), F.col("document_name").alias("_document_name"))
    binary = dict(base.dtypes)[payload] == "binary"
    exported = base.drop(payload).join(names, F.col(key) == F.col("_ledger_id"))
    kept = base.join(open_, key, "left_semi").unionByName(base.filter(F.col(key).isNull()))

    def columns(payload_columns: list[Column]) -> list[Column]:
        out = []
        for name in base.columns:
            out += payload_columns if name == payload else [F.col(name)]
        return out

    name_only = [F.col("_document_name").alias(payload)]
    bytes_only = [F.col(payload)]
    if binary:
        name_only.append(F.lit(None).cast("binary").alias(f"{payload}_bytes"))
        bytes_only = [F.lit(None).cast("string").alias(payload), F.col(payload).alias(f"{payload}_bytes")]
    return exported.select(columns(name_only)), kept.select(columns(bytes_only))
