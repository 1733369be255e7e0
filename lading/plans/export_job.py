"""The export jobs: write new payloads as files, record them, and be able to resume."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.operators import export, ledger
from lading.operators.numbering import assign_batches
from lading.operators.spread import HOT_ROWS
from lading.plans.runlog import LEASE, RunLog, State
from lading.session import exists, qualified, removed, sub_folders
from lading.sources import blobfiles
from lading.sources.register import register_blobfiles

RECEIPT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
    ]
)
IDS = T.StructType([T.StructField("id", T.LongType())])


@dataclass(frozen=True)
class Paths:
    """Where a job keeps its files and tables; all reachable from every executor.

    Each kind of export has its own ledger and, below ``work``, its own folder with the log of open runs,
    manifests, quarantined rows and receipts, one subfolder per run. The ledger may also be a
    catalog table (``table:<name>``). Several runs may use a ledger at the same time if they share ``work``.
    A run that shows no sign of life for ``lease`` seconds counts as interrupted.
    Outside local mode folders on local disks are refused unless they are a ``shared_mount``.
    """

    root: str
    ledger: str
    work: str
    shared_mount: bool = False
    lease: float = LEASE


@dataclass(frozen=True)
class ExportResult:
    """``planned`` files should have been written, ``files`` were; the rest is in quarantine."""

    planned: int
    files: int
    bytes: int
    recovered: int
    manifest: str
    quarantine: str


def export_attachments(
    spark: SparkSession,
    attachments: DataFrame,
    headers: DataFrame,
    paths: Paths,
    batch_size: int | None = None,
    case_sensitive: bool = True,
) -> ExportResult:
    """Write every printed attachment that the ledger does not hold."""

    def open_ids(done: DataFrame) -> DataFrame:
        return export.attachment_ids(attachments, headers, done, case_sensitive)

    source = _Source(
        "attachments",
        open_ids,
        export.attachment_names(attachments, case_sensitive),
        export.attachment_payload(attachments, case_sensitive),
        None,
    )
    return _run(spark, source, paths, batch_size)


def export_signatures(
    spark: SparkSession,
    shipments: DataFrame,
    paths: Paths,
    random_names: bool = False,
    batch_size: int | None = None,
    case_sensitive: bool = True,
) -> ExportResult:
    """Decode and write the signature of every delivered shipment not in the ledger."""

    def open_ids(done: DataFrame) -> DataFrame:
        return export.signature_ids(shipments, done, random_names, case_sensitive)

    source = _Source(
        "signatures",
        open_ids,
        export.signature_names(shipments, case_sensitive),
        export.signature_payload(shipments, case_sensitive),
        None if random_names else export.signature_rows(shipments, case_sensitive),
        random_names,
    )
    return _run(spark, source, paths, batch_size)


@dataclass(frozen=True)
class _Source:
    """What a job reads: ids to export given the ledger, names and payloads of all rows.

    ``rows`` has names and payload together, where they stand in one row and the name
    does not depend on the run.
    """

    kind: str
    open_ids: Callable[[DataFrame], DataFrame]
    names: DataFrame
    payload: DataFrame
    rows: DataFrame | None
    random_names: bool = False


def selected_rows(
    source: _Source, manifest: DataFrame, hot: DataFrame, excluded: DataFrame, by_exclusion: bool
) -> DataFrame:
    """The manifest's rows with their payload, selected by one of two lists.

    Either by the manifest, or by what is not in it: ``excluded`` must hold every id of
    ``source.rows`` that the manifest does not. Payloads of the ids in ``hot`` are dropped where
    they are scanned, before any join.
    """
    if by_exclusion and source.rows is not None:
        return export.without_ids(export.without_hot(source.rows, hot), excluded)
    payload = export.without_hot(source.payload, hot)
    return export.with_payload(manifest.select("id", "folder", "file_name"), payload)


@dataclass(frozen=True)
class _Plan:
    """What a run has set itself to write, stored in its folders."""

    run: str
    ids: DataFrame
    manifest: DataFrame
    planned: int
    not_open: DataFrame


def _folders(work: str, run: str) -> dict[str, str]:
    return {table: f"{work}/{table}/run={run}" for table in ("ids", "manifest", "quarantine", "receipts")}


def _planned(
    spark: SparkSession, source: _Source, paths: Paths, work: str, state: State, batch_size: int | None
) -> _Plan:
    """Plan a run that leaves alone what the ledger holds and what the open runs of ``state`` have claimed.

    The list of open runs is older than the ledger that is read here: a run that closed in between is still
    left out by its claim.
    """
    run = uuid.uuid4().hex
    at = _folders(work, run)
    # Keys and names first, written once: later steps then agree on them (random
    # names too), nothing is counted twice, and Spark knows the manifest's true size when
    # it plans the join with the payload.
    not_open = ledger.read_ledger(spark, paths.ledger).select("id")
    if state.owners:
        claims = [_folders(work, other)["manifest"] for other in state.owners]
        not_open = not_open.unionAll(spark.read.schema(IDS).parquet(*claims))
    source.open_ids(not_open).write.parquet(at["ids"])
    ids = spark.read.parquet(at["ids"])
    manifest = export.accepted(ids)
    if batch_size:
        manifest = assign_batches(manifest, ["id"], batch_size)
    manifest.write.parquet(at["manifest"])
    export.rejected(ids, source.names, random_names=source.random_names).write.parquet(at["quarantine"])
    manifest = spark.read.parquet(at["manifest"])
    return _Plan(run, ids, manifest, manifest.count(), not_open)


def _run(spark: SparkSession, source: _Source, paths: Paths, batch_size: int | None) -> ExportResult:
    """Plan, claim, write, record.

    A run claims its manifest by entering itself into the log of open runs. If the log has changed since
    the plan was made, the plan is dropped and made again.
    """
    register_blobfiles(spark)
    root, work = (qualified(spark, p, paths.shared_mount) for p in (paths.root, paths.work))
    work = f"{work.rstrip('/')}/{source.kind}"
    log, owner = RunLog(spark, f"{work}/log"), uuid.uuid4().hex
    with log.alive(owner, paths.lease):
        recovered = _recovered(spark, paths.ledger, work, log, owner, paths.lease)
        while True:
            state = log.read()
            plan = _planned(spark, source, paths, work, state, batch_size)
            if plan.planned == 0 or log.commit(state, state.owners | {plan.run: owner}):
                break
            removed(spark, *_folders(work, plan.run).values())
        at = _folders(work, plan.run)
        if plan.planned == 0:
            return ExportResult(0, 0, 0, recovered, at["manifest"], at["quarantine"])
        files, size = _written(spark, source, plan, root, at["receipts"], batch_size)
        if log.read().owners.get(plan.run) != owner:
            raise RuntimeError(f"run {plan.run} was out of reach for over {paths.lease} s and has been taken over")
        receipts = spark.read.schema(RECEIPT).parquet(at["receipts"])
        ledger.append_entries(spark, paths.ledger, receipts)
        if files < plan.planned:
            (
                plan.manifest.join(receipts.select("id"), "id", "left_anti")
                .select("id", "folder", "file_name", F.lit(export.NO_PAYLOAD).alias("reason"))
                .write.mode("append")
                .parquet(at["quarantine"])
            )
        log.close(owner)
    return ExportResult(plan.planned, files, size, recovered, at["manifest"], at["quarantine"])


def _written(
    spark: SparkSession, source: _Source, plan: _Plan, root: str, receipts_path: str, batch_size: int | None
) -> tuple[int, int]:
    """Write the plan's files; how many there are, and their bytes."""
    # Select the payloads by the shorter list, so that it can be broadcast as often
    # as possible: on a first run nearly everything is exported, later very little.
    held_back = plan.ids.join(plan.manifest.select("id"), "id", "left_anti").select("id")
    hot = plan.ids.filter(F.col("n_rows") >= HOT_ROWS).select("id")
    excluded = plan.not_open.unionAll(held_back)
    selected = selected_rows(source, plan.manifest, hot, excluded, excluded.count() < plan.planned)
    written = Observation("written")
    ledger.create_if_missing(spark, receipts_path, RECEIPT)
    sink = (
        selected.filter(F.col("content").isNotNull())
        .observe(written, F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("content")).alias("bytes"))
        .write.format("blobfiles")
        .mode("append")
        .option("receipts", receipts_path)
    )
    if batch_size:
        sink = sink.option("batch", batch_size)
    sink.save(root)
    receipts = spark.read.schema(RECEIPT).parquet(receipts_path).select("id")
    # With batches, repeated attempts of a task may have listed a file twice.
    files = (receipts.distinct() if batch_size else receipts).count()
    if files != written.get["files"]:
        raise RuntimeError(f"{written.get['files']} files sent, {files} receipts in {receipts_path}")
    return files, written.get["bytes"] or 0


def recover(spark: SparkSession, ledger_path: str, work: str, lease: float = LEASE) -> int:
    """Record files that interrupted runs wrote but did not get to record; ``work`` is that of one kind of export."""
    log, owner = RunLog(spark, f"{work}/log"), uuid.uuid4().hex
    with log.alive(owner, lease):
        return _recovered(spark, ledger_path, work, log, owner, lease)


def _recovered(spark: SparkSession, ledger_path: str, work: str, log: RunLog, owner: str, lease: float) -> int:
    """Take over interrupted runs, record their receipts and close them.

    Tasks leave their receipts after their files, so a crash costs only the tasks (or batches of tasks) that
    were running. Only receipts of these runs are looked at, however many runs there have been.
    """
    gone = log.take_over(owner, lease)
    missing = 0
    written = [_folders(work, run)["receipts"] for run in gone]
    if written:
        for folder in written:
            # A run may have ended before its first task did.
            ledger.create_if_missing(spark, folder, RECEIPT)
        receipts = spark.read.schema(RECEIPT).parquet(*written)
        missing = ledger.new_entries(receipts, ledger.read_ledger(spark, ledger_path)).count()
        if missing:
            ledger.append_entries(spark, ledger_path, receipts)
    if gone:
        log.close(owner)
    return missing


def progress(spark: SparkSession, work: str) -> DataFrame:
    """Rows (run, state, planned, files, bytes): how far the runs below ``work`` are, of one kind of export.

    ``state`` is ``open`` from the claim until the run is recorded, then ``closed``. ``files`` counts what has
    a receipt: without batches that is what finished tasks wrote, with batches each is counted as it is done.
    Any session can ask at any time; narrow tables are read only.
    """
    work = work.rstrip("/")
    owners = RunLog(spark, f"{work}/log").read().owners
    nothing = "run string, planned long"
    planned, done = (spark.createDataFrame([], t) for t in (nothing, "run string, files long, bytes long"))
    runs = T.StructType([*IDS.fields, T.StructField("run", T.StringType())])
    if sub_folders(spark, f"{work}/manifest"):
        manifests = spark.read.schema(runs).parquet(f"{work}/manifest")
        planned = manifests.groupBy("run").agg(F.count("*").alias("planned"))
    if sub_folders(spark, f"{work}/receipts"):
        receipts = spark.read.schema(T.StructType([*RECEIPT.fields, runs["run"]])).parquet(f"{work}/receipts")
        once = receipts.select("run", "id", "n_bytes").distinct()
        done = once.groupBy("run").agg(F.count("*").alias("files"), F.sum("n_bytes").alias("bytes"))
    state = F.when(F.col("run").isin(*owners), "open").otherwise("closed") if owners else F.lit("closed")
    zero = F.lit(0).cast("long")
    return planned.join(done, "run", "left").select(
        "run", state.alias("state"), "planned", F.coalesce("files", zero).alias("files"), F.coalesce("bytes", zero).alias("bytes")
    )


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """``folder, file_name, n_bytes, content`` of every exported file (``root`` must exist).

    The sink writes no names that this reader takes for hidden files. The driver lists the month folders; tasks
    list the files in them and read them, dealt out by name, so that neither the driver nor the number of tasks
    grows with the number of files.
    """
    register_blobfiles(spark)
    root = qualified(spark, root, shared_mount=True)
    if not exists(spark, root):
        raise FileNotFoundError(root)
    folders = [(name,) for name in sub_folders(spark, root) if not blobfiles.hidden(name)]
    names = spark.createDataFrame(folders, "folder string").mapInArrow(
        blobfiles.file_names(root), "folder string, file_name string"
    )
    # The number is given, since names are short and say nothing about the size of the files.
    dealt = names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "folder", "file_name")
    return dealt.mapInArrow(
        blobfiles.file_contents(root), "folder string, file_name string, n_bytes long, content binary"
    )
