import base64
import datetime as dt
import hashlib
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lading.operators import export, ledger
from lading.plans import export_job, runlog, writeback_job
from lading.sources import blobfiles
from lading.sources.register import register_blobfiles
from lading.sources.tables import LEDGER, SHIPMENT_DELIVERY_COURIER, conform, read_table

JUNE = dt.datetime(2018, 6, 12, 23, 30)


def attachments(spark, rows):
    schema = "detain_hawb_id long, atch_is_printed string, atchmnt_name string, atchmnt_data binary"
    return spark.createDataFrame(rows, schema)


def headers(spark, rows):
    return spark.createDataFrame(rows, "detain_hawb_id long, created_date timestamp")


def shipments(spark, rows):
    schema = "cour_delivery_id long, created_date timestamp, rec_status string, signature string"
    return spark.createDataFrame(rows, schema)


def done(spark, *ids):
    return spark.createDataFrame([(i, f"done-{i}", JUNE) for i in ids], LEDGER)


def paths(folder):
    return export_job.Paths(f"{folder}/files", f"{folder}/ledger", f"{folder}/work")


def on_disk(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if not name.endswith(".crc"):
                with open(os.path.join(folder, name), "rb") as f:
                    found[os.path.relpath(os.path.join(folder, name), root)] = f.read()
    return found


def test_attachment_candidates(spark):
    rows = [
        (7, "YES", "inv", b"7"), (8, "YES ", None, b"8"), (9, None, "n", b"9"), (10, "NO", "n", b"x"),
        (11, "YES", "n", b"x"), (12, "YES", "a/b\\..\n", b"x"), (13, "YES", "no header", b"x"),
    ]
    dated = headers(spark, [(i, JUNE) for i in (7, 8, 9, 10, 11, 12)])
    found = export.attachment_candidates(attachments(spark, rows), dated, done(spark, 11))
    assert {(r.id, r.folder, r.file_name) for r in found.collect()} == {
        (7, "2018-06", "inv-7.pdf"), (8, "2018-06", "-8.pdf"), (12, "2018-06", "a_b_.._-12.pdf"),
    }


def test_signature_candidates_and_decoding(spark):
    rows = [(5, JUNE, "DE", "AQID"), (6, JUNE, "DE", "!!!"), (7, JUNE, "XX", "AQID"), (8, JUNE, "DE", None)]
    frame = shipments(spark, rows)
    found = {r.id: r for r in export.signature_candidates(frame, done(spark)).collect()}
    assert set(found) == {5, 6, 8}
    stem = found[5].file_name.removesuffix(".jpg")
    assert [len(part) for part in stem.split("-")] == [8, 4, 4, 4, 12]
    assert stem.replace("-", "").lower() == hashlib.md5(b"signature-5").hexdigest()
    decoded = {r.id: r.content for r in export.signature_payload(frame).collect()}
    assert decoded == {5: bytearray(b"\x01\x02\x03"), 6: None, 8: None}


def test_base64(spark):
    cases = {"AQID": b"\x01\x02\x03", "AQ\r\nI D": b"\x01\x02\x03", "AQI=": b"\x01\x02", "": b""}
    cases |= {"AQI": None, "AQI*": None, "!!!": None, "é===": None, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    found = {r.c: r.d and bytes(r.d) if r.d != b"" else b"" for r in df.select("c", export.decode_base64("c").alias("d")).collect()}
    assert found == cases


def test_held_back_rows(spark, any_hot_rows):
    rows = [
        (1, "YES", "one", b"1"), (2, "YES", "a", b"2"), (2, "YES", "b", b"2"),
        (3, "YES", "x" * 300, b"3"), (4, "YES", "undated", b"4"), (5, "YES", "twin", b"5"), (5, "NO", "twin", b"5"),
    ]
    dated = headers(spark, [(1, JUNE), (2, JUNE), (3, JUNE), (4, None), (5, JUNE)])
    ids = export.attachment_ids(attachments(spark, rows), dated, done(spark))
    names = export.attachment_names(attachments(spark, rows))
    for hot_rows in (1, 10**6):
        held = export.rejected(ids, names, hot_rows=hot_rows).collect()
        assert sorted((r.id, r.reason) for r in held) == [
            (2, "duplicate_id"), (2, "duplicate_id"), (3, "name_too_long"), (4, "no_created_date"),
        ]
        assert {r.file_name for r in held if r.id == 2} == {"a-2.pdf", "b-2.pdf"}
    assert sorted(r.id for r in export.accepted(ids).collect()) == [1, 5]
    twice = dated.unionAll(headers(spark, [(1, JUNE)]))
    ids = export.attachment_ids(attachments(spark, rows), twice, done(spark, 5))
    assert export.accepted(ids).count() == 0


def test_repeated_id_reaches_the_join_once(spark):
    frame = attachments(spark, [(1, "YES", "n", b"x")] * 500)
    ids = export.attachment_ids(frame, headers(spark, [(1, JUNE)]), done(spark))
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("partial_count(1)")
    assert ids.select("id", "n_rows").collect() == [(1, 500)]


def written_back(base, ledger_rows, columns):
    open_ = export.open_keys(base, ledger_rows, columns[0])
    return export.write_back(base, ledger_rows, *columns, open_)


def test_write_back(spark, tmp_path):
    base = shipments(spark, [(5, JUNE, "DE", "AQID"), (6, JUNE, "DE", "keep"), (7, JUNE, "XX", None), (None, JUNE, "DE", "x")])
    changed = written_back(base, done(spark, 5), writeback_job.SIGNATURES)
    assert changed.columns == base.columns
    expected = {5: "done-5", 6: "keep", 7: None, None: "x"}
    assert {r.cour_delivery_id: r.signature for r in changed.collect()} == expected
    done(spark, 5).write.parquet(f"{tmp_path}/ledger")
    result = writeback_job.write_back_to(spark, base, f"{tmp_path}/ledger", writeback_job.SIGNATURES, f"{tmp_path}/out")
    assert (result.exported, result.kept) == (1, 3)
    assert {r.cour_delivery_id: r.signature for r in spark.read.parquet(result.table).collect()} == expected
    base = attachments(spark, [(1, "YES", "a", b"1"), (2, "YES", "b", b"2")])
    changed = written_back(base, done(spark, 1), writeback_job.ATTACHMENTS)
    assert {tuple(r)[0]: tuple(r)[3:] for r in changed.collect()} == {1: ("done-1", None), 2: (None, bytearray(b"2"))}


def test_attachment_job_and_second_run(spark, tmp_path):
    where = paths(tmp_path)
    rows = [(i, "YES", f"n{i}", bytes([i]) * i) for i in range(1, 30)] + [(2, "YES", "again", b"")]
    rows += [(40, "YES", "empty", b""), (41, "YES", "missing", None)]
    frame = attachments(spark, rows)
    dated = headers(spark, [(i, dt.datetime(2018, 1 + i % 12, 1)) for i in range(1, 50)])
    first = export_job.export_attachments(spark, frame, dated, where)
    assert (first.planned, first.files, first.bytes) == (30, 29, sum(range(1, 30)) - 2)
    files = on_disk(where.root)
    assert files["2018-04/n3-3.pdf"] == b"\x03" * 3
    assert files["2018-05/empty-40.pdf"] == b""
    assert len(files) == 29
    assert "2018-03/n2-2.pdf" not in files
    recorded = spark.read.parquet(where.ledger)
    assert recorded.count() == recorded.select("id").distinct().count() == 29
    assert recorded.filter(F.col("migrated_at").isNull()).count() == 0
    held = spark.read.parquet(first.quarantine).collect()
    assert sorted((r.id, r.reason) for r in held) == [(2, "duplicate_id"), (2, "duplicate_id"), (41, "no_payload")]

    second = export_job.export_attachments(spark, frame, dated, where)
    assert (second.files, second.recovered) == (0, 0)
    assert on_disk(where.root) == files

    more = frame.unionAll(attachments(spark, [(45, "YES", "new", b"new")]))
    third = export_job.export_attachments(spark, more, dated, where)
    assert third.files == 1
    assert spark.read.parquet(where.ledger).count() == 30


@pytest.mark.parametrize("random_names", [False, True])
def test_signature_job(spark, tmp_path, random_names):
    where = paths(tmp_path)
    contents = {i: os.urandom(50 + i) for i in range(40)}
    rows = [(i, JUNE, "DE", base64.b64encode(c).decode()) for i, c in contents.items()]
    frame = shipments(spark, rows + [(99, JUNE, "DE", "!!!"), (98, None, "DE", "AQID")])
    result = export_job.export_signatures(spark, frame, where, random_names=random_names, batch_size=15)
    assert (result.planned, result.files) == (41, 40)
    manifest = spark.read.parquet(result.manifest)
    assert {r.batch_id: r["count"] for r in manifest.groupBy("batch_id").count().collect()} == {0: 15, 1: 15, 2: 11}
    names = {r.id: r.document_name for r in spark.read.parquet(where.ledger).collect()}
    assert set(names) == set(contents)
    files = on_disk(where.root)
    assert {i: files[f"2018-06/{names[i]}"] for i in names} == contents
    read_back = export_job.read_files(spark, where.root)
    assert {r.file_name: bytes(r.content) for r in read_back.collect()} == {names[i]: c for i, c in contents.items()}
    changed = written_back(frame, spark.read.parquet(where.ledger), writeback_job.SIGNATURES)
    assert {r.cour_delivery_id: r.signature for r in changed.collect()} == {**names, 99: "!!!", 98: "AQID"}


def test_interrupted_run_is_recovered(spark, tmp_path, monkeypatch):
    where = paths(tmp_path)
    frame = shipments(spark, [(i, JUNE, "DE", "AQID") for i in range(10)])
    first = export_job.export_signatures(spark, frame.filter("cour_delivery_id < 3"), where)
    assert first.files == 3

    def crash(*_):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "append_entries", crash)
        with pytest.raises(InterruptedError):
            export_job.export_signatures(spark, frame.filter("cour_delivery_id < 7"), where)
    # Files and receipts of the second run are there, its ledger entries are not.
    assert spark.read.parquet(where.ledger).count() == 3
    result = export_job.export_signatures(spark, frame, where)
    assert (result.recovered, result.files) == (4, 3)
    recorded = spark.read.parquet(where.ledger)
    assert sorted(r.id for r in recorded.collect()) == list(range(10))
    assert runlog.RunLog(spark, f"{where.work}/signatures/log").read().owners == {}
    assert export_job.export_signatures(spark, frame, where).recovered == 0


def test_ledger_keeps_ids_unique(spark, tmp_path):
    path = str(tmp_path / "ledger")
    written = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, file_name string")
    ledger.append_entries(spark, path, written)
    ledger.append_entries(spark, path, written.unionAll(spark.createDataFrame([(3, "c")], written.schema)))
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def batch(rows):
    columns = list(zip(*rows, strict=True))
    return pa.record_batch(
        [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.binary()), pa.array(range(len(rows)))],
        names=["folder", "file_name", "content", "id"],
    )


class FakeTask:
    def __init__(self, partition, attempt):
        self.partitionId = lambda: partition
        self.taskAttemptId = lambda: attempt


def test_sink_retry_and_abort(tmp_path, monkeypatch):
    root, receipts = str(tmp_path / "files"), str(tmp_path / "receipts")
    writer = blobfiles.BlobFilesWriter(root, receipts)
    rows = [("2018-06", "a", b"1"), ("2018-06", "b", b"22"), ("2018-07", "a", b"")]
    for attempt in (1, 2):
        monkeypatch.setattr(blobfiles.TaskContext, "get", lambda attempt=attempt: FakeTask(0, attempt))
        message = writer.write(iter([batch(rows[:2]), batch(rows[2:])]))
        assert (message.files, message.bytes) == (3, 3)
    writer.commit([message])
    assert on_disk(root) == {"2018-06/a": b"1", "2018-06/b": b"22", "2018-07/a": b""}
    assert len(os.listdir(receipts)) == 1

    failing = blobfiles.BlobFilesWriter(root, receipts)
    with pytest.raises(ValueError, match="no content"):
        failing.write(iter([batch([("2018-06", "c", b"3"), ("2018-06", "d", None)])]))
    failing.abort([None])
    assert sorted(os.listdir(root)) == ["2018-06", "2018-07"]
    assert len(os.listdir(receipts)) == 1


@pytest.mark.parametrize("name", ["..", "_a", ".a", "a/b", "a\\b", "", None, "x\x00"])
def test_sink_refuses_paths(tmp_path, monkeypatch, name):
    monkeypatch.setattr(blobfiles.TaskContext, "get", lambda: FakeTask(0, 1))
    with pytest.raises(ValueError, match="not a usable"):
        blobfiles.BlobFilesWriter(str(tmp_path), None).write(iter([batch([("f", name, b"1")])]))


def test_sink_checks_columns(spark, tmp_path):
    register_blobfiles(spark)
    df = spark.createDataFrame([("f", "n")], "folder string, file_name string")
    with pytest.raises(Exception, match="needs a binary column content"):
        df.write.format("blobfiles").mode("append").save(str(tmp_path))


def test_file_system_paths():
    assert blobfiles.open_filesystem("file:/tmp/x/")[1] == "/tmp/x"
    assert blobfiles.open_filesystem("file:///tmp/x")[1] == "/tmp/x"
    assert blobfiles.open_filesystem("/tmp/x")[1] == "/tmp/x"


def test_conform_matches_other_spellings(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "2018-06-12 00:00:00", "DE", "AQID", "other")],
        "CourDeliveryId int, CreatedDate string, RecStatus string, Signature string, Extra string",
    )
    df.write.parquet(str(tmp_path / "t"))
    read = read_table(spark, SHIPMENT_DELIVERY_COURIER, str(tmp_path / "t"))
    assert read.dtypes == [(f.name, f.dataType.simpleString()) for f in SHIPMENT_DELIVERY_COURIER.fields]
    assert read.first().created_date == dt.datetime(2018, 6, 12)
    with pytest.raises(ValueError, match="rec_status"):
        conform(df.drop("RecStatus"), SHIPMENT_DELIVERY_COURIER)
    with pytest.raises(ValueError, match="partitionColumn"):
        read_table(spark, SHIPMENT_DELIVERY_COURIER, format="jdbc", url="jdbc:x", dbtable="t")


def test_payload_side_is_not_shuffled(spark, tmp_path):
    rows = spark.createDataFrame([(1, "f", "n", b"x")], "id long, folder string, file_name string, content binary")
    rows.write.parquet(str(tmp_path / "rows"))
    rows.drop("content").write.parquet(str(tmp_path / "manifest"))
    rows, manifest = (spark.read.parquet(str(tmp_path / name)) for name in ("rows", "manifest"))
    chosen = export.with_payload(manifest, rows.select("id", "content"))
    for df, kind in ((chosen, "Inner"), (export.without_ids(rows, manifest), "LeftAnti")):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert kind in text and "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_rows_without_id_are_held_back(spark, tmp_path):
    good = [(i, JUNE, "DE", base64.b64encode(bytes([i]) * 9).decode()) for i in range(1, 6)]
    rows = [*good, (None, JUNE, "DE", "AQID"), (None, JUNE, "DE", "AQIE"), (None, JUNE, "XX", "AQIE")]
    where = paths(tmp_path)
    for random_names in (False, True):
        result = export_job.export_signatures(spark, shipments(spark, rows), where, random_names)
        held = [(r.id, r.folder, r.file_name, r.reason) for r in spark.read.parquet(result.quarantine).collect()]
        assert held == [(None, None, None, "no_id")] * 2
    assert len(on_disk(where.root)) == 5
    assert sorted(r.id for r in spark.read.parquet(where.ledger).collect()) == [1, 2, 3, 4, 5]
    frame = attachments(spark, [(None, "YES", "n", b"x"), (1, "YES", "_draft", b"1"), (2, "YES", ".x", b"2"), (3, "YES", "/lead", b"3")])
    where = paths(tmp_path / "attachments")
    result = export_job.export_attachments(spark, frame, headers(spark, [(i, JUNE) for i in (1, 2, 3, None)]), where)
    assert sorted(on_disk(where.root)) == ["2018-06/-.x-2.pdf", "2018-06/-_draft-1.pdf", "2018-06/-_lead-3.pdf"]
    assert export_job.read_files(spark, where.root).count() == result.files == 3


@pytest.mark.parametrize("by_exclusion", [False, True])
def test_either_selection_gives_the_same(spark, tmp_path, monkeypatch, by_exclusion):
    plain = export_job.selected_rows
    monkeypatch.setattr(export_job, "selected_rows", lambda *args: plain(*args[:-1], by_exclusion))
    rows = [(i, JUNE, "DE", base64.b64encode(bytes([i])).decode()) for i in range(1, 9)]
    rows += [(2, JUNE, "DE", "AQID"), (None, JUNE, "DE", "AQID"), (None, JUNE, "DE", "AQIE"), (11, None, "DE", "AQID")]
    rows += [(12, JUNE, "DE", "!!!"), (13, JUNE, "DE", None), (14, JUNE, "XX", "AQID")]
    where = paths(tmp_path)
    done(spark, 3, 77).write.parquet(where.ledger)
    result = export_job.export_signatures(spark, shipments(spark, rows), where)
    assert (result.planned, result.files) == (8, 6)
    names = {r.id: r.document_name for r in spark.read.parquet(where.ledger).collect()}
    assert set(names) == {1, 3, 4, 5, 6, 7, 8, 77}
    assert on_disk(where.root) == {f"2018-06/{names[i]}": bytes([i]) for i in (1, 4, 5, 6, 7, 8)}
    held = sorted((r.id or 0, r.reason) for r in spark.read.parquet(result.quarantine).collect())
    assert held == [
        (0, "no_id"), (0, "no_id"), (2, "duplicate_id"), (2, "duplicate_id"), (11, "no_created_date"),
        (12, "no_payload"), (13, "no_payload"),
    ]


def test_ledger_may_be_a_catalog_table(spark, tmp_path):
    where = export_job.Paths(f"{tmp_path}/files", "table:export_ledger_test", f"{tmp_path}/work")
    spark.sql("DROP TABLE IF EXISTS export_ledger_test")
    try:
        frame = shipments(spark, [(1, JUNE, "DE", "AQID"), (2, JUNE, "DE", "AQID")])
        assert export_job.export_signatures(spark, frame.filter("cour_delivery_id = 1"), where).files == 1
        assert export_job.export_signatures(spark, frame, where).files == 1
        assert sorted(r.id for r in spark.table("export_ledger_test").collect()) == [1, 2]
    finally:
        spark.sql("DROP TABLE IF EXISTS export_ledger_test")


def test_payload_of_bucketed_tables_is_not_shuffled(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = attachments(spark, [(i, "YES", f"n{i}", b"x") for i in range(50)])
        base.write.mode("overwrite").bucketBy(4, "detain_hawb_id").saveAsTable("attachments_test")
        payload = export.attachment_payload(spark.table("attachments_test"))
        ids = spark.createDataFrame([(i, "f", f"n{i}") for i in range(40)], "id long, folder string, file_name string")
        ids.write.mode("overwrite").bucketBy(4, "id").saveAsTable("manifest_test")
        hot = spark.createDataFrame([(3,)], "id long")
        chosen = export.with_payload(spark.table("manifest_test"), export.without_hot(payload, hot))
        text = chosen._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
        # Unbucketed, the hot ids are dropped below the shuffle of the payload.
        base.write.mode("overwrite").saveAsTable("attachments_plain_test")
        payload = export.attachment_payload(spark.table("attachments_plain_test"))
        chosen = export.with_payload(spark.table("manifest_test"), export.without_hot(payload, hot))
        text = chosen._jdf.queryExecution().executedPlan().toString()
        assert text.index("Exchange hashpartitioning") < text.index("LeftAnti")
        # Written back, the payload is not shuffled while the list of open ids is short.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        kept = spark.table("attachments_plain_test").join(spark.table("manifest_test").select(F.col("id").alias("detain_hawb_id")), "detain_hawb_id", "left_semi")
        assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("attachments_test", "manifest_test", "attachments_plain_test"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_files_do_not_move_between_folders(tmp_path, monkeypatch):
    """Renames between folders exclude each other on a file system, so that tasks would wait for one another."""
    root = str(tmp_path / "files")
    moves = []
    plain = blobfiles.pafs.LocalFileSystem

    class Watched:
        type_name = "local"

        def __getattr__(self, name):
            return getattr(plain(), name)

        def move(self, source, target):
            moves.append((os.path.dirname(source), os.path.dirname(target)))
            plain().move(source, target)

    monkeypatch.setattr(blobfiles, "open_filesystem", lambda path: (Watched(), path))
    monkeypatch.setattr(blobfiles.TaskContext, "get", lambda: FakeTask(1, 1))
    writer = blobfiles.BlobFilesWriter(root, None)
    rows = [("2018-06", "a", b"1"), ("2018-07", "b", b"2"), ("2018-06", "c", b"3"), ("2018-06", "a", b"4")]
    writer.commit([writer.write(iter([batch(rows)]))])
    assert on_disk(root) == {"2018-06/a": b"4", "2018-06/c": b"3", "2018-07/b": b"2"}
    assert sorted(os.listdir(root)) == ["2018-06", "2018-07"]
    # Folder by folder, each rename within one.
    assert moves == [(f"{root}/{f}",) * 2 for f in ("2018-07", "2018-06", "2018-06", "2018-06")]


@pytest.mark.parametrize("killed", [False, True])
def test_unfinished_files_are_dropped(tmp_path, monkeypatch, killed):
    root = str(tmp_path / "files")
    monkeypatch.setattr(blobfiles.TaskContext, "get", lambda: FakeTask(0, 1))
    writer = blobfiles.BlobFilesWriter(root, None)
    with monkeypatch.context() as patch:
        patch.setattr(blobfiles._Target, "__exit__", lambda *_: None) if killed else None
        # The target is a folder, so the rename fails.
        os.makedirs(f"{root}/2018-06/taken/x")
        with pytest.raises(OSError):
            writer.write(iter([batch([("2018-06", "a", b"1"), ("2018-06", "taken", b"2")])]))
    assert [n.startswith("_") for n in sorted(os.listdir(f"{root}/2018-06"))].count(True) == killed
    writer.abort([None])
    assert os.listdir(root) == ["2018-06"]
    assert sorted(os.listdir(f"{root}/2018-06")) == ["a", "taken"]


def test_reading_takes_no_more_tasks_for_more_files(spark, tmp_path):
    names = [f"{i:03d} %41#?.gz" for i in range(300)]
    for folder in ("2018-06", "2018-07", "_staging-x"):
        os.makedirs(tmp_path / folder)
        for name in [*names, "_hidden"]:
            (tmp_path / folder / name).write_bytes(name.encode() * 2)
    found = export_job.read_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 4
    rows = {(r.folder, r.file_name, r.n_bytes, bytes(r.content)) for r in found.collect()}
    assert rows == {(f, n, 2 * len(n), n.encode() * 2) for f in ("2018-06", "2018-07") for n in names}
    os.makedirs(tmp_path / "none")
    assert export_job.read_files(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        export_job.read_files(spark, str(tmp_path / "missing"))
