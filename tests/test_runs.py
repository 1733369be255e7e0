"""Runs that meet: interleaved, interrupted and resumed, in batches."""

import base64
import datetime as dt
import glob
import os
from collections import Counter

import pytest

from lading.operators import export, ledger
from lading.plans import export_job, runlog

JUNE = dt.datetime(2018, 6, 12)


def shipments(spark, ids):
    rows = [(i, JUNE, "DE", base64.b64encode(b"%d" % i).decode()) for i in ids]
    return spark.createDataFrame(rows, "cour_delivery_id long, created_date timestamp, rec_status string, signature string")


def paths(base, **options):
    return export_job.Paths(f"{base}/files", f"{base}/ledger", f"{base}/work", **options)


def recorded(spark, where):
    return Counter(r.id for r in ledger.read_ledger(spark, where.ledger).collect())


def log(spark, where):
    return runlog.RunLog(spark, f"{where.work}/signatures/log")


def test_changes_of_the_log(spark, tmp_path):
    first, second = (runlog.RunLog(spark, f"{tmp_path}/log") for _ in range(2))
    seen, also = first.read(), second.read()
    assert seen.owners == {} and first.commit(seen, {"r1": "a"})
    # The other looked before that change.
    assert not second.commit(also, {"r2": "b"})
    assert second.read().owners == {"r1": "a"}
    assert second.commit(second.read(), {"r1": "a", "r2": "b"})
    for i in range(40):
        assert first.commit(first.read(), {"r1": "a", "r2": "b", "n": str(i)})
    assert len(glob.glob(f"{tmp_path}/log/*.json")) == runlog.KEPT
    first.close("a")
    assert second.read().owners == {"r2": "b", "n": "39"}
    assert first.take_over("c", 60) == ["n", "r2"] and set(second.read().owners.values()) == {"c"}
    assert not [n for n in os.listdir(f"{tmp_path}/log") if n.startswith("_")]


def test_only_the_living_keep_their_runs(spark, tmp_path):
    shared = runlog.RunLog(spark, f"{tmp_path}/log")
    with shared.alive("a", 60):
        shared.commit(shared.read(), {"r": "a"})
        assert shared.take_over("b", 60) == []
        # Silent for longer than the lease.
        os.utime(f"{tmp_path}/log/alive-a", (1, 1))
        assert shared.take_over("b", 60) == ["r"]
    with shared.alive("b", 60):
        assert shared.take_over("a", 60) == []
    assert shared.take_over("a", 60) == ["r"]


@pytest.mark.parametrize("random_names", [False, True])
def test_interleaved_runs(spark, tmp_path, monkeypatch, random_names):
    where = paths(tmp_path)
    plain_commit, plain_written = runlog.RunLog.commit, export_job._written
    results, planned = [], []

    # The second run goes through from start to end between the plan of the first and its claim.
    def commit(self, before, owners):
        if not results:
            results.append(None)
            results[0] = export_job.export_signatures(spark, shipments(spark, range(6)), where, random_names)
        return plain_commit(self, before, owners)

    with monkeypatch.context() as patch:
        patch.setattr(runlog.RunLog, "commit", commit)
        first = export_job.export_signatures(spark, shipments(spark, range(10)), where, random_names)
    assert (results[0].files, first.files) == (6, 4)
    assert recorded(spark, where) == Counter(range(10))
    assert len(glob.glob(f"{where.root}/*/*")) == 10

    # A run that starts while another writes leaves its claim alone.
    def written(*args):
        if not planned:
            planned.append(None)
            planned[0] = export_job.export_signatures(spark, shipments(spark, range(30)), where, random_names)
        return plain_written(*args)

    with monkeypatch.context() as patch:
        patch.setattr(export_job, "_written", written)
        outer = export_job.export_signatures(spark, shipments(spark, range(20)), where, random_names)
    assert (outer.files, planned[0].files) == (10, 10)
    assert recorded(spark, where) == Counter(range(30))
    assert len(glob.glob(f"{where.root}/*/*")) == 30
    assert log(spark, where).read().owners == {}
    assert {r.state for r in export_job.progress(spark, f"{where.work}/signatures").collect()} == {"closed"}


def test_a_run_that_was_taken_over_records_nothing(spark, tmp_path, monkeypatch):
    where = paths(tmp_path)
    plain = export_job._written

    def late(*args):
        found = plain(*args)
        # Another finds the run silent, and records it.
        for sign in glob.glob(f"{where.work}/signatures/log/alive-*"):
            os.utime(sign, (1, 1))
        assert export_job.recover(spark, where.ledger, f"{where.work}/signatures", where.lease) == 5
        return found

    with monkeypatch.context() as patch:
        patch.setattr(export_job, "_written", late)
        with pytest.raises(RuntimeError, match="taken over"):
            export_job.export_signatures(spark, shipments(spark, range(5)), where)
    assert recorded(spark, where) == Counter(range(5))


def test_killed_in_the_third_batch(spark, tmp_path):
    where = paths(tmp_path)
    shipments(spark, range(1, 13)).coalesce(1).sortWithinPartitions("cour_delivery_id").write.parquet(f"{tmp_path}/in")
    frame = spark.read.parquet(f"{tmp_path}/in")
    name = frame.filter("cour_delivery_id = 8").select(export.signature_name("cour_delivery_id")).first()[0]
    # Something that cannot be replaced stands where the eighth file belongs.
    os.makedirs(f"{where.root}/2018-06/{name}/x")
    with pytest.raises(Exception, match="(?s)."):
        export_job.export_signatures(spark, frame, where, batch_size=3)
    # Another session sees how far it got: two batches of three.
    seen = export_job.progress(spark.newSession(), f"{where.work}/signatures").collect()
    assert [(r.state, r.planned, r.files) for r in seen] == [("open", 12, 6)]
    assert recorded(spark, where) == Counter()
    os.removedirs(f"{where.root}/2018-06/{name}/x")
    result = export_job.export_signatures(spark, frame, where, batch_size=3)
    assert (result.recovered, result.planned, result.files) == (6, 6, 6)
    manifest = sorted(r.id for r in spark.read.parquet(result.manifest).collect())
    assert manifest == list(range(7, 13))
    assert recorded(spark, where) == Counter(range(1, 13))
    files = glob.glob(f"{where.root}/*/*")
    assert sorted(open(f, "rb").read() for f in files) == sorted(b"%d" % i for i in range(1, 13))
    state = {(r.state, r.planned, r.files) for r in export_job.progress(spark, f"{where.work}/signatures").collect()}
    assert state == {("closed", 12, 6), ("closed", 6, 6)}


def test_closed_runs_are_not_looked_at(spark, tmp_path):
    where = paths(tmp_path)
    work = f"{where.work}/signatures"
    assert export_job.export_signatures(spark, shipments(spark, range(3)), where).files == 3
    # Receipts of 50 closed runs that cannot be read: opening any of them would fail.
    for i in range(50):
        os.makedirs(f"{work}/receipts/run=closed{i}")
        with open(f"{work}/receipts/run=closed{i}/part-0.parquet", "wb") as file:
            file.write(b"no parquet")
    result = export_job.export_signatures(spark, shipments(spark, range(5)), where)
    assert (result.recovered, result.files) == (0, 2)
    shared = log(spark, where)
    assert shared.commit(shared.read(), {"crashed": "nobody"})
    spark.createDataFrame([(9, "f", "n", 1)], export_job.RECEIPT).write.parquet(f"{work}/receipts/run=crashed")
    spark.createDataFrame([(9, "f", "n")], "id long, folder string, file_name string").write.parquet(f"{work}/manifest/run=crashed")
    assert export_job.recover(spark, where.ledger, work) == 1
    assert recorded(spark, where) == Counter([*range(5), 9])


def test_appends_at_the_same_time(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    place = f"{tmp_path}/ledger"
    ledger.read_ledger(spark, place)
    frames = [spark.createDataFrame([(i, f"n{i}")], "id long, file_name string") for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda frame: ledger.append_entries(spark, place, frame), frames))
    assert sorted(r.id for r in ledger.read_ledger(spark, place).collect()) == list(range(6))
