import datetime as dt

import pytest

from lading import __main__ as cli
from lading import session
from lading.operators import address
from lading.plans import clean_job, derived, merge_job, registry


def inputs(spark, data):
    return derived.view(spark, data, "pickup_input"), derived.view(spark, data, "customer_input")


def test_clean_job_writes_table_and_report(spark, data, tmp_path, any_hot_rows):
    pickups, customers = inputs(spark, data)
    result = clean_job.clean_to(spark, pickups, customers, str(tmp_path), derived.AS_OF, hot_rows=10)
    cleaned = spark.read.parquet(result.cleaned).select(*address.CLEANED_COLUMNS)
    assert sorted(map(str, cleaned.collect())) == sorted(map(str, registry.pickup_clean(spark, data).collect()))
    report = spark.read.parquet(result.report)
    expected = registry.overlong_report(spark, data).collect()
    assert sorted(map(str, report.select(*expected[0].asDict()).collect())) == sorted(map(str, expected))
    assert result.n_reported == len(expected)


def test_merge_job_keeps_every_pickup(spark, data, tmp_path, any_hot_rows):
    pickups, customers = inputs(spark, data)
    result = merge_job.merge_to(spark, customers, pickups, str(tmp_path), hot_rows=2)
    walk = registry.customer_crosswalk(spark, data).collect()
    assert sorted(spark.read.parquet(result.crosswalk).collect()) == sorted(walk)
    assert result.n_removed == sum(old != new for old, new in walk) > 0
    assert spark.read.parquet(result.customers).count() == customers.count() - result.n_removed
    moved = spark.read.parquet(result.pickups)
    assert moved.columns == pickups.columns
    assert sorted(moved.select("pickup_id", "customer_id").collect()) == sorted(
        registry.pickup_repointed(spark, data).collect()
    )


def test_merge_job_with_further_tables(spark, data, tmp_path, any_hot_rows):
    pickups, customers = inputs(spark, data)
    parcels = derived.view(spark, data, "parcel_input")
    expected = sorted(
        (r.row_id, r.column_name, r.customer_id or 0)
        for r in registry.references_repointed(spark, data).collect()
        if r.table_name == "parcels"
    )
    for salted in (False, True):
        result = merge_job.merge_to(
            spark, customers, pickups, f"{tmp_path}/{salted}", hot_rows=2, salted=salted,
            references={"parcels": (parcels, ["sender_id", "receiver_id"])},
        )
        moved = spark.read.parquet(result.references["parcels"])
        assert moved.columns == parcels.columns
        rows = [(r.parcel_id, c, r[c] or 0) for r in moved.collect() for c in ("sender_id", "receiver_id")]
        assert sorted(rows) == expected
    with pytest.raises(ValueError, match="cannot be called"):
        merge_job.merge_to(spark, customers, pickups, f"{tmp_path}/x", references={"lost": (parcels, ["sender_id"])}, hot_rows=2)


def test_command_line(spark, data, tmp_path):
    for name in ("pickup_input", "customer_input", "attachment_input", "header_input", "shipment_input"):
        derived.view(spark, data, name).write.parquet(f"{tmp_path}/{name}")
    where = ["--root", f"{tmp_path}/files", "--work", f"{tmp_path}/work", "--ledger"]
    sides = ["--pickups", f"{tmp_path}/pickup_input", "--customers", f"{tmp_path}/customer_input", "--out"]

    result = cli.run(
        spark,
        ["export-attachments", *where, f"{tmp_path}/l1", "--attachments", f"{tmp_path}/attachment_input",
         "--headers", f"{tmp_path}/header_input"],
    )
    assert result.files == result.planned > 0
    exported = result.files
    result = cli.run(
        spark, ["export-signatures", *where, f"{tmp_path}/l2", "--shipments", f"{tmp_path}/shipment_input"]
    )
    assert 0 < result.files < result.planned
    # The jobs may share a work folder; each records its own files only.
    assert result.recovered == 0
    assert spark.read.parquet(f"{tmp_path}/l2").count() == result.files
    before = spark.read.parquet(f"{tmp_path}/shipment_input")
    result = cli.run(
        spark,
        ["write-back-signatures", "--shipments", f"{tmp_path}/shipment_input", "--ledger", f"{tmp_path}/l2",
         "--out", f"{tmp_path}/after"],
    )
    assert result.exported == spark.read.parquet(f"{tmp_path}/l2").count()
    assert result.exported + result.kept == before.count() == spark.read.parquet(result.table).count()
    result = cli.run(
        spark,
        ["write-back-attachments", "--attachments", f"{tmp_path}/attachment_input", "--ledger", f"{tmp_path}/l1",
         "--out", f"{tmp_path}/after2"],
    )
    assert spark.read.parquet(result.table).filter("atchmnt_data is not null").count() == result.exported > 0
    (seen,) = cli.run(spark, ["progress", "--work", f"{tmp_path}/work", "--kind", "attachments"])
    assert (seen.state, seen.planned, seen.files) == ("closed", exported, exported)
    result = cli.run(spark, ["clean-addresses", *sides, f"{tmp_path}/clean", "--as-of", derived.AS_OF])
    assert result.n_reported == registry.overlong_report(spark, data).count()
    options = ["--months", "60", "--limits", "20", "20", "20"]
    wider = cli.run(spark, ["clean-addresses", *sides, f"{tmp_path}/wide", "--as-of", derived.AS_OF, *options])
    assert wider.n_reported > result.n_reported
    with pytest.raises(SystemExit):
        cli.run(spark, ["merge-customers", *sides, f"{tmp_path}/x", "--hot-rows", "10"])
    derived.view(spark, data, "parcel_input").write.parquet(f"{tmp_path}/parcels")
    further = ["--reference", "parcels", f"{tmp_path}/parcels", "sender_id,receiver_id"]
    result = cli.run(spark, ["--ignore-case", "merge-customers", *sides, f"{tmp_path}/merged", "--repaired", *further])
    assert result.n_removed > 0
    assert spark.read.parquet(result.references["parcels"]).count() == spark.read.parquet(f"{tmp_path}/parcels").count()


def test_recency_accepts_dates_and_text(spark, data):
    pickups, _ = inputs(spark, data)
    by_text = address.recent_pickups(pickups, "2001-08-01").count()
    assert by_text == address.recent_pickups(pickups, dt.date(2001, 8, 1)).count()


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = FakeContext(master, folder)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_shared_folder():
    assert session.shared_folder(FakeSession("yarn", "hdfs:///shared")) == "hdfs:///shared"
    fake = FakeSession("yarn", "hdfs:///shared")
    session.shared_folder(fake)
    assert fake.sparkContext.folder == "hdfs:///shared"
    assert session.shared_folder(FakeSession("yarn", None, "/mnt/x")) == "/mnt/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert session.shared_folder(local) == local.sparkContext.folder


def test_paths_are_those_of_spark(spark, tmp_path):
    assert session.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    before = configuration.get("fs.defaultFS")
    configuration.set("fs.defaultFS", "viewfs://cluster/")
    configuration.set("fs.viewfs.mounttable.cluster.link./x", f"file://{tmp_path}")
    try:
        assert session.qualified(spark, "/x/y") == "viewfs://cluster/x/y"
    finally:
        configuration.set("fs.defaultFS", before)


def test_local_folders_are_refused_on_a_cluster(spark, monkeypatch):
    class OnCluster:
        master = "yarn"
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    class Session:
        sparkContext = OnCluster

    with pytest.raises(ValueError, match="own disk"):
        session.qualified(Session, "file:///tmp/x")
    assert session.qualified(Session, "file:///tmp/x", shared_mount=True) == "file:/tmp/x"
