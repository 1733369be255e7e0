import pytest

from lading.plans import versions, writeback_job


@pytest.fixture
def name(spark):
    spark.sql("DROP VIEW IF EXISTS published_view_test")
    spark.sql("DROP TABLE IF EXISTS published_test")
    yield "published_test"
    spark.sql("DROP VIEW IF EXISTS published_view_test")
    spark.sql("DROP TABLE IF EXISTS published_test")


def shipments(spark, n):
    return spark.createDataFrame([(i, f"text{i}") for i in range(n)], "cour_delivery_id long, signature string")


def ledger(spark, path, ids):
    rows = spark.createDataFrame([(i, f"name{i}") for i in ids], "id long, document_name string")
    rows.selectExpr("id", "document_name", "timestamp'2020-01-01' migrated_at").write.parquet(path)


def test_table_moves_to_the_new_version_and_back(spark, tmp_path, name):
    shipments(spark, 6).write.parquet(f"{tmp_path}/v1")
    spark.sql(f"CREATE TABLE {name} (cour_delivery_id BIGINT, signature STRING) USING parquet LOCATION '{tmp_path}/v1'")
    ledger(spark, f"{tmp_path}/ledger", [1, 3])
    old = sorted(map(tuple, spark.table(name).collect()))
    reader = spark.table(name)
    other = spark.newSession()
    result = writeback_job.write_back_to(
        spark, spark.table(name), f"{tmp_path}/ledger", writeback_job.SIGNATURES, f"{tmp_path}/v2", publish=name
    )
    assert (result.exported, result.kept) == (2, 4)
    assert result.before.removeprefix("file:").replace("///", "/") == f"{tmp_path}/v1"
    # Who had planned before sees all of the old version; who plans now, all of the new one.
    assert sorted(map(tuple, reader.collect())) == old
    new = [(i, f"name{i}" if i in (1, 3) else f"text{i}") for i in range(6)]
    assert sorted(map(tuple, spark.table(name).collect())) == new
    assert sorted(map(tuple, other.table(name).collect())) == new
    versions.roll_back(spark, name)
    assert sorted(map(tuple, spark.table(name).collect())) == old
    # Back and forth: the version before is the new one now.
    versions.roll_back(spark, name)
    assert sorted(map(tuple, spark.table(name).collect())) == new


def test_view_takes_other_columns(spark, tmp_path, name):
    view = "published_view_test"
    base = spark.createDataFrame([(1, b"x"), (2, b"y")], "detain_hawb_id long, atchmnt_data binary")
    base.write.parquet(f"{tmp_path}/v1")
    ledger(spark, f"{tmp_path}/ledger", [2])
    assert versions.publish(spark, view, f"{tmp_path}/v1") is None
    writeback_job.write_back_to(
        spark, spark.table(view), f"{tmp_path}/ledger", writeback_job.ATTACHMENTS, f"{tmp_path}/v2", publish=view
    )
    rows = {r.detain_hawb_id: (r.atchmnt_data, r.atchmnt_data_bytes) for r in spark.table(view).collect()}
    assert rows == {1: (None, bytearray(b"x")), 2: ("name2", None)}
    versions.roll_back(spark, view)
    assert spark.table(view).columns == base.columns and spark.table(view).count() == 2


def test_refused(spark, tmp_path, name):
    shipments(spark, 2).write.parquet(f"{tmp_path}/v1")
    spark.sql(f"CREATE TABLE {name} (cour_delivery_id BIGINT) USING parquet LOCATION '{tmp_path}/v1'")
    with pytest.raises(ValueError, match="through a view"):
        versions.publish(spark, name, f"{tmp_path}/v1")
    with pytest.raises(ValueError, match="no version before"):
        versions.roll_back(spark, name)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} (a BIGINT, b BIGINT) USING parquet PARTITIONED BY (b) LOCATION '{tmp_path}/p'")
    with pytest.raises(ValueError, match="unpartitioned"):
        versions.publish(spark, name, f"{tmp_path}/v1")
    spark.sql(f"CREATE VIEW published_view_test AS SELECT * FROM {name}")
    with pytest.raises(ValueError, match="published path"):
        versions.publish(spark, "published_view_test", f"{tmp_path}/v1")
