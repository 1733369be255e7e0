"""Putting a new version of a table in place of the old one, in one catalog change, and back.

What readers name is a pointer in the catalog: the location of an unpartitioned Parquet table, or a
view of one path. Moving it is a single catalog operation; a reader sees the files
of the old version or of the new one. The version before stays where it is and is remembered as
a property of the pointer.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lading.session import qualified

_PREVIOUS = "lading.previous"
_CURRENT = "lading.current"


def publish(spark: SparkSession, name: str, path: str) -> str | None:
    """Let ``name`` stand for the Parquet table at ``path``; returns the path it stood for.

    A table keeps its declared columns, so the new version must have the same. A view takes any; where there
    is nothing of that name yet, a view is created. An exported binary payload becomes a column of
    names and one of bytes, so such tables are published through a view.
    """
    path = qualified(spark, path, shared_mount=True)
    if not spark.catalog.tableExists(name):
        _view(spark, name, path, None)
        return None
    details = _details(spark, name)
    if details["Type"] == "VIEW":
        before = _properties(spark, name).get(_CURRENT)
        if before is None:
            raise ValueError(f"{name} is a view of something else than a published path")
        _view(spark, name, path, before)
        return before
    if details.get("Provider", "").lower() != "parquet" or "Partition Provider" in details or "# Partition Information" in details:
        raise ValueError(f"{name} is no unpartitioned Parquet table")
    new, declared = spark.read.parquet(path).dtypes, spark.table(name).dtypes
    if new != declared:
        raise ValueError(f"{name} declares {declared}, the new version has {new}; publish it through a view")
    before = details["Location"]
    # If only the first of both happens, rolling back changes nothing.
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PREVIOUS}' = {_quoted(before)})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(name)
    return before


def roll_back(spark: SparkSession, name: str) -> str:
    """Let ``name`` stand for the version before again; the path of that one is returned."""
    before = _properties(spark, name).get(_PREVIOUS)
    if not before:
        raise ValueError(f"{name} has no version before")
    publish(spark, name, before)
    return before


def _view(spark: SparkSession, name: str, path: str, before: str | None) -> None:
    # The path goes between backticks, where a backtick is written twice.
    source = path.replace("`", "``")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES "
        f"('{_CURRENT}' = {_quoted(path)}, '{_PREVIOUS}' = {_quoted(before or '')}) "
        f"AS SELECT * FROM parquet.`{source}`"
    )


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
