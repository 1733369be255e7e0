"""Schemas of the base tables and a reader that brings a source into that shape."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PICKUP = T.StructType(
    [
        T.StructField("pickup_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("pickup_address", T.StringType()),
        T.StructField("pickup_town", T.StringType()),
        T.StructField("created_date", T.TimestampType()),
    ]
)
CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("town", T.StringType()),
    ]
)
DETAINED_HAWB = T.StructType(
    [
        T.StructField("detain_hawb_id", T.LongType()),
        T.StructField("created_date", T.TimestampType()),
    ]
)
DETAINED_HAWB_ATCH = T.StructType(
    [
        T.StructField("detain_hawb_id", T.LongType()),
        T.StructField("atch_is_printed", T.StringType()),
        T.StructField("atchmnt_name", T.StringType()),
        T.StructField("atchmnt_data", T.BinaryType()),
    ]
)
SHIPMENT_DELIVERY_COURIER = T.StructType(
    [
        T.StructField("cour_delivery_id", T.LongType()),
        T.StructField("created_date", T.TimestampType()),
        T.StructField("rec_status", T.StringType()),
        T.StructField("signature", T.StringType()),
    ]
)
LEDGER = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("document_name", T.StringType(), False),
        T.StructField("migrated_at", T.TimestampType(), False),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the schema's columns.

    Names match without regard to case and underscores, so a table with
    ``CourDeliveryId`` fits ``cour_delivery_id``. Other columns are dropped, which
    is what prunes them from the scan.
    """
    by_name = {name.replace("_", "").lower(): name for name in df.columns}
    columns = []
    for field in schema.fields:
        source = by_name.get(field.name.replace("_", "").lower())
        if source is None:
            raise ValueError(f"column {field.name} is missing; found {df.columns}")
        columns.append(F.col(f"`{source}`").cast(field.dataType).alias(field.name))
    return df.select(*columns)


def equal_depth_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """At most ``parts`` - 1 ascending values of ``column`` that cut ``keys`` into parts of about equal size.

    ``keys`` may be a sample. Percentiles are approximate, to one in ``accuracy``. A value with
    more rows than a part needs gives fewer parts.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, shares, accuracy)).first()[0]
    # The first cut must leave rows below it.
    least = keys.agg(F.min(column)).first()[0]
    return sorted({value for value in found or [] if value != least})


def range_predicates(column: str, bounds: list) -> list[str]:
    """SQL conditions, of which every row fulfils exactly one: below, between and from ``bounds`` on.

    Rows without the key belong to the first.
    """

    def literal(value) -> str:
        if isinstance(value, bool) or not isinstance(value, int | float | decimal.Decimal):
            quoted = str(value).replace("'", "''")
            return f"'{quoted}'"
        return str(value)

    if not bounds:
        return ["1 = 1"]
    cuts = [literal(value) for value in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    schema: T.StructType,
    url: str,
    dbtable: str,
    column: str,
    parts: int,
    sample: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table over JDBC in ``parts`` ranges of ``column`` that hold about equally many rows.

    The ranges come from the keys that the query ``sample`` gives (all keys without it), read by one task;
    with evenly spaced bounds, one range of a skewed key can hold most of the table.
    """
    query = sample or f"SELECT {column} FROM {dbtable}"
    properties = properties or {}
    keys = spark.read.jdbc(url, f"({query}) lading_keys", properties=properties)
    bounds = equal_depth_bounds(keys, keys.columns[0], parts)
    found = spark.read.jdbc(url, dbtable, predicates=range_predicates(column, bounds), properties=properties)
    return conform(found, schema)


def read_table(
    spark: SparkSession, schema: T.StructType, path: str | None = None, format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Read a base table from files, a catalog table (``format="table"``) or a source such as JDBC.

    For JDBC give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``; otherwise one task reads the whole table. ``read_jdbc`` finds the bounds itself.
    """
    if format == "table":
        return conform(spark.table(path), schema)
    if format == "jdbc" and "partitionColumn" not in options:
        raise ValueError("a JDBC read needs partitionColumn, lowerBound, upperBound, numPartitions")
    reader = spark.read.format(format).options(**options)
    return conform(reader.load(path) if path else reader.load(), schema)
