"""Makes the ``blobfiles`` sink known to a session."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import SparkSession

from lading.sources import blobfiles


def register_blobfiles(spark: SparkSession) -> None:
    # By value, so that executors need pyarrow but not this package.
    cloudpickle.register_pickle_by_value(blobfiles)
    spark.dataSource.register(blobfiles.BlobFilesDataSource)
