"""Readings laid out by year and bucketed, so that a year filter skips folders and the station join moves nothing.

Buckets are by station and month: a station's days are in twelve buckets, so one with a third of all
readings does not fill one task.  The station list is stored twelve times, once a month, in the same buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.sources.versions import SIZE

KEYS = ("station", "month")
YEAR = "year"
BUCKET_BYTES = 1024 ** 3


def bucket_count(listing: DataFrame, years: int, at_least: int = 8, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for files as listed by :func:`~terrapanel.sources.versions.input_files`: about ``bucket_bytes`` a bucket and year."""
    total = listing.agg(F.sum(SIZE).alias("n")).first()["n"] or 0
    return max(at_least, math.ceil(total / max(years, 1) / bucket_bytes))


def _bucketed(rows: DataFrame, table: str, path: str, buckets: int, partition: tuple[str, ...]) -> None:
    # The exchange deals as the buckets do, so each bucket (and year) is one file.
    writer = rows.repartition(buckets, *KEYS).write.mode("errorifexists").format("parquet").option("path", path)
    if partition:
        writer = writer.partitionBy(*partition)
    writer.bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)


def write_layout(readings: DataFrame, stations: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store ``readings`` (station, year, month, ...) and ``stations`` as tables ``<name>_readings`` and ``<name>_stations`` below ``path``.

    Readings without a station or a year are kept (a null year is a folder of its own); a null station meets no station.
    """
    kind = readings.schema["month"].dataType
    months = F.explode(F.sequence(F.lit(1).cast(kind), F.lit(12).cast(kind)))
    _bucketed(readings, f"{name}_readings", f"{path}/readings", buckets, (YEAR,))
    _bucketed(stations.withColumn("month", months), f"{name}_stations", f"{path}/stations", buckets, ())


def located_readings(spark: SparkSession, name: str, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Readings of the years asked for with their station's columns, without an exchange of either table."""
    readings = spark.table(f"{name}_readings")
    if first_year is not None:
        readings = readings.where(F.col(YEAR) >= first_year)
    if last_year is not None:
        readings = readings.where(F.col(YEAR) <= last_year)
    return readings.join(spark.table(f"{name}_stations"), list(KEYS))
