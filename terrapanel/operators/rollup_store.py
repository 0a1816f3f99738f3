"""One stored roll-up of the readings from which the yearly and the monthly series both come.

Readings are summed once, per (file, station, position, year, month).  The sums are a published version
(:mod:`terrapanel.sources.versions`) beside the list of files they cover.  An update reads only files that are
new or changed; sums of files that are as they were are taken over, those of changed or vanished files go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.operators.clean import clean_observations
from terrapanel.operators.panel import _finish, _partial_sums
from terrapanel.sources import files, versions
from terrapanel.sources.versions import FILE, LOCATION, MODIFIED, SIZE

GRAIN = [FILE, "station", "latitude", "longitude", "year", "month"]
SUMS, FILES = "sums", "files"
Reader = Callable[[SparkSession, Sequence[str], str], DataFrame]


@dataclass(frozen=True)
class Update:
    """Where the version is, and which files were read for it."""

    folder: str
    read: tuple[str, ...]


def update(spark: SparkSession, root: str, paths: str | Sequence[str], read: Reader = files.read_observations) -> Update:
    """Bring the store at ``root`` to the files at ``paths`` and publish it.

    ``read(spark, locations, column)`` gives their readings with the file's name in ``column``.
    The driver holds the names of the files to read, as Spark's own scan of them does.
    No files at all is an error: it is more often a wrong path than an empty store.
    """
    listing = versions.input_files(spark, paths)
    key = versions.input_key(listing)
    done = versions.version_of(spark, root, key)
    if done:
        return Update(done, ())
    before = versions.latest(spark, root)
    todo, kept = listing, None
    if before:
        same = [FILE, SIZE, MODIFIED]
        known = spark.read.parquet(f"{before}/{FILES}")
        todo = listing.join(known, same, "left_anti")
        unchanged = known.join(listing, same, "left_semi").select(FILE)
        kept = spark.read.parquet(f"{before}/{SUMS}").join(unchanged, FILE, "left_semi")
    locations = sorted(row[LOCATION] for row in todo.select(LOCATION).collect())
    if not locations and kept is None:
        raise ValueError(f"no files at {paths}")
    sums = kept
    if locations:
        new = _partial_sums(clean_observations(read(spark, locations, FILE)), GRAIN)
        sums = new if kept is None else kept.unionByName(new)
    folder = versions.publish(spark, root, key, {SUMS: sums, FILES: listing})
    return Update(folder, tuple(locations))


def sums_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{SUMS}")


def country_years(sums: DataFrame, stations: DataFrame, key: str = "country_code") -> DataFrame:
    """Per (key, year): means, total snow and count of readings that have a position and a known station."""
    located = sums.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _finish(located.join(stations.select("station", key), "station"), [key, "year"])


def months(sums: DataFrame) -> DataFrame:
    """Per (year, month): means, total snow and count over all readings."""
    return _finish(sums, ["year", "month"])
