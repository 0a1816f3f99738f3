"""Derived tables keyed by the files they were made from.

A version is a folder ``root/key/attempt`` with one or more Parquet tables; its ``_DONE`` mark is
created after all of them are written.  Readers look at marked versions only, nothing is renamed or overwritten: a writer
that is lost leaves an unmarked folder, and the version before stays what is read.  This also holds in
object stores, where a rename is not one step.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Collection, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE, SIZE, MODIFIED = "file", "size", "modified"
LOCATION = "location"
MARK = "_DONE"


def input_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The files at ``paths`` (folders or globs): file, location (to read it by), size, modified.  Contents are not read."""
    listed = spark.read.format("binaryFile").load(paths)
    return listed.select(F.col("_metadata.file_path").alias(FILE), F.col("path").alias(LOCATION),
                         F.col("_metadata.file_size").alias(SIZE), F.col("_metadata.file_modification_time").alias(MODIFIED))


def input_key(listing: DataFrame) -> str:
    """One key for a listing: another file, size or time gives another key, their order does not matter."""
    codes = [F.sum(F.xxhash64(F.lit(seed), FILE, SIZE, MODIFIED).cast("decimal(38,0)")) for seed in (1, 2)]
    return listing.agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)), *codes), 256).alias("key")).first()["key"]


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_state(spark: SparkSession, folder: str) -> str:
    """A key of the tables in ``folder`` (files, or folders of files with at most one level of partitions), without a job.

    Names, sizes and times come from the store's listing, one call a level, so it is cheap enough to ask before every use.
    """
    fs, _ = _hadoop(spark, folder)
    levels = [fs.globStatus(_hadoop(spark, folder + below)[1]) for below in ("/*", "/*/*", "/*/*/*")]
    listed = "".join(spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(found) for found in levels if found)
    # The time of the last reading is no part of the state.
    return hashlib.sha256(re.sub(r"access_time=\d+; ", "", listed).encode()).hexdigest()


def _marks(spark: SparkSession, pattern: str) -> list[tuple[int, str]]:
    """(time, version folder) of every marked version at ``pattern``, newest first."""
    fs, glob = _hadoop(spark, f"{pattern}/{MARK}")
    found = fs.globStatus(glob)
    return sorted(((s.getModificationTime(), s.getPath().getParent().toString()) for s in found or ()), reverse=True)


def version_of(spark: SparkSession, root: str, key: str) -> str | None:
    """Folder of the version made for ``key``, if there is a whole one."""
    marks = _marks(spark, f"{root}/{key}/*")
    return marks[0][1] if marks else None


def latest(spark: SparkSession, root: str) -> str | None:
    """Folder of the version published last, whatever its key."""
    marks = _marks(spark, f"{root}/*/*")
    return marks[0][1] if marks else None


def publish(spark: SparkSession, root: str, key: str, tables: dict[str, DataFrame]) -> str:
    """Write ``tables`` as a new version for ``key`` and mark it; returns its folder."""
    folder = f"{root}/{key}/{uuid4().hex}"
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{folder}/{name}")
    fs, mark = _hadoop(spark, f"{folder}/{MARK}")
    fs.create(mark, False).close()
    return fs.makeQualified(mark).getParent().toString()


def published(spark: SparkSession, root: str, paths: str | Sequence[str], name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` made by ``build`` from the files at ``paths``: read if they are as they were, else made anew."""
    key = input_key(input_files(spark, paths))
    folder = version_of(spark, f"{root}/{name}", key) or publish(spark, f"{root}/{name}", key, {name: build()})
    return spark.read.parquet(f"{folder}/{name}")


def clean_up(spark: SparkSession, root: str, keep: Collection[str]) -> list[str]:
    """Delete all versions, whole or not, whose folder is not in ``keep``; returns what went.

    For one caretaker at a time, while nobody publishes: an unmarked folder may be a version in the making.
    """
    fs, glob = _hadoop(spark, f"{root}/*/*")
    kept = {_hadoop(spark, folder)[1].toUri().getPath() for folder in keep}
    gone = [s.getPath() for s in fs.globStatus(glob) or () if s.getPath().toUri().getPath() not in kept]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.toString() for p in gone)
