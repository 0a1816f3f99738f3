"""CSV sources and sinks of the study's raw files.

* station-day files (malformed records go to a rejects table with their reason): one CSV per station and year, header in every file,
  every field quoted, numbers padded with blanks inside the quotes;
  often laid out one directory per year (``.../1960/*.csv``).
* indicator files in the published wide layout (country name/code,
  indicator name/code, one column per year) and the long layout the
  cleaning step writes (country name, code, year, value).

Schemas are explicit (no inference pass over the data).  A padded ``" 99.9"`` arrives as 99.9; a
garbage value rejects its station-day record and is NULL in an indicator file, and never fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the daily station summary files, in file order.
GSOD_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "TEMP", "TEMP_ATTRIBUTES",
    "DEWP", "DEWP_ATTRIBUTES", "SLP", "SLP_ATTRIBUTES", "STP", "STP_ATTRIBUTES", "VISIB",
    "VISIB_ATTRIBUTES", "WDSP", "WDSP_ATTRIBUTES", "MXSPD", "GUST", "MAX", "MAX_ATTRIBUTES",
    "MIN", "MIN_ATTRIBUTES", "PRCP", "PRCP_ATTRIBUTES", "SNDP", "FRSHTT",
]
WIDE_IDS = ["Country Name", "Country Code", "Indicator Name", "Indicator Code"]


def _csv(spark: SparkSession, schema: T.StructType | None = None):
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", True).option("mode", "PERMISSIVE"))
    return reader.schema(schema) if schema is not None else reader


RECORD, REASON = "record", "reason"
_RAW = "_corrupt_record"


def _reject_reason() -> F.Column:
    """Why a record of a station-day file can't be used; null for a good one.  The first reason that holds is told."""
    reason = F.when(F.col(_RAW).isNotNull(), F.lit("fields"))
    reason = reason.when(F.coalesce(F.trim("STATION"), F.lit("")) == "", F.lit("station"))
    reason = reason.when(F.try_to_date(F.trim("DATE"), "yyyy-MM-dd").isNull(), F.lit("date"))
    for name in ("LATITUDE", "LONGITUDE", "TEMP", "PRCP", "SNDP"):
        text = F.trim(name)
        reason = reason.when((text != "") & text.try_cast("double").isNull(), F.lit(f"number: {name}"))
    return reason


def read_observation_records(spark: SparkSession, path: str | Sequence[str], file_column: str | None = None) -> DataFrame:
    """All records of station-day files in one scan: the columns of :func:`read_observations`, ``reason`` and ``record``.

    Every field is read as text, so a record is judged here and not nulled by the reader: ``reason`` is
    'fields' (too few or too many of them, or an open quote), 'station' (blank), 'date' (no such day), 'number: NAME'
    (neither blank nor a number), or null for a good record.  A blank number is a good record with a null.
    ``record`` is the rejected line, as it was for 'fields', else its fields joined by commas.
    ``file_column`` adds the name of the record's file.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in GSOD_COLUMNS] + [T.StructField(_RAW, T.StringType())])
    # Fields are counted only where all of them are parsed.
    raw = _csv(spark, schema).option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False).csv(path)
    raw = raw.withColumn(REASON, _reject_reason())
    number = {c: F.trim(c).try_cast("double") for c in ("LATITUDE", "LONGITUDE", "TEMP", "PRCP", "SNDP")}
    line = F.coalesce(F.col(_RAW), F.array_join(F.array(*GSOD_COLUMNS), ",", ""))
    return raw.select(
        F.trim("STATION").alias("station"),
        F.try_to_date(F.trim("DATE"), "yyyy-MM-dd").alias("obs_date"),
        number["LATITUDE"].alias("latitude"),
        number["LONGITUDE"].alias("longitude"),
        number["TEMP"].alias("temp"),
        number["PRCP"].alias("prcp"),
        F.col("PRCP_ATTRIBUTES").alias("prcp_flag"),
        number["SNDP"].alias("snow_depth"),
        REASON,
        F.when(F.col(REASON).isNotNull(), line).alias(RECORD),
        *([F.col("_metadata.file_path").alias(file_column)] if file_column else []),
    )


def read_observations(spark: SparkSession, path: str | Sequence[str], file_column: str | None = None) -> DataFrame:
    """Station-day readings: station, obs_date, latitude, longitude, temp, prcp, prcp_flag, snow_depth.

    ``path`` may be a glob over year directories; the header line of every
    file is skipped by the reader.  Records that can't be used are left out here and returned, with
    the reason, by :func:`read_observation_rejects`.
    """
    return read_observation_records(spark, path, file_column).where(F.col(REASON).isNull()).drop(REASON, RECORD)


def read_observation_rejects(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records left out by :func:`read_observations`: station, reason, record."""
    return read_observation_records(spark, path).where(F.col(REASON).isNotNull()).select("station", REASON, RECORD)


def read_indicator_wide(spark: SparkSession, path: str) -> DataFrame:
    """Wide indicator CSV; every year column becomes a double (unparsable -> NULL)."""
    raw = _csv(spark).csv(path)
    years = [c for c in raw.columns if c not in WIDE_IDS and c.strip().isdigit()]
    return raw.select(*[F.col(f"`{c}`") for c in WIDE_IDS if c in raw.columns],
                      *[F.col(f"`{c}`").try_cast("double").alias(c.strip()) for c in years])


def read_indicator_long(spark: SparkSession, path: str, value_name: str) -> DataFrame:
    """Long indicator CSV (Country Name, Country Code, Year, value) as (country_code, year, value)."""
    schema = T.StructType([
        T.StructField("Country Name", T.StringType()), T.StructField("Country Code", T.StringType()),
        T.StructField("Year", T.StringType()), T.StructField(value_name, T.StringType())])
    raw = _csv(spark, schema).csv(path)
    return raw.select(
        F.trim("Country Code").alias("country_code"),
        F.col("Year").try_cast("int").alias("year"),
        F.col(f"`{value_name}`").try_cast("double").alias(value_name.lower()),
    )


def read_map_inputs(spark: SparkSession, points_path: str, values_path: str) -> tuple[DataFrame, DataFrame]:
    """The two map inputs: country points (code_3, Country, Latitude, Longitude) and
    per-country values (code_3, co2).  Codes may carry surrounding blanks; the
    merge trims them (:func:`terrapanel.operators.mapout.code_merge`)."""
    points = _csv(spark).csv(points_path)
    points = points.select("code_3", "Country",
                           F.col("Latitude").try_cast("double").alias("Latitude"),
                           F.col("Longitude").try_cast("double").alias("Longitude"))
    values = _csv(spark).csv(values_path)
    values = values.select("code_3", F.col("co2").try_cast("double").alias("co2"))
    return points, values


def write_station_day_files(fields: DataFrame, path: str, year: str = "year", compression: str = "none") -> None:
    """Text fields as station-day files: a folder for each ``year``, a header in each file, every field quoted, padding kept.

    Rows that come ordered by ``year`` are written as they come; others are sorted by it.
    """
    (fields.write.mode("errorifexists").partitionBy(year).option("header", True).option("quoteAll", True).option("escape", '"')
     .option("compression", compression)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV with a header line (no index column), replacing ``path``."""
    writer = df.write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
