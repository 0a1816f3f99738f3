"""Incremental country/year roll-up with Structured Streaming.

New station-day files are picked up as they land; each micro-batch is
cleaned with the same expressions as the batch path, joined to the static
station table (stream-static join), and folded into running sums per
(country, year).  The state is bounded by countries x years, whatever the
number of readings.  Every micro-batch writes the complete current result
to a table in the shared folder, and progress lives in a checkpoint there,
so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.operators.clean import clean_observations, with_coordinates
from terrapanel.session import checkpoint_dir
from terrapanel.sources import tables


def read_station_day_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Station-day readings as a stream over the lineitem files of ``sf_dir``."""
    schema = tables.table(spark, sf_dir, "lineitem").schema
    raw = (spark.readStream.schema(schema).format("parquet")
           .option("maxFilesPerTrigger", files_per_trigger)
           .load(f"{sf_dir}/lineitem*.parquet"))
    return tables.station_days_from(raw)


def running_country_year(days: DataFrame, stations: DataFrame, key: str = "country_code") -> DataFrame:
    """Streaming aggregate of running sums per (key, year) for readings with coordinates."""
    clean = clean_observations(days)
    located = with_coordinates(stations).select("station", key)
    joined = clean.join(located, "station")
    return joined.groupBy(key, "year").agg(
        F.sum("temperature").alias("_sum_t"), F.count("temperature").alias("_n_t"),
        F.sum("precipitation").alias("_sum_p"), F.count("precipitation").alias("_n_p"),
        F.sum("snow").alias("snow"), F.count(F.lit(1)).alias("n_obs"))


def finish_running(sums: DataFrame, key: str = "country_code") -> DataFrame:
    """Means from running sums (applied to each complete micro-batch result)."""
    return sums.select(
        key, "year",
        (F.col("_sum_t") / F.col("_n_t")).alias("temperature"),
        (F.col("_sum_p") / F.col("_n_p")).alias("precipitation"),
        "snow", "n_obs")


def run_country_year_stream(
    spark: SparkSession,
    sf_dir: str,
    out_path: str | None = None,
    checkpoint_location: str | None = None,
    state_partitions: int | None = None,
) -> str:
    """Run the roll-up over all files available now; return the result table path.

    The aggregation state holds one row per (country, year) whatever the input
    volume (partial sums are combined map-side before the shuffle).  Spark
    fixes its partitions from the session setting when the query first
    starts; ``state_partitions`` replaces that setting for the start only.
    """
    base = os.path.join(checkpoint_dir(spark), "streams", f"country_year-{uuid.uuid4().hex}")
    out_path = out_path or os.path.join(base, "table")
    checkpoint_location = checkpoint_location or os.path.join(base, "progress")
    sums = running_country_year(read_station_day_stream(spark, sf_dir), tables.stations(spark, sf_dir))

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        finish_running(batch).write.mode("overwrite").parquet(out_path)

    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = (sums.writeStream.outputMode("complete").foreachBatch(write_batch)
                 .option("checkpointLocation", checkpoint_location)
                 .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    query.awaitTermination()
    return out_path
