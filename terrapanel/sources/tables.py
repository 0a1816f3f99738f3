"""Views of the shared parquet tables in the shapes the operators expect.

The study's inputs are station-day weather readings, a station list with
coordinates, a place gazetteer, and yearly country indicators.  The driver's
tables (TPC-H-like) are mapped onto those shapes as follows:

* station-days  <- ``lineitem``  (one line = one station-day)
* stations      <- ``supplier`` joined with ``nation`` (coordinates, country)
* gazetteer     <- ``customer`` joined with ``nation`` (places with a country)
* indicators    <- ``orders`` joined with ``customer`` and ``nation``,
  rolled up by (nation, order year)

Every derived column is a deterministic expression of table columns, so the
same views can be written in plain SQL for the correctness checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.sources.files import GSOD_COLUMNS

# Fixed values of the fixture mapping (shared with the SQL checks).
PRCP_FLAG_LETTERS = "ABCDEFGHI "
INDICATOR_NAME = "Order value (thousands)"
INDICATOR_CODE = "ORD.VAL.K"
ISO_EXCLUDED_REGION = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grid_coordinate(key: str, mult: int, modulus: int, offset: float) -> F.Column:
    return (F.col(key) * mult % modulus) / 100.0 - offset


def station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station-day readings: station, obs_date, temp, prcp, prcp_flag, snow_depth."""
    return station_days_from(table(spark, sf_dir, "lineitem"))


def station_days_from(li: DataFrame, flag: str | None = None) -> DataFrame:
    """The station-day mapping over a lineitem frame (batch or streaming); ``flag`` names another column of flags."""
    days = _station_day_columns()
    return li.select(*days) if flag is None else li.select(*days, F.col(flag).alias("_other")).withColumn("prcp_flag", F.col("_other")).drop("_other")


def _station_day_columns() -> list[F.Column]:
    return [
        F.col("l_suppkey").alias("station"),
        F.to_date("l_shipdate").alias("obs_date"),
        (F.col("l_quantity") + 30.0).alias("temp"),
        F.when(F.col("l_discount") > 0.095, F.lit(99.9))
        .otherwise(F.round(F.col("l_discount") * 10.0, 2)).alias("prcp"),
        F.expr(f"substr('{PRCP_FLAG_LETTERS}', CAST(l_partkey % 10 AS INT) + 1, 1)").alias("prcp_flag"),
        F.when(F.col("l_tax") > 0.075, F.lit(999.9))
        .otherwise(F.round(F.col("l_tax") * 10.0, 2)).alias("snow_depth"),
    ]


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station list: station, latitude, longitude (blank for every 50th), country_code."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    blank = F.col("s_suppkey") % 50 == 0
    return sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
        F.col("s_suppkey").alias("station"),
        F.when(~blank, _grid_coordinate("s_suppkey", 7919, 18001, 90.0)).alias("latitude"),
        F.when(~blank, _grid_coordinate("s_suppkey", 104729, 36001, 180.0)).alias("longitude"),
        F.col("n_name").alias("country_code"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-days with the station's coordinates and country attached."""
    return station_days(spark, sf_dir).join(stations(spark, sf_dir), "station", "left")


#: The fixture's station-day files have this many keys of lines in turn, five of them malformed.
FILE_KEYS = 97


def station_day_file_fields(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Station-days as the padded text fields of the raw files, with ``year`` (the folder) and ``fault``.

    ``fault`` is the line's key modulo ``FILE_KEYS``: 1 an impossible date, 2 a temperature that is no
    number, 3 a blank station, 4 one field too few, 5 one too many, anything else a good line.

    With ``parts`` the readings are dealt to so many tasks, a station's month to one of them, and ordered by
    year while they are numbers: a write by year then need not sort the fields, which are several times as wide.
    """
    li = table(spark, sf_dir, "lineitem")
    fault = F.pmod(F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.lit(FILE_KEYS))
    days = li.select(*_station_day_columns(), fault.alias("fault"))
    rows = days.join(stations(spark, sf_dir), "station", "left").withColumn("year", F.year("obs_date"))
    if parts is not None:
        rows = rows.repartition(parts, "station", "year", F.month("obs_date")).sortWithinPartitions("year")

    def padded(c: str) -> F.Column:
        return F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("")), 6, " ") if c in ("temp", "prcp", "snow_depth") \
            else F.coalesce(F.col(c).cast("string"), F.lit(""))

    station = F.col("station").cast("string")
    fields = {
        "STATION": F.when(F.col("fault") == 3, F.lit(" ")).otherwise(station),
        "DATE": F.when(F.col("fault") == 1, F.lit("1999-02-30")).otherwise(F.date_format("obs_date", "yyyy-MM-dd")),
        "LATITUDE": padded("latitude"), "LONGITUDE": padded("longitude"),
        "NAME": F.concat(F.lit("STATION "), station, F.lit(", XX")),
        "TEMP": F.when(F.col("fault") == 2, F.lit("  n/a ")).otherwise(padded("temp")),
        "PRCP": padded("prcp"), "PRCP_ATTRIBUTES": F.col("prcp_flag"), "SNDP": padded("snow_depth"),
        "FRSHTT": F.lit("000000"),
    }
    return rows.select("fault", "year",
                       *[fields.get(c, F.lit("")).alias(c) for c in GSOD_COLUMNS])


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known places: place_id, latitude, longitude, cc (two-letter code stand-in)."""
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    return cust.join(nat, cust.c_nationkey == nat.n_nationkey).select(
        F.col("c_custkey").alias("place_id"),
        _grid_coordinate("c_custkey", 6131, 18001, 90.0).alias("latitude"),
        _grid_coordinate("c_custkey", 51137, 36001, 180.0).alias("longitude"),
        F.col("n_name").alias("cc"),
    )


def iso_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code dimension alpha_2 -> alpha_3; one region is left out so lookups can miss."""
    nat = table(spark, sf_dir, "nation")
    return nat.where(F.col("n_regionkey") != ISO_EXCLUDED_REGION).select(
        F.col("n_name").alias("alpha_2"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("alpha_3"),
    )


def _orders_by_nation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .join(nat, cust.c_nationkey == nat.n_nationkey)
        .select(
            "n_nationkey", "n_name", "o_orderstatus", "o_totalprice",
            F.year("o_orderdate").alias("year"),
        )
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly indicators per country: country_code, year, co2, energy, population."""
    base = _orders_by_nation_year(spark, sf_dir)
    status = F.col("o_orderstatus")
    price = F.col("o_totalprice")
    return base.groupBy(F.col("n_name").alias("country_code"), "year").agg(
        (F.avg(F.when(status == "F", price)) / 1000.0).alias("co2"),
        (F.avg(F.when(status == "O", price)) / 1000.0).alias("energy"),
        F.count(F.lit(1)).cast("double").alias("population"),
    )


def indicator_long(ind: DataFrame, value: str) -> DataFrame:
    """One indicator as a long table (country_code, year, value); gaps dropped."""
    return ind.select("country_code", "year", value).where(
        F.col(value).isNotNull() & ~F.isnan(value))


def indicator_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator with holes: country_name, country_id, year, value (NULL = gap)."""
    base = _orders_by_nation_year(spark, sf_dir)
    agg = base.groupBy("n_nationkey", "n_name", "year").agg(
        (F.avg("o_totalprice") / 1000.0).alias("value"))
    key = F.col("n_nationkey")
    year = F.col("year")
    gap = ((key * 7 + year * 3) % 5 == 0) | ((key % 8 == 3) & (year % 2 == 0))
    return agg.select(
        F.col("n_name").alias("country_name"),
        F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("country_id"),
        "year",
        F.when(~gap, F.col("value")).alias("value"),
    )


def order_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Calendar years spanned by the orders (min and max of one column)."""
    row = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    if row is None or row.lo is None:
        return []
    return list(range(row.lo.year, row.hi.year + 1))


def indicator_wide(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    """The gap table in the published wide layout: four id columns, then one column per year.

    The year columns are passed to ``pivot`` explicitly so Spark does not run
    a discovery job over the aggregated data.
    """
    if years is None:
        years = order_years(spark, sf_dir)
    gaps = indicator_gaps(spark, sf_dir)
    return (
        gaps.groupBy(
            F.col("country_name").alias("Country Name"),
            F.col("country_id").alias("Country Code"),
            F.lit(INDICATOR_NAME).alias("Indicator Name"),
            F.lit(INDICATOR_CODE).alias("Indicator Code"),
        )
        .pivot("year", years)
        .agg(F.first("value"))
    )


def country_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map points per country: code_3 (with surrounding blanks), Country, Latitude, Longitude.

    The point is the mean position of the country's gazetteer places.
    """
    g = gazetteer(spark, sf_dir)
    return g.groupBy("cc").agg(
        F.avg("latitude").alias("Latitude"), F.avg("longitude").alias("Longitude")
    ).select(F.concat(F.lit(" "), F.col("cc")).alias("code_3"), F.col("cc").alias("Country"),
             "Latitude", "Longitude")
