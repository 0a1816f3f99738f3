"""Map-ready point table: code merge, emission classes, popups, cell clusters, GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the studied scripts): class limits on average CO2,
# marker radius, outline colour and fill opacity, popup wording.
GREEN_BELOW = 2.0
ORANGE_BELOW = 10.0
RADIUS = 5
OUTLINE = "grey"
FILL_OPACITY = 0.7
POPUP_TEMPLATE = "Country : %s<br>\n                    Average co2 emission(kt) : %s<br>"


def code_merge(points: DataFrame, values: DataFrame, key: str = "code_3") -> DataFrame:
    """Inner join of two tables on a code with surrounding blanks trimmed on both sides."""
    left = points.withColumn(key, F.trim(key))
    right = values.withColumn(key, F.trim(key))
    return left.join(right, key, "inner")


def emission_class(co2: Column | str) -> Column:
    """'green' below 2, 'orange' from 2 to below 10, otherwise (also NULL/NaN) 'red'."""
    co2 = F.col(co2) if isinstance(co2, str) else co2
    return (F.when(co2 < GREEN_BELOW, "green")
            .when((co2 >= GREEN_BELOW) & (co2 < ORANGE_BELOW), "orange")
            .otherwise("red"))


def popup_text(country: Column | str, co2: Column | str) -> Column:
    """Popup text; the average is printed in its shortest round-trip form
    (Spark switches to E-notation from 1e7 and below 1e-3)."""
    co2 = F.col(co2) if isinstance(co2, str) else co2
    return F.format_string(POPUP_TEMPLATE, country, co2.cast("string"))


def point_features(merged: DataFrame, name: str = "Country", co2: str = "co2") -> DataFrame:
    """One marker per row: position, radius, popup, fill colour, outline, opacity."""
    return merged.select(
        "code_3",
        F.col(name).alias("country"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        F.lit(RADIUS).cast("long").alias("radius"),
        popup_text(name, co2).alias("popup"),
        emission_class(co2).alias("fill_color"),
        F.lit(OUTLINE).alias("color"),
        F.lit(FILL_OPACITY).alias("fill_opacity"),
    )


def grid_cells(points: DataFrame, cell_deg: float, lat: str = "latitude",
               lon: str = "longitude") -> DataFrame:
    """Cluster markers into lat/lon grid cells: count and centroid per cell."""
    return points.groupBy(
        F.floor(F.col(lat) / cell_deg).alias("cell_lat"),
        F.floor(F.col(lon) / cell_deg).alias("cell_lon"),
    ).agg(F.count(F.lit(1)).alias("n_points"),
          F.avg(lat).alias("centroid_lat"), F.avg(lon).alias("centroid_lon"))


#: Finest zoom of the pyramid: 2**ZOOM cells around the globe, as many from pole to pole.
ZOOM = 8


def cell_pyramid(points: DataFrame, zoom: int = ZOOM, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Marker groups of every zoom level: zoom, cell_x, cell_y, n_points, centroid_lat, centroid_lon.

    At level z a cell is 360/2**z degrees wide and 180/2**z high, counted from 180 west and 90 south; the far edges belong to
    the last cell.  Points are summed into the finest cells first, and only those are merged upwards: a cell's path
    is its quarter at each level, the levels are a rollup over that path.  Points without a position (null, NaN or off
    the globe) are on no map and left out.
    """
    side = 2 ** zoom

    def index(c: str, span: float) -> Column:
        return F.least(F.floor((F.col(c) + span / 2) / span * side), F.lit(side - 1)).cast("long")

    placed = points.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))
    finest = placed.groupBy(index(lon, 360.0).alias("_x"), index(lat, 180.0).alias("_y")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(lat).alias("_lat"), F.sum(lon).alias("_lon"))
    path = [(F.shiftright("_x", zoom - z) % 2 * 2 + F.shiftright("_y", zoom - z) % 2).alias(f"_q{z}") for z in range(1, zoom + 1)]
    quarters = [f"_q{z}" for z in range(1, zoom + 1)]
    levels = finest.select("*", *path).rollup(*quarters).agg(
        F.bit_count(F.grouping_id()).alias("_up"), F.min("_x").alias("_x"), F.min("_y").alias("_y"),
        F.sum("_n").alias("n_points"), F.sum("_lat").alias("_lat"), F.sum("_lon").alias("_lon"))
    return levels.where(F.col("n_points").isNotNull()).select(
        (zoom - F.col("_up")).cast("long").alias("zoom"), F.expr("shiftright(_x, _up)").alias("cell_x"), F.expr("shiftright(_y, _up)").alias("cell_y"),
        "n_points", (F.col("_lat") / F.col("n_points")).alias("centroid_lat"), (F.col("_lon") / F.col("n_points")).alias("centroid_lon"))


def to_geojson(features: DataFrame) -> DataFrame:
    """One GeoJSON Feature (JSON text) per marker row, in a column ``feature``."""
    props = [c for c in features.columns if c not in ("latitude", "longitude")]
    return features.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
        F.struct(*props).alias("properties"),
    )).alias("feature"))


def write_geojson_lines(features: DataFrame, path: str) -> None:
    """Write features as newline-delimited GeoJSON text files."""
    to_geojson(features).write.mode("overwrite").text(path)
