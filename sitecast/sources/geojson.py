"""Point features in GeoJSON, and the choice of points by box and tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = (
    "struct<type: string, "
    "properties: struct<amenity: string, tourism: string, shop: string, name: string>, "
    "geometry: struct<type: string, coordinates: array<double>>>"
)

# The default search box (degrees) and the wanted tags.
DEFAULT_BOX = {"north": 31.240, "south": 31.180, "east": 121.540, "west": 121.460}
DEFAULT_TAGS = {
    "amenity": ["restaurant", "cafe", "hospital", "school", "bank", "hotel", "pharmacy", "parking"],
    "tourism": ["hotel", "attraction", "museum"],
    "shop": ["supermarket", "mall", "convenience"],
}


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(amenity, tourism, shop, name, lat, lon)`` of the point features.

    One feature per line, alone or inside a ``FeatureCollection`` that puts each on
    a line of its own: the comma between features is cut off, the wrapper's lines
    are no features.  Either way Spark splits the file by lines.
    """
    line = F.regexp_replace(F.trim("value"), ",$", "")
    features = spark.read.text(path).filter(line.startswith("{") & line.endswith("}")).select(F.from_json(line, FEATURE).alias("f"))
    return features.filter(F.col("f.geometry.type") == "Point").select(
        "f.properties.amenity",
        "f.properties.tourism",
        "f.properties.shop",
        "f.properties.name",
        F.col("f.geometry.coordinates")[1].alias("lat"),
        F.col("f.geometry.coordinates")[0].alias("lon"),
    )


def write_geojson(df: DataFrame, path: str, lat: str = "lat", lon: str = "lon") -> str:
    """One point feature per line; all columns but the coordinates are properties."""
    props = [c for c in df.columns if c not in (lat, lon)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*props).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
    )
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)
    return path


def select_pois(
    df: DataFrame,
    box: dict[str, float] = DEFAULT_BOX,
    tags: dict[str, list[str]] = DEFAULT_TAGS,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Points inside the box that carry a wanted value under any tag."""
    present = [F.col(k).isin(v) for k, v in tags.items() if k in df.columns]
    wanted = reduce(lambda a, b: a | b, present, F.lit(False))
    return df.filter(
        F.col(lat).between(box["south"], box["north"]) & F.col(lon).between(box["west"], box["east"]) & wanted
    )
