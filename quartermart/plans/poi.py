"""POI dimension cleaning (raw POI -> dwd POI).

Narrow transformations only (no shuffle) up to the optional dedupe:
required columns -> text to double -> bounding box -> label fill -> label
array -> region rule -> category rule -> projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.rules import (DEFAULT_CATEGORY_RULES, DEFAULT_REGION_RULES,
                                         CategoryRules, RegionRules)
from quartermart.operators import clean

POI_COLUMNS = ["poi_id", "name", "city", "latitude", "longitude", "label", "category", "region"]


def prepared_poi(ods_poi: DataFrame,
                 lat_range: tuple[float, float] = K.LATITUDE_RANGE,
                 lon_range: tuple[float, float] = K.LONGITUDE_RANGE,
                 no_label: str = K.NO_LABEL) -> DataFrame:
    """Required columns, numeric coordinates inside the box, label filled."""
    df = ods_poi.select("poi_id", "name_zh", "city_zh", "latitude", "longitude", "label_zh")
    df = clean.require(df, ["poi_id", "name_zh", "city_zh", "latitude", "longitude"])
    df = clean.to_double(df, ["latitude", "longitude"])
    df = clean.in_range(df, {"latitude": lat_range, "longitude": lon_range})
    return clean.fill(df, {"label_zh": no_label})


def classify(df: DataFrame, regions: RegionRules = DEFAULT_REGION_RULES,
             categories: CategoryRules = DEFAULT_CATEGORY_RULES) -> DataFrame:
    return (df.withColumn("label", F.split(F.col("label_zh"), K.LIST_SEPARATOR, -1))
              .withColumn("region", regions.column("latitude", "longitude"))
              .withColumn("category", categories.column("label_zh")))


def clean_poi(ods_poi: DataFrame,
              regions: RegionRules = DEFAULT_REGION_RULES,
              categories: CategoryRules = DEFAULT_CATEGORY_RULES,
              lat_range: tuple[float, float] = K.LATITUDE_RANGE,
              lon_range: tuple[float, float] = K.LONGITUDE_RANGE,
              unique: bool = True) -> DataFrame:
    """Clean POI dimension with columns :data:`POI_COLUMNS`.

    ``unique=True`` keeps one row per ``poi_id`` (the smallest row), so a
    repeated id in the raw file cannot multiply fact rows in later joins.
    """
    df = classify(prepared_poi(ods_poi, lat_range, lon_range, categories.no_label), regions, categories)
    out = df.select("poi_id", F.col("name_zh").alias("name"), F.col("city_zh").alias("city"),
                    "latitude", "longitude", "label", "category", "region")
    return clean.dedupe_rows(out, ["poi_id"]) if unique else out


def rejected_regions(ods_poi: DataFrame, regions: RegionRules = DEFAULT_REGION_RULES,
                     categories: CategoryRules = DEFAULT_CATEGORY_RULES) -> DataFrame:
    """POIs left without a region (the quality report; empty while the rules end in a default)."""
    df = classify(prepared_poi(ods_poi, no_label=categories.no_label), regions, categories)
    return df.filter(F.col("region").isNull()).select("poi_id", "name_zh", "latitude", "longitude")
