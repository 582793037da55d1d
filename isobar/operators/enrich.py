"""Dimension join (J1) with fallback naming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions.columns import UNKNOWN_STATE, coordinate_label

def attach_locations(
    df: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """J1 + P6: left join on exact (latitude, longitude) equality.

    Adds ``location_name``, ``state``, ``city``; unmatched coordinates fall back to the
    ``lat_lon`` text (name, city) and ``UNKNOWN`` (state). The fact's own coordinates
    and timezone are kept. A duplicated coordinate pair in the dimension fans out, as
    in the reference (its uniqueness is a data-quality rule, not a join property). Spark
    broadcasts the dimension if its bytes are under the session's threshold.
    """
    dim = locations.select(
        F.col("latitude").alias("_dim_lat"),
        F.col("longitude").alias("_dim_lon"),
        F.col("location_name").alias("_dim_name"),
        F.col("state").alias("_dim_state"),
        F.col("city").alias("_dim_city"),
    )
    joined = df.join(
        dim,
        (df["latitude"] == dim["_dim_lat"]) & (df["longitude"] == dim["_dim_lon"]),
        "left",
    )
    label = coordinate_label(F.col("latitude"), F.col("longitude"))
    return joined.withColumns(
        {
            "location_name": F.coalesce(F.col("_dim_name"), label),
            "state": F.coalesce(F.col("_dim_state"), F.lit(UNKNOWN_STATE)),
            "city": F.coalesce(F.col("_dim_city"), label),
        }
    ).drop("_dim_lat", "_dim_lon", "_dim_name", "_dim_state", "_dim_city")
