"""Geographic points as structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def geo_point(longitude: Column, latitude: Column) -> Column:
    """``struct<lon, lat>``; null when either part is null.

    A latitude outside [-90, 90] is an error; a longitude is brought into
    [-180, 180] by full turns.
    """
    lon = longitude.cast("double")
    lat = latitude.cast("double")
    turned = F.when(F.abs(lon) <= 180, lon).otherwise(F.pmod(lon + 180, F.lit(360.0)) - 180)
    checked = F.when(F.abs(lat) <= 90, lat).otherwise(
        F.raise_error(F.concat(F.lit("latitude out of range: "), lat.cast("string")))
    )
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(turned.alias("lon"), checked.alias("lat")))
