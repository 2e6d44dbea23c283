"""Distance between two points given in degrees."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def degree_distance(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Euclidean distance in degrees (not a distance on the ground)."""
    d_lat, d_lon = lat_a - lat_b, lon_a - lon_b
    return F.sqrt(d_lat * d_lat + d_lon * d_lon)
