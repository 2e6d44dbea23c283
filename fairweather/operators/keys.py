"""Lookup keys of an event table, and their distinct values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.functions.text import address_key, clean_key


def with_address_key(df: DataFrame) -> DataFrame:
    """Add ``full_address``, the text under which a place is looked up."""
    return df.withColumn(
        "full_address",
        address_key(F.col("lieu_adresse"), F.col("lieu_code_postal"), F.col("lieu_ville")),
    )


def clean_keys(df: DataFrame, column: str) -> DataFrame:
    """Strip a key column; rows without a key or with a blank one are dropped."""
    return df.withColumn(column, clean_key(F.col(column))).where(F.col(column) != "")


def distinct_addresses(df: DataFrame) -> DataFrame:
    """Distinct address keys, without null and empty ones. Stays on the executors."""
    return df.select("full_address").where(F.col("full_address") != "").distinct()


def distinct_combinations(df: DataFrame) -> DataFrame:
    """Distinct (latitude, longitude, department, day) of located events."""
    return df.select(
        "latitude", "longitude", "lieu_departement_code", "day_representation"
    ).distinct()


def distinct_names(df: DataFrame, column: str = "festival_nom") -> DataFrame:
    """Distinct values of a name column."""
    return df.select(column).distinct()
