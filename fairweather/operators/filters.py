"""Row filters and projections of event tables."""

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_COLUMN = "declaration_date_representation"

# What is selected by default, and what enrichment needs.
DEFAULT_COLUMNS = [
    "festival_nom",
    "lieu_nom",
    "lieu_adresse",
    "lieu_code_postal",
    "lieu_ville",
    "lieu_departement_code",
    "declaration_date_representation",
]
REQUIRED_COLUMNS = [
    "lieu_adresse",
    "lieu_code_postal",
    "lieu_ville",
    "lieu_departement_code",
    "declaration_date_representation",
]


def _equals(df: DataFrame, name: str, value: Any) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # bool before number: in Python a bool is an int
        if isinstance(value, bool):
            return column.try_cast("boolean") == value
        if isinstance(value, (int, float)):
            return column.try_cast("double") == float(value)
    return column == F.lit(value)


def filter_equals(df: DataFrame, filters: dict[str, Any] | None = None) -> DataFrame:
    """Keep rows where every named column equals its value.

    Text compares exactly. A number against a text column compares as a number,
    and text that is no number does not match. A null value matches nothing.
    Filter columns need not be selected later; no filters keeps everything.
    """
    if not filters:
        return df
    return df.where(reduce(and_, [_equals(df, name, value) for name, value in filters.items()]))


def project_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The given columns in order; all of them when none are given."""
    return df.select(*columns) if columns else df


def required_columns(columns: list[str] | None = None) -> list[str]:
    """The columns asked for (or the default ones), then any that enrichment needs besides."""
    chosen = list(DEFAULT_COLUMNS if columns is None else columns)
    return chosen + [name for name in REQUIRED_COLUMNS if name not in chosen]


def project_required(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Project to :func:`required_columns`. The caller's list is left alone."""
    return df.select(*required_columns(columns))


def filter_valid_address(df: DataFrame) -> DataFrame:
    """Keep rows whose address and city are present and not the text ``null``."""
    street, city = F.col("lieu_adresse"), F.col("lieu_ville")
    return df.where(
        street.isNotNull() & (street != "null") & city.isNotNull() & (city != "null")
    )


def filter_located(df: DataFrame) -> DataFrame:
    """Keep rows with latitude, longitude and department."""
    return df.dropna(subset=["latitude", "longitude", "lieu_departement_code"])


def rename_day(df: DataFrame) -> DataFrame:
    """Give the day column its output name; nothing happens when it is absent."""
    return df.withColumnRenamed(DAY_COLUMN, "day_representation")
