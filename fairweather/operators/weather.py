"""Daily weather: cleaning of landed text, lookup per station and day, join back to events."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.functions.text import combination_key, null_tokens, parse_decimal_comma
from fairweather.operators.skew import (
    ROWS_PER_TASK,
    HotKeys,
    counted_hot_keys,
    salted_join,
    sketch_hot_keys,
)
from fairweather.operators.stations import PLACE_DAY


@dataclass(frozen=True)
class WeatherColumns:
    """Which columns of a weather table name the station and the day, and how days are written."""

    station: str = "poste"
    day: str = "jour"
    day_format: str = "yyyyMMdd"


DEFAULT_WEATHER = WeatherColumns()

_STATION_TEXT, _DAY_TEXT = "_station_text", "_day_text"


def parse_weather(
    weather: DataFrame,
    columns: WeatherColumns = DEFAULT_WEATHER,
    values: list[str] | None = None,
) -> DataFrame:
    """Text to numbers: tokens for "no value" become null, decimal commas are read.

    ``values`` names the columns to read; by default all but station and day. A
    value that is no number becomes null by itself and leaves the rest of its
    column alone.
    """
    if values is None:
        values = [c for c in weather.columns if c not in (columns.station, columns.day)]
    return weather.withColumns(
        {name: parse_decimal_comma(null_tokens(F.col(name))) for name in values}
    )


def null_column_profile(df: DataFrame) -> DataFrame:
    """How many values each column has, in one pass: ``column_name, non_null, all_null``."""
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "non_null").withColumn(
        "all_null", F.col("non_null") == 0
    )


def value_counts(names: list[str]) -> dict[str, Column]:
    """An aggregate for every column, in order: how many values it has."""
    return {f"values_{n}": F.count(F.col(f"`{name}`")) for n, name in enumerate(names)}


def drop_null_columns(df: DataFrame, counts: dict | None = None) -> DataFrame:
    """Drop the columns that hold no value at all.

    The schema depends on the data: this runs a job (one row comes back), unless
    ``counts`` has the values of :func:`value_counts`, as a write of the rows can
    observe them. Restrict the rows first: it is columns empty in the fetched set
    that go.
    """
    wanted = value_counts(df.columns)
    if counts is None:
        counts = df.agg(*[count.alias(key) for key, count in wanted.items()]).first().asDict()
    return df.select(*[f"`{name}`" for name, key in zip(df.columns, wanted, strict=True) if counts[key]])


def drop_quality_columns(df: DataFrame) -> DataFrame:
    """Drop quality flags: the columns whose name starts with a capital ``Q``."""
    return df.select(*[name for name in df.columns if not name.startswith("Q")])


def weather_for_day(
    weather: DataFrame, station_id: str, day: dt.date, columns: WeatherColumns = DEFAULT_WEATHER
) -> DataFrame:
    """Weather of one station on one day.

    Compares the landed texts as they are, so that the filter reaches the scan
    (and prunes directories where the table is partitioned by day).
    """
    text = F.date_format(F.lit(day), columns.day_format)
    return weather.where((F.col(columns.station) == station_id) & (F.col(columns.day) == text))


# The most days that a lookup names to the scan of the weather, one by one.
MOST_DAYS = 20_000


def lookup_key(columns: WeatherColumns = DEFAULT_WEATHER) -> list[Column]:
    """Station and day of a key as they are written in the landed weather."""
    return [F.col("station_id"), F.date_format("day", columns.day_format)]


def asked_days(keys: DataFrame, columns: WeatherColumns = DEFAULT_WEATHER) -> list[str] | None:
    """The days of the keys as landed texts; null if there are more than ``MOST_DAYS``. Runs a job."""
    text = lookup_key(columns)[1].alias("day")
    found = keys.where(F.col("station_id").isNotNull()).select(text).where("day IS NOT NULL").distinct()
    days = [row["day"] for row in found.limit(MOST_DAYS + 1).collect()]
    return sorted(days) if len(days) <= MOST_DAYS else None


def weather_lookup(
    keys: DataFrame,
    weather: DataFrame,
    columns: WeatherColumns = DEFAULT_WEATHER,
    *,
    hot: HotKeys = (),
    days: list[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Weather of each key's ``station_id`` on its ``day``; keys without weather drop out.

    Many places may share a station and day: ``hot`` tells those with more than
    ``rows_per_task`` keys, by the hash of :func:`lookup_key`, and they are split.
    ``days`` are the days of the keys as texts (:func:`asked_days`). They become a
    filter of the scan, so that only the folders of these days are read where
    the weather is laid out by day, and only their rows are shuffled elsewhere.
    """
    keys = keys.where(F.col("station_id").isNotNull() & F.col("day").isNotNull())
    # The keys take the form of the landed text, not the other way round: the
    # large side stays a plain scan, which filters can prune.
    station, day = lookup_key(columns)
    if days is not None:
        # as text: thousands of literals, one by one, take seconds to build
        named = ", ".join("'" + day.replace("'", "\\'") + "'" for day in days)
        weather = weather.where(f"CAST(`{columns.day}` AS STRING) IN ({named})" if days else F.lit(False))
    place = [name for name in keys.columns if name not in ("station_id", "day")]
    return salted_join(
        keys.withColumns({_STATION_TEXT: station, _DAY_TEXT: day}),
        weather.withColumns(
            {
                _STATION_TEXT: F.col(columns.station).cast("string"),
                _DAY_TEXT: F.col(columns.day).cast("string"),
            }
        ),
        [_STATION_TEXT, _DAY_TEXT],
        hot=hot,
        spread=F.xxhash64(*place) if place else None,
        rows_per_task=rows_per_task,
    ).drop(_STATION_TEXT, _DAY_TEXT)


def tag_weather(weather_by_key: DataFrame) -> DataFrame:
    """Add the readable combination key, and the station id as a number."""
    return weather_by_key.withColumns(
        {
            "station_key": combination_key(
                F.col("latitude"),
                F.col("longitude"),
                F.col("departement"),
                F.date_format("day", "dd-MM-yyyy"),
            ),
            "station_id": F.col("station_id").try_cast("bigint"),
        }
    )


def skip_empty_weather(keys: DataFrame, weather_by_key: DataFrame) -> DataFrame:
    """Keys with the station whose weather they get: null if there is no weather that day."""
    stations = weather_by_key.select(*PLACE_DAY, "station_id").distinct()
    return keys.select(*PLACE_DAY).join(stations, PLACE_DAY, "left")


def join_weather_back(
    events: DataFrame,
    weather_by_key: DataFrame,
    *,
    key_counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join of weather to events on place, department and day.

    Events without weather stay, with nulls; repeated events stay repeated;
    several weather rows of a key repeat the event. With no weather at all the
    schema is the same and everything from the right side is null.

    Keys that more than ``rows_per_task`` events share are split. They are read
    from ``key_counts``, a written table of the keys with their events
    (``skew.count_keys`` makes one), and otherwise found by a job over the keys
    of the events.
    """
    if key_counts is not None:
        hot = counted_hot_keys(key_counts, PLACE_DAY, rows_per_task)
    else:
        hot = sketch_hot_keys(events.where(F.col("day").isNotNull()), PLACE_DAY, rows_per_task)
    return salted_join(events, weather_by_key, PLACE_DAY, "left", hot=hot, rows_per_task=rows_per_task)
