"""Declarations to events with coordinates and daily weather.

The wide event rows are shuffled once, with and without adaptive execution.
Everything that has to be looked up is looked up for the distinct ``(address,
department, day)`` groups, or ``(address, department, first day, last day)``
where events last. They come from a first, pre-aggregated pass over a few narrow
columns and are written to the shared scratch folder with their coordinates,
and so are the places and days with their stations. What the later joins have to
know, such as hot keys and missing addresses, is observed by these writes. The
rest is one lazy plan that reads both and, at its end, joins the answers back to
the events.
"""

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairweather.functions.dates import parse_day
from fairweather.functions.text import clean_key, department_key
from fairweather.operators.filters import (
    filter_equals,
    filter_valid_address,
    project_columns,
    project_required,
    rename_day,
)
from fairweather.operators.geocoding import (
    coordinates_by_address,
    require_complete_geocoding,
)
from fairweather.operators.keys import distinct_addresses, with_address_key
from fairweather.operators.skew import (
    N_ROWS,
    ROWS_PER_TASK,
    above,
    count_keys,
    counted_hot_keys,
    frequent_keys,
    salted_join,
    sketch_hot_keys,
)
from fairweather.operators.stations import PLACE_DAY, join_station_info, nearest_station
from fairweather.operators.weather import (
    DEFAULT_WEATHER,
    WeatherColumns,
    asked_days,
    drop_null_columns,
    drop_quality_columns,
    lookup_key,
    parse_weather,
    value_counts,
    weather_lookup,
)
from fairweather.session import Scratch, observe_write
from fairweather.sources.declarations import read_declarations
from fairweather.sources.geocodes import read_geocode_results
from fairweather.sources.stations import read_station_info, read_station_list
from fairweather.sources.weather import read_weather_csv

# Names of the join columns that events carry through the plan.
_ADDRESS, _DEPARTMENT, _FIRST, _LAST = "_address", "_departement", "_first_day", "_last_day"
_PLACE = ["latitude", "longitude", "departement"]

# Stands for "no readable day" in the group key, so that such events join by
# plain equality. No date has this day number.
_NO_DAY = -(2**31)


def extract_declarations(
    spark: SparkSession,
    path: str,
    filters: dict[str, Any] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Read declarations, filter them, then project."""
    return project_columns(filter_equals(read_declarations(spark, path), filters), columns)


def prepare_addresses(declarations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Declarations with a usable address and its key, and the distinct keys."""
    keyed = with_address_key(filter_valid_address(declarations))
    return keyed, distinct_addresses(keyed)


def station_day_weather(
    weather: DataFrame,
    station_days: DataFrame,
    columns: WeatherColumns = DEFAULT_WEATHER,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Cleaned weather of a set of ``(station_id, day)``, without empty and quality columns.

    Which columns are empty is known only after a pass over the data: what was
    fetched is written out, and the write counts the values of each column.
    """
    kept = drop_quality_columns(weather)
    wanted = station_days.select("station_id", "day").distinct()
    fetched = parse_weather(weather_lookup(wanted, kept, columns).select(*kept.columns), columns)
    written, counts = observe_write(fetched, "station-day-weather", scratch, **value_counts(kept.columns))
    return drop_null_columns(written, counts)


def covered_days(periods: DataFrame) -> DataFrame:
    """The days of periods ``(latitude, longitude, departement, first, last)``, each once: ``PLACE_DAY``.

    Days are numbers, and periods have one. Periods of a place that overlap or
    touch are merged before they become days. Of those that begin on one day
    only the longest counts, so a place has at most one row per day to sort.
    """
    longest = periods.groupBy(*_PLACE, "first").agg(F.max("last").alias("last"))
    by_first = Window.partitionBy(*_PLACE).orderBy("first")
    before = F.max("last").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    starts = longest.withColumn("starts", F.when(F.col("first") <= before + 1, 0).otherwise(1))
    merged = (
        starts.withColumn("run", F.sum("starts").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_PLACE, "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    days = merged.select(*_PLACE, F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(*_PLACE, F.date_from_unix_date("day").alias("day"))


def _attach_weather(
    events: DataFrame,
    first: Column,
    last: Column | None,
    gazetteer: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    *,
    output: list[str],
    as_of: dt.datetime,
    strict: bool,
    weather_columns: WeatherColumns,
    rows_per_task: int,
    scratch: Scratch | None,
) -> DataFrame:
    """Events (with ``full_address``) to located events with weather; see the module text.

    With ``last`` there is a row for every day from ``first`` to it, in
    ``weather_day``.
    """
    scratch = scratch or Scratch(events.sparkSession)
    group = [_ADDRESS, _DEPARTMENT, _FIRST, *([] if last is None else [_LAST])]
    keyed = events.withColumns(
        {
            _ADDRESS: clean_key(F.col("full_address")),
            _DEPARTMENT: department_key(F.col("lieu_departement_code")),
            _FIRST: F.coalesce(F.unix_date(first), F.lit(_NO_DAY)),
            **({} if last is None else {_LAST: F.unix_date(last)}),
        }
    ).where(F.col(_ADDRESS) != "")
    if last is not None:
        # no readable period, or one that ends before it starts: the first day alone
        readable = (F.col(_FIRST) != _NO_DAY) & (F.col(_LAST) >= F.col(_FIRST))
        keyed = keyed.withColumn(_LAST, F.when(readable, F.col(_LAST)).otherwise(F.col(_FIRST)))

    coordinates = coordinates_by_address(gazetteer).withColumnRenamed("full_address", _ADDRESS)
    groups, found = scratch.observe_write(
        count_keys(keyed, group).join(coordinates, _ADDRESS, "left"),
        "groups",
        groups=F.count(F.lit(1)),
        missing=F.count_if(F.col("latitude").isNull()),
        largest=F.max(N_ROWS),
    )
    # the write has told whether all is well; only an error needs a job for what it says
    if strict and (not found["groups"] or found["missing"]):
        by_address = groups.groupBy(F.col(_ADDRESS).alias("full_address"))
        require_complete_geocoding(by_address.agg(F.first("latitude").alias("latitude")))

    # addresses were checked for every event; those without a department have no station
    located = groups.where(F.col("latitude").isNotNull() & F.col(_DEPARTMENT).isNotNull())
    located = located.withColumn("departement", F.col(_DEPARTMENT))
    has_day = F.col(_FIRST) != _NO_DAY
    if last is None:
        located = located.withColumn("day", F.when(has_day, F.date_from_unix_date(_FIRST)))
        asked = count_keys(located, PLACE_DAY)
    else:
        periods = located.where(has_day).select(*_PLACE, F.col(_FIRST).alias("first"), F.col(_LAST).alias("last"))
        asked = scratch.materialize(covered_days(periods), "asked-days").withColumn(N_ROWS, F.lit(1))
        days = F.when(has_day, F.sequence(_FIRST, _LAST)).otherwise(F.array(F.lit(None).cast("int")))
        located = located.withColumn("day", F.explode(days)).withColumn("day", F.date_from_unix_date("day"))
    places, seen = scratch.observe_write(
        nearest_station(asked, stations, as_of, scratch),
        "places",
        largest=F.max(N_ROWS),
        lookups=frequent_keys(lookup_key(weather_columns)),
    )
    weather = drop_quality_columns(weather)
    observed = parse_weather(
        weather_lookup(
            places.drop(N_ROWS),
            weather,
            weather_columns,
            hot=above(seen["lookups"], rows_per_task),
            days=asked_days(places, weather_columns),
            rows_per_task=rows_per_task,
        ),
        weather_columns,
        values=[c for c in weather.columns if c not in (weather_columns.station, weather_columns.day)],
    )
    if last is None:
        hot = counted_hot_keys(places, PLACE_DAY, rows_per_task, largest=seen["largest"])
    else:
        hot = sketch_hot_keys(located.where("day IS NOT NULL"), PLACE_DAY, rows_per_task)
    answers = salted_join(
        located,
        observed.withColumn("station_id", F.col("station_id").try_cast("bigint")),
        PLACE_DAY,
        "left",
        hot=hot,
        spread=F.xxhash64(*group),
        rows_per_task=rows_per_task,
    )
    day = [] if last is None else [F.col("day").alias("weather_day")]
    answers = answers.select(*group, *day, "latitude", "longitude", *weather.columns, "station_id")
    return salted_join(
        keyed,
        answers,
        group,
        hot=counted_hot_keys(groups, group, rows_per_task, largest=found["largest"]),
        rows_per_task=rows_per_task,
    ).select(*output, *([] if last is None else ["weather_day"]), "latitude", "longitude", *weather.columns, "station_id")


def enrich_events_with_weather(
    declarations: DataFrame,
    gazetteer: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    *,
    as_of: dt.datetime,
    filters: dict[str, Any] | None = None,
    columns: list[str] | None = None,
    strict: bool = True,
    weather_columns: WeatherColumns = DEFAULT_WEATHER,
    rows_per_task: int = ROWS_PER_TASK,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Events with the coordinates of their address and the weather of their day.

    Takes the landed tables as text: declarations, geocode answers
    (``full_address, result_status, latitude, longitude``), stations with their
    validity, and daily weather. Returns the columns asked for in order (the day
    renamed ``day_representation``), ``latitude``, ``longitude``, the weather
    columns and ``station_id``, which is null where there is no weather.

    With ``strict`` an address without coordinates is an error; otherwise such
    events are left out. ``as_of`` is the end of stations that are still running.
    The intermediate tables are read by the result: remove them with ``scratch``
    when it is written.
    """
    events = project_required(filter_equals(declarations, filters), columns)
    events = rename_day(with_address_key(filter_valid_address(events)))
    return _attach_weather(
        events,
        parse_day(F.col("day_representation")),
        None,
        gazetteer,
        stations,
        weather,
        output=[name for name in events.columns if name != "full_address"],
        as_of=as_of,
        strict=strict,
        weather_columns=weather_columns,
        rows_per_task=rows_per_task,
        scratch=scratch,
    )


def weather_per_event_day(
    declarations: DataFrame,
    gazetteer: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    *,
    last_day: Column,
    as_of: dt.datetime,
    filters: dict[str, Any] | None = None,
    columns: list[str] | None = None,
    strict: bool = True,
    weather_columns: WeatherColumns = DEFAULT_WEATHER,
    rows_per_task: int = ROWS_PER_TASK,
    scratch: Scratch | None = None,
) -> DataFrame:
    """As :func:`enrich_events_with_weather`, with one row per day of an event's period.

    The period runs from the declared day to ``last_day``, a date made of
    declaration columns. An event without a readable period, or one that ends
    before it starts, keeps one row. ``weather_day`` tells the day of the row.

    Events stay one row each until the last join. What is looked up are the
    distinct periods of an address; those of a place are merged, so that each of
    its days is looked up once however many periods hold it.
    """
    events = filter_equals(declarations, filters).withColumn("_period_end", last_day)
    events = with_address_key(filter_valid_address(events))
    wanted = project_required(events, columns).columns
    events = rename_day(events.select(*wanted, "_period_end", "full_address"))
    return _attach_weather(
        events,
        parse_day(F.col("day_representation")),
        F.col("_period_end"),
        gazetteer,
        stations,
        weather,
        output=[name for name in events.columns if name not in ("_period_end", "full_address")],
        as_of=as_of,
        strict=strict,
        weather_columns=weather_columns,
        rows_per_task=rows_per_task,
        scratch=scratch,
    )


def enrich_files(
    spark: SparkSession,
    *,
    declarations: str,
    geocodes: str,
    station_lists: str,
    station_information: str,
    weather: list[str],
    as_of: dt.datetime,
    **options: Any,
) -> DataFrame:
    """:func:`enrich_events_with_weather` over landed files."""
    stations = join_station_info(
        read_station_list(spark, station_lists), read_station_info(spark, station_information)
    )
    return enrich_events_with_weather(
        read_declarations(spark, declarations),
        read_geocode_results(spark, geocodes),
        stations,
        read_weather_csv(spark, *weather),
        as_of=as_of,
        **options,
    )
