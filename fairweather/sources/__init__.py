"""Readers and writers. Only these functions take paths."""

from fairweather.sources.declarations import (
    DECLARED_TYPES,
    apply_declared_types,
    read_declarations,
)
from fairweather.sources.geocodes import read_geocode_results
from fairweather.sources.sinks import (
    export_address_batches,
    preview,
    write_csv,
    write_parquet,
    write_unique_names,
)
from fairweather.sources.stations import (
    first_station_info,
    read_station_info,
    read_station_list,
    unwrap_station_json,
)
from fairweather.sources.weather import read_weather_csv, union_weather

__all__ = [
    "DECLARED_TYPES",
    "apply_declared_types",
    "export_address_batches",
    "first_station_info",
    "preview",
    "read_declarations",
    "read_geocode_results",
    "read_station_info",
    "read_station_list",
    "read_weather_csv",
    "union_weather",
    "unwrap_station_json",
    "write_csv",
    "write_parquet",
    "write_unique_names",
]
