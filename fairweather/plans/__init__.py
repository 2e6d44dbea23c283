"""The composed dataflows."""

from fairweather.plans.enrichment import (
    enrich_events_with_weather,
    enrich_files,
    extract_declarations,
    prepare_addresses,
    station_day_weather,
    weather_per_event_day,
)

__all__ = [
    "enrich_events_with_weather",
    "enrich_files",
    "extract_declarations",
    "prepare_addresses",
    "station_day_weather",
    "weather_per_event_day",
]
