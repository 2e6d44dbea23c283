"""Event-weather enrichment on Spark."""

from fairweather.plans import enrich_events_with_weather, enrich_files
from fairweather.session import build_session

__all__ = ["build_session", "enrich_events_with_weather", "enrich_files"]
