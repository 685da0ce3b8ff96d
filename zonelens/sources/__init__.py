"""Scans, sinks and adapters from the raw tables to the canonical shapes."""
from zonelens.sources.readings import (  # noqa: F401
    READINGS_COLUMNS,
    readings_from_events,
    scan_readings,
    station_table_from_events,
)
