"""Scans, fixture views and sinks."""

from dosecast.sources.tables import Tables  # noqa: F401
