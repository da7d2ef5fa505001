"""Observation tables on Spark: ingest, means, rankings, extremes and trends."""

from almanac.spec import SEASONS, STATION_REPORT, Measure, ObservationSpec

__all__ = ["SEASONS", "STATION_REPORT", "Measure", "ObservationSpec"]
