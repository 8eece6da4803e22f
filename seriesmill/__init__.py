"""Sensor time-series analytics on Spark: ingest, clean, featurise, split, train, evaluate."""

from seriesmill.spec import WELL_SERIES, SeriesSpec

__all__ = ["SeriesSpec", "WELL_SERIES"]
