"""sensorlake: building-sensor time series on Spark DataFrames.

Every operator is a function DataFrame -> DataFrame (or a Column
expression) built from Spark's own operators; see README.md for the map.
"""

from sensorlake.session import configure, get_session, scratch_path

__all__ = ["configure", "get_session", "scratch_path"]
