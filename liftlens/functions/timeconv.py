"""Instant handling independent of the session time zone.

Instants are kept as UTC wall-clock ``TIMESTAMP_NTZ`` so that every result
(and its comparison with DuckDB) is the same whatever
``spark.sql.session.timeZone`` a caller runs with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros_since_epoch(ts_ntz: Column) -> Column:
    """bigint microseconds since 1970-01-01 of a UTC wall-clock timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts_ntz)


def ntz_from_micros(micros: Column) -> Column:
    """UTC wall-clock timestamp of bigint epoch microseconds (GA4 ``timestamp_micros``)."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH_NTZ))
