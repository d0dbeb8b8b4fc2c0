"""Zone-free timestamps to instants and back, always as UTC, whatever zone the session has.

Watermarks need instants; the tables hold zone-free timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.extract(F.lit("SECOND"), ts)
    return F.make_timestamp_ltz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), seconds, F.lit("UTC"))


def utc_naive(instant: Column | str) -> Column:
    instant = F.col(instant) if isinstance(instant, str) else instant
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
