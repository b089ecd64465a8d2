"""Time helpers: wire timestamps, epoch arithmetic, text renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's formats.
# ISO wire format of JSON timestamps, and the SQL cast-to-string rendering.
ISO_WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
TS_TEXT_NANOS = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
DAY_PARTITION_FORMAT = "yyyy_MM_dd"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wire_timestamp(text: Column | str) -> Column:
    """Parse a JSON timestamp that is either decimal epoch seconds
    (``1658419083.146222000``) or ISO-8601 text; NULL if neither."""
    t = _c(text)
    return F.coalesce(F.timestamp_seconds(t.try_cast("decimal(20,6)")), F.try_to_timestamp(t))


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(_c(ts))


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts))


def ts_text_nanos(ts: Column | str) -> Column:
    """Timestamp as text with nine fractional digits and a space separator."""
    return F.date_format(_c(ts), TS_TEXT_NANOS)


def iso_wire(ts: Column | str) -> Column:
    """Timestamp as ISO-8601 wire text with milliseconds and a literal ``Z``."""
    return F.date_format(_c(ts), ISO_WIRE_FORMAT)


def day_partition(ts: Column | str) -> Column:
    return F.date_format(_c(ts), DAY_PARTITION_FORMAT)
