"""Event-time helpers.

Timestamps are kept zone-less (``timestamp_ntz``) end to end, so results do
not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickfold.functions._util import col

# Fixed value: the text layout of event times.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"



def epoch_to_local(seconds, tz: str = "UTC") -> Column:
    """Epoch seconds -> local wall-clock ``timestamp_ntz`` in zone ``tz``.

    The zone is an explicit parameter rather than the host's or the
    session's, so the same file gives the same wall clock everywhere.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", col(seconds).cast("long"), epoch)
    if tz.upper() in ("UTC", "Z", "+00:00"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def ntz_literal(value) -> Column:
    """A zone-less ``timestamp_ntz`` literal from a naive ``datetime`` (or
    text).  ``F.lit(datetime)`` would make a zoned timestamp and the cast
    would shift it by the session zone; text casts carry no zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def truncate_to_hour(ts) -> Column:
    """Zone-less hour truncation of a ``timestamp_ntz``."""
    t = col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def truncate_to_second(ts) -> Column:
    t = col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.minute(t), F.floor(F.second(t)).cast("int"))


def hour_of_day(ts) -> Column:
    """Hour of the wall clock, 0-23 (P10)."""
    return F.hour(col(ts))


def timestamp_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, as the reference keeps event times."""
    return F.date_format(col(ts), TIMESTAMP_TEXT)
