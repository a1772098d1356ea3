"""Event-time expressions."""

from pyspark.sql import functions as F


# Epoch milliseconds of the first and last instant of the years 1 to 9999.
FIRST_MILLIS, LAST_MILLIS = -62135596800000, 253402300799999


def as_instant(text):
    """Timestamp from text holding epoch milliseconds or ISO date-time; NULL if neither.

    A number outside the years 1 to 9999 is no time: it would overflow, and end the job.
    """
    millis = text.try_cast("bigint")
    real = F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)
    return F.coalesce(F.timestamp_millis(real), F.try_to_timestamp(text))


def event_time(text, created_text):
    """Event time, repaired from the creation time where it is absent or unreadable."""
    return F.coalesce(as_instant(text), as_instant(created_text))


def moment(as_of=None):
    """The reference instant for "now" rules: a Column, a literal, or the clock."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return as_of


def hours(n):
    return F.make_dt_interval(F.lit(0), F.lit(n))
