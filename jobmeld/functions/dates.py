"""Dates as sources write them, as timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Forms of a date in the sources, tried in this order
DATE_FORMS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX][XX]",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
]


def to_time(col: Column) -> Column:
    """The time that a text says in one of the known forms, seconds or milliseconds since 1970 among them; null in any
    other.

    A form counts only if it takes up all of the text, so a day that does not exist is null and not another day.
    """
    text = F.trim(col.cast("string"))
    number = text.try_cast("bigint")
    since = F.when(text.rlike(r"^\d{13}$"), F.timestamp_millis(number)).when(text.rlike(r"^\d{9,10}$"), F.timestamp_seconds(number))
    return F.coalesce(since, *[F.try_to_timestamp(text, F.lit(form)) for form in DATE_FORMS])
