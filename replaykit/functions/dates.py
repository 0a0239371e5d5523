"""Business-date parsing and delivery-date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, is_blank

# A four-digit year from 0001, month and day with or without a
# leading zero, optionally followed by a time of day, all within white space.
# Calendar validity (30 February) is left to the cast, which also reads no match
# as null.
_BUSINESS_DATE = (
    rf"^{WHITESPACE_CLASS}*((?!0000)[0-9]{{4}}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12][0-9]|0?[1-9]))"
    rf"(?:{WHITESPACE_CLASS}+((?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]))?{WHITESPACE_CLASS}*$"
)


def business_date(text: Column) -> Column:
    """Date of a timestamp text, or null when it is blank or malformed."""
    return F.regexp_extract(text, _BUSINESS_DATE, 1).try_cast("date")


def business_timestamp(text: Column) -> Column:
    """The same texts with their time of day; a time alone or a part of a date is malformed."""
    parts = [F.regexp_extract(text, _BUSINESS_DATE, i) for i in (1, 2)]
    return F.btrim(F.concat_ws(" ", *parts)).try_cast("timestamp")


def business_date_issue(text: Column, parsed: Column) -> Column:
    """``missing``, ``malformed`` or null, given the text and its parsed date."""
    return F.when(is_blank(text), "missing").when(parsed.isNull(), "malformed")


def historical_ingestion_date(delivery_date: Column, lag_days: int = 1) -> Column:
    """Landing date of a historical slice; the lag belongs to the provider."""
    return F.date_add(delivery_date, lag_days)


def effective_ingestion_date(ingestion_date: Column, delivery_date: Column) -> Column:
    """What a generic consumer uses: the supplied date, never a derived one."""
    return F.coalesce(ingestion_date, delivery_date)
