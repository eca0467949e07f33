"""Dates from text. Unparsable text gives null; nothing depends on the current date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted formats, the first that fits wins.
FORMATS = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-M-d", "M/d/yyyy", "MMMM yyyy", "MMM yyyy", "d/M/yyyy"]


def parse_date(text: Column, first: tuple[str, ...] = ()) -> Column:
    """The date in the first fitting format (those in `first` before the usual ones); a month alone is its first day."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.try_to_date(trimmed, f) for f in (*first, *FORMATS)])


def iso_date(text: Column) -> Column:
    """The date of an ISO timestamp in its own offset, else parse_date."""
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), parse_date(text))


def mail_date(text: Column) -> Column:
    """The date of an RFC 2822 timestamp in its own offset, else iso_date."""
    return F.coalesce(F.try_to_date(F.regexp_extract(text, r"(\d{1,2} [A-Z][a-z]{2} \d{4})", 1), "d MMM yyyy"), iso_date(text))


def looks_like_date(text: Column) -> Column:
    return F.lower(F.trim(text)).rlike(r"^\d|january|february|march|april|may|june|july|august|september|october|november|december")


def trial_day(start: Column, day: Column) -> Column:
    return F.date_diff(day, start) + 1


def within_days(day: Column, as_of: Column, days: int) -> Column:
    return day >= F.date_sub(as_of, days)
