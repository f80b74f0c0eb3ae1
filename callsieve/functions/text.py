"""Parsing of complaint text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TOLL_FREE_CODES = ["800", "888", "877", "866", "855", "844", "833"]
FAKE_NUMBERS = ["000-000-0000", "555-555-5555", "111-111-1111", "999-999-9999"]
DATE_FORMATS = {
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ssX": r"^\d{4}-\d{2}-\d{2}T",
}
CLOCK = r"^(\d{1,2}):(\d{2})\s*(am|pm)?"


def parse_hour(text: Column) -> Column:
    """Hour 0-23 from texts such as ``2:30 p.m.`` or ``14:30``; minutes are not checked."""
    tidy = F.regexp_replace(F.lower(F.trim(text)), r"\.", "")
    hour = F.regexp_extract(tidy, CLOCK, 1).try_cast("int")
    half = F.regexp_extract(tidy, CLOCK, 3)
    hour = (F.when((half == "pm") & (hour != 12), hour + 12)
            .when((half == "am") & (hour == 12), 0).otherwise(hour))
    return F.when(hour.between(0, 23), hour)


def area_code(number: Column) -> Column:
    digits = F.regexp_replace(number, r"\D", "")
    return F.when(F.length(digits) >= 3, F.substring(digits, 1, 3))


def is_toll_free(number: Column) -> Column:
    return F.coalesce(area_code(number).isin(TOLL_FREE_CODES), F.lit(False))


def parse_date(text: Column) -> Column:
    """Timestamp in the first fitting format. The shape test first, since a failed parse costs an exception."""
    return F.coalesce(*[F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(f))) for f, shape in DATE_FORMATS.items()])


def contains(text: Column, pattern: str) -> Column:
    """Case-insensitive pattern test; a missing text contains nothing."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))
