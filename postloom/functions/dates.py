"""Lenient and strict date reading, date printing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postloom.functions.text import strip_ws

# Layouts after ISO, each with the shape of text it is tried on: a parse that
# fails is far slower than a shape that does not match. Month first in slashed dates.
DATE_LAYOUTS = (
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("yyyyMMdd", r"^\d{8}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("M/d/yyyy H:mm", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$"),
    ("M/d/yyyy H:mm:ss", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$"),
    ("M-d-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
    ("MMMM d, yyyy", r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$"),
    ("MMM d yyyy", r"^[A-Za-z]{3} \d{1,2} \d{4}$"),
    ("MMMM d yyyy", r"^[A-Za-z]{3,9} \d{1,2} \d{4}$"),
    ("d MMM yyyy", r"^\d{1,2} [A-Za-z]{3} \d{4}$"),
    ("d MMMM yyyy", r"^\d{1,2} [A-Za-z]{3,9} \d{4}$"),
    ("d-MMM-yyyy", r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"),
    ("yyyy-M", r"^\d{4}-\d{1,2}$"),
    ("yyyy/M/d H:mm", r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$"),
    ("yyyy/M/d H:mm:ss", r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$"),
    ("M/d/yyyy h:mm a", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AaPp][Mm]$"),
    ("M/d/yyyy h:mm:ss a", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$"),
    ("M/d/yy", r"^\d{1,2}/\d{1,2}/\d{2}$"),
    ("d.M.yyyy", r"^\d{1,2}\.\d{1,2}\.\d{4}$"),
    ("MMMM yyyy", r"^[A-Za-z]{3,9} \d{4}$"),
    ("MMM yyyy", r"^[A-Za-z]{3} \d{4}$"),
    ("MMM d, yyyy H:mm", r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2}$"),
    ("MMM d, yyyy H:mm:ss", r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2}$"),
    ("MMM d, yyyy h:mm a", r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2} [AaPp][Mm]$"),
    ("MMMM d, yyyy H:mm", r"^[A-Za-z]{3,9} \d{1,2}, \d{4} \d{1,2}:\d{2}$"),
    ("MMMM d, yyyy h:mm a", r"^[A-Za-z]{3,9} \d{1,2}, \d{4} \d{1,2}:\d{2} [AaPp][Mm]$"),
)

# Weekday names before a date say nothing that the date doesn't; RFC 1123 dates end in a zone.
_WEEKDAY = r"^(?i:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?i:day)?,? +"
_RFC_1123 = r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} (?:GMT|UTC|[+-]\d{4})$"


def iso_timestamp(c: Column) -> Column:
    """ISO text -> timestamp, anything else -> NULL.

    The leading four-digit test keeps bare times such as ``12:30`` out, which a
    cast would complete with today's date.
    """
    t = strip_ws(c)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), t.try_cast("timestamp"))


def lenient_timestamp(c: Column, layouts: tuple[tuple[str, str], ...] = DATE_LAYOUTS) -> Column:
    """First layout that fits, else NULL. ISO is tried first."""
    t = F.regexp_replace(strip_ws(c), _WEEKDAY, "")
    zoned = F.regexp_replace(t, " (?:GMT|UTC)$", " +0000")
    tries = [F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(layout))) for layout, shape in layouts]
    tries.append(F.when(t.rlike(_RFC_1123), F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx"))))
    return F.coalesce(iso_timestamp(c), *tries)


def print_date(c: Column) -> Column:
    """``yyyy-MM-dd``; missing -> ''."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
