"""Column expressions over postcodes and located points."""

from pyspark.sql import functions as F

# Two numbers, optionally a third (height), inside POINT(...).
POINT_PATTERN = (
    r"(?i)^\s*POINT\s*Z?\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)(?:\s+[-+0-9.eE]+)?\s*\)\s*$"
)


def outcode(postcode):
    """Text before the first space; the whole text when there is none."""
    return F.split_part(postcode, F.lit(" "), F.lit(1))


def first_letter(postcode):
    return F.substring(postcode, 1, 1)


def geometry_text(location):
    """The WKT part of ``SRID=...;WKT``, null when there is no such part.

    ``split_part`` gives '' past the last part, where a null is meant.
    """
    return F.nullif(F.split_part(location, F.lit(";"), F.lit(2)), F.lit(""))


def _coordinate(wkt, group):
    # regexp_extract gives '' when nothing matches, which try_cast makes null.
    return F.regexp_extract(wkt, POINT_PATTERN, group).try_cast("double")


def point_x(wkt):
    return _coordinate(wkt, 1)


def point_y(wkt):
    return _coordinate(wkt, 2)


def has_value(column):
    """True when the list holds a non-null element; a null list holds none."""
    return F.coalesce(F.exists(column, lambda v: v.isNotNull()), F.lit(False))
