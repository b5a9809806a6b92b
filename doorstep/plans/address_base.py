"""Layer 1: every address with its point, outcode, first letter and lineage."""

from pyspark.sql import functions as F

from ..functions.text import first_letter, geometry_text, outcode, point_x, point_y


def build_address_base(raw, source, strict=False):
    """A pure projection of the raw table: no shuffle.

    ``source`` is the location the raw rows came from, stamped on each row.  A location
    that is not a point gives null coordinates, or fails the job when ``strict``.
    """
    wkt = geometry_text(F.col("location"))
    longitude, latitude = point_x(wkt), point_y(wkt)
    if strict:
        bad = wkt.isNotNull() & (longitude.isNull() | latitude.isNull())
        message = F.concat(F.lit("not a point: "), wkt)
        longitude = F.when(bad, F.raise_error(message)).otherwise(longitude)
    return raw.select(
        outcode(F.col("postcode")).alias("outcode"),
        "uprn",
        "address",
        "postcode",
        longitude.alias("longitude"),
        latitude.alias("latitude"),
        F.lit(source).alias("addressbase_source"),
        first_letter(F.col("postcode")).alias("first_letter"),
    )


def rejected_locations(raw):
    """Rows whose location holds text that is not a point."""
    wkt = geometry_text(F.col("location"))
    return raw.where(
        wkt.isNotNull() & (point_x(wkt).isNull() | point_y(wkt).isNull())
    )


def first_letter_counts(addresses):
    """Addresses per partition of the layer."""
    return addresses.groupBy("first_letter").agg(F.count(F.lit(1)).alias("n_addresses"))


def of_letters(addresses, letters=None):
    """The addresses of some first letters; prunes partitions of a stored layer."""
    if letters is None:
        return addresses
    return addresses.where(F.col("first_letter").isin(list(letters)))
