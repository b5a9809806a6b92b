"""The raw address file with the lines that are no rows set aside.

A line with too few or too many fields, or with a quote that is not closed, is kept as
text with its file and the reason.  So is a row whose location is not a point.  Every
line is either a row or set aside: the counts add up.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .. import schemas
from ..functions.text import geometry_text, point_x, point_y
from .stage import materialise
from .tables import CSV_OPTIONS

LINE = "_line"
#: Why a line or row is set aside.
FEW, MANY, QUOTE, LOCATION = "few fields", "many fields", "open quote", "location"
_FIELDS = len(schemas.RAW_ADDRESSES.fields)


def _reason():
    # what stands in closed quotes holds no separators
    bare = F.regexp_replace(LINE, '"(?:[^"]|"")*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    wkt = geometry_text(F.col("location"))
    no_point = wkt.isNotNull() & (point_x(wkt).isNull() | point_y(wkt).isNull())
    return (
        F.when(F.contains(bare, F.lit('"')) & F.col(LINE).isNotNull(), QUOTE)
        .when(separators < _FIELDS - 1, FEW)
        .when(separators > _FIELDS - 1, MANY)
        .when(no_point, LOCATION)
    )


def scan_raw_addresses(spark, path):
    """The stored rows of the file with ``_line``, ``file`` and ``reason``.

    ``reason`` is null for a good row; ``_line`` is the text of a line that is no row.
    """
    kinds = StructType([*schemas.RAW_ADDRESSES.fields]).add(LINE, StringType())
    rows = (
        spark.read.schema(kinds)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, **CSV_OPTIONS)
        .csv(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    # stored: Spark does not know which lines are corrupt unless all fields are read
    return materialise(rows.withColumn("reason", _reason()), "scanned")


def good_addresses(scanned):
    return scanned.where(F.col("reason").isNull()).select(*schemas.RAW_ADDRESSES.fieldNames())


def rejected_lines(scanned):
    """(file, reason, line) of all that was set aside; a row is written as JSON."""
    names = schemas.RAW_ADDRESSES.fieldNames()
    text = F.coalesce(LINE, F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    return scanned.where(F.col("reason").isNotNull()).select("file", "reason", text.alias("line"))
