"""Declared schemas of every table; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    BooleanType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(*columns):
    return StructType([StructField(name, kind, True) for name, kind in columns])


def _strings(names):
    return [(name, StringType()) for name in names.split()]


RAW_ADDRESSES = _table(*_strings("uprn address postcode location address_type"))

ADDRESS_BASE = _table(
    *_strings("outcode uprn address postcode"),
    ("longitude", DoubleType()),
    ("latitude", DoubleType()),
    *_strings("addressbase_source first_letter"),
)

BALLOTS = _table(*_strings("election_id division_id geometry source_table"))

BALLOTS_BY_ADDRESS = _table(
    *_strings("uprn address postcode addressbase_source"),
    ("ballot_ids", ArrayType(StringType())),
    *_strings("first_letter"),
)

BOUNDARY_CHANGES = _table(
    *_strings(
        "slug status latest_event consultation_url legislation_title effective_date"
        " review_created review_modified organisation_name organisation_official_name"
        " organisation_gss divisionset_id divisionset_pmtiles_url division_slug"
        " division_name division_official_identifier division_boundary_wkt"
    ),
    ("boundary_review_id", IntegerType()),
    *_strings("divisionset_generation division_type"),
)

BOUNDARY_CHANGE_PARTITIONS = [
    "boundary_review_id",
    "divisionset_generation",
    "division_type",
]

ADDRESS_CHANGES = _table(
    *_strings("uprn address postcode addressbase_source division_type"),
    ("boundary_review_id", IntegerType()),
    ("boundary_change_details", MapType(StringType(), StringType())),
    ("boundary_review_details", MapType(StringType(), StringType())),
)

REVIEWS_BY_ADDRESS = _table(
    *_strings("uprn address postcode addressbase_source"),
    ("boundary_reviews", ArrayType(StringType())),
    *_strings("first_letter"),
)

CHANGE_EVENTS = _table(
    ("event_id", LongType()),
    ("ts", TimestampType()),
    ("event_type", StringType()),
    ("content", StringType()),
)

# Source-database tables, as the exports read them.
ELECTIONS = _table(
    *_strings("election_id current_status"),
    ("poll_open_date", DateType()),
    ("current", BooleanType()),
    ("group_type", StringType()),
    ("division_geography_id", LongType()),
    ("organisation_geography_id", LongType()),
)
