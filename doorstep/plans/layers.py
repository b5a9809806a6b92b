"""The three layer jobs, from stored inputs to checked, published tables.

Each job writes its tables aside, checks them, and only then shows them, all in one step: a
build that is refused, or a job that ends half way, leaves what was published as it was.
``table`` says where a layer's published table lies.
"""

import logging

from pyspark.sql import functions as F

from .. import schemas
from ..operators.duplicates import has_unique_keys
from ..operators.quality import LayerCheckFailed, assert_single_source, check_layer
from ..sources import tables
from ..sources.quarantine import LOCATION, rejected_lines, scan_raw_addresses
from ..sources.releases import Release
from ..sources.releases import table_path as table
from .address_base import build_address_base
from .elections import ballots_by_address, current_ballots
from .outcodes import index_path, read_outcodes, sums_path, write_outcodes
from .reviews import address_changes, boundary_changes, reviews_by_address

logger = logging.getLogger(__name__)


class RejectedLocations(LayerCheckFailed):
    """Lines that are no rows, or addresses whose location is not a point."""


_REJECTED = {LOCATION: "addresses have a location that is not a point"}


# The layers' names, and the tables each publishes.
ADDRESS_BASE = "address_base"
ELECTIONS = "current_elections"
REVIEWS = "boundary_reviews"


def bake_address_base(spark, raw_path, out, allow_rejected=False):
    """Raw address file to the address base by first letter.

    Lines that are no rows, and locations that are no point, are counted and logged, and
    refused unless allowed.  Then they are published beside the layer, as
    ``rejected_lines``: lines are left out, and an address without a point has no
    coordinates and lies in no area.
    """
    scanned = scan_raw_addresses(spark, raw_path)
    reasons = {r["reason"]: r["n"] for r in scanned.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    reasons.pop(None, None)
    messages = [f"{n} {_REJECTED.get(reason, f'lines have {reason}')}" for reason, n in sorted(reasons.items())]
    for message in messages:
        logger.error("%s", message)
    if messages and not allow_rejected:
        raise RejectedLocations(messages)
    raw = scanned.where(F.col("reason").isNull() | (F.col("reason") == LOCATION))
    raw = raw.select(*schemas.RAW_ADDRESSES.fieldNames())
    with Release(out, ADDRESS_BASE) as release:
        path = release.path("address_base")
        tables.write_by_letter(build_address_base(raw, raw_path), path)
        check_layer(raw, tables.read_by_letter(spark, path, schemas.ADDRESS_BASE))
        rejected_lines(scanned).write.parquet(release.path("rejected_lines"))
    return tables.read_by_letter(spark, path, schemas.ADDRESS_BASE)


def bake_current_elections(
    spark, raw_path, base, elections, division_pieces, organisation_pieces, out,
    as_of=None, refresh=False,
):
    """Current ballots per address, published per outcode.

    With ``refresh`` the units of the release before are taken over and only those that
    differ from the new layer are written or deleted.
    """
    with Release(out, ELECTIONS) as release:
        ballots_path = release.path("current_ballots")
        tables.write_ballots(
            current_ballots(elections, division_pieces, organisation_pieces, as_of),
            ballots_path,
        )
        ballots = tables.read_ballots(spark, ballots_path)

        path = release.path("ballots_by_address")
        # A narrow count buys a job without any shuffle of whole addresses.
        unique = has_unique_keys(base)
        tables.write_by_letter(
            ballots_by_address(base, ballots, unique_addresses=unique),
            path,
            rebalance=not unique,
        )
        layer = tables.read_by_letter(spark, path, schemas.BALLOTS_BY_ADDRESS)
        check_layer(tables.read_raw_addresses(spark, raw_path), layer)
        # The check has shown the layer's keys to be those of the raw file, each once.
        _units(release, layer, "ballot_ids", refresh)
    return tables.read_by_letter(spark, path, schemas.BALLOTS_BY_ADDRESS)


def _units(release, layer, column, refresh):
    """The units, with their index and sums beside them."""
    units = release.share("units") if refresh else release.path("units")
    release.tables |= {"units_index": index_path(units), "units_sums": sums_path(units)}
    write_outcodes(layer, units, column, unique=True, refresh=refresh)
    return units


def bake_boundary_reviews(
    spark, raw_path, base, source, tiles_url, out, review_ids=None, refresh=False
):
    """Boundary reviews per address, published per outcode; ``refresh`` as for the elections.

    ``source`` holds the seven source tables by the argument names of
    ``boundary_changes``.
    """
    with Release(out, REVIEWS) as release:
        changes_path = release.path("boundary_changes")
        tables.write_boundary_changes(
            boundary_changes(**source, tiles_url=tiles_url, review_ids=review_ids),
            changes_path,
        )
        changes = tables.read_boundary_changes(spark, changes_path)

        by_address = release.path("address_changes")
        tables.write_address_changes(address_changes(base, changes), by_address)

        path = release.path("reviews_by_address")
        tables.write_by_letter(
            reviews_by_address(base, tables.read_address_changes(spark, by_address)), path
        )
        layer = tables.read_by_letter(spark, path, schemas.REVIEWS_BY_ADDRESS)
        check_layer(tables.read_raw_addresses(spark, raw_path), layer)
        units = _units(release, layer, "boundary_reviews", refresh)
        assert_single_source(read_outcodes(spark, units, schemas.REVIEWS_BY_ADDRESS))
    return tables.read_by_letter(spark, path, schemas.REVIEWS_BY_ADDRESS)
