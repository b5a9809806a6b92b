"""Layer 2: the current ballots of every address."""

from pyspark.sql import functions as F

from ..operators.contains import (
    BROADCAST_BYTES,
    Touched,
    contains_join,
    contains_lists,
    measure_cover,
)
from ..operators.skew import lookup_join
from ..sources.stage import materialise

# Fixed values of source_table.
ORGANISATION = "Organisation"
DIVISION = "Division"
NO_GEOGRAPHY = "None"

ADDRESS_KEYS = ["uprn", "address", "postcode", "addressbase_source", "first_letter"]

# Addresses in a stored file.
ROWS_PER_FILE = 50_000


def is_current(as_of):
    """Which elections count: approved single ballots, flagged current, or unflagged
    and polled no earlier than the cutoff.

    ``as_of`` is a date column or text; the default cutoff is 30 days before today.
    """
    cutoff = (
        F.date_sub(F.current_date(), 30) if as_of is None else F.lit(as_of).cast("date")
    )
    current = F.col("current")
    return (
        (F.col("current_status") == "Approved")
        & F.col("group_type").isNull()
        & F.coalesce(current, F.col("poll_open_date") >= cutoff)
    )


def current_ballots(elections, division_pieces, organisation_pieces, as_of=None):
    """Current elections with the polygon pieces of their area.

    The pieces are (id, division_geography_id / organisation_geography_id, geography).
    A division's id and polygon win over an organisation's, while the tag names the
    organisation when it matched; elections without an area keep null text.
    """
    kept = elections.where(is_current(as_of)).select(
        "election_id", "division_geography_id", "organisation_geography_id"
    )
    divisions = division_pieces.select(
        F.col("id").alias("_division"),
        F.col("division_geography_id").alias("_division_key"),
        F.col("geography").alias("_division_text"),
    )
    organisations = organisation_pieces.select(
        F.col("id").alias("_organisation"),
        F.col("organisation_geography_id").alias("_organisation_key"),
        F.col("geography").alias("_organisation_text"),
    )
    # Plain joins: where a key or a null holds much of the elections, adaptive execution
    # splits it, and nothing has to be run beforehand to find it.
    placed = kept.join(
        divisions, F.col("division_geography_id") == F.col("_division_key"), "left"
    ).join(
        organisations, F.col("organisation_geography_id") == F.col("_organisation_key"), "left"
    )
    return placed.select(
        "election_id",
        F.coalesce("_division", "_organisation").cast("string").alias("division_id"),
        F.coalesce("_division_text", "_organisation_text").alias("geometry"),
        F.when(F.col("_organisation").isNotNull(), ORGANISATION)
        .when(F.col("_division").isNotNull(), DIVISION)
        .otherwise(NO_GEOGRAPHY)
        .alias("source_table"),
    )


def ballot_areas(ballots):
    """(area, geometry, election ids): every distinct polygon with the ballots on it.

    Ballots often share a polygon, and the export repeats a ballot per combination of
    pieces; the join then tests each polygon once.
    """
    return (
        ballots.where(
            F.col("source_table").isin(ORGANISATION, DIVISION)
            & F.col("geometry").isNotNull()
        )
        .groupBy("geometry")
        .agg(F.sort_array(F.collect_set("election_id")).alias("election_ids"))
        .withColumn("area", F.unhex(F.sha2("geometry", 256)))
    )


def ballots_at(points, ballots, level=None, broadcast_bytes=BROADCAST_BYTES):
    """Each point once per area it lies in, with that area's ballots (null if none)."""
    return _areas_at(points, materialise(ballot_areas(ballots), "areas"), level, broadcast_bytes)


def _areas_at(points, areas, level, broadcast_bytes):
    """As ``ballots_at``, from stored areas: they are measured, cut and listed."""
    options = {"how": "left", "level": level, "broadcast_bytes": broadcast_bytes}

    whole = areas.select("election_ids", "geometry")
    size = measure_cover(whole)
    grid = size.level(broadcast_bytes) if level is None else level
    if size.bytes(grid) <= broadcast_bytes:
        return contains_join(points, whole, size=size, **options)

    # The cover repeats its columns per cell: a large one carries the area's key alone.
    keyed = areas.select("area", "geometry")
    matched = contains_join(points, keyed, size=measure_cover(keyed), **options)
    lists = areas.select(F.col("area").alias("_area"), "election_ids")
    joined = lookup_join(matched, lists, [("area", "_area")], "left", broadcast_bytes)
    return joined.select(*points.columns, "election_ids")


def _merged(placed, broadcast_bytes):
    """``placed`` with the rows of an address as one row: only those that repeat are shuffled.

    A hash that two addresses share only sends their rows the long way as well.
    """
    hashed = F.xxhash64(*ADDRESS_KEYS)
    repeated = materialise(
        placed.groupBy(hashed.alias("_repeated")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_repeated"),
        "repeated",
    )
    if repeated.isEmpty():
        return placed

    def cut(how):
        marked = placed.withColumn("_hash", hashed)
        return lookup_join(marked, repeated, [("_hash", "_repeated")], how, broadcast_bytes).select(*placed.columns)

    union = F.array_sort(F.array_distinct(F.flatten(F.collect_set("areas"))))
    merged = cut("left_semi").groupBy(*ADDRESS_KEYS).agg(union.alias("areas"))
    return cut("left_anti").unionByName(materialise(merged, "merged"))


def _placed(points, areas, level, broadcast_bytes, unique):
    """(the address, ``areas``): the sorted numbers of the areas that each address lies in.

    Stored with the rows of a set of areas together, task by task, so that what is made
    from them repeats a list next to itself and columnar files hold it once.  Small rows
    become long ones, so the files are of few rows, to be dealt to all cores.
    """
    options = {"level": level, "broadcast_bytes": broadcast_bytes, "size": measure_cover(areas)}
    found = contains_lists(points, areas, "area", **options)
    grouped = found is None
    if grouped:
        # collect_set skips the null of an address without an area
        found = contains_join(points, areas, how="left", **options)
        found = found.groupBy(*ADDRESS_KEYS).agg(F.collect_set("area").alias("area"))
    numbers = F.array_sort("area").alias("areas")
    placed = found.select(*ADDRESS_KEYS, numbers).sortWithinPartitions("areas")
    placed = materialise(placed, "placed", maxRecordsPerFile=ROWS_PER_FILE)
    return placed if grouped or unique else _merged(placed, broadcast_bytes)


def _lists(placed, areas, shape, broadcast_bytes):
    """(``_areas``, ``ballot_ids``): what each set of areas that occurs has for ballots."""
    held = areas.select(F.col("area").alias("_number"), "election_ids")
    sets = placed.select(F.col("areas").alias("_areas")).distinct()
    members = sets.select("_areas", F.explode_outer("_areas").alias("_area"))
    listed = lookup_join(members, held, [("_area", "_number")], "left", broadcast_bytes)
    ids = F.array_sort(F.array_distinct(F.flatten("_found")))
    return (
        listed.groupBy("_areas")
        .agg(F.collect_list("election_ids").alias("_found"))
        .select("_areas", (shape(ids) if shape else ids).alias("ballot_ids"))
    )


def ballots_by_address(
    addresses,
    ballots,
    level=None,
    broadcast_bytes=BROADCAST_BYTES,
    unique_addresses=False,
    shape=None,
):
    """One row per address with its sorted distinct ballot ids, [] when it has none.

    Addresses carry the numbers of their areas; the ballots of each set of areas are
    gathered once and attached last, so no list is ever shuffled or sorted per address.
    ``shape`` makes the column of the list, once per set as well.

    With a broadcast cover only a hash per address is shuffled, to find those that occur
    twice, and the rows of these.  ``unique_addresses`` states that there are none, as
    the checks of the address base establish: then no address is shuffled.
    """
    points = addresses.select(*ADDRESS_KEYS, "longitude", "latitude")
    numbered = ballot_areas(ballots).withColumn("area", F.monotonically_increasing_id())
    areas = materialise(numbered, "areas")
    placed = _placed(points, areas.select("area", "geometry"), level, broadcast_bytes, unique_addresses)
    lists = materialise(_lists(placed, areas, shape, broadcast_bytes), "lists")
    listed = lookup_join(placed, lists, [("areas", "_areas")], "inner", broadcast_bytes)
    return listed.select(
        "uprn", "address", "postcode", "addressbase_source", "ballot_ids", "first_letter"
    )


def update_ballots(addresses, layer, before, after, level=None, broadcast_bytes=BROADCAST_BYTES):
    """``ballots_by_address(addresses, after)`` from ``layer``, that of the ballots ``before``.

    The addresses in grid cells that a changed area meets, an area whose outline or ballots
    differ, are joined again, with all rows they have; the layer's other rows are kept.
    """
    areas = [materialise(ballot_areas(b).select("election_ids", "geometry"), "areas") for b in (before, after)]
    touched = Touched(*areas, level=level, broadcast_bytes=broadcast_bytes)
    # all fields of an address as text: none of it is null
    address = F.to_json(F.struct(*ADDRESS_KEYS), {"ignoreNullFields": "false"})
    moved = materialise(touched.inside(addresses).select(address.alias("_moved")).distinct(), "moved")

    def cut(rows, how):
        keyed = rows.withColumn("_address", address)
        return lookup_join(keyed, moved, [("_address", "_moved")], how, broadcast_bytes).select(*rows.columns)

    again = ballots_by_address(cut(addresses, "left_semi"), after, level, broadcast_bytes)
    return cut(layer, "left_anti").unionByName(again)


def ballots_by_address_union(
    addresses, ballots, level=None, broadcast_bytes=BROADCAST_BYTES
):
    """The same answer as a distinct union of one left join per kind of area."""
    points = addresses.select(*ADDRESS_KEYS, "longitude", "latitude")

    def branch(kind):
        areas = ballots.where(F.col("source_table") == kind)
        found = ballots_at(points, areas, level, broadcast_bytes)
        return found.select(*ADDRESS_KEYS, F.explode_outer("election_ids").alias("id"))

    both = branch(ORGANISATION).union(branch(DIVISION)).distinct()
    return both.groupBy(*ADDRESS_KEYS).agg(
        F.array_sort(F.collect_set("id")).alias("ballot_ids")
    )
