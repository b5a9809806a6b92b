"""Layer 3: the boundary reviews of every address and what each changes there."""

from pyspark.sql import functions as F

from ..operators.contains import BROADCAST_BYTES, contains_join, measure_cover
from ..operators.same_members import same_members
from ..operators.skew import fits_broadcast, lookup_join
from ..sources.stage import materialise

# Generations, change scenarios, and the keys of the two detail maps.
OLD, NEW = "old", "new"
NO_CHANGE = "NO_CHANGE"
NAME_CHANGED = "NAME_CHANGED"
BOUNDARY_CHANGED = "BOUNDARY_CHANGED"
BOTH_CHANGED = "BOTH_CHANGED"
CHANGE_KEYS = [
    "division_type",
    "old_division_slug",
    "old_division_name",
    "old_division_official_identifier",
    "old_divisionset_pmtiles_url",
    "new_division_slug",
    "new_division_name",
    "new_division_official_identifier",
    "new_divisionset_pmtiles_url",
    "change_scenario",
]
REVIEW_KEYS = [
    "consultation_url",
    "legislation_title",
    "effective_date",
    "organisation_name",
    "organisation_official_name",
    "organisation_gss",
]

PAIR = ["boundary_review_id", "division_type"]
SLUGS = ["old_division_slug", "new_division_slug"]
ADDRESS = ["uprn", "address", "postcode", "addressbase_source"]
# What one division brings to the result, beside its slug.
DIVISION_FIELDS = [
    "division_name",
    "division_official_identifier",
    "divisionset_pmtiles_url",
]


# --- export from the source database -------------------------------------------


def current_divisionsets(divisionsets):
    """Per organisation the divisionset ending last, open ends counting as earliest.

    A maximum, not a sorted window: it is combined before the shuffle, so an
    organisation with very many divisionsets is no burden.  Ties go to the lowest id.
    """
    latest = F.max(F.struct(F.col("end_date"), (-F.col("id")).alias("minus_id")))
    return divisionsets.groupBy("organisation_id").agg(
        (-latest["minus_id"]).alias("old_divisionset_id")
    )


def boundary_changes(
    reviews,
    organisations,
    organisation_geographies,
    divisionsets,
    divisions,
    division_geographies,
    division_pieces,
    tiles_url,
    review_ids=None,
):
    """Every polygon piece of the old and the new divisionset of each review.

    ``tiles_url`` is the address the tile file names are appended to.  All joins are
    equi-joins between plain shuffles, which adaptive execution splits when skewed.
    """
    if review_ids is not None:
        reviews = reviews.where(F.col("id").isin(list(review_ids)))
    organisation = organisations.select(
        F.col("id").alias("organisation_id"),
        F.col("common_name").alias("organisation_name"),
        F.col("slug").alias("_organisation_slug"),
        F.col("official_name").alias("organisation_official_name"),
    )
    geography = organisation_geographies.select(
        "organisation_id", F.col("gss").alias("organisation_gss")
    )
    review = (
        reviews.select(
            F.col("id").cast("int").alias("boundary_review_id"),
            "slug",
            "status",
            "latest_event",
            "consultation_url",
            "legislation_title",
            F.col("effective_date").cast("string").alias("effective_date"),
            F.col("created").cast("string").alias("review_created"),
            F.col("modified").cast("string").alias("review_modified"),
            "organisation_id",
            F.col("divisionset_id").alias("_new"),
        )
        .join(organisation, "organisation_id")
        .join(geography, "organisation_id")
        .join(
            current_divisionsets(divisionsets).withColumnRenamed(
                "old_divisionset_id", "_old"
            ),
            "organisation_id",
            "left",
        )
        .drop("organisation_id")
    )
    # "id is one of old, new" as rows: once when both are the same set.
    wanted = review.withColumn(
        "_set", F.explode(F.array_distinct(F.array("_old", "_new")))
    )
    sets = divisionsets.select(
        F.col("id").alias("_set"), F.col("pmtiles_md5_hash").alias("_hash")
    )
    division = divisions.select(
        F.col("id").alias("_division"),
        F.col("divisionset_id").alias("_set"),
        F.col("slug").alias("division_slug"),
        F.col("name").alias("division_name"),
        F.col("official_identifier").alias("division_official_identifier"),
        "division_type",
    )
    areas = division_geographies.select(
        F.col("id").alias("_area"), F.col("division_id").alias("_division")
    )
    pieces = division_pieces.select(
        F.col("division_geography_id").alias("_area"),
        F.col("geography").alias("division_boundary_wkt"),
    )
    generation = F.when(F.col("_set") == F.col("_old"), OLD).when(
        F.col("_set") == F.col("_new"), NEW
    )
    # concat_ws leaves a missing part out, where concat would make the whole null.
    tiles = F.concat_ws(
        "",
        F.lit(tiles_url),
        "_organisation_slug",
        F.lit("_"),
        F.col("_set").cast("string"),
        F.lit("_"),
        "_hash",
        F.lit(".pmtiles"),
    )
    return (
        wanted.join(sets, "_set")
        .join(division, "_set")
        .join(areas, "_division")
        .join(pieces, "_area")
        .select(
            "slug",
            "status",
            "latest_event",
            "consultation_url",
            "legislation_title",
            "effective_date",
            "review_created",
            "review_modified",
            "organisation_name",
            "organisation_official_name",
            "organisation_gss",
            F.col("_set").cast("string").alias("divisionset_id"),
            tiles.alias("divisionset_pmtiles_url"),
            "division_slug",
            "division_name",
            "division_official_identifier",
            "division_boundary_wkt",
            "boundary_review_id",
            generation.alias("divisionset_generation"),
            "division_type",
        )
    )


def review_pairs(changes):
    """The (review, division type) pairs there are, in order."""
    return changes.select(*PAIR).distinct().orderBy(*PAIR)


# --- addresses and the changes they see ------------------------------------------


def _of_generation(changes, generation, shared=()):
    """(pieces to join with, attributes by content key) of one generation.

    The cover repeats a piece's columns once per cell, so the pieces carry only a key
    of the attributes, which are attached after the join.
    """
    fields = {f"{generation}_division_slug": F.col("division_slug")}
    fields |= {f"{generation}_{c}": F.col(c) for c in DIVISION_FIELDS}
    attributes = changes.where(F.col("divisionset_generation") == generation).select(
        *PAIR,
        *[column.alias(name) for name, column in fields.items()],
        *shared,
        F.col("division_boundary_wkt").alias("geometry"),
    )
    content = [*PAIR, *fields, *shared]
    key = F.unhex(
        F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    )
    keyed = attributes.withColumn(f"{generation}_key", key)
    pieces = keyed.select(
        *PAIR, f"{generation}_division_slug", f"{generation}_key", "geometry"
    )
    extra = [c for c in content if c not in PAIR and not c.endswith("_division_slug")]
    dimension = keyed.select(f"{generation}_key", *extra).distinct()
    return pieces, dimension


def in_old_and_new(
    addresses, old_pieces, new_pieces, level=None, broadcast_bytes=BROADCAST_BYTES
):
    """Addresses inside an old and a new division of the same review and type."""
    options = {"how": "inner", "level": level, "broadcast_bytes": broadcast_bytes}
    points = addresses.select(*ADDRESS, "longitude", "latitude")
    old = contains_join(points, old_pieces, **options)
    size = measure_cover(new_pieces)
    if size.bytes(size.level(broadcast_bytes) if level is None else level) > broadcast_bytes:
        # The second join will look for hot cells: the first must not run for that too.
        old = materialise(old, "old")
    both = contains_join(old, new_pieces, on=PAIR, size=size, **options)
    return both.drop("longitude", "latitude")


def address_divisions(addresses, changes, level=None, broadcast_bytes=BROADCAST_BYTES):
    """In which old and which new division each address lies, all reviews at once."""
    old, _ = _of_generation(changes, OLD, REVIEW_KEYS)
    new, _ = _of_generation(changes, NEW)
    return in_old_and_new(addresses, old, new, level, broadcast_bytes).select(
        *ADDRESS, *PAIR, *SLUGS
    )


def same_boundary(divided):
    """Pairs of old and new division holding exactly the same addresses."""
    return same_members(divided, *SLUGS, member="uprn", within=PAIR)


def same_name():
    """Old and new division share a slug; a missing slug is shared with nothing."""
    return F.coalesce(F.col(SLUGS[0]) == F.col(SLUGS[1]), F.lit(False))


def change_scenario(boundary_same, name_same):
    return (
        F.when(boundary_same & name_same, NO_CHANGE)
        .when(boundary_same, NAME_CHANGED)
        .when(name_same, BOUNDARY_CHANGED)
        .otherwise(BOTH_CHANGED)
    )


def with_scenario(divided, same, broadcast_bytes=BROADCAST_BYTES):
    """Adds boundary_same, name_same and change_scenario to address rows."""
    flags = same.select(
        *[F.col(c).alias(f"_same_{c}") for c in [*PAIR, *SLUGS]],
        F.lit(True).alias("_same"),
    )
    keys = [(c, f"_same_{c}") for c in [*PAIR, *SLUGS]]
    joined = lookup_join(divided, flags, keys, limit_bytes=broadcast_bytes)
    return (
        joined.withColumn("boundary_same", F.col("_same").isNotNull())
        .withColumn("name_same", same_name())
        .withColumn(
            "change_scenario",
            change_scenario(F.col("boundary_same"), F.col("name_same")),
        )
        .drop("_same", *[theirs for _, theirs in keys])
    )


def address_scenarios(addresses, changes, level=None, broadcast_bytes=BROADCAST_BYTES):
    """Address rows with their divisions and change scenario, without the details."""
    divided = materialise(
        address_divisions(addresses, changes, level, broadcast_bytes), "divided"
    )
    same = materialise(same_boundary(divided), "same")
    return with_scenario(divided, same, broadcast_bytes)


def address_changes(addresses, changes, level=None, broadcast_bytes=BROADCAST_BYTES):
    """One row per address, review, division type, old and new piece it lies in.

    The spatial join over all addresses runs once; its result, the addresses under
    review, is kept for the same-boundary test and for the output.
    """
    old_pieces, old_details = _of_generation(changes, OLD, REVIEW_KEYS)
    new_pieces, new_details = _of_generation(changes, NEW)
    divided = materialise(
        in_old_and_new(addresses, old_pieces, new_pieces, level, broadcast_bytes),
        "divided",
    )
    same = materialise(same_boundary(divided), "same")
    rows = with_scenario(divided, same, broadcast_bytes)
    # Both sets of details are distinct parts of the changes, without the polygons.
    fits = fits_broadcast(changes.drop("division_boundary_wkt"), broadcast_bytes)
    for generation, details in ((OLD, old_details), (NEW, new_details)):
        mine, theirs = f"{generation}_key", f"_{generation}_key"
        details = details.withColumnRenamed(mine, theirs)
        rows = lookup_join(rows, details, [(mine, theirs)], "inner", fits=fits)
        rows = rows.drop(mine, theirs)

    def details_map(keys):
        return F.map_from_arrays(
            F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k) for k in keys])
        )

    return rows.select(
        *ADDRESS,
        "division_type",
        "boundary_review_id",
        details_map(CHANGE_KEYS).alias("boundary_change_details"),
        details_map(REVIEW_KEYS).alias("boundary_review_details"),
    )


# --- one list of reviews per address --------------------------------------------


def details_json(details, keys):
    """A detail map as JSON text with its keys in alphabetical order, nulls kept."""
    return F.to_json(
        F.struct(*[details[k].alias(k) for k in sorted(keys)]),
        {"ignoreNullFields": "false"},
    )


def review_lists(changes):
    """Per uprn the JSON texts of its reviews, ordered by review id.

    Equal rows of a uprn are counted before they are gathered, so that what is
    shuffled and nested inside the row are its distinct entries, of which there are as
    many as divisions it lies in; repeats are put back at the end.  Rows without a uprn
    belong to no address and are left out.
    """
    named = changes.where(F.col("uprn").isNotNull())
    entries = named.select(
        "uprn",
        F.col("boundary_review_id").alias("review"),
        F.col("division_type").alias("type"),
        details_json(F.col("boundary_change_details"), CHANGE_KEYS).alias("change"),
        details_json(F.col("boundary_review_details"), REVIEW_KEYS).alias("about"),
    )
    fields = ["review", "type", "change", "about"]
    counted = entries.groupBy("uprn", *fields).agg(F.count(F.lit(1)).alias("n"))
    gathered = counted.groupBy("uprn").agg(
        F.array_sort(F.collect_list(F.struct(*fields, "n"))).alias("_entries")
    )

    def review_json(review):
        mine = F.filter("_entries", lambda e: e["review"] == review)
        about = F.array_min(F.transform(mine, lambda e: e["about"]))
        repeated = F.transform(mine, lambda e: F.array_repeat(e["change"], e["n"].cast("int")))
        listed = F.array_join(F.flatten(repeated), ",")
        return F.concat(
            F.lit('{"boundary_review_id":'),
            review.cast("string"),
            F.lit(',"boundary_review_details":'),
            about,
            F.lit(',"changes":['),
            listed,
            F.lit("]}"),
        )

    reviews = F.array_distinct(F.transform("_entries", lambda e: e["review"]))
    return gathered.select(
        "uprn", F.transform(reviews, review_json).alias("boundary_reviews")
    )


def reviews_by_address(addresses, changes, broadcast_bytes=BROADCAST_BYTES):
    """Every address with its list of reviews, [] when there is none.

    The lists are stored first: when they turn out small the addresses are not
    shuffled, and otherwise they are read back rather than built twice.
    """
    lists = materialise(review_lists(changes), "reviews")
    every = addresses.select(*ADDRESS, "first_letter")
    joined = lookup_join(
        every, lists.withColumnRenamed("uprn", "_uprn"), [("uprn", "_uprn")],
        limit_bytes=broadcast_bytes,
    )
    return joined.select(
        *ADDRESS,
        F.coalesce(
            "boundary_reviews", F.array().cast("array<string>")
        ).alias("boundary_reviews"),
        "first_letter",
    )
