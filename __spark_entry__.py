"""

Each query reads whole tables below ``sf_dir``; the inputs of the layers' kinds are
derived from them by the SQL text in ``doorstep.fixtures``, which both sides share.
The comparison SQL is written independently of the operators: containment, for one,
tests every point against every segment, without any grid.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections.abc import Callable
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doorstep import fixtures as fx
from doorstep import schemas
from doorstep.functions.text import outcode
from doorstep.operators import content_sums as sums
from doorstep.operators import duplicates, quality, same_members
from doorstep.plans import address_base as base_plan
from doorstep.plans import elections, outcodes, reviews
from doorstep.sources import quarantine, tables
from doorstep.sources.stage import materialise
from doorstep.sources.stage import folder as stage_folder
from doorstep.sources.tables import spread
from doorstep.streaming import held, triggers

SOURCE = "addresses/version-1"
AS_OF = "2026-03-01"
TILES = "https://tiles.example/store/"


# --- inputs ----------------------------------------------------------------------


def _derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for name in set(re.findall(r"(?:FROM|JOIN) (\w+)", text)) & set(fx.TABLES):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name not in ("region", "nation"):
            table = spread(table)
        table.createOrReplaceTempView(name)
    return spark.sql(fx.spark_text(text))


def _raw(spark, d):
    return _derive(spark, d, fx.RAW_ADDRESSES)


def _base(spark, d):
    return base_plan.build_address_base(_raw(spark, d), SOURCE)


def _stored_base(spark, d):
    """The address base as a stored table, as the review layer reads it."""
    return materialise(_base(spark, d), "base")


def _ballots(spark, d):
    return _derive(spark, d, fx.BALLOTS)


def _changes(spark, d):
    return _derive(spark, d, fx.BOUNDARY_CHANGES)


def _export(spark, d, review_ids=None):
    return reviews.boundary_changes(
        reviews=_derive(spark, d, fx.REVIEWS),
        organisations=_derive(spark, d, fx.ORGANISATIONS),
        organisation_geographies=_derive(spark, d, fx.ORGANISATION_GEOGRAPHIES),
        divisionsets=_derive(spark, d, fx.DIVISIONSETS),
        divisions=_derive(spark, d, fx.DIVISIONS),
        division_geographies=_derive(spark, d, fx.DIVISION_GEOGRAPHIES),
        division_pieces=_derive(spark, d, fx.REVIEW_PIECES),
        tiles_url=TILES,
        review_ids=review_ids,
    )


def _text(found):
    return F.array_join(found, "|")


def _joined(column):
    """Lists as text, so that engines' list types need not be compared."""
    return _text(column).alias(column)


def _copies(spark, d):
    """The address base with every eleventh row twice, as exact copies."""
    base = _base(spark, d)
    return base.unionAll(base.where(F.col("uprn").cast("bigint") % 11 == 0))


# --- queries ---------------------------------------------------------------------


def address_base(spark, d):
    return _base(spark, d)


def rejected_locations(spark, d):
    spoiled = _raw(spark, d).withColumn(
        "location",
        F.when(
            F.col("uprn").cast("bigint") % 13 == 0,
            F.regexp_replace("location", " ", "; "),
        ).otherwise(F.col("location")),
    )
    return base_plan.rejected_locations(spoiled).select("uprn", "location")


def _spoiled_lines(spark, d):
    """The raw addresses as lines of text, some of them short, long or badly quoted."""
    k = F.col("uprn").cast("bigint")
    kept = F.concat_ws(
        ",", "uprn", F.concat(F.lit('"'), "address", F.when(k % 23 == 3, "").otherwise('"')), "postcode", "location"
    )
    line = F.when(k % 23 == 1, kept).when(k % 23 == 2, F.concat_ws(",", kept, "address_type", F.lit("more")))
    return _raw(spark, d).select(line.otherwise(F.concat_ws(",", kept, "address_type")).alias("value"))


def quarantined_lines(spark, d):
    """How many lines of a raw file are rows, and why the others are not."""
    path = f"{stage_folder(spark)}/doorstep-lines-{uuid.uuid4().hex}"
    _spoiled_lines(spark, d).write.text(path)
    scanned = quarantine.scan_raw_addresses(spark, path)
    return scanned.groupBy(F.coalesce("reason", F.lit("row")).alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))


def quarantined_rows(spark, d):
    """The good rows of such a file."""
    path = f"{stage_folder(spark)}/doorstep-lines-{uuid.uuid4().hex}"
    _spoiled_lines(spark, d).write.text(path)
    return quarantine.good_addresses(quarantine.scan_raw_addresses(spark, path))


def raw_addresses_file(spark, d):
    """Raw addresses written as CSV without a header, and read back."""
    path = f"{stage_folder(spark)}/doorstep-raw-{uuid.uuid4().hex}"
    tables.write_raw_addresses(_raw(spark, d), path)
    return tables.read_raw_addresses(spark, path)


def ballots_file(spark, d):
    """Ballots of supplier size written as CSV with a header, and read back."""
    path = f"{stage_folder(spark)}/doorstep-ballots-{uuid.uuid4().hex}"
    tables.write_ballots(_derive(spark, d, fx.WARD_BALLOTS), path)
    return tables.read_ballots(spark, path)


def boundary_changes_files(spark, d):
    """The review export written as CSV in three levels of folders, and read back typed."""
    path = f"{stage_folder(spark)}/doorstep-changes-{uuid.uuid4().hex}"
    tables.write_boundary_changes(_export(spark, d), path)
    return tables.read_boundary_changes(spark, path)


def letters_stored(spark, d):
    """The address base stored by letter, and some letters read from their folders alone."""
    path = f"{stage_folder(spark)}/doorstep-letters-{uuid.uuid4().hex}"
    tables.write_by_letter(_base(spark, d), path)
    found = tables.read_by_letter(spark, path, schemas.ADDRESS_BASE, ["A", "Q", "X"])
    return found.select("uprn", "postcode", "addressbase_source", "first_letter")


def ballots_as_of_today(spark, d):
    """The elections export with the default cutoff, thirty days before today."""
    return elections.current_ballots(
        _derive(spark, d, fx.ELECTIONS), _derive(spark, d, fx.DIVISION_PIECES),
        _derive(spark, d, fx.ORGANISATION_PIECES),
    )


def first_letter_counts(spark, d):
    return base_plan.first_letter_counts(_base(spark, d))


def letters_filter(spark, d):
    kept = base_plan.of_letters(_base(spark, d), ["B", "N", "X"])
    return kept.select("uprn", "postcode", "first_letter")


def _current_ballots(spark, d):
    return elections.current_ballots(
        _derive(spark, d, fx.ELECTIONS),
        _derive(spark, d, fx.DIVISION_PIECES),
        _derive(spark, d, fx.ORGANISATION_PIECES),
        AS_OF,
    )


def _by_address(result):
    return result.select(
        "uprn", "address", "postcode", "addressbase_source", "first_letter",
        _joined("ballot_ids"),
    )


def _texts_by_address(addresses, ballots, **options):
    """The same of the layer, each list made text once instead of once per address."""
    layer = elections.ballots_by_address(addresses, ballots, shape=_text, **options)
    return layer.select("uprn", "address", "postcode", "addressbase_source", "first_letter", "ballot_ids")


def ballots_by_address(spark, d):
    return _by_address(elections.ballots_by_address(_base(spark, d), _ballots(spark, d)))


def ballots_by_unique_address(spark, d):
    """The form without any shuffle of addresses, for a base without repeats."""
    base = _base(spark, d)
    return _by_address(
        elections.ballots_by_address(
            base,
            _ballots(spark, d),
            unique_addresses=duplicates.has_unique_keys(base),
        )
    )


def ballots_by_address_shuffled(spark, d):
    """The join beyond the broadcast bound, with a third of the addresses on one spot."""
    base = _base(spark, d)
    crowd = F.col("uprn").cast("bigint") % 3 == 0
    crowded = base.withColumns(
        {
            "longitude": F.when(crowd, F.lit(0.75)).otherwise(F.col("longitude")),
            "latitude": F.when(crowd, F.lit(0.375)).otherwise(F.col("latitude")),
        }
    )
    return _by_address(
        elections.ballots_by_address(crowded, _ballots(spark, d), broadcast_bytes=0)
    )


def _wards(spark, d):
    """Areas of supplier size on a 50 by 50 plane, and the addresses stretched to it."""
    base = _base(spark, d).withColumns(
        {"longitude": F.col("longitude") * 10, "latitude": F.col("latitude") * 10}
    )
    return base, _derive(spark, d, fx.WARD_BALLOTS)


def ballots_many_areas(spark, d):
    return _texts_by_address(*_wards(spark, d))


def ballots_union_form(spark, d):
    return _by_address(
        elections.ballots_by_address_union(_base(spark, d), _ballots(spark, d))
    )


def exported_ballots_by_address(spark, d):
    """The elections export feeding the layer."""
    return _texts_by_address(_base(spark, d), _current_ballots(spark, d))


def current_divisionset(spark, d):
    return reviews.current_divisionsets(_derive(spark, d, fx.DIVISIONSETS))


def boundary_changes(spark, d):
    return _export(spark, d)


def boundary_changes_selected(spark, d):
    chosen = _export(spark, d, review_ids=[3, 5, 43])
    return chosen.select(
        "boundary_review_id", "divisionset_generation", "divisionset_id",
        "division_slug", "division_boundary_wkt",
    )


def review_pairs(spark, d):
    return reviews.review_pairs(_export(spark, d))


def _divided(spark, d):
    return reviews.address_divisions(_base(spark, d), _changes(spark, d))


def address_in_old_and_new(spark, d):
    return _divided(spark, d).select(
        "uprn", *reviews.PAIR, *reviews.SLUGS
    )


def same_boundary(spark, d):
    return reviews.same_boundary(_divided(spark, d))


def same_name(spark, d):
    return (
        _divided(spark, d)
        .where(reviews.same_name())
        .groupBy(*reviews.PAIR, *reviews.SLUGS)
        .agg(F.count(F.lit(1)).alias("n_addresses"))
    )


def same_orders_by_part(spark, d):
    """Equal multisets on plain data: orders of a part, and of a part after some merge."""
    rows = _derive(
        spark,
        d,
        """SELECT l_returnflag AS flag, concat('p', cast(l_partkey AS varchar(20))) AS part,
                  concat('s', cast(l_partkey - CASE WHEN l_partkey % 5 = 1 THEN 1 ELSE 0 END AS varchar(20))) AS pair,
                  cast(l_orderkey AS varchar(20)) AS member
           FROM lineitem""",
    )
    return same_members.same_members(rows, "part", "pair", "member", ["flag"])


def same_members_crowded(spark, d):
    """One member in every group, and all groups under one key."""
    rows = _derive(spark, d, fx.CROWDED_GROUPS)
    return same_members.same_members(rows, "part", "pair", "member", ["flag"])


def change_scenario(spark, d):
    return reviews.address_scenarios(_base(spark, d), _changes(spark, d)).select(
        "uprn", *reviews.PAIR, *reviews.SLUGS, "boundary_same", "name_same",
        "change_scenario",
    )


def _address_changes(spark, d, base=None, **options):
    base = base or _base(spark, d)
    return reviews.address_changes(base, _changes(spark, d), **options)


def change_details(spark, d):
    return _details(_address_changes(spark, d))


def change_details_shuffled(spark, d):
    """Beyond every broadcast bound: both spatial joins and all look-ups are shuffled."""
    return _details(_address_changes(spark, d, broadcast_bytes=0))


def _details(found):
    return found.select(
        "uprn", "division_type", "boundary_review_id",
        reviews.details_json(
            F.col("boundary_change_details"), reviews.CHANGE_KEYS
        ).alias("boundary_change_details"),
        reviews.details_json(
            F.col("boundary_review_details"), reviews.REVIEW_KEYS
        ).alias("boundary_review_details"),
    )


def review_rollup(spark, d):
    return reviews.review_lists(_address_changes(spark, d)).select(
        "uprn", _joined("boundary_reviews")
    )


def reviews_by_address(spark, d, **options):
    base = _stored_base(spark, d)
    changes = _address_changes(spark, d, base, **options)
    found = reviews.reviews_by_address(base, changes, **options)
    return found.select(
        "uprn", "address", "postcode", "addressbase_source", "first_letter",
        _joined("boundary_reviews"),
    )


def reviews_by_address_shuffled(spark, d):
    return reviews_by_address(spark, d, broadcast_bytes=0)


def _counts_only(check):
    return check.drop("source_uprn_checksum", "target_uprn_checksum")


def key_set_match(spark, d):
    return _counts_only(quality.key_set_check(_raw(spark, d), _base(spark, d)))


def key_set_mismatch(spark, d):
    """A copy of a row in the target, and as many keys swapped as the source lacks."""
    base = _base(spark, d)
    changed = base.withColumn(
        "uprn",
        F.when(F.col("uprn") == "7", F.lit("seven")).otherwise(F.col("uprn")),
    )
    changed = changed.unionAll(changed.where(F.col("uprn") == "11"))
    return _counts_only(quality.key_set_check(_raw(spark, d), changed))


def key_sets_after_changes(spark, d):
    """The key-set check from stored sums and the rows that came and went alone.

    The same addresses change in both tables; then also the target alone repeats a key, or
    keeps one that went; then the source alone repeats keys, which it may.
    """
    raw = _raw(spark, d)
    source, target = raw.select("uprn"), _base(spark, d).select("uprn")
    gone = source.where(F.col("uprn").cast("bigint") % 29 == 3)
    came = source.where(F.col("uprn").cast("bigint") % 31 == 5).select(F.concat(F.lit("n"), "uprn").alias("uprn"))
    again = source.where(F.col("uprn").cast("bigint") % 37 == 4)
    none = source.where("false")
    stored = materialise(sums.distinct_key_sums(source), "source-sums")
    held = materialise(sums.key_sums(target), "target-sums")
    found = None
    for name, (deleted, inserted), (lost, got) in (
        ("both", (gone, came), (gone, came)),
        ("target repeats", (gone, came), (gone, came.unionAll(again))),
        ("target keeps", (gone, came), (none, came)),
        ("source repeats", (gone, came.unionAll(again)), (gone, came)),
    ):
        new, old = sums.key_change(source, deleted, inserted)
        after = sums.merged((stored, 1), (sums.key_sums(new), 1), (sums.key_sums(old), -1))
        now = sums.merged((held, 1), (sums.key_sums(got), 1), (sums.key_sums(lost), -1))
        row = sums.sums_check(after, now).select(F.lit(name).alias("changed"), "*")
        found = row if found is None else found.unionByName(row)
    return found


def single_source(spark, d):
    return quality.single_source_check(_base(spark, d))


def several_sources(spark, d):
    return quality.single_source_check(_raw(spark, d), "address_type")


def duplicate_report(spark, d):
    return duplicates.duplicated_rows(_copies(spark, d)).select(
        "uprn", "address", "postcode", "addressbase_source"
    )


def duplicate_keys(spark, d):
    return duplicates.duplicate_keys(_copies(spark, d))


def dedupe_identical(spark, d):
    resolved = duplicates.resolve_duplicates(_copies(spark, d))
    return resolved.select("uprn", "address", "postcode", "addressbase_source")


def outcode_index(spark, d):
    base = _base(spark, d)
    layer = elections.ballots_by_address(base, _ballots(spark, d))
    return outcodes.outcode_index(layer, "ballot_ids")


def outcode_rows(spark, d):
    layer = elections.ballots_by_address(_base(spark, d), _ballots(spark, d))
    return outcodes.outcode_rows(layer).select(
        "outcode", "postcode", "uprn", _joined("ballot_ids")
    )


def _units(spark, d):
    """Units of an older build: one more outcode per letter, and one that is null."""
    base = _base(spark, d)
    older = base.select(
        F.when(F.col("uprn").cast("bigint") % 50 == 0, F.concat("outcode", F.lit("X")))
        .when(F.col("uprn").cast("bigint") % 77 == 0, F.lit(None))
        .otherwise(F.col("outcode"))
        .alias("outcode")
    )
    return older, base


def stale_outcodes(spark, d):
    return outcodes.stale_outcodes(*_units(spark, d))


def stale_outcodes_null_source(spark, d):
    """One address without a postcode: nothing is provably stale."""
    older, base = _units(spark, d)
    nulled = base.withColumn(
        "postcode", F.when(F.col("uprn") != "3", F.col("postcode"))
    )
    return outcodes.stale_outcodes(older, nulled)


def _asked(base):
    following = (F.col("uprn").cast("bigint") + 1).cast("string")
    return base.select("outcode", "uprn").unionAll(base.select("outcode", following.alias("uprn")))


def lookup_batch(spark, d):
    """The ballots at each order's own address and at the next one, which may not be."""
    base = _base(spark, d)
    layer = outcodes.with_outcode(
        elections.ballots_by_address(base, _ballots(spark, d))
    )
    return outcodes.lookup(layer, _asked(base), "ballot_ids").select(
        "outcode", "uprn", _joined("ballot_ids")
    )


def lookup_in_units(spark, d):
    """The same from stored units, of which only those asked for are read."""
    path = f"{stage_folder(spark)}/doorstep-units-{uuid.uuid4().hex}"
    base = _base(spark, d)
    layer = materialise(elections.ballots_by_address(base, _ballots(spark, d)), "layer")
    outcodes.write_outcodes(layer, path, "ballot_ids", unique=True)
    units = outcodes.read_outcodes(spark, path, layer.schema)
    return outcodes.lookup(units, _asked(base), "ballot_ids").select(
        "outcode", "uprn", _joined("ballot_ids")
    )


def stored_units(spark, d):
    """The elections layer written as units of whole outcodes, and read back."""
    path = f"{stage_folder(spark)}/doorstep-units-{uuid.uuid4().hex}"
    layer = materialise(
        elections.ballots_by_address(_base(spark, d), _ballots(spark, d)), "layer"
    )
    outcodes.write_outcodes(layer, path, "ballot_ids")
    units = outcodes.read_outcodes(spark, path, layer.schema)
    return units.select("unit", "outcode", "postcode", "uprn", _joined("ballot_ids"))


def ballots_after_change(spark, d):
    """The elections layer brought up to date where areas or their ballots changed."""
    base, ballots = _stored_base(spark, d), _ballots(spark, d)
    before = _derive(spark, d, fx.BALLOTS_BEFORE)
    layer = materialise(elections.ballots_by_address(base, before), "layer")
    return _by_address(elections.update_ballots(base, layer, before, ballots))


def _former_units(spark, layer):
    layer.withColumn("ballot_ids", F.array_join("ballot_ids", "|")).createOrReplaceTempView("layer")
    former = spark.sql(fx.FORMER_UNITS)
    ids = F.filter(F.split("ballot_ids", r"\|"), lambda x: x != "")
    return former.withColumn("ballot_ids", ids)


def _unit_layer(spark, d):
    layer = elections.ballots_by_address(_base(spark, d), _ballots(spark, d))
    layer = materialise(layer.select("uprn", "postcode", "ballot_ids"), "layer")
    return layer, materialise(_former_units(spark, layer).select("uprn", "postcode", "ballot_ids"), "former")


def unit_changes(spark, d):
    """What a refresh would do with each unit, from content sums of the two layers."""
    layer, former = _unit_layer(spark, d)
    found = [outcodes.unit_sums(outcodes.with_outcode(x), "ballot_ids") for x in (layer, former)]
    return outcodes.unit_changes(*found)


def refreshed_units(spark, d):
    """Units of a former layer refreshed to the present one, and read back."""
    path = f"{stage_folder(spark)}/doorstep-units-{uuid.uuid4().hex}"
    layer, former = _unit_layer(spark, d)
    outcodes.write_outcodes(former, path, "ballot_ids", unique=True)
    outcodes.write_outcodes(layer, path, "ballot_ids", unique=True, refresh=True)
    units = outcodes.read_outcodes(spark, path, layer.schema)
    return units.select("unit", "outcode", "postcode", "uprn", _joined("ballot_ids"))


def held_requests(spark, d):
    """Rebuild requests held back until a layer has been quiet for five minutes."""
    found = held.held_requests(_derive(spark, d, fx.CHANGE_EVENTS))
    times = ["first_ts", "last_ts", "requested_at"]
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in times})


def rebuild_requests(spark, d):
    requests = triggers.rebuild_requests(_derive(spark, d, fx.CHANGE_EVENTS))
    return requests.withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )


def routed_events(spark, d):
    routed = triggers.route_events(_derive(spark, d, fx.CHANGE_EVENTS))
    return routed.groupBy("layer", "content").agg(F.count(F.lit(1)).alias("n_events"))


QUERIES = [
    address_base,
    rejected_locations,
    quarantined_lines,
    quarantined_rows,
    raw_addresses_file,
    ballots_file,
    boundary_changes_files,
    letters_stored,
    ballots_as_of_today,
    first_letter_counts,
    letters_filter,
    ballots_by_address,
    ballots_by_unique_address,
    ballots_by_address_shuffled,
    ballots_many_areas,
    ballots_union_form,
    exported_ballots_by_address,
    current_divisionset,
    boundary_changes,
    boundary_changes_selected,
    review_pairs,
    address_in_old_and_new,
    same_boundary,
    same_name,
    same_orders_by_part,
    same_members_crowded,
    change_scenario,
    change_details,
    change_details_shuffled,
    review_rollup,
    reviews_by_address,
    reviews_by_address_shuffled,
    key_set_match,
    key_set_mismatch,
    single_source,
    several_sources,
    duplicate_report,
    duplicate_keys,
    dedupe_identical,
    outcode_index,
    outcode_rows,
    stale_outcodes,
    stale_outcodes_null_source,
    lookup_batch,
    lookup_in_units,
    stored_units,
    key_sets_after_changes,
    ballots_after_change,
    unit_changes,
    refreshed_units,
    held_requests,
    rebuild_requests,
    routed_events,
]


def current_ballots(spark, d):
    return _current_ballots(spark, d)


def entry(spark: SparkSession) -> DataFrame:
    """Current ballots of every address."""
    return ballots_by_address(spark, "/root/testdata/sf0.001")


def _optional():
    """The training-text subpackage and the pipeline over it, where both are present."""
    if not find_spec("doorstep.llm") or not find_spec("corpus_pipeline"):
        return {}, {}
    import corpus_pipeline
    from doorstep.llm import queries as more

    sql = dict(more.SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**more.QUERIES, "pipeline": corpus_pipeline.run}, sql


def layer_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in QUERIES}
    found["current_ballots"] = current_ballots
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return layer_queries() | _optional()[0]


# --- comparison SQL --------------------------------------------------------------


def _with(ctes: dict[str, str], select: str) -> str:
    listed = ",\n".join(f"{name} AS (\n{text.strip()}\n)" for name, text in ctes.items())
    return fx.ansi_text(f"WITH {listed}\n{select.strip()}")


POINT = r"^\s*POINT\s*Z?\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)(?:\s+[-+0-9.eE]+)?\s*\)\s*$"

BASE = f"""
SELECT split_part(postcode, ' ', 1) AS outcode, uprn, address, postcode,
       try_cast(regexp_extract(wkt, '{POINT}', 1) AS double) AS longitude,
       try_cast(regexp_extract(wkt, '{POINT}', 2) AS double) AS latitude,
       '{SOURCE}' AS addressbase_source, substr(postcode, 1, 1) AS first_letter
FROM (SELECT *, nullif(split_part(location, ';', 2), '') AS wkt FROM raw) r
"""

ADDRESSES = {"raw": fx.RAW_ADDRESSES, "base": BASE}


def _inside(points: str, pieces: str, piece_key: str, wkt: str, name: str) -> dict:
    """CTE ``name``(uprn, k): points strictly inside polygons, by brute force."""
    return {
        f"{name}_piece": f"""
SELECT row_number() OVER () AS p, {piece_key} AS k, {wkt} AS w FROM {pieces} WHERE {wkt} IS NOT NULL""",
        f"{name}_ring": f"""
SELECT p, string_split(unnest(regexp_extract_all(w, '\\(([^()]+)\\)', 1)), ',') AS v FROM {name}_piece""",
        f"{name}_seg": f"""
SELECT p, trim(v[i]) AS a, trim(v[i + 1]) AS b
FROM (SELECT p, v, unnest(range(1, len(v))) AS i FROM {name}_ring) s""",
        f"{name}_edge": f"""
SELECT p, cast(split_part(a, ' ', 1) AS double) AS x1, cast(split_part(a, ' ', 2) AS double) AS y1,
       cast(split_part(b, ' ', 1) AS double) AS x2, cast(split_part(b, ' ', 2) AS double) AS y2
FROM {name}_seg""",
        f"{name}_near": f"""
SELECT a.uprn, a.longitude AS x, a.latitude AS y, e.p,
       count(*) FILTER (WHERE (e.y1 > a.latitude) <> (e.y2 > a.latitude)
         AND (((e.x2 - e.x1) * (a.latitude - e.y1) - (a.longitude - e.x1) * (e.y2 - e.y1)) > 0) = (e.y2 > e.y1)) AS crossed,
       count(*) FILTER (WHERE a.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
         AND a.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
         AND (e.x2 - e.x1) * (a.latitude - e.y1) - (a.longitude - e.x1) * (e.y2 - e.y1) = 0) AS touched
FROM {points} a JOIN {name}_edge e
  ON a.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
GROUP BY a.uprn, a.longitude, a.latitude, e.p""",
        name: f"""
SELECT n.uprn, q.k FROM {name}_near n JOIN {name}_piece q ON q.p = n.p
WHERE n.touched = 0 AND n.crossed % 2 = 1""",
    }


def _ballot_lists(points: str, pieces: str) -> dict:
    areas = f"(SELECT * FROM {pieces} WHERE source_table IN ('Organisation', 'Division'))"
    return {
        **_inside(points, areas, "election_id", "geometry", "hit"),
        "layer": f"""
SELECT a.uprn, a.address, a.postcode, a.addressbase_source, a.first_letter,
       coalesce(string_agg(DISTINCT h.k, '|' ORDER BY h.k), '') AS ballot_ids
FROM {points} a LEFT JOIN hit h ON h.uprn = a.uprn
GROUP BY ALL""",
    }


CURRENT_BALLOTS = {
    "elections": fx.ELECTIONS,
    "division_pieces": fx.DIVISION_PIECES,
    "organisation_pieces": fx.ORGANISATION_PIECES,
    "exported": f"""
SELECT e.election_id, cast(coalesce(d.id, o.id) AS varchar) AS division_id,
       coalesce(d.geography, o.geography) AS geometry,
       CASE WHEN o.id IS NOT NULL THEN 'Organisation' WHEN d.id IS NOT NULL THEN 'Division' ELSE 'None' END AS source_table
FROM elections e
LEFT JOIN division_pieces d ON d.division_geography_id = e.division_geography_id
LEFT JOIN organisation_pieces o ON o.organisation_geography_id = e.organisation_geography_id
WHERE e.current_status = 'Approved' AND e.group_type IS NULL
  AND (e.poll_open_date >= DATE '{AS_OF}' OR e."current")
  AND NOT (NOT e."current" AND e."current" IS NOT NULL)""",
}

EXPORT = {
    "reviews": fx.REVIEWS,
    "organisations": fx.ORGANISATIONS,
    "organisation_geographies": fx.ORGANISATION_GEOGRAPHIES,
    "divisionsets": fx.DIVISIONSETS,
    "divisions": fx.DIVISIONS,
    "division_geographies": fx.DIVISION_GEOGRAPHIES,
    "pieces": fx.REVIEW_PIECES,
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY organisation_id ORDER BY end_date DESC NULLS LAST, id) AS place
FROM divisionsets""",
    "review": """
SELECT r.*, o.common_name, o.slug AS organisation_slug, o.official_name, g.gss, k.id AS old_id
FROM reviews r JOIN organisations o ON o.id = r.organisation_id
JOIN organisation_geographies g ON g.organisation_id = o.id
LEFT JOIN ranked k ON k.organisation_id = o.id AND k.place = 1""",
    "export": f"""
SELECT r.slug, r.status, r.latest_event, r.consultation_url, r.legislation_title,
       cast(r.effective_date AS varchar) AS effective_date, cast(r.created AS varchar) AS review_created,
       cast(r.modified AS varchar) AS review_modified, r.common_name AS organisation_name,
       r.official_name AS organisation_official_name, r.gss AS organisation_gss,
       cast(s.id AS varchar) AS divisionset_id,
       concat('{TILES}', r.organisation_slug, '_', cast(s.id AS varchar), '_', s.pmtiles_md5_hash, '.pmtiles') AS divisionset_pmtiles_url,
       d.slug AS division_slug, d.name AS division_name, d.official_identifier AS division_official_identifier,
       p.geography AS division_boundary_wkt, cast(r.id AS int) AS boundary_review_id,
       CASE WHEN s.id = r.old_id THEN 'old' WHEN s.id = r.divisionset_id THEN 'new' END AS divisionset_generation,
       d.division_type
FROM review r JOIN divisionsets s ON s.id = r.old_id OR s.id = r.divisionset_id
JOIN divisions d ON d.divisionset_id = s.id
JOIN division_geographies a ON a.division_id = d.id
JOIN pieces p ON p.division_geography_id = a.id""",
}

PIECE = """struct_pack(r := boundary_review_id, t := division_type, slug := division_slug, name := division_name,
 code := division_official_identifier, tiles := divisionset_pmtiles_url, c := consultation_url, l := legislation_title,
 e := effective_date, o := organisation_name, f := organisation_official_name, g := organisation_gss)"""

DIVIDED = {
    **ADDRESSES,
    "changes": fx.BOUNDARY_CHANGES,
    **_inside(
        "base", "(SELECT * FROM changes WHERE divisionset_generation = 'old')",
        PIECE, "division_boundary_wkt", "inold",
    ),
    **_inside(
        "base", "(SELECT * FROM changes WHERE divisionset_generation = 'new')",
        PIECE, "division_boundary_wkt", "innew",
    ),
    "divided": """
SELECT a.uprn, a.address, a.postcode, a.addressbase_source, o.k.r AS boundary_review_id, o.k.t AS division_type,
       o.k.slug AS old_division_slug, n.k.slug AS new_division_slug, o.k AS ok, n.k AS nk
FROM base a JOIN inold o ON o.uprn = a.uprn JOIN innew n ON n.uprn = a.uprn AND n.k.r = o.k.r AND n.k.t = o.k.t""",
}

SAME = {
    **DIVIDED,
    "old_lists": """
SELECT boundary_review_id, division_type, old_division_slug, list(uprn ORDER BY uprn) AS members
FROM divided GROUP BY ALL""",
    "new_lists": """
SELECT boundary_review_id, division_type, new_division_slug, list(uprn ORDER BY uprn) AS members
FROM divided GROUP BY ALL""",
    "same": """
SELECT o.boundary_review_id, o.division_type, o.old_division_slug, n.new_division_slug
FROM old_lists o JOIN new_lists n
  ON n.boundary_review_id = o.boundary_review_id AND n.division_type = o.division_type AND n.members = o.members""",
    "scenarios": """
SELECT *, CASE WHEN boundary_same AND name_same THEN 'NO_CHANGE' WHEN boundary_same THEN 'NAME_CHANGED'
               WHEN name_same THEN 'BOUNDARY_CHANGED' ELSE 'BOTH_CHANGED' END AS change_scenario
FROM (SELECT d.*, s.old_division_slug IS NOT NULL AS boundary_same,
             coalesce(d.old_division_slug = d.new_division_slug, false) AS name_same
      FROM divided d LEFT JOIN same s
        ON s.boundary_review_id = d.boundary_review_id AND s.division_type = d.division_type
       AND s.old_division_slug = d.old_division_slug AND s.new_division_slug = d.new_division_slug) f""",
}

CHANGED = {
    **SAME,
    "changed": """
SELECT uprn, division_type, boundary_review_id,
       cast(json_object('change_scenario', change_scenario, 'division_type', division_type,
         'new_division_name', nk.name, 'new_division_official_identifier', nk.code,
         'new_division_slug', nk.slug, 'new_divisionset_pmtiles_url', nk.tiles,
         'old_division_name', ok.name, 'old_division_official_identifier', ok.code,
         'old_division_slug', ok.slug, 'old_divisionset_pmtiles_url', ok.tiles) AS varchar) AS boundary_change_details,
       cast(json_object('consultation_url', ok.c, 'effective_date', ok.e, 'legislation_title', ok.l,
         'organisation_gss', ok.g, 'organisation_name', ok.o, 'organisation_official_name', ok.f) AS varchar) AS boundary_review_details
FROM scenarios""",
}

ROLLUP = {
    **CHANGED,
    "per_review": """
SELECT uprn, boundary_review_id, min(boundary_review_details) AS about,
       string_agg(boundary_change_details, ',' ORDER BY division_type, boundary_change_details) AS changes
FROM changed GROUP BY uprn, boundary_review_id""",
    "rollup": """
SELECT uprn, string_agg(concat('{"boundary_review_id":', boundary_review_id, ',"boundary_review_details":', about,
         ',"changes":[', changes, ']}'), '|' ORDER BY boundary_review_id) AS boundary_reviews
FROM per_review GROUP BY uprn""",
}

COPIES = {
    **ADDRESSES,
    "copies": "SELECT * FROM base UNION ALL SELECT * FROM base WHERE cast(uprn AS bigint) % 11 = 0",
}

BALLOT_LAYER = {**ADDRESSES, "ballots": fx.BALLOTS, **_ballot_lists("base", "ballots")}

UNITS = {
    **ADDRESSES,
    "units": """
SELECT CASE WHEN cast(uprn AS bigint) % 50 = 0 THEN outcode || 'X'
            WHEN cast(uprn AS bigint) % 77 = 0 THEN NULL ELSE outcode END AS outcode FROM base""",
}

EVENTS = {
    "changes": fx.CHANGE_EVENTS,
    "routes": """
SELECT 'elections_set_changed' AS event_type, 'current_elections' AS layer
UNION ALL SELECT 'elections_set_changed', 'boundary_reviews'
UNION ALL SELECT 'boundary_change_set_changed', 'boundary_reviews'""",
    "routed": "SELECT c.ts, c.content, r.layer FROM changes c JOIN routes r ON r.event_type = c.event_type",
}


def _key_sets(target: str) -> str:
    return f"""
SELECT (SELECT count(*) FROM raw) AS source_row_count, (SELECT count(*) FROM {target}) AS target_row_count,
       (SELECT count(DISTINCT uprn) FROM raw) AS source_distinct_count,
       (SELECT count(DISTINCT uprn) FROM {target}) AS target_distinct_count,
       CASE WHEN (SELECT count(*) FROM (SELECT uprn FROM raw EXCEPT SELECT uprn FROM {target}) a) = 0
             AND (SELECT count(*) FROM (SELECT uprn FROM {target} EXCEPT SELECT uprn FROM raw) b) = 0
             AND (SELECT count(*) = count(DISTINCT uprn) FROM {target})
            THEN 'match' ELSE 'mismatch' END AS match_status"""


def oracle_sql() -> dict[str, str]:
    return layer_sql() | _optional()[1]


def layer_sql() -> dict[str, str]:
    crowded = """
SELECT * REPLACE (CASE WHEN cast(uprn AS bigint) % 3 = 0 THEN 0.75 ELSE longitude END AS longitude,
                  CASE WHEN cast(uprn AS bigint) % 3 = 0 THEN 0.375 ELSE latitude END AS latitude) FROM base"""
    stretched = "SELECT * REPLACE (longitude * 10 AS longitude, latitude * 10 AS latitude) FROM base"
    slugs = "boundary_review_id, division_type, old_division_slug, new_division_slug"
    ballots = {"ballots": fx.BALLOTS}
    return {
        "address_base": _with(ADDRESSES, "SELECT * FROM base"),
        "rejected_locations": _with(
            {
                "raw": fx.RAW_ADDRESSES,
                "spoiled": """
SELECT uprn, CASE WHEN cast(uprn AS bigint) % 13 = 0 THEN replace(location, ' ', '; ') ELSE location END AS location FROM raw""",
            },
            r"""SELECT uprn, location FROM spoiled
WHERE split_part(location, ';', 2) <> ''
  AND NOT regexp_full_match(split_part(location, ';', 2), 'POINT\(\d\.\d{3} \d\.\d{3}\)')""",
        ),
        "quarantined_lines": _with(
            {"raw": fx.RAW_ADDRESSES},
            """
SELECT CASE cast(uprn AS bigint) % 23 WHEN 1 THEN 'few fields' WHEN 2 THEN 'many fields' WHEN 3 THEN 'open quote'
       ELSE 'row' END AS kind, count(*) AS n_lines FROM raw GROUP BY 1""",
        ),
        "quarantined_rows": _with(
            {"raw": fx.RAW_ADDRESSES}, "SELECT * FROM raw WHERE cast(uprn AS bigint) % 23 NOT IN (1, 2, 3)"
        ),
        "raw_addresses_file": _with({"raw": fx.RAW_ADDRESSES}, "SELECT * FROM raw"),
        "ballots_file": _with({"wards": fx.WARD_BALLOTS}, "SELECT * FROM wards"),
        "boundary_changes_files": _with(EXPORT, "SELECT * FROM export"),
        "letters_stored": _with(
            ADDRESSES,
            "SELECT uprn, postcode, addressbase_source, first_letter FROM base WHERE first_letter IN ('A', 'Q', 'X')",
        ),
        "ballots_as_of_today": _with(
            {k: v.replace(f"DATE '{AS_OF}'", "current_date - 30") for k, v in CURRENT_BALLOTS.items()},
            "SELECT * FROM exported",
        ),
        "first_letter_counts": _with(
            ADDRESSES, "SELECT first_letter, count(*) AS n_addresses FROM base GROUP BY 1"
        ),
        "letters_filter": _with(
            ADDRESSES,
            "SELECT uprn, postcode, first_letter FROM base WHERE first_letter IN ('B', 'N', 'X')",
        ),
        "current_ballots": _with(CURRENT_BALLOTS, "SELECT * FROM exported"),
        "ballots_by_address": _with(BALLOT_LAYER, "SELECT * FROM layer"),
        "ballots_by_unique_address": _with(BALLOT_LAYER, "SELECT * FROM layer"),
        "ballots_union_form": _with(BALLOT_LAYER, "SELECT * FROM layer"),
        "ballots_by_address_shuffled": _with(
            {**ADDRESSES, **ballots, "crowded": crowded, **_ballot_lists("crowded", "ballots")},
            "SELECT * FROM layer",
        ),
        "ballots_many_areas": _with(
            {
                **ADDRESSES,
                "wards": fx.WARD_BALLOTS,
                "stretched": stretched,
                **_ballot_lists("stretched", "wards"),
            },
            "SELECT * FROM layer",
        ),
        "exported_ballots_by_address": _with(
            {
                **ADDRESSES,
                **CURRENT_BALLOTS,
                "areas": "SELECT DISTINCT election_id, geometry, source_table FROM exported",
                **_ballot_lists("base", "areas"),
            },
            "SELECT * FROM layer",
        ),
        "current_divisionset": _with(
            {"divisionsets": fx.DIVISIONSETS},
            """
SELECT organisation_id, (SELECT s.id FROM divisionsets s WHERE s.organisation_id = o.organisation_id
                         ORDER BY s.end_date DESC NULLS LAST, s.id LIMIT 1) AS old_divisionset_id
FROM (SELECT DISTINCT organisation_id FROM divisionsets) o""",
        ),
        "boundary_changes": _with(EXPORT, "SELECT * FROM export"),
        "boundary_changes_selected": _with(
            EXPORT,
            """
SELECT boundary_review_id, divisionset_generation, divisionset_id, division_slug, division_boundary_wkt
FROM export WHERE boundary_review_id IN (3, 5, 43)""",
        ),
        "review_pairs": _with(
            EXPORT, "SELECT DISTINCT boundary_review_id, division_type FROM export"
        ),
        "address_in_old_and_new": _with(DIVIDED, f"SELECT uprn, {slugs} FROM divided"),
        "same_boundary": _with(SAME, f"SELECT {slugs} FROM same"),
        "same_name": _with(
            DIVIDED,
            f"""
SELECT {slugs}, count(*) AS n_addresses FROM divided
WHERE old_division_slug = new_division_slug GROUP BY ALL""",
        ),
        "same_orders_by_part": """
WITH rows_ AS (
SELECT l_returnflag AS flag, concat('p', cast(l_partkey AS varchar)) AS part,
       concat('s', cast(l_partkey - CASE WHEN l_partkey % 5 = 1 THEN 1 ELSE 0 END AS varchar)) AS pair, cast(l_orderkey AS varchar) AS member
FROM lineitem),
a AS (SELECT flag, part, list(member ORDER BY member) AS members FROM rows_ GROUP BY ALL),
b AS (SELECT flag, pair, list(member ORDER BY member) AS members FROM rows_ GROUP BY ALL)
SELECT a.flag, a.part, b.pair FROM a JOIN b ON a.flag = b.flag AND a.members = b.members""",
        "same_members_crowded": _with(
            {"rows_": fx.CROWDED_GROUPS},
            """
SELECT a.flag, a.part, b.pair
FROM (SELECT flag, part, list(member ORDER BY member) AS members FROM rows_ GROUP BY ALL) a
JOIN (SELECT flag, pair, list(member ORDER BY member) AS members FROM rows_ GROUP BY ALL) b
  ON a.flag = b.flag AND a.members = b.members""",
        ),
        "change_scenario": _with(
            SAME, f"SELECT uprn, {slugs}, boundary_same, name_same, change_scenario FROM scenarios"
        ),
        "change_details": _with(CHANGED, "SELECT * FROM changed"),
        "review_rollup": _with(ROLLUP, "SELECT * FROM rollup"),
        "reviews_by_address": _with(
            ROLLUP,
            """
SELECT a.uprn, a.address, a.postcode, a.addressbase_source, a.first_letter,
       coalesce(r.boundary_reviews, '') AS boundary_reviews
FROM base a LEFT JOIN rollup r ON r.uprn = a.uprn""",
        ),
        "reviews_by_address_shuffled": _with(
            ROLLUP,
            """
SELECT a.uprn, a.address, a.postcode, a.addressbase_source, a.first_letter,
       coalesce(r.boundary_reviews, '') AS boundary_reviews
FROM base a LEFT JOIN rollup r ON r.uprn = a.uprn""",
        ),
        "change_details_shuffled": _with(CHANGED, "SELECT * FROM changed"),
        "key_set_match": _with(ADDRESSES, _key_sets("base")),
        "key_set_mismatch": _with(
            {
                **ADDRESSES,
                "changed": """
SELECT CASE WHEN uprn = '7' THEN 'seven' ELSE uprn END AS uprn FROM base
UNION ALL SELECT uprn FROM base WHERE uprn = '11'""",
            },
            _key_sets("changed"),
        ),
        "single_source": _with(
            ADDRESSES,
            """
SELECT count(DISTINCT addressbase_source) AS source_count,
       count(DISTINCT addressbase_source) = 1 AS single_source FROM base""",
        ),
        "several_sources": _with(
            ADDRESSES,
            """
SELECT count(DISTINCT address_type) AS source_count, count(DISTINCT address_type) = 1 AS single_source FROM raw""",
        ),
        "duplicate_report": _with(
            COPIES,
            """
SELECT uprn, address, postcode, addressbase_source FROM copies
WHERE uprn IN (SELECT uprn FROM copies GROUP BY uprn HAVING count(*) > 1)""",
        ),
        "duplicate_keys": _with(
            COPIES,
            "SELECT uprn, count(*) AS n_rows FROM copies GROUP BY uprn HAVING count(*) > 1",
        ),
        "dedupe_identical": _with(
            COPIES, "SELECT DISTINCT uprn, address, postcode, addressbase_source FROM copies"
        ),
        "outcode_index": _with(
            BALLOT_LAYER,
            """
SELECT split_part(postcode, ' ', 1) AS outcode, count(*) AS n_addresses,
       bool_or(ballot_ids <> '') AS has_data FROM layer GROUP BY 1""",
        ),
        "outcode_rows": _with(
            BALLOT_LAYER,
            """
SELECT split_part(postcode, ' ', 1) AS outcode, postcode, uprn, ballot_ids
FROM layer ORDER BY outcode, postcode, uprn""",
        ),
        "stale_outcodes": _with(
            UNITS,
            """
SELECT DISTINCT outcode FROM units
WHERE outcode NOT IN (SELECT DISTINCT split_part(postcode, ' ', 1) FROM base)""",
        ),
        "stale_outcodes_null_source": _with(
            UNITS,
            """
SELECT DISTINCT outcode FROM units
WHERE outcode NOT IN (SELECT split_part(CASE WHEN uprn <> '3' THEN postcode END, ' ', 1) FROM base)""",
        ),
        "lookup_batch": _with(
            {
                **BALLOT_LAYER,
                "asked": """
SELECT outcode, uprn FROM base
UNION ALL SELECT outcode, cast(cast(uprn AS bigint) + 1 AS varchar) FROM base""",
            },
            """
SELECT k.outcode, k.uprn, coalesce(l.ballot_ids, '') AS ballot_ids
FROM asked k LEFT JOIN layer l ON l.uprn = k.uprn AND split_part(l.postcode, ' ', 1) = k.outcode""",
        ),
        "lookup_in_units": _with(
            {
                **BALLOT_LAYER,
                "asked": """
SELECT outcode, uprn FROM base
UNION ALL SELECT outcode, cast(cast(uprn AS bigint) + 1 AS varchar) FROM base""",
            },
            """
SELECT k.outcode, k.uprn, coalesce(l.ballot_ids, '') AS ballot_ids
FROM asked k LEFT JOIN layer l ON l.uprn = k.uprn AND split_part(l.postcode, ' ', 1) = k.outcode""",
        ),
        "stored_units": _with(
            BALLOT_LAYER,
            """
SELECT u.outcode AS unit, u.outcode, u.postcode, u.uprn, u.ballot_ids
FROM (SELECT *, split_part(postcode, ' ', 1) AS outcode FROM layer) u
WHERE u.outcode IN (SELECT split_part(postcode, ' ', 1) FROM layer WHERE ballot_ids <> '')""",
        ),
        "ballots_after_change": _with(BALLOT_LAYER, "SELECT * FROM layer"),
        "unit_changes": _with(
            {
                **BALLOT_LAYER,
                "now": "SELECT split_part(postcode, ' ', 1) AS outcode, postcode, uprn, ballot_ids FROM layer",
                "former": fx.FORMER_UNITS,
                **{
                    f"{t}_units": f"""
SELECT outcode AS unit, count(*) AS n, list(concat_ws('#', postcode, uprn, ballot_ids) ORDER BY postcode, uprn) AS held
FROM {t} GROUP BY 1 HAVING bool_or(ballot_ids <> '')"""
                    for t in ("now", "former")
                },
            },
            """
SELECT coalesce(a.unit, b.unit) AS unit, coalesce(a.n, 0) AS n,
       CASE WHEN b.unit IS NULL THEN 'added' WHEN a.unit IS NULL THEN 'removed'
            WHEN a.held = b.held THEN 'kept' ELSE 'rewritten' END AS change
FROM now_units a FULL JOIN former_units b ON a.unit = b.unit""",
        ),
        "refreshed_units": _with(
            BALLOT_LAYER,
            """
SELECT u.outcode AS unit, u.outcode, u.postcode, u.uprn, u.ballot_ids
FROM (SELECT *, split_part(postcode, ' ', 1) AS outcode FROM layer) u
WHERE u.outcode IN (SELECT split_part(postcode, ' ', 1) FROM layer WHERE ballot_ids <> '')""",
        ),
        "key_sets_after_changes": _with(
            {
                "raw": fx.RAW_ADDRESSES,
                "keys": "SELECT uprn, cast(uprn AS bigint) AS k FROM raw",
                "left_": "SELECT uprn FROM keys WHERE k % 29 <> 3",
                "came": "SELECT concat('n', uprn) AS uprn FROM keys WHERE k % 31 = 5",
                "again": "SELECT uprn FROM keys WHERE k % 37 = 4",
                "source_a": "SELECT uprn FROM left_ UNION ALL SELECT uprn FROM came",
                "source_b": "SELECT uprn FROM source_a UNION ALL SELECT uprn FROM again",
                "target_b": "SELECT uprn FROM source_a UNION ALL SELECT uprn FROM again",
                "target_c": "SELECT uprn FROM keys UNION ALL SELECT uprn FROM came",
            },
            " UNION ALL ".join(
                f"""
SELECT '{name}' AS changed, (SELECT count(DISTINCT uprn) FROM {a}) AS source_distinct_count,
       (SELECT count(*) FROM {b}) AS target_row_count,
       CASE WHEN NOT EXISTS (SELECT uprn FROM {a} EXCEPT SELECT uprn FROM {b})
             AND NOT EXISTS (SELECT uprn FROM {b} EXCEPT SELECT uprn FROM {a})
             AND (SELECT count(*) = count(DISTINCT uprn) FROM {b}) THEN 'match' ELSE 'mismatch' END AS match_status"""
                for name, a, b in (
                    ("both", "source_a", "source_a"), ("target repeats", "source_a", "target_b"),
                    ("target keeps", "source_a", "target_c"), ("source repeats", "source_b", "source_a"),
                )
            ),
        ),
        "held_requests": _with(
            {
                **EVENTS,
                "fresh": """
SELECT * FROM routed WHERE ts IS NOT NULL
QUALIFY coalesce(ts >= lag(ts) OVER (PARTITION BY layer, content ORDER BY ts) + INTERVAL '5 minutes', true)""",
                "begun": """
SELECT *, coalesce(ts >= lag(ts) OVER (PARTITION BY layer ORDER BY ts) + INTERVAL '5 minutes', true) AS begins FROM fresh""",
                "numbered": "SELECT *, sum(begins::int) OVER (PARTITION BY layer ORDER BY ts) AS request FROM begun",
            },
            """
SELECT layer, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts,
       strftime(max(ts) + INTERVAL '5 minutes', '%Y-%m-%d %H:%M:%S.%f') AS requested_at, count(*) AS n_events
FROM numbered GROUP BY layer, request""",
        ),
        "rebuild_requests": _with(
            EVENTS,
            """
SELECT layer, strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n_events, count(DISTINCT content) AS n_contents
FROM routed GROUP BY 1, 2""",
        ),
        "routed_events": _with(
            EVENTS, "SELECT layer, content, count(*) AS n_events FROM routed GROUP BY 1, 2"
        ),
    }
