"""Per-outcode units of a finished layer, the index of outcodes, and lookups."""

import math

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import has_value, outcode
from ..operators.content_sums import SUMS, content_sums
from ..operators.duplicates import resolve_duplicates
from ..operators.skew import lookup_join, salted_join
from ..sources.files import delete_file, delete_folder
from ..sources.stage import materialise

ROWS_PER_FILE = 4_000_000
UNIT = "unit"


class StaleUnitsLeft(Exception):
    """Files of stale units that could not be deleted."""


def with_outcode(layer):
    return layer.withColumn("outcode", outcode(F.col("postcode")))


def outcode_rows(layer):
    """The rows as the units hold them, in order of outcode, postcode and uprn."""
    return with_outcode(layer).orderBy("outcode", "postcode", "uprn")


def outcode_index(layer, column):
    """One row per outcode: its addresses, and whether any has data in ``column``."""
    rows = layer if "outcode" in layer.columns else with_outcode(layer)
    return rows.groupBy("outcode").agg(
        F.count(F.lit(1)).alias("n_addresses"),
        F.bool_or(has_value(F.col(column))).alias("has_data"),
    )


def index_path(path):
    return f"{path.rstrip('/')}_index"


def sums_path(path):
    return f"{path.rstrip('/')}_sums"


def unit_sums(rows, column):
    """(unit, n, s1, s2, has_data): what each unit holds, by sums over its rows.

    Equal sums mean equal rows, so a unit whose sums are those of its stored files need
    not be written again.
    """
    held = rows.withColumn(UNIT, F.coalesce("outcode", F.lit("")))
    sums = content_sums(held, [UNIT], rows.columns)
    data = held.groupBy(F.col(UNIT).alias("_of")).agg(F.bool_or(has_value(F.col(column))).alias("has_data"))
    return sums.join(data, F.col(UNIT) == F.col("_of")).drop("_of")


def unit_changes(new, old):
    """(unit, n, change) from the sums: ``added``, ``removed``, ``rewritten`` or ``kept``."""
    theirs = old.where("has_data").select(F.col(UNIT).alias("_unit"), *[F.col(c).alias(f"_{c}") for c in SUMS])
    same = F.lit(True)
    for c in SUMS:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return new.where("has_data").join(theirs, F.col(UNIT) == F.col("_unit"), "full").select(
        F.coalesce(UNIT, "_unit").alias(UNIT),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.when(F.col("_unit").isNull(), "added")
        .when(F.col(UNIT).isNull(), "removed")
        .when(same, "kept")
        .otherwise("rewritten")
        .alias("change"),
    )


def write_outcodes(
    layer, path, column, rows_per_file=ROWS_PER_FILE, refresh=False, unique=False,
    **duplicates,
):
    """Write one sorted unit per outcode that has data, and the index of all outcodes.

    An outcode of up to ``rows_per_file`` rows is one file, in order of postcode and
    uprn.  A larger one is split by ranges of (postcode, uprn) into files that are each
    sorted and follow one another.  A unit is a folder named by its outcode, the
    default one for a missing outcode, and its files hold the outcode as well.

    Repeated rows are resolved first, unless the caller knows that keys are ``unique``.
    ``layer`` is read several times and should be a stored table.  A full build replaces
    everything below ``path``.  With ``refresh`` only the units whose content sums differ
    from the stored ones are written, and units that are no longer due are deleted; the
    files of all others stay as they are.  The index follows the units, the sums come
    last: the sums of units to be written go first, so that a job that ends half way
    leaves none that its files do not have, and the next refresh mends the rest.
    """
    spark = layer.sparkSession
    if not unique:
        layer = resolve_duplicates(layer, **duplicates)
    rows = with_outcode(layer)
    sums = materialise(unit_sums(rows, column), "sums")
    known = _stored_sums(spark, path) if refresh else None
    if known is None:
        changes = sums.where("has_data").select(UNIT, "n", F.lit("added").alias("change"))
        delete_folder(sums_path(path))
    else:
        changes = materialise(unit_changes(sums, known), "changes")
        trusted = known.join(changes.where("change = 'kept'"), [UNIT], "left_semi")
        _replace(materialise(trusted, "sums"), sums_path(path))
    _write_units(rows, path, changes.where("change IN ('added', 'rewritten')"), rows_per_file, refresh)
    if refresh:
        _remove_units(spark, path, sums.where("has_data").select(F.col(UNIT).alias("_have")))
    outcode_index(rows, column).write.mode("overwrite").parquet(index_path(path))
    _replace(sums, sums_path(path))
    return read_index(spark, path)


_SUMS = f"{UNIT} string, n long, s1 long, s2 long, has_data boolean"


def _stored_sums(spark, path):
    """The sums of the stored units; none are known for units written without them."""
    try:
        found = spark.read.schema(_SUMS).parquet(sums_path(path))
        return materialise(found, "sums")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SUMS)


def _replace(sums, path):
    sums.write.mode("overwrite").parquet(path)


def _write_units(rows, path, due, rows_per_file, refresh):
    """Write the units named in ``due`` (unit, n) from ``rows``."""
    spark = rows.sparkSession
    due = due.select(F.col(UNIT).alias("_unit"), F.col("n").alias("_rows"))
    small, large = due.where(F.col("_rows") <= rows_per_file), due.where(F.col("_rows") > rows_per_file)
    few, total, many, rest = due.agg(
        F.count_if(F.col("_rows") <= rows_per_file),
        F.sum(F.when(F.col("_rows") <= rows_per_file, F.col("_rows"))),
        F.count_if(F.col("_rows") > rows_per_file),
        F.sum(F.when(F.col("_rows") > rows_per_file, F.col("_rows"))),
    ).first()
    if refresh and not few and not many:
        return
    named = rows.withColumn(UNIT, F.coalesce("outcode", F.lit("")))
    order = [UNIT, "postcode", "uprn"]

    def of(units):
        return lookup_join(named, units.select("_unit"), [(UNIT, "_unit")], "left_semi")

    # A unit that fits a file lies whole in one partition, whichever that is.
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, math.ceil((total or 0) / rows_per_file), min(cores, few))
    written = of(small).repartition(tasks, UNIT).sortWithinPartitions(*order)
    if many:
        ranges = math.ceil(rest / rows_per_file) + many
        split = of(large).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        written = written.unionByName(split)
    (
        written.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if refresh else "static")
        .option("compression", "snappy")
        .partitionBy(UNIT)
        .parquet(path)
    )


def read_outcodes(spark, path, schema):
    """``schema`` is the layer's, without its outcode.  ``unit`` is the folder's name."""
    more = [StructField("outcode", StringType()), StructField(UNIT, StringType())]
    return spark.read.schema(StructType([*schema.fields, *more])).parquet(path)


def read_index(spark, path):
    return spark.read.parquet(index_path(path))


def stale_outcodes(target, source):
    """Outcodes of the units that the address base no longer has.

    ``outcode NOT IN (source outcodes)`` with SQL's nulls: one address without a
    postcode leaves no outcode provably stale.
    """
    have = source.select(outcode(F.col("postcode")).alias("_have")).distinct()
    facts = have.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_have").isNull()).alias("nulls")
    )
    n, nulls = facts.select("n").scalar(), facts.select("nulls").scalar()
    known = F.col("outcode").isNotNull() & (nulls == 0)
    return (
        target.select("outcode")
        .distinct()
        .join(have, F.col("outcode") == F.col("_have"), "left_anti")
        .where((n == 0) | known)
    )


_DELETED = f"{UNIT} string, path string, error string"


def _deleted(batches):
    """Delete the files of (unit, path); a file that is gone already is no failure."""
    for batch in batches:
        errors = []
        for path in batch["path"]:
            try:
                delete_file(path)
                errors.append(None)
            except FileNotFoundError:
                errors.append(None)
            except OSError as error:
                errors.append(f"{type(error).__name__}: {error}")
        yield pd.DataFrame({UNIT: batch[UNIT], "path": batch["path"], "error": errors})


def _remove_units(spark, path, have):
    """Delete the units not among ``have`` (one column, '' for the default unit).

    Spark lists the files and their units, and its tasks delete them, each its own; a task
    that is repeated finds them gone.  Returns the stored report (unit, path, error), one
    row a file; raises ``StaleUnitsLeft`` if a file could not be deleted.
    """
    listed = (
        spark.read.schema(f"path string, modificationTime timestamp, length long, content binary, {UNIT} string")
        .format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        .select(F.coalesce(UNIT, F.lit("")).alias(UNIT), "path")
    )
    stale = listed.join(have, F.col(UNIT) == F.col(have.columns[0]), "left_anti")
    # the list is kept, so that what was to go is known whatever happens
    stale = materialise(stale, "stale")
    report = materialise(stale.mapInPandas(_deleted, _DELETED), "deleted")
    left = report.where("error IS NOT NULL")
    failed, first = left.agg(F.count(F.lit(1)), F.min(F.concat_ws(": ", "path", "error"))).first()
    if failed:
        raise StaleUnitsLeft(f"{failed} files of stale units are left, such as {first}")
    return report


def remove_stale_outcodes(spark, path, source):
    """Delete the units whose outcode ``source`` lacks; returns (outcode, n_files) of those.

    Exactly the files of each outcode go, not those of every name beginning with it.
    Rows of ``source`` without a postcode do not block the removal here; the default
    unit, of addresses without an outcode, goes when there are no such rows.
    """
    have = source.select(F.coalesce(outcode(F.col("postcode")), F.lit("")).alias("_have"))
    report = _remove_units(spark, path, have.distinct())
    return report.groupBy(F.col(UNIT).alias("outcode")).agg(F.count(F.lit(1)).alias("n_files"))


def lookup(layer, keys, column):
    """The list in ``column`` for each (outcode, uprn) of ``keys``, [] when unknown.

    Only the folders of the outcodes asked for are read from stored units: the layer
    is first cut to them by a semi join on the folders' column, which prunes at run
    time.  A layer that is not stored as units has no such column and is not cut.
    """
    if UNIT in layer.columns:
        asked = keys.select(F.col("outcode").alias("_asked")).where("_asked > ''").distinct()
        cut = lookup_join(layer, asked, [(UNIT, "_asked")], "left_semi")
        layer = cut.unionByName(layer.where(F.col(UNIT).isNull()))
    found = layer.select(
        F.col("outcode").alias("_outcode"), F.col("uprn").alias("_uprn"), column
    )
    joined = salted_join(keys, found, [("outcode", "_outcode"), ("uprn", "_uprn")])
    return joined.select(
        *keys.columns,
        F.coalesce(column, F.array().cast("array<string>")).alias(column),
    )
