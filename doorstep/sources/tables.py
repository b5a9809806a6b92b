"""Readers and writers of the layers' tables, with declared schemas."""

from functools import reduce

from pyspark.sql import functions as F

from .. import schemas
from .files import subfolders
from .folders import is_local, write_csv_folders

# Quotes are doubled inside quoted fields, as spreadsheet programs write them.
CSV_OPTIONS = {"escape": '"'}
# A table in fewer splits than a quarter of the cores is spread over all cores.
FEW_SPLITS = 4
# Tasks per core, at least, for a table of many small files.
GATHERED = 4
# Folders of reviews in one scan.
FOLDERS_AT_ONCE = 2000
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Characters of a file's buffer, filled again for longer lines; the default of a million is
# cleared anew for every small file.
FILE_BUFFER = 1 << 14


def spread(df):
    """Spread a scan that comes in few splits; large tables are left alone.

    Only for a plain scan: asking for its partitions runs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * FEW_SPLITS <= cores:
        return df.repartition(cores)
    return df


def gather(df):
    """Read very many small files with fewer tasks, as many as their bytes ask for.

    Spark reckons megabytes for the opening of a file and makes a task of a few of them.
    Only for a plain scan: asking for its partitions runs nothing.
    """
    spark = df.sparkSession
    held = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    tasks = max(GATHERED * spark.sparkContext.defaultParallelism, held // most)
    return df.coalesce(tasks) if df.rdd.getNumPartitions() > 2 * tasks else df


def read_raw_addresses(spark, path):
    """The cleaned address file: five text columns, no header."""
    return spark.read.schema(schemas.RAW_ADDRESSES).options(**CSV_OPTIONS).csv(path)


def write_raw_addresses(df, path):
    columns = schemas.RAW_ADDRESSES.fieldNames()
    df.select(*columns).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_ballots(df, path):
    """Ballots as CSV with a header row."""
    (
        df.select(*schemas.BALLOTS.fieldNames())
        .write.mode("overwrite")
        .options(header=True, **CSV_OPTIONS)
        .csv(path)
    )


def read_ballots(spark, path):
    """Columns by position; the header row is not data."""
    return (
        spark.read.schema(schemas.BALLOTS)
        .options(header=True, enforceSchema=True, **CSV_OPTIONS)
        .csv(path)
    )


def write_boundary_changes(df, path):
    """Headerless CSV under review / generation / type folders."""
    keys = schemas.BOUNDARY_CHANGE_PARTITIONS
    df = df.select(*schemas.BOUNDARY_CHANGES.fieldNames())
    if is_local(df.sparkSession, path):
        write_csv_folders(df, keys, path, CSV_OPTIONS)
        return
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .partitionBy(*keys)
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def _by_part(reader, path):
    """The folders in parts: Spark's time to name a scan's folders grows with their square."""
    root = path.rstrip("/")
    names = [n for n in subfolders(root) if not n.startswith(("_", "."))]
    if len(names) <= FOLDERS_AT_ONCE:
        return reader.csv(path)
    reader = reader.option("basePath", root)
    starts = range(0, len(names), FOLDERS_AT_ONCE)
    parts = [reader.csv([f"{root}/{n}" for n in names[i:i + FOLDERS_AT_ONCE]]) for i in starts]
    return reduce(lambda a, b: a.unionAll(b), parts)


def read_boundary_changes(spark, path):
    """The declared schema covers the folder keys, so none of them is guessed."""
    reader = spark.read.schema(schemas.BOUNDARY_CHANGES)
    reader = reader.options(inputBufferSize=FILE_BUFFER, **CSV_OPTIONS)
    # The folders are listed now, by default in a task for each of up to 10,000.
    before = spark.conf.get(LISTING_TASKS)
    wanted = GATHERED * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_TASKS, min(int(before), wanted))
    try:
        listed = _by_part(reader, path) if is_local(spark, path) else reader.csv(path)
    finally:
        spark.conf.set(LISTING_TASKS, before)
    return gather(listed)


def write_by_letter(df, path, rebalance=True):
    """Parquet by first letter.

    Rebalancing gathers a letter's rows into well-sized files and, with adaptive
    execution, splits a letter that holds much of the table over many tasks.  Rows
    that come unshuffled from a table stored this way are already gathered.
    """
    if rebalance:
        df = df.hint("rebalance", "first_letter")
    (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("first_letter")
        .parquet(path)
    )


def read_by_letter(spark, path, schema, letters=None):
    table = spark.read.schema(schema).parquet(path)
    if letters is not None:
        table = table.where(F.col("first_letter").isin(list(letters)))
    return table


def write_address_changes(df, path):
    """One folder per review, so that one review can be read or replaced alone."""
    (
        df.hint("rebalance", "boundary_review_id")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("boundary_review_id")
        .parquet(path)
    )


def read_address_changes(spark, path):
    return spark.read.schema(schemas.ADDRESS_CHANGES).parquet(path)


def register_table(spark, name, path, partitioned=True):
    """A catalog table over stored files, its partitions picked up from the folders."""
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def read_database_table(
    spark, url, table, properties=None, split_on=None, bounds=None, splits=1
):
    """A table of the source database.

    With ``split_on`` (an integer column) and ``bounds`` it is read in ``splits``
    parallel ranges instead of through one connection.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, **(properties or {})
    )
    if split_on is not None:
        low, high = bounds
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=low,
            upperBound=high,
            numPartitions=splits,
        )
    return reader.load()
