"""The folder that driver and executors share, and files in it.

``spark.checkpoint.dir`` names it.  Where it is unset, a local session makes one of its
own; a cluster has to set it.  Plain files are reached through ``pyarrow.fs``, which
knows ``file:``, ``hdfs:``, ``s3:`` and ``gs:`` addresses; tables through Spark.
"""

import pathlib
import tempfile
import uuid
import zipfile

from pyarrow import fs
from pyspark.sql.types import StructType

_own = []


def shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="doorstep-llm-"))
        folder = _own[0]
    return folder.rstrip("/")


def new_folder(spark, name):
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df, name, **options):
    """Write ``df`` to the shared folder and read it back; cuts the lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df):
    """Delete a table that ``stored`` wrote, once nothing will read it again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        files, path = opened(folder)
        files.delete_dir(path)


def opened(address):
    """(file system, path) of an address such as ``hdfs://host/x`` or ``/x``."""
    if address.startswith("file:"):
        address = "/" + address[5:].lstrip("/")
    if address.startswith("/"):
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(address)


class NewFile:
    """A file that appears under its name only when it is whole.

    A repeated task writes the same bytes to the same name, so a lost executor or a
    second attempt does no harm.
    """

    def __init__(self, folder, name):
        self.files, root = opened(folder)
        self.files.create_dir(root, recursive=True)
        self.path = f"{root}/{name}"
        self.draft = f"{root}/_{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.stream = self.files.open_output_stream(self.draft)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.files.move(self.draft, self.path)
        else:
            self.files.delete_file(self.draft)


def listed(spark, folder, pattern="*"):
    """(path, length) of a folder's files, listed by Spark without reading them.

    Names that begin with ``_`` are hidden, so drafts are not seen.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )


BATCH_ROWS = 4000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped = {}


def ship(spark):
    """Prepare a session: the package for its Python workers, and batches of fewer rows.

    Rows are texts here, so the usual 10,000 of them are tens of megabytes, several times
    over, in every worker.  Another setting than the default is left alone.
    """
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = pathlib.Path(__file__).resolve().parents[1]
        target = pathlib.Path(tempfile.mkdtemp(prefix="doorstep-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as bundle:
            for file in sorted(package.rglob("*.py")):
                bundle.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped[context.applicationId] = str(target)


def small_batches(spark, size=8 << 20):
    """Batches of fewer bytes: where stages follow one another in the same Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def widened(df, **kinds):
    """(``df`` without columns of these names, its schema with them at the end)."""
    names = {k.lower() for k in kinds}
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    schema = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return df, schema


def fresh(columns, *names):
    """The names, each with underscores put before it until no column is called so."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
