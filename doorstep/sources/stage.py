"""Intermediate tables that several steps read."""

import atexit
import shutil
import tempfile
import uuid

from .files import delete_folder

_own = []  # the temporary folder of a local session
_kept = {}  # intermediate tables by application


def folder(spark):
    """``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    known = known or spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="doorstep-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def materialise(df, name, **options):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: the steps that follow do not repeat the work, and an executor
    that is lost costs only its own tasks.  Without a configured folder only a local
    session may fall back to a temporary one, which goes when the program ends.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/doorstep-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _kept.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark):
    """Delete this application's intermediate tables; what reads them must be done."""
    for path in _kept.pop(spark.sparkContext.applicationId, []):
        delete_folder(path)
