"""CSV in folders by key on local disk, as Spark's writer lays it out.

Hadoop's local file system starts a process for every file and folder that it makes, which
is nearly all the time of writing very many small files; here the tasks write them.
"""

import itertools
import re
import uuid
from functools import partial

from pyspark import TaskContext
from pyspark.sql import functions as F

from .files import delete_folder, opened

LINE = "_line"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def is_local(spark, address):
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return address.startswith("file:") or (address.startswith("/") and default.startswith("file:"))


def _escaped(text):
    return _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", text)


def _folder(keys, values):
    return "/".join(f"{_escaped(k)}={NO_VALUE if v is None else _escaped(v)}" for k, v in zip(keys, values))


class _File:
    """A file that has its name once it is whole; a repeated task replaces it by the same."""

    def __init__(self, files, folder, name):
        files.create_dir(folder, recursive=True)
        self.files, self.draft, self.path = files, f"{folder}/_{uuid.uuid4().hex}", f"{folder}/{name}"
        self.stream = files.open_output_stream(self.draft)

    def close(self):
        self.stream.close()
        self.files.move(self.draft, self.path)


def _write(batches, keys, address, mark):
    """Write rows that come in order of their keys; how many files and lines they were."""
    files, top = opened(address)
    name = f"part-{TaskContext.get().partitionId():05d}-{mark}.csv"
    current = file = None
    for batch in batches:
        n_files, start, lines = 0, 0, batch.column(LINE)
        for values, run in itertools.groupby(zip(*(batch.column(k).to_pylist() for k in keys))):
            if values != current:
                if file:
                    file.close()
                current, file = values, _File(files, f"{top}/{_folder(keys, values)}", name)
                n_files += 1
            n = sum(1 for _ in run)
            file.stream.write("".join(f"{line}\n" for line in lines.slice(start, n).to_pylist()).encode())
            start += n
        yield batch.from_pydict({"files": [n_files], "lines": [start]})
    if file:
        file.close()


def write_csv_folders(df, keys, path, options):
    """``df`` below a folder per level of ``keys``, instead of what was there.

    Spark makes the lines, with the ``options`` of its CSV writer.  A task writes one file
    per folder; one that ended half way leaves hidden files that no reader sees.  The table
    is written aside and has its name once all tasks are done.
    """
    # an empty key has the folder of a missing one
    named = [F.nullif(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]
    values = F.struct(*[c for c in df.columns if c not in keys])
    rows = df.select(*named, F.to_csv(values, options).alias(LINE))
    files, top = opened(path.rstrip("/"))
    mark = uuid.uuid4().hex
    parent, name = top.rsplit("/", 1)
    draft = f"{parent}/_{name}-{mark}"
    files.create_dir(draft, recursive=True)
    try:
        write = partial(_write, keys=keys, address=draft, mark=mark)
        written = rows.hint("rebalance", *keys).sortWithinPartitions(*keys).mapInArrow(write, "files long, lines long")
        written.agg(F.sum("files"), F.sum("lines")).first()
        files.open_output_stream(f"{draft}/_SUCCESS").close()
        delete_folder(path)
        files.move(draft, top)
    except BaseException:
        delete_folder(draft)
        raise
