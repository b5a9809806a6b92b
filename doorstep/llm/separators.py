"""Token counts by scanning flat token files for end-of-document ids.

A flat token file is nothing but ids of one width, one after another, each document
ended by a separator id; there is no index and no header.  Files are read in ranges of
``BLOCK_TOKENS`` ids, each by whichever task, and searched at once with numpy.  A block
knows only the separators inside it.  A prefix scan over the blocks of a file stitches
them: the number of separators before a block numbers its documents, and the place of
the last separator before it (a running maximum) is where its first document began, even
many blocks earlier.  The scan goes in two levels, over runs of blocks and within them,
so that a file may have any number of blocks.

A file whose size is no whole number of ids raises ``ValueError``.  Ids behind the last
separator are an unfinished document, reported with ``closed`` false.  Empty files have
no document; two separators side by side hold an empty one.

For the query the files are made from the documents' texts (null: empty), file by task,
with a list of the document ids in order.  Repeated rows and ids, null ones too, are
documents of their own.  An empty table gives an empty result; extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import NewFile, listed, new_folder, opened, stored
from .text import buffers, whole_rows
from .vocab import encoder, tokenizer_path

BLOCK_TOKENS = 1 << 20
#: Blocks in a run, the first level of the scan.
RUN_BLOCKS = 1024
ENCODE_BYTES = 12 << 20


def write_flat(docs, folder, path, separator):
    """Write each task's texts as a flat file; (file, nth, doc_id) of all documents."""

    def run(batches):
        encode = encoder(path, plain_special=True)  # no text can hold the separator then
        name = f"part-{TaskContext.get().partitionId():06d}.ids"
        n = 0
        with NewFile(folder, name) as stream:
            for batch in whole_rows(batches, 1, ENCODE_BYTES):
                ids, bounds = encode.encode(*buffers(batch.column(1)))
                ids = np.insert(ids, bounds[1:], encode.dtype(separator))
                stream.write(ids.astype(ids.dtype.newbyteorder("<")).tobytes())
                nth = np.arange(n, n + batch.num_rows)
                n += batch.num_rows
                yield pa.record_batch(
                    [pa.array([name] * batch.num_rows, pa.string()), pa.array(nth), batch.column(0)],
                    names=["file", "nth", "doc_id"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(rows.mapInArrow(run, "file string, nth long, doc_id long"), "flat-list")


def _search(separator, width, block_tokens):
    """Per block: how many separators it holds, the last one's place, and all places."""

    def run(batches):
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            out = []
            for path, block in zip(*(batch.column(c).to_pylist() for c in ("path", "block"))):
                system, place = opened(path)
                with system.open_input_file(place) as file:
                    raw = file.read_at(block_tokens * width, block * block_tokens * width)
                found = np.flatnonzero(np.frombuffer(raw, kind) == separator) + block * block_tokens
                out.append((path, block, len(found), int(found[-1]) if len(found) else None, found))
            paths, blocks, counts, last, places = zip(*out)
            yield pa.record_batch(
                [
                    pa.array(paths), pa.array(blocks, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(last, pa.int64()), pa.array(places, pa.list_(pa.int64())),
                ],
                names=["path", "block", "n", "last", "places"],
            )

    return run


def scan(spark, folder, separator, width=2, pattern="*.ids", block_tokens=BLOCK_TOKENS, run_blocks=RUN_BLOCKS):
    """(file, nth, start, n_tokens, closed) of every document of the flat files."""
    files = listed(spark, folder, pattern)
    odd = files.where(F.col("length") % width != 0).limit(1).collect()
    if odd:
        raise ValueError(f"{odd[0].path} is no whole number of ids")
    tokens = (F.col("length") / width).cast("long")
    blocks = (
        files.where("length > 0")
        .withColumn("tokens", tokens)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {block_tokens}"))))
    )
    spread = blocks.repartition(max(1, blocks.count() // 4), "path", "block")
    held = stored(
        spread.select("path", "block").mapInArrow(
            _search(separator, width, block_tokens), "path string, block long, n long, last long, places array<long>"
        ),
        "separators",
    )
    # first level: within runs of blocks; second: over the runs of a file
    held = held.withColumn("run", F.expr(f"block div {run_blocks}"))
    in_run = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over_runs = Window.partitionBy("path").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = held.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    runs = runs.select(
        "path", "run",
        F.coalesce(F.sum("n").over(over_runs), F.lit(0)).alias("run_n"),
        F.max("last").over(over_runs).alias("run_last"),
    )
    stitched = (
        held.withColumn("n_before", F.coalesce(F.sum("n").over(in_run), F.lit(0)))
        .withColumn("last_before", F.max("last").over(in_run))
        .join(runs, ["path", "run"])
        .withColumn("first_nth", F.col("n_before") + F.col("run_n"))
        .withColumn("begin", F.coalesce("last_before", "run_last", F.lit(-1)) + 1)
    )
    closed = stitched.select("path", "first_nth", "begin", "places", F.posexplode("places").alias("i", "at")).select(
        "path",
        (F.col("first_nth") + F.col("i")).alias("nth"),
        F.when(F.col("i") == 0, F.col("begin")).otherwise(F.expr("places[greatest(i, 1) - 1] + 1")).alias("start"),
        "at",
        F.lit(True).alias("closed"),
    )
    ends = held.groupBy("path").agg(F.sum("n").alias("nth"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    open_ends = (
        files.withColumn("at", tokens).join(ends, "path").where("at > last + 1")
        .select("path", "nth", (F.col("last") + 1).alias("start"), "at", F.lit(False).alias("closed"))
    )
    return closed.unionByName(open_ends).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "nth", "start",
        (F.col("at") - F.col("start")).alias("n_tokens"), "closed",
    )


def op1_separators(spark, sf_dir):
    """Tokens of every document (without its end), counted in flat files of the corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = tokenizer_path("word_bpe_49k.json")
    separator = 49407  # the vocabulary's end of text
    folder = new_folder(spark, "flat")
    listing = write_flat(docs, folder, path, separator)
    return listing.join(scan(spark, folder, separator), ["file", "nth"]).select("doc_id", "n_tokens")
