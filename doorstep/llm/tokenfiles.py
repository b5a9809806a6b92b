"""Token files: whole corpora as range-coded blocks of ids, written and read by tasks.

A file holds the documents of one range of ids, in ascending order, so that the files in
order of their names are the corpus:

    magic, then blocks, then the documents' table, then the table's place and magic again

A block is its number of ids, the length of its code, the CRC-32 of its ids (little-endian
unsigned 32-bit numbers) and its code (see ``rangecoder``); blocks end where they are
full, regardless of documents.  The table is zlib-compressed and has its own checksum: per
document its id, whether that is null, and its number of ids, the end id included.
Damaged blocks, tables or ends raise ``ValueError``.

Texts are range-partitioned by id, so that every task writes one file, a wave of blocks
at a time.  A file gets its name when it is whole; a repeated task replaces it by an
equal one.  Reading goes by file, a wave at a time.

A null text is an empty one: the end id alone.  Null ids come first; rows with equal ids
are in order of their texts' hash, then of their place in the input.  An empty table
gives files without documents and an empty result.  Extra columns are ignored.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import rangecoder
from .shared import NewFile, listed, new_folder, opened, stored
from .text import buffers, reuse, whole_rows
from .vocab import encoder, tokenizer_path

MAGIC = b"DSTOKEN1"
END = 0
#: Characters of text for a file; a single longer document makes a longer file.
FILE_CHARS = 24_000_000
ENCODE_BYTES = 12 << 20

_BLOCK = struct.Struct("<III")
_TABLE = struct.Struct("<QQII")
_PLACE = struct.Struct("<Q")


class TokenWriter:
    """Writes one file: documents in, blocks out as waves fill up."""

    def __init__(self, stream):
        self.stream = stream
        self.held, self.size = [], 0
        self.ids, self.nulls, self.lengths = [], [], []
        self.at = stream.write(MAGIC) or len(MAGIC)

    def add(self, doc_ids, ids, lengths):
        """Documents' ids (an Arrow array), and their token ids one after another."""
        self.nulls.append(np.array(doc_ids.is_null()))
        self.ids.append(np.array(doc_ids.fill_null(0), np.int64))
        self.lengths.append(np.asarray(lengths, np.int64))
        self.held.append(np.asarray(ids, np.uint32))
        self.size += len(ids)
        if self.size >= rangecoder.BLOCK * rangecoder.WAVE:
            self._flush(False)

    def _flush(self, last):
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        size, wave = rangecoder.BLOCK, rangecoder.BLOCK * rangecoder.WAVE
        stop = len(ids) if last else len(ids) // wave * wave
        for at in range(0, stop, wave):
            part = ids[at : min(at + wave, stop)]
            blocks = [part[i : i + size] for i in range(0, len(part), size)]
            for block, code in zip(blocks, rangecoder.encode_blocks(blocks)):
                crc = zlib.crc32(block.astype("<u4"))
                self._write(_BLOCK.pack(len(block), len(code), crc) + code)
        self.held = [ids[stop:].copy()]
        self.size = len(ids) - stop

    def _write(self, raw):
        self.stream.write(raw)
        self.at += len(raw)

    def close(self):
        self._flush(True)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in (self.ids, self.nulls, self.lengths)]
        raw = zlib.compress(
            columns[0].astype("<i8").tobytes() + columns[1].astype(np.uint8).tobytes()
            + columns[2].astype("<i8").tobytes(), 1,
        )
        place = self.at
        # a block of no ids ends the blocks
        self._write(_BLOCK.pack(0, 0, 0))
        self._write(_TABLE.pack(len(columns[0]), len(raw), zlib.crc32(raw), 0) + raw)
        self._write(_PLACE.pack(place) + MAGIC)


def _exactly(stream, n):
    raw = stream.read(n)
    if len(raw) != n:
        raise ValueError("a token file ends too early")
    return raw


class TokenReader:
    """Reads one file: its documents' table, and its ids wave by wave."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()
        if self.size < 2 * len(MAGIC) + _PLACE.size or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        tail = file.read_at(_PLACE.size + len(MAGIC), self.size - _PLACE.size - len(MAGIC))
        if tail[_PLACE.size :] != MAGIC:
            raise ValueError("a token file has no end")
        file.seek(_PLACE.unpack(tail[: _PLACE.size])[0] + _BLOCK.size)
        n, size, crc, _ = _TABLE.unpack(_exactly(file, _TABLE.size))
        raw = _exactly(file, size)
        if zlib.crc32(raw) != crc:
            raise ValueError("a token file's table is damaged")
        raw = zlib.decompress(raw)
        self.nulls = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.lengths = np.frombuffer(raw, "<i8", n, 9 * n)

    def waves(self):
        """The ids of up to WAVE blocks at a time."""
        self.file.seek(len(MAGIC))
        codes, lengths, crcs = [], [], []
        while True:
            n, size, crc = _BLOCK.unpack(_exactly(self.file, _BLOCK.size))
            if n:
                codes.append(_exactly(self.file, size))
                lengths.append(n)
                crcs.append(crc)
            if codes and (not n or len(codes) == rangecoder.WAVE):
                blocks = rangecoder.decode_blocks(codes, lengths)
                if any(zlib.crc32(b.astype("<u4")) != c for b, c in zip(blocks, crcs)):
                    raise ValueError("a token file's block is damaged")
                yield np.concatenate(blocks)
                codes, lengths, crcs = [], [], []
            if not n:
                return

    def documents(self):
        """(first document, ids of documents that follow one another, their lengths)."""
        ends = np.cumsum(self.lengths)
        rest, done, doc = [], 0, 0
        for ids in self.waves():
            rest.append(ids)
            done += len(ids)
            stop = int(np.searchsorted(ends, done, "right"))
            if stop > doc:
                ids = np.concatenate(rest)
                used = int(self.lengths[doc:stop].sum())
                yield doc, ids[:used], self.lengths[doc:stop]
                rest, doc = [ids[used:]], stop
        if doc != len(self.lengths):
            raise ValueError("a token file holds fewer ids than its documents")


def write(docs, folder, path, end=END):
    """Write (doc_id, text) rows as token files; the number of documents and ids written."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(1, -(-chars // FILE_CHARS))
    hashed = F.xxhash64("text")
    rows = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(files, F.asc_nulls_first("doc_id"), hashed, "_place")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), hashed, "_place")
        .drop("_place")
    )

    def run(batches):
        reuse()
        encode = encoder(path)
        name = f"part-{TaskContext.get().partitionId():06d}.tokens"
        documents = tokens = 0
        with NewFile(folder, name) as stream:
            writer = TokenWriter(stream)
            for batch in whole_rows(batches, 1, ENCODE_BYTES):
                data, offsets = buffers(batch.column(1))
                ids, bounds = encode.encode_column(batch.column(1), data, offsets)
                ids = np.insert(ids, bounds[1:], encode.dtype(end))
                lengths = np.diff(bounds) + 1
                # at once no more than a wave
                step = rangecoder.BLOCK * rangecoder.WAVE
                edges = np.r_[0, np.cumsum(lengths)]
                at = 0
                while at < len(lengths):
                    to = max(int(np.searchsorted(edges, edges[at] + step, "right")) - 1, at + 1)
                    writer.add(batch.column(0).slice(at, to - at), ids[edges[at] : edges[to]], lengths[at:to])
                    at = to
                documents += len(lengths)
                tokens += len(ids)
            writer.close()
        yield pa.record_batch(
            [pa.array([documents]), pa.array([tokens], pa.int64())], names=["documents", "tokens"]
        )

    written = rows.mapInArrow(run, "documents long, tokens long")
    return tuple(written.agg(F.sum("documents"), F.sum("tokens")).first())


def read(spark, folder):
    """(doc_id, start, n_tokens, ids_crc32, file) of every document, from the files."""
    files = listed(spark, folder, "*.tokens").select("path")
    spread = files.repartition(max(1, files.count()))

    def run(batches):
        reuse()
        for batch in batches:
            for address in batch.column(0).to_pylist():
                system, place = opened(address)
                with system.open_input_file(place) as file:
                    reader = TokenReader(file)
                    before = 0
                    for doc, ids, lengths in reader.documents():
                        edges = np.r_[0, np.cumsum(lengths)]
                        raw = ids.astype("<u4")
                        crcs = [zlib.crc32(raw[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                        some = slice(doc, doc + len(lengths))
                        yield pa.record_batch(
                            [
                                pa.array(reader.doc_ids[some], pa.int64(), mask=reader.nulls[some]),
                                pa.array(before + edges[:-1]), pa.array(lengths),
                                pa.array(crcs, pa.int64()), pa.array([address] * len(lengths)),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
                        )
                        before += int(edges[-1])

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def numbered(found):
    """``read``'s rows with ``start`` counted over all files: a row per file is summed up."""
    sizes = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return found.join(before, "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op8_tokens(spark, sf_dir):
    """The contract's rows, read back from the files written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "tokens")
    write(docs, folder, tokenizer_path("byte_bpe_50k.json"))
    return numbered(stored(read(spark, folder), "tokens-read"))
