"""Packing token pieces into sequences: first-fit decreasing with a tournament tree.

Pieces are dealt to randomised groups of about ``GROUP_ROWS``; each group packs for
itself, longest piece first, into the first sequence with room.  The room of all open
sequences stands in a tournament tree whose inner nodes hold the larger of their
children, so that the first sequence with room is found from the root in
``log2(sequences)`` steps.  The number of groups follows the number of pieces; a group's
sequences are not shared with others.

``token_pieces`` encodes whole texts, ends each with ``END`` and cuts what is longer than
a sequence: full pieces first, the rest last.  Only the pieces' numbers are shuffled, and
the ids are not, unless they are asked for (``with_ids``), for ``sequences`` to join them.

A null or empty text is the end id alone.  Rows that repeat, ids that are null or occur
twice are packed each for itself.  Pieces of equal length are placed in the order of
their columns.  An empty table gives no sequence.  Other columns are not kept by
``token_pieces``; ``pack`` keeps all columns and replaces its own two.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import stored, widened
from .text import buffers, forget, whole_rows
from .vocab import encoder, tokenizer_path

CAPACITY = 2048
END = 1
#: Pieces in a group, on average.
GROUP_ROWS = 4096
#: Bytes of text encoded at once; larger parts repeat fewer pieces.
ENCODE_BYTES = 12 << 20

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths, capacity=CAPACITY):
    """(sequence, offset) of every piece; sequences are numbered from 0."""
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) and (lengths.min() < 0 or lengths.max() > capacity):
        raise ValueError("a piece must have between 0 and capacity tokens")
    order = np.argsort(-lengths, kind="stable")
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        sequence[i] = node - leaves
        offset[i] = capacity - tree[node]
        tree[node] -= n
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return sequence, offset


def token_pieces(docs, path, end=END, capacity=CAPACITY, with_ids=False):
    """The pieces of every whole text: a row of numbers each, and the ids if asked for."""
    def run(batches):
        forget("vocab")
        encode = encoder(path)
        for batch in whole_rows(batches, 1, ENCODE_BYTES):
            data, offsets = buffers(batch.column(1))
            ids, bounds = encode.encode_column(batch.column(1), data, offsets)
            counts = np.diff(bounds) + 1
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(batch.num_rows), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(counts[doc] - start, capacity)
            low = bounds[doc] + start
            last = start + length == counts[doc]
            crcs, held = [], []
            for a, n, closes in zip(low.tolist(), length.tolist(), last.tolist()):
                part = ids[a : a + n - closes].astype("<u4")
                raw = np.append(part, np.uint32(end)).astype("<u4") if closes else part
                crcs.append(zlib.crc32(raw))
                if with_ids:
                    held.append(raw)
            columns = [
                batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length),
                pa.array(crcs, pa.int64()), pa.array(counts[doc]),
            ]
            if with_ids:
                columns.append(pa.array([x.astype(np.int64) for x in held], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + (", ids array<long>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(pieces, length="length", capacity=CAPACITY):
    """``pieces``, which should be a stored table, with ``sequence_id`` and ``offset``."""
    pieces, schema = widened(pieces, sequence_id="long", offset="long")
    groups = max(1, -(-pieces.count() // GROUP_ROWS))
    columns = [f.name for f in schema.fields]
    # the row's number decides too, so that rows that repeat are dealt to all groups
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(11)), F.lit(groups))

    def run(key, rows):
        rows = rows.drop(columns="_group")
        keys = [c for c in columns[:-2] if c != length and rows[c].map(np.isscalar).all()]
        rows = rows.sort_values(keys, kind="stable").reset_index(drop=True) if keys else rows
        sequence, offset = first_fit_decreasing(rows[length].to_numpy(), capacity)
        more = {"sequence_id": (int(key[0]) << 32) + sequence, "offset": offset}
        return pd.concat([rows, pd.DataFrame(more)], axis=1)[columns]

    return pieces.withColumn("_group", group).groupBy("_group").applyInPandas(run, schema)


def sequences(packed):
    """The ids of each sequence, from packed pieces that carry theirs."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids")
    )


def packed_documents(docs, path=None):
    """Every document's pieces and where they lie."""
    path = path or tokenizer_path("word_bpe_49k.json")
    return pack(stored(token_pieces(docs, path), "pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_packing(spark, sf_dir):
    """The contract's rows: the pieces of every document, packed."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
