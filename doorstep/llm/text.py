"""Texts of an Arrow batch as numpy arrays: splitting, counting and numbering words.

Everything here works on the UTF-8 bytes of many texts at once.  A null text counts as
an empty one.  White space is what the contracts name: the bytes 09-0D and 20.
"""

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled at once; a longer text is handled alone.
PART_BYTES = 4 << 20


def fold(column, parts):
    """``crc32`` of the id's text modulo ``parts``; a row without id is in no fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts, F.lit(-1))


def one_text(rows, label):
    """One row an id and label: of texts that share an id, the one of the smallest hash."""
    order = F.struct(F.xxhash64("text"), "text")
    return rows.groupBy("doc_id", label).agg(F.min_by("text", order).alias("text")).select("doc_id", "text", label)


def whole_rows(batches, column, limit=PART_BYTES):
    """The batches, cut so that a part holds ``limit`` bytes of text or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = buffers(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
        release()


def gathered(batches, column, limit):
    """Batches put together until they hold ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        more = int(buffers(batch.column(column))[1][-1])
        if held and size + more > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.concat_batches(held)


#: What modules remember in a worker from task to task, by module.
CACHES = {}


def forget(but=None):
    """Drop what other modules remember in this worker: it lives on from stage to stage."""
    for name, cache in CACHES.items():
        if name != but:
            cache.clear()
    release()


_libc = ctypes.CDLL(None)
_trim = getattr(_libc, "malloc_trim", None)
_option = getattr(_libc, "mallopt", None)


def reuse():
    """Let numpy's working arrays take over each other's memory, until :func:`release`.

    Else the C library hands arrays of a megabyte or so back to the system and asks for them
    anew each time, and clearing their pages costs as much as computing on them.
    """
    if _option:
        _option(-3, 8 << 20)  # M_MMAP_THRESHOLD: what is larger still goes back at once
        _option(-1, 32 << 20)  # M_TRIM_THRESHOLD


def release():
    """Give freed memory back: a worker lives on, beside others, when its task is done."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def buffers(column):
    """(bytes, offsets) of a string or binary column; offsets index the bytes."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data, offsets):
    """Starts and ends of the words, and per text the number of words before it."""
    n = len(data)
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    if n:
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def binary_array(data, offsets):
    """An Arrow binary array over bytes that follow one another."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
    )


def numbered(data, starts, ends):
    """Number the pieces ``data[start:end]``: (number per piece, distinct pieces).

    Equal pieces get equal numbers, by their whole bytes.  Pieces must not overlap and
    must be in order.
    """
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    if offsets[-1] != len(data):
        # starts are distinct among themselves, and so are ends
        change = np.zeros(len(data) + 1, np.int8)
        change[starts] += np.int8(1)
        change[ends] -= np.int8(1)
        data = data[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    found = binary_array(data, offsets).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def utf8_lengths(data):
    """1 for every byte that begins a code point."""
    return (data & 0xC0) != 0x80
