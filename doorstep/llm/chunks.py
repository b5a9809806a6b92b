"""Encoding with chunks that documents share encoded once, and decoding.

Texts are cut into chunks where a rolling hash of the last ``SPAN`` bytes has ten zero
bits, so that equal passages are cut alike wherever they stand.  A chunk that occurs more
than once is encoded in one document, its first, and reused in all others.

A chunk's ids hold for its body only: from the first to the last place inside it where
the tokenizer's word splitting begins anew whatever surrounds the chunk (see ``vocab``).
What lies between two bodies, across the join of their chunks, is encoded again in its
document; a chunk without a body joins that stretch.  The ids are those of the whole text
then, whatever the chunks.  A text that holds the string of an added token is encoded
whole.

Steps: chunks are listed by hash and place (no text is moved for it); the texts are
joined with the list of their shared chunks; each task encodes what is its own, and each
shared chunk's first occurrence; then the shared ids are joined to where they are missing,
and a document's parts, in order, run through the digests one after another, however long
it is.  Texts are dealt by their MD5 digest, which also stands for their copies: a text
is encoded once for all its copies, and hashes of 128 bits identify texts and chunks.

A null text is an empty one, with no ids.  Null or repeated ids get a row each.  An empty
table gives an empty result; extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F

from .shared import stored
from .text import buffers, whole_rows
from .vocab import cuts, encoder, tokenizer_path

#: Bytes that a boundary depends on, and one boundary in so many places.
SPAN = 16
SPACING = 1024
ENCODE_BYTES = 8 << 20

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_bounds(data, offsets):
    """Where chunks begin, and per text the number of chunks before it."""
    rolling = _GEAR[data]
    step = 1
    while step < SPAN:  # sums over 2, 4, 8, then 16 bytes
        rolling[step:] += rolling[:-step] << np.uint32(step)
        step *= 2
    hit = (rolling >> np.uint32(32 - SPACING.bit_length() + 1)) == 0
    hit[:SPAN] = False
    begins = np.zeros(len(data) + 1, bool)
    begins[1:] = hit
    begins[:-1] &= (data & 0xC0) != 0x80  # whole code points
    # near a text's start the hash saw the text before it
    for k in range(1, SPAN):
        early = offsets[:-1] + k
        begins[early[early < len(data)]] = False
    begins[offsets[:-1]] = True
    begins[-1] = False
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def _chunk_rows(batches):
    """(hash, key, place) of every chunk of every distinct text of a task."""
    seen = set()
    for batch in whole_rows(batches, 1):
        keys = batch.column(0).to_pylist()
        data, offsets = buffers(batch.column(1))
        starts, edges = chunk_bounds(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        raw = data.tobytes()
        hashes, owner, place = [], [], []
        for i, key in enumerate(keys):
            if key in seen:
                continue
            seen.add(key)
            a, b = int(edges[i]), int(edges[i + 1])
            for k in range(a, b):
                hashes.append(xxhash.xxh3_128_digest(raw[starts[k] : ends[k]]))
            owner += [key] * (b - a)
            place += range(b - a)
        yield pa.record_batch(
            [pa.array(hashes, pa.binary()), pa.array(owner, pa.binary()), pa.array(place, pa.int32())],
            names=["hash", "key", "place"],
        )


def _packed_texts(batches):
    """(key, compressed text), once per task for texts that repeat."""
    seen, press = set(), zstandard.ZstdCompressor(level=1)
    for batch in whole_rows(batches, 1):
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out_keys, out = [], []
        for key, text in zip(keys, texts):
            if key not in seen:
                seen.add(key)
                out_keys.append(key)
                out.append(press.compress(text.encode()))
        yield pa.record_batch(
            [pa.array(out_keys, pa.binary()), pa.array(out, pa.binary())], names=["key", "packed"]
        )


class Digest:
    """Digests of a document's ids and of its decoded text, part by part."""

    def __init__(self, tokens):
        self.tokens = tokens
        self.n, self.ids, self.text = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids):
        if len(ids):
            gap = b" " if self.n else b""
            listed = ids.tolist()
            self.n += len(listed)
            self.ids.update(gap + " ".join(map(str, listed)).encode())
            self.text.update(gap + b" ".join([self.tokens[i] for i in listed]))

    def row(self):
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


def _tokens(encode):
    """The decoded form of each id: without a decoder, tokens stand between blanks."""
    if encode.tokenizer.decoder is not None:
        raise ValueError("only vocabularies without a decoder join tokens by blanks")
    return [(encode.tokenizer.id_to_token(i) or "").encode() for i in range(encode.size)]


_DONE, _PART, _CHUNK, _MISSING = 0, 1, 2, 3
_PIECES = (
    "kind int, key binary, seq int, hash binary, ids binary,"
    " n_tokens long, ids_sha256 string, decoded_sha256 string"
)
_NAMES = [x.split()[0] for x in _PIECES.split(",")]
_KINDS = [pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]


def _bodies(places, starts, ends):
    """The first and last place in each chunk that its own bytes decide."""
    low = np.searchsorted(places, starts + 3)
    high = np.searchsorted(places, ends - 3, "right") - 1
    last = len(places) - 1
    return places[np.minimum(low, last)], places[np.maximum(high, 0)], low < high


def _encode_texts(path):
    def run(batches):
        encode = encoder(path)
        tokens = _tokens(encode)
        unpack = zstandard.ZstdDecompressor()
        before = None  # copies of a text follow one another
        for batch in batches:
            rows, size = [], 0
            for key, packed, shared in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != before:
                    before = key
                    rows.append((key, unpack.decompress(packed), shared or []))
                    size += len(rows[-1][1])
                if size > ENCODE_BYTES:
                    yield _encoded(encode, tokens, rows)
                    rows, size = [], 0
            if rows:
                yield _encoded(encode, tokens, rows)

    return run


def _encoded(encode, tokens, rows):
    data = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
    offsets = np.r_[0, np.cumsum([len(r[1]) for r in rows])].astype(np.int64)
    starts, edges = chunk_bounds(data, offsets)
    ends = np.r_[starts[1:], len(data)]
    special = set(encode._with_added(data, offsets).tolist())
    # the bodies of shared chunks: (text, start, end, hash, whether encoded here)
    low, high, whole = _bodies(cuts(data, offsets), starts, ends) if len(starts) else ([], [], [])
    spans, where = [], []
    for i, (_, text, shared) in enumerate(rows):
        at, seq = int(offsets[i]), 0
        for place, chunk, first in sorted((s["place"], s["hash"], s["first"]) for s in shared):
            k = int(edges[i]) + place
            if whole[k]:
                spans.append((i, at, int(low[k]), None, True))
                spans.append((i, int(low[k]), int(high[k]), chunk, first))
                at = int(high[k])
        spans.append((i, at, int(offsets[i + 1]), None, True))
    keep = np.ones(len(data), bool)
    for i, a, b, _, here in spans:
        if not here:
            keep[a:b] = False
    own = [b - a for _, a, b, _, here in spans if here]
    ids, bounds = encode.encode(data[keep], np.r_[0, np.cumsum(own)].astype(np.int64))
    out, at, digest, waits = [], 0, {}, {x[0] for x in spans if not x[4]} - special
    seq = [0] * len(rows)
    for i, a, b, chunk, here in spans:
        key, n = rows[i][0], seq[i]
        seq[i] += 1
        if not here:
            if i in waits:
                out.append((_MISSING, key, n, chunk, None, None, None, None))
            continue
        part = ids[bounds[at] : bounds[at + 1]]
        at += 1
        if chunk is not None:
            out.append((_CHUNK, None, None, chunk, part.astype("<u4").tobytes(), None, None, None))
        if i in waits:
            if len(part):
                out.append((_PART, key, n, None, part.astype("<u4").tobytes(), None, None, None))
        elif i not in special:
            digest.setdefault(i, Digest(tokens)).add(part)
    for i in special:
        digest[i] = Digest(tokens)
        digest[i].add(np.array(encode.raw(rows[i][1].decode()), np.int64))
    for i, d in digest.items():
        out.append((_DONE, rows[i][0], None, None, None, *d.row()))
    columns = list(zip(*out)) if out else [()] * len(_NAMES)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _finish(path):
    """Digest parts that come in order of key and place."""
    def run(batches):
        tokens = _tokens(encoder(path))
        key, digest = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if digest:
                        done.append((key, *digest.row()))
                    key, digest = k, Digest(tokens)
                digest.add(np.frombuffer(ids, "<u4"))
            yield _digest_rows(done)
        if digest:
            yield _digest_rows([(key, *digest.row())])

    return run


def _digest_rows(rows):
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def encode_texts(docs, path):
    """(key, n_tokens, ids_sha256, decoded_sha256) of every distinct text, by its MD5."""
    texts = docs.select(
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    listed = stored(texts.mapInArrow(_chunk_rows, "hash binary, key binary, place int"), "chunk-list")
    spot = F.struct("key", "place")
    shared = (
        listed.groupBy("hash")
        .agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
        .where("first != last")
        .select("hash", "first")
    )
    shared_by_text = (
        listed.join(shared, "hash")
        .select("key", F.struct("place", "hash", (F.struct("key", "place") == F.col("first")).alias("first")).alias("s"))
        .groupBy("key")
        .agg(F.collect_set("s").alias("shared"))  # a text's own chunks, no more
    )
    packed = texts.mapInArrow(_packed_texts, "key binary, packed binary")
    pieces = stored(
        packed.join(shared_by_text, "key", "left")
        .select("key", "packed", "shared")
        .mapInArrow(_encode_texts(path), _PIECES),
        "chunk-pieces",
    )
    # a split hot text is encoded by several tasks, with equal results
    ids = pieces.where(F.col("kind") == _CHUNK).groupBy("hash").agg(F.first("ids").alias("ids"))
    missing = pieces.where(F.col("kind") == _MISSING).select("key", "seq", "hash").distinct()
    parts = (
        pieces.where(F.col("kind") == _PART)
        .groupBy("key", "seq")
        .agg(F.first("ids").alias("ids"))
        .unionByName(missing.join(ids, "hash").select("key", "seq", "ids"))
    )
    finished = (
        parts.repartition("key").sortWithinPartitions("key", "seq")
        .mapInArrow(_finish(path), "key binary, n_tokens long, ids_sha256 string, decoded_sha256 string")
    )
    done = pieces.where(F.col("kind") == _DONE).select(finished.columns).dropDuplicates(["key"])
    return done.unionByName(finished)


def encode_and_decode(docs, path=None):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    path = path or tokenizer_path("word_bpe_49k.json")
    found = encode_texts(docs, path)
    keyed = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"))
    return keyed.join(found, "key").drop("key")


def op9_chunks(spark, sf_dir):
    """The contract's rows: ids and decoded text of every document, as digests."""
    return encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
