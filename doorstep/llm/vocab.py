"""Encoding many texts with a public tokenizer, each distinct piece of text once.

A text is cut at places where the tokenizer's own word splitting always begins anew, so
the ids of the pieces, one after another, are the ids of the text:

* before a single blank, and on both sides of a single line feed, between two
  characters that are no white space;
* between a letter and a following ASCII sign, and between an ASCII sign other than the
  apostrophe and a following letter.

Both word patterns served here (byte-level and word-end) start a new word at these
places whatever stands before or after them.  Letters are those of ASCII and Latin-1;
around other characters nothing is cut.  Texts that hold the string of an added token
are encoded whole.  Every id comes from the ``tokenizers`` library.
"""

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import CACHES, LOWER, numbered

#: Distinct pieces that a worker remembers; beyond that only those last asked for stay.
CACHE_PIECES = 500_000
#: Bytes of a piece that is remembered.
CACHE_BYTES = 255

_LETTER, _SIGN, _DIGIT, _BLANK, _FEED = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _LETTER
_KIND[97:123] = _LETTER
_KIND[0x20] = _BLANK
_KIND[0x0A] = _FEED
_APOSTROPHE = 39


def cuts(data, offsets, window=4 << 20):
    """Places where pieces begin, ascending; those of ``offsets`` are among them."""
    n = len(data)
    found = []
    for at in range(0, max(n, 1), window):
        # one byte before and two after decide about a place
        low, high = max(at - 2, 0), min(at + window + 2, n)
        first, last = np.searchsorted(offsets, [low, high + 1])
        cut = _cuts(data[low:high], offsets[first:last] - low)
        end = n + 1 if at + window >= n else at + window
        found.append((np.flatnonzero(cut[at - low : end - low]) + at).astype(np.int32))
    return np.concatenate(found)


def _cuts(data, edges):
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    if len(data) > 2:
        kind = _KIND[data]
        # a two-byte Latin-1 letter: C3 and no multiplication or division sign
        pair = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins = kind == _LETTER
        ends = begins.copy()
        begins[:-1] |= pair
        ends[1:] |= pair
        sign = kind == _SIGN
        alone = ~cut[1:-2] & ~cut[2:-1]  # a byte that has both neighbours in its text
        cut[1:-1] |= ends[:-1] & sign[1:]
        cut[1:-1] |= sign[:-1] & (data[:-1] != _APOSTROPHE) & begins[1:]
        sign |= kind == _DIGIT
        alone &= (ends | sign)[:-2] & (begins | sign)[2:]
        feed = alone & (kind[1:-1] == _FEED)
        cut[1:-2] |= feed | (alone & (kind[1:-1] == _BLANK))
        cut[2:-1] |= feed
    return cut


class PieceEncoder:
    """Encodes texts with a tokenizer file and remembers the pieces it has met."""

    def __init__(self, path, plain_special=False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_special
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.lowers = "Lowercase" in json.dumps(kind["normalizer"])
        self.added = [] if plain_special else [
            t["content"].encode() for t in kind["added_tokens"]
        ]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        # remembered pieces, their numbers of ids, and all their ids one after another
        self.pieces = pa.array([], pa.large_binary())
        self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def raw(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _look_up(self, pieces):
        """(place of each piece, numbers of ids by place, ids by place)."""
        found = pc.index_in(pieces, value_set=self.pieces)
        missing = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        at = found.fill_null(0).to_numpy().astype(np.int64)
        at[missing] = len(self.pieces) + np.arange(len(missing))
        fresh = pieces.take(pa.array(missing))
        lengths, ids = [self.lengths], [self.pool]
        for i in range(0, len(fresh), 20_000):
            part = fresh.slice(i, 20_000).cast(pa.large_string()).to_pylist()
            made = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, made), np.int64, len(made)))
            ids.append(np.fromiter(chain.from_iterable(made), self.dtype, int(lengths[-1].sum())))
        lengths, pool = np.concatenate(lengths), np.concatenate(ids)
        keep = np.ones(len(lengths), bool)
        keep[len(self.pieces) :] = pc.binary_length(fresh).to_numpy() <= CACHE_BYTES
        if len(keep) > CACHE_PIECES:
            asked = np.zeros(len(keep), bool)
            asked[at] = True
            keep &= asked
            keep &= np.cumsum(keep) <= CACHE_PIECES
        self.pieces, self.lengths, self.pool = pa.concat_arrays([self.pieces, fresh]), lengths, pool
        if not keep.all():
            self.pieces = self.pieces.filter(pa.array(keep))
            self.lengths, self.pool = lengths[keep], pool[np.repeat(keep, lengths)]
        return at, lengths, pool

    def encode(self, data, offsets):
        """(ids of all texts one after another, number of ids before each text)."""
        if self.lowers:
            data = LOWER[data]
        places = cuts(data, offsets)
        codes, distinct = numbered(data, places[:-1], places[1:])
        at, lengths, pool = self._look_up(distinct)
        firsts = (np.cumsum(lengths) - lengths)[at]
        lengths = lengths[at]
        del at, distinct
        edges = np.searchsorted(places, offsets)
        counts = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(lengths[codes], out=counts[1:])
        ids = np.empty(counts[-1], self.dtype)
        for at in range(0, len(codes), 1 << 18):
            part = codes[at : at + (1 << 18)]
            n, base = lengths[part], counts[at]
            ends = counts[at + 1 : at + 1 + len(part)] - base
            where = np.repeat(firsts[part] - (ends - n), n) + np.arange(ends[-1])
            ids[base : base + len(where)] = pool[where]
        return ids, counts[edges]

    def encode_column(self, column, data, offsets):
        """As :meth:`encode`, with texts that hold an added token encoded whole."""
        ids, bounds = self.encode(data, offsets)
        held = self._with_added(data, offsets)
        if not len(held):
            return ids, bounds
        rows = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i in held:
            rows[i] = np.array(self.raw(column[int(i)].as_py()), self.dtype)
        bounds = np.r_[0, np.cumsum([len(r) for r in rows])]
        return np.concatenate(rows), bounds

    def _with_added(self, data, offsets):
        whole = data.tobytes() if self.added else b""
        found = set()
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[i + 1]:
                    found.add(i)
                at = whole.find(token, at + 1)
        return np.array(sorted(found), np.int64)


_encoders = CACHES.setdefault("vocab", {})


def encoder(path, plain_special=False):
    """The worker's encoder for a tokenizer file; kept from task to task."""
    key = (path, plain_special)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, plain_special)
    return _encoders[key]


def tokenizer_path(name):
    import public_tokenizers

    return public_tokenizers.path(name)
