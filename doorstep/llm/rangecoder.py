"""An adaptive context-mixing range coder for token ids, many blocks at a time.

Within a block three models predict the next id: the id that last followed the two ids
before it (order 2), the one that last followed the id before it (order 1), and the
ids' frequencies (order 0).  How often a prediction has held so far, counted apart for
where orders 1 and 2 agree, sets its share; the shares mix the models into one
distribution that drives an arithmetic (range) coder with carries.  An id that order 0
has not seen is sent in plain bits behind an escape.  Shares are renewed every
``_RENEW`` ids, order 0 when a block's first 64, 256, 1024 and 2048 ids are complete.

Blocks are reset independently, so any of them can be decoded alone.  Numpy takes one
step in all blocks of a wave at once.  The encoder knows all ids and finds predictions
and shares without stepping; only the decoder has to step through the models.
"""

import numpy as np

#: Ids in a block, and blocks in a wave (a bound on memory).
BLOCK = 4096
WAVE = 2048

_SLOT_BITS = 10
_REFRESH = (64, 256, 1024, 2048)
_RENEW = 64
_TOGETHER = 128  # blocks modelled at once by the encoder, few enough for the caches
_UNIT_BITS = 20
_UNIT = 1 << _UNIT_BITS  # shares add up to this
_TOP = 1 << 48
_LEAST = 1 << 32


def _slot2(x1, x2):
    """Of unsigned 32-bit ids, whose products run over."""
    return (x1 * np.uint32(0x9E3779B1) + x2 * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _SLOT_BITS)


def _slot1(x1):
    return (x1 * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOT_BITS)


def _share(whole, hits, cases, most):
    """A prediction's share of ``whole``, from how often it has held."""
    return np.minimum(np.maximum(whole * (2 * hits + 1) // (2 * cases + 4), whole >> 8), most)


def _borders(n):
    """Ends of the shares of order 2, order 1 and order 0: (3, apart or agreeing, blocks).

    ``n`` counts, per block: agreeing, of these right; apart, of these order 2 right,
    else order 1 right; neither while order 0 was there, of these escapes.
    """
    agree, agree_hit, apart, hit2, hit1, other, escape = n
    ends = np.empty((3, 2, len(agree)), np.int32)
    whole = np.full(len(agree), _UNIT)
    for k, (cases, hits) in enumerate(((apart, hit2), (agree, agree_hit))):
        f2 = _share(whole, hits, cases, _UNIT * 15 // 16)
        rest = _UNIT - f2
        f1 = np.zeros_like(rest) if k else _share(rest, hit1, apart - hit2, rest * 15 >> 4)
        rest = rest - f1
        fe = _share(rest, escape, other, rest >> 1)
        ends[0, k], ends[1, k], ends[2, k] = f2, f2 + f1, _UNIT - fe
    return ends


def _layout(lengths):
    """Longest first: the order of blocks, and how many are alive at each step."""
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max(initial=0))
    alive = np.searchsorted(-lengths[order], -np.arange(steps), "left")
    return order, alive


class _Writer:
    def __init__(self, lanes, words):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _TOP)
        # a row holds one word of every block: what is written at about one time lies together
        self.out = np.zeros(words * lanes, "<u2")
        self.lanes, self.words = lanes, words
        self.n = np.arange(lanes)  # where a block's next word goes

    def put(self, n, bits, start, size):
        """Narrow the first ``n`` blocks to ``start`` .. ``start + size`` of ``2**bits``."""
        self.low[:n], self.range[:n], self.n[:n] = self._put(
            self.low[:n], self.range[:n], self.n[:n], bits, start, size
        )

    def put_some(self, who, bits, start, size):
        self.low[who], self.range[who], self.n[who] = self._put(
            self.low[who], self.range[who], self.n[who], bits, start, size
        )

    def _put(self, low, span, at, bits, start, size):
        step = span >> bits
        low = low + step * start
        span = step * size
        carry = np.flatnonzero(low >= _TOP)
        if len(carry):
            low[carry] -= _TOP
            back = at[carry] - self.lanes
            while len(back):
                self.out[back] += 1
                back = back[self.out[back] == 0] - self.lanes
        while span.min(initial=_TOP) < _LEAST:
            # every block writes its top word; only where it is due does it count
            due = (span < _LEAST).astype(np.int64)
            self.out[at] = (low >> 32).astype(np.uint16)
            at = at + due * self.lanes
            shift = due << 4
            low = (low & (_TOP - 1 >> shift)) << shift
            span = span << shift
        return low, span, at

    def end(self):
        """The words of each block."""
        for shift in (32, 16, 0):
            self.out[self.n] = ((self.low >> shift) & 0xFFFF).astype(np.uint16)
            self.n += self.lanes
        sizes = self.n // self.lanes
        out = self.out.reshape(self.words, self.lanes)[: sizes.max(initial=0)]
        # a part of the blocks at once: each needs a copy in its own order
        for i in range(0, self.lanes, _TOGETHER):
            for row, n in zip(out[:, i : i + _TOGETHER].T.copy(), sizes[i : i + _TOGETHER]):
                yield row[:n]


def _by_value(values, most):
    """Per block its values in order, equal ones by place, and all their places in the table."""
    lanes, steps = values.shape
    kind = np.int32 if (most + 1) * BLOCK <= 1 << 31 else np.int64
    # a value and its place in one number, to be sorted as they are
    keys = np.sort(values.astype(kind) * kind(BLOCK) + np.arange(steps, dtype=kind), axis=1)
    places = (keys & kind(BLOCK - 1)) + (np.arange(lanes) * steps)[:, None]
    return keys // kind(BLOCK), places


def _last_followers(ids, slots):
    """Per place the id at the last earlier place of its block with the same slot, or 0."""
    ranked, places = _by_value(slots, 1 << _SLOT_BITS)
    by_slot = ids.reshape(-1).take(places)
    before = np.zeros(ids.shape, ids.dtype)
    np.multiply(by_slot[:, :-1], ranked[:, 1:] == ranked[:, :-1], out=before[:, 1:])
    out = np.empty_like(before)
    out.reshape(-1)[places] = before
    return out


def _ranks(ids, inside):
    """Ids as their rank among the distinct ids of their block."""
    most = int(ids.max(initial=0))
    by_rank, places = _by_value(np.where(inside, ids, np.uint32(most)), most)
    fresh = np.zeros(ids.shape, np.int16)
    fresh[:, 1:] = by_rank[:, 1:] != by_rank[:, :-1]
    ranks = np.empty(ids.shape, np.int16)
    ranks.reshape(-1)[places] = np.cumsum(fresh, axis=1, dtype=np.int16)
    return ranks


def _spans(ids, lengths):
    """(start, size, whether escaped) of every id, as steps x blocks."""
    lanes, steps = ids.shape
    inside = np.arange(steps) < lengths[:, None]
    x1, x2 = np.zeros_like(ids), np.zeros_like(ids)
    x1[:, 1:] = ids[:, :-1]
    x2[:, 2:] = ids[:, :-2]
    guess2 = _last_followers(ids, _slot2(x1, x2))
    guess1 = _last_followers(ids, _slot1(x1))
    del x1, x2
    agree, hit2 = guess2 == guess1, guess2 == ids
    hit1 = (guess1 == ids) & ~hit2
    other = ~(hit2 | hit1)
    ranks = _ranks(ids, inside)
    # all shares and their products with places in order 0 stay below 2**31
    start = np.zeros((steps, lanes), np.int32)
    size = np.zeros((steps, lanes), np.int32)
    escaped = np.zeros((steps, lanes), bool)
    counts = np.zeros((7, lanes), np.int64)
    seen = bits = 0
    for at in range(0, steps, _RENEW):
        if at in _REFRESH:
            seen, bits = at, at.bit_length() - 1
            # only blocks that reach this place need it; shorter ones are not read here
            width = int(ranks[:, :at].max()) + 1
            flat = (np.arange(lanes)[:, None] * width + ranks[:, :at]).ravel()
            many = np.bincount(flat, minlength=lanes * width).reshape(lanes, width)
            # where an id's share begins, and its size, in one number
            order0 = (((np.cumsum(many, axis=1) - many) << 16) | many).astype(np.int32).ravel()
            row = (np.arange(lanes) * width)[:, None]
        cut = slice(at, min(at + _RENEW, steps))
        a, h2, h1, o = agree[:, cut], hit2[:, cut], hit1[:, cut], other[:, cut]
        ends = _borders(counts)
        ends = np.where(a, ends[:, 1, :, None], ends[:, 0, :, None])
        if not seen:
            ends[2] = ends[1]
        known = np.zeros(a.shape, bool)
        low = np.where(h2, np.int32(0), np.where(h1, ends[0], ends[2]))
        high = np.where(h2, ends[0], np.where(h1, ends[1], np.int32(_UNIT)))
        if seen:
            r = ranks[:, cut]
            share = order0.take(np.minimum(r, width - 1) + row)
            first, run = share >> 16, share & 0xFFFF
            known = o & (r < width) & (run > 0)
            f0 = ends[2] - ends[1]
            low = np.where(known, ends[1] + (first * f0 >> bits), low)
            high = np.where(known, ends[1] + ((first + run) * f0 >> bits), high)
        start[cut], size[cut] = low.T, (high - low).T
        escaped[cut] = (o & ~known).T
        counts += _counted(a.T, h2.T, h1.T, o.T, known.T, seen)
    return start, size, escaped


def _counted(agree, hit2, hit1, other, known, seen):
    """What a stretch of steps (steps x blocks) adds to the counts of ``_borders``."""
    both = (agree & hit2).sum(0)
    agrees, others = agree.sum(0), other.sum(0)
    parts = [agrees, both, len(agree) - agrees, hit2.sum(0) - both, hit1.sum(0)]
    late = [others, others - known.sum(0)] if seen else [0 * others, 0 * others]
    return np.stack(parts + late)


def encode_blocks(blocks):
    """The code of each block of ids (at most ``BLOCK`` each, below 2**32)."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    order, alive = _layout(lengths)
    lanes, steps = len(blocks), len(alive)
    ids = np.zeros((lanes, max(steps, 1)), np.uint32)
    for i, k in enumerate(order):
        ids[i, : lengths[k]] = blocks[k]
    wide = bool(ids.max(initial=0) >> 16)
    start = np.empty((steps, lanes), np.int32)
    size, escaped = np.empty_like(start), np.empty(start.shape, bool)
    for i in range(0, lanes if steps else 0, _TOGETHER):
        part = slice(i, i + _TOGETHER)
        start[:, part], size[:, part], escaped[:, part] = _spans(ids[part], lengths[order[part]])
    writer = _Writer(lanes, 4 * steps + 4)
    for t, n in enumerate(alive.tolist()):
        writer.put(n, _UNIT_BITS, start[t, :n], size[t, :n])
        k = np.flatnonzero(escaped[t, :n])
        if len(k):
            plain = ids[k, t].astype(np.int64)
            if wide:
                writer.put_some(k, 16, plain >> 16, 1)
            writer.put_some(k, 16, plain & 0xFFFF, 1)
    code = [None] * lanes
    for k, words in zip(order, writer.end()):
        code[k] = bytes([wide]) + words.tobytes()
    return code


class _Reader:
    def __init__(self, codes):
        words = max(len(c) for c in codes) // 2 + 6
        table = np.zeros((len(codes), words), "<u2")
        for i, c in enumerate(codes):
            part = np.frombuffer(c, "<u2")
            table[i, : len(part)] = part
        w = table[:, :3].astype(np.int64)
        self.code = (w[:, 0] << 32) | (w[:, 1] << 16) | w[:, 2]
        # a row holds one word of every block: what is read at about one time lies together
        self.words, self.lanes = table.T.ravel(), len(codes)
        self.n = np.arange(len(codes)) + 3 * self.lanes
        self.range = np.full(len(codes), _TOP)

    def value(self, who, bits):
        # both numbers are below 2**48: the quotient of floats has the right whole part
        step = self.range[who] >> bits
        return step, np.minimum((self.code[who] / step).astype(np.int32), np.int32((1 << bits) - 1))

    def take(self, who, step, start, size):
        code = self.code[who] - step * start
        span = step * size
        while span.min(initial=_TOP) < _LEAST:
            due = (span < _LEAST).astype(np.int64)
            at = self.n[who]
            shift = due << 4
            code = (code << shift) | self.words.take(at, mode="clip") * due
            span = span << shift
            self.n[who] = at + due * self.lanes
        self.code[who] = code
        self.range[who] = span


def decode_blocks(codes, lengths):
    """The ids of blocks from their codes and lengths."""
    lengths = np.asarray(lengths, np.int64)
    out = [np.zeros(0, np.uint32)] * len(codes)
    for wide in (False, True):
        mine = [k for k, c in enumerate(codes) if bool(c[0]) == wide]
        if mine:
            found = _decode([codes[k][1:] for k in mine], lengths[mine], wide)
            for k, ids in zip(mine, found):
                out[k] = ids
    return out


def _decode(codes, lengths, wide):
    order, alive = _layout(lengths)
    lanes, steps = len(codes), len(alive)
    kind = np.uint32 if wide else np.uint16
    ids = np.zeros((max(steps, 1), lanes), kind)
    reader = _Reader([codes[k] for k in order])
    base = np.arange(lanes) << _SLOT_BITS
    guess2, guess1 = (np.zeros(lanes << _SLOT_BITS, kind) for _ in range(2))
    x1, x2 = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
    counts = np.zeros((7, lanes), np.int64)
    flags = np.zeros((5, _RENEW, lanes), bool)
    seen = bits = 0
    for t, n in enumerate(alive.tolist()):
        if t % _RENEW == 0:
            if t:
                counts += _counted(*flags, seen)
                flags[:] = False
            if t in _REFRESH:
                seen, bits = t, t.bit_length() - 1
                table, order0 = _tables(ids[:t, :n])
                row = np.arange(n) * t
            ends = _borders(counts)
            if not seen:
                ends[2] = ends[1]
        at2, at1 = _slot2(x1[:n], x2[:n]) + base[:n], _slot1(x1[:n]) + base[:n]
        now2, now1 = guess2.take(at2), guess1.take(at1)
        agree = now2 == now1
        end2, end1, end0 = np.where(agree, ends[:, 1, :n], ends[:, 0, :n])
        step, v = reader.value(slice(0, n), _UNIT_BITS)
        hit2 = v < end2
        past = v >= end1
        escaped = v >= end0
        start = np.where(hit2, np.int32(0), np.where(past, end0, end2))
        end = np.where(hit2, end2, np.where(past, np.int32(_UNIT), end1))
        x = np.where(hit2, now2, now1)
        known = past & ~escaped
        if seen:
            # for all blocks at once; where order 0 did not send, nothing of it is used
            f0 = end0 - end1
            j = ((((v - end1 + 1) << bits) - 1) / f0).astype(np.int64)
            j = np.minimum(np.maximum(j, 0), seen - 1) + row[:n]
            share = order0.take(j)
            first = share >> 16
            start = np.where(known, end1 + (first * f0 >> bits), start)
            end = np.where(known, end1 + ((first + (share & 0xFFFF)) * f0 >> bits), end)
            x = np.where(known, table.take(j), x)
        reader.take(slice(0, n), step, start, end - start)
        k = np.flatnonzero(escaped)
        if len(k):
            plain = np.zeros(len(k), np.int64)
            for _ in range(2 if wide else 1):
                step, half = reader.value(k, 16)
                reader.take(k, step, half, 1)
                plain = (plain << 16) | half
            x[k] = plain.astype(kind)
        ids[t, :n] = x
        guess2[at2] = x
        guess1[at1] = x
        # an id sent otherwise may still be what a model had said
        hit2, hit1 = now2 == x, (now1 == x) & (now2 != x)
        f = flags[:, t % _RENEW]
        f[0, :n], f[1, :n], f[2, :n], f[3, :n], f[4, :n] = agree, hit2, hit1, ~(hit2 | hit1), known
        x2[:n] = x1[:n]
        x1[:n] = x
    found = [None] * lanes
    for i in range(0, lanes, _TOGETHER):
        part = order[i : i + _TOGETHER]
        for k, column in zip(part, ids[:, i : i + _TOGETHER].T.astype(np.uint32, order="C")):
            found[k] = column[: lengths[k]]
    return found


def _tables(ids):
    """Order 0 from steps x blocks: the ids in order, and where each one's run lies."""
    t, n = ids.shape
    table = ids.T.astype(np.uint32, order="C")
    table.sort(axis=1)
    change = np.ones((n, t), bool)
    change[:, 1:] = table[:, 1:] != table[:, :-1]
    edges = np.flatnonzero(change)
    runs = np.diff(edges, append=n * t)
    return table.ravel().astype(ids.dtype), np.repeat((((edges % t) << 16) | runs).astype(np.int32), runs)
