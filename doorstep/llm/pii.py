"""Personal data by fixed patterns and a skip-chain conditional random field.

**Base.**  E-mail and network addresses, card numbers with a right check digit and phone
numbers are found by their patterns, each kind for itself, leftmost first; a match that
fails its test is dropped and not tried again inside.

**Field.**  Pieces of a text with a digit or an ``@`` are the field's nodes; every other
word is outside.  Nodes that stand side by side share a potential of their labels (begin
and continue, for numbers of several pieces).  Equal pieces, and pieces that end in the
same seven digits, share one however far apart: each is linked to the next such piece of
its document, so the links grow with the text.  Loopy message passing gives each node's
marginals; pieces inside a base span are fixed to its label.  What the field labels beyond
that becomes a span if it passes the test of its kind: the card's check digit, 8 to 15
digits for a phone with a plus sign or with the last seven digits of another span, and so
on.  So a number that its neighbour swallowed, or one that is repeated in another form, is
found; base spans always stay.

**Learning.**  Labels are the base spans of the corpus itself.  Pieces in a match with too
many digits are unknown and not learned from; pieces in other dropped matches are outside.
Weights maximise the pseudo-likelihood of at most ``SAMPLE`` pieces of each label, those of
the smallest hash, weighted to their share; each is seen again without some of its telling
features and without any, so that its neighbours and links are learned from as well.

Offsets are code points.  A null text is empty.  Equal rows give equal results; without
any span to learn from nothing is added.  No rows: no result.  Other columns are ignored.
"""

import functools
import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored, widened
from .text import whole_rows

KINDS = ["email", "ip", "card", "phone"]
#: Bound of the sample of pieces, per label.
SAMPLE = 4_000
ROUNDS = 24
STEPS = 250
PART_BYTES = 2 << 20

# --- base patterns -------------------------------------------------------------------

# An e-mail's local part is looked for from its @ to the left, in linear time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _digits(text):
    return _NOT_DIGIT.sub("", text)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part):
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def emails(text):
    """(start, end) of the e-mail addresses, leftmost first and apart."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                found.append((start, domain.end()))
                last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text):
    """(spans (kind, start, end), matches dropped for too many digits (start, end))."""
    spans = [(0, *s) for s in emails(text)]
    long = []
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = _digits(m.group())
        if len(digits) > 19:
            long.append(m.span())
        elif len(digits) >= 16 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        n = len(_digits(m.group()))
        if n > 15:
            long.append(m.span())
        elif n >= 8:
            spans.append((3, m.start(), m.end()))
    return spans, long


# --- the field of a text -----------------------------------------------------------------

#: A label is 0 outside, else one more than the place of its kind.
LABELS = 1 + len(KINDS)
OUTSIDE = 0
_ONE = np.eye(LABELS)

_PIECE = re.compile(r"[0-9@][A-Za-z0-9@._%+()-]*+")
_INSIDE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@._%+()-")
_FOUR = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_SEVEN = re.compile(r"[0-9]{3}[-.][0-9]{4}")

FEATURES = [
    "any", "at", "at and dot", "small parts", "large parts", "plus", "brackets", "three and four",
    "digits only", "right check digit", "wrong check digit", "four digits", "letters", "to 3 digits",
    "4 to 7 digits", "8 to 15 digits", "20 digits or more", "after a plus", "run with right check digit",
    "run of a phone's length after a plus",
]
#: Features that tell most by themselves; they are left out of a piece's second view.
TELLING = [3, 5, 7, 9, 17, 18, 19]


@dataclass
class Graph:
    """The nodes of a text: core (start, end), features, labels; chain and skip edges."""

    spans: list
    core: list
    features: np.ndarray
    label: np.ndarray  # of base spans, OUTSIDE where there is none
    fixed: np.ndarray  # inside a base span
    unknown: np.ndarray  # inside a match of too many digits
    edges: np.ndarray  # (first, second, 0 chain / 1 equal / 2 same end)
    tails: list  # last seven digits up to each node in its run, or None


def _pieces(text):
    last = 0
    for m in _PIECE.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _INSIDE:
            start -= 1
        last = m.end()
        end = last
        while end > start and text[end - 1] in ".-_%+(":
            end -= 1
        while start < end and text[start] in ".-_%)":
            start += 1
        if start < end:
            yield start, end


def _features(text, core, runs):
    x = np.zeros((len(core), len(FEATURES)), np.float32)
    x[:, 0] = 1
    for run in runs:
        whole = "".join(_digits(text[a:b]) for a, b in (core[i] for i in run))
        card = 16 <= len(whole) <= 19 and luhn(whole)
        plus = None
        for i in run:
            piece = text[core[i][0] : core[i][1]]
            digits = _digits(piece)
            n, f = len(digits), x[i]
            at = piece.find("@")
            f[1], f[2] = at >= 0, at >= 0 and "." in piece[at:]
            if _FOUR.fullmatch(piece):
                small = all(_small(p) for p in piece.split("."))
                f[3], f[4] = small, not small
            f[5], f[6] = piece[0] == "+", piece[0] == "(" and piece[-1] == ")"
            f[7], f[8] = _SEVEN.fullmatch(piece) is not None, n == len(piece)
            if 16 <= n <= 19:
                right = luhn(digits)
                f[9], f[10] = right, not right
            f[11] = n == 4 == len(piece)
            f[12] = at < 0 and any(c.isalpha() for c in piece)
            f[13], f[14], f[15], f[16] = n <= 3, 4 <= n <= 7, 8 <= n <= 15, n >= 20
            f[17] = plus is not None
            f[18] = card and len(run) > 1
            if piece[0] == "+":
                plus = 0
            if plus is not None:
                plus += n
                f[19] = plus <= 15
    return x


def graph(text):
    spans, long = base_spans(text)
    core = list(_pieces(text))
    if not core:
        return Graph(spans, core, *[None] * 6)
    n = len(core)
    runs = [[0]]
    for i in range(1, n):
        gap = text[core[i - 1][1] : core[i][0]]
        if len(gap) <= 3 and not gap.strip(" ().-"):
            runs[-1].append(i)
        else:
            runs.append([i])
    label, fixed, unknown = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)
    starts, ends = np.array([a for a, _ in core]), np.array([b for _, b in core])
    for a, b in long:
        unknown[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b)] = True
    for kind, a, b in reversed(spans):
        i, j = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b)
        if i < j:
            label[i:j], fixed[i:j] = kind + 1, True
    edges, equal, same, tails = [], {}, {}, []
    for run in runs:
        edges += [(i, i + 1, 0) for i in run[:-1]]
        tail = ""
        for i in run:
            piece = text[core[i][0] : core[i][1]].lower()
            tail = (tail + _digits(piece))[-7:]
            tails.append(tail if len(tail) == 7 else None)
            if len(piece) >= 4:
                if piece in equal:
                    edges.append((equal[piece], i, 1))
                equal[piece] = i
            if len(tail) == 7 and "@" not in piece:
                if tail in same and same[tail] != equal.get(piece):
                    edges.append((same[tail], i, 2))
                same[tail] = i
    return Graph(
        spans, core, _features(text, core, runs), label, fixed, unknown & ~fixed,
        np.array(edges, np.int64).reshape(-1, 3), tails,
    )


# --- learning ------------------------------------------------------------------------------


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label x next label
    skip: np.ndarray  # link kind x label x label


def examples(g):
    """Of each known node (label, features with those of its neighbours' labels, place)."""
    n = len(g.core)
    known = ~g.unknown
    left, right = np.zeros((n, LABELS)), np.zeros((n, LABELS))
    linked = np.zeros((2, n, LABELS))
    for kind in range(3):
        for i, j in ((0, 1), (1, 0)):
            e = g.edges[g.edges[:, 2] == kind]
            e = e[known[e[:, i]]]
            of, to = e[:, i], e[:, j]
            if kind:
                np.add.at(linked[kind - 1], to, _ONE[g.label[of]])
            else:
                (left if i == 0 else right)[to] = _ONE[g.label[of]]
    x = np.concatenate([g.features, left, right, linked[0], linked[1]], 1)
    return g.label[known], x[known], np.flatnonzero(known)


WIDTH = len(FEATURES) + 4 * LABELS


def _texts(column):
    for value in column:
        yield value.as_py() or ""


def _examples(batches):
    for batch in whole_rows(batches, 0, PART_BYTES):
        held = {}
        for text in _texts(batch.column(0)):
            g = graph(text)
            if not g.core:
                continue
            label, x, place = examples(g)
            seed = xxhash.xxh64_intdigest(text.encode())
            for one, row, p in zip(label, x, place):
                h = xxhash.xxh64_intdigest(seed.to_bytes(8, "little") + int(p).to_bytes(8, "little")) >> 1
                held.setdefault(int(one), []).append((h, row))
        for one, rows in held.items():
            count = len(rows)
            rows = sorted(rows, key=lambda r: r[0])[:SAMPLE]
            flat = np.concatenate([r[1] for r in rows]).astype(np.float32)
            ends = np.arange(0, len(flat) + 1, WIDTH, dtype=np.int32)
            yield pa.record_batch(
                [
                    pa.array([one] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([count] + [0] * (len(rows) - 1), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(flat)),
                ],
                names=["label", "h", "n", "x"],
            )


def fit(docs):
    """A field learned from the base spans of ``docs``, or None without any."""
    rows = docs.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(
        _examples, "label int, h long, n long, x array<float>"
    )
    rows = stored(rows, "pii-pieces")
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not set(counts) - {OUTSIDE}:
        return None
    order = Window.partitionBy("label").orderBy("h", "x")
    best = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE)
    # at most SAMPLE rows of each of the labels
    best = best.select("label", "at", "x").toArrow().sort_by([("label", "ascending"), ("at", "ascending")])
    label = best["label"].to_numpy()
    x = best["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    drawn = np.bincount(label, minlength=LABELS)
    share = np.array([counts.get(k, 0) for k in range(LABELS)]) / np.maximum(drawn, 1)
    return train(label, x, share[label])


def train(label, x, weight):
    """Weights of the greatest pseudo-likelihood, by adaptive steps of the whole sample."""
    rng = np.random.default_rng(3)
    again, bare = x.copy(), x.copy()
    again[:, TELLING] *= rng.random((len(x), len(TELLING))) < 0.5
    bare[:, 1 : len(FEATURES)] = 0
    x, label = np.concatenate([x, again, bare]), np.tile(label, 3)
    weight = np.tile(weight, 3)
    # a rare kind counts as much as a common one, within bounds
    weight = np.sqrt(weight / weight.mean())
    weight /= weight.sum()
    f = len(FEATURES)
    local, left, right = x[:, :f], x[:, f : f + LABELS], x[:, f + LABELS : f + 2 * LABELS]
    linked = [x[:, f + (2 + k) * LABELS :][:, :LABELS] for k in range(2)]
    target = _ONE[label]
    held = [np.zeros((f, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((2, LABELS, LABELS))]
    seen = [np.full_like(h, 1e-4) for h in held]
    for _ in range(STEPS):
        unary, chain, skip = held
        z = local @ unary + left @ chain + right @ chain.T
        for k in range(2):
            z += linked[k] @ skip[k]
        z = np.exp(z - z.max(1, keepdims=True))
        g = (z / z.sum(1, keepdims=True) - target) * weight[:, None]
        pull = np.stack([linked[k].T @ g for k in range(2)])
        slopes = [
            local.T @ g + 1e-4 * unary,
            left.T @ g + (right.T @ g).T + 1e-4 * chain,
            (pull + pull.transpose(0, 2, 1)) / 2 + 1e-4 * skip,
        ]
        for h, s, d in zip(held, seen, slopes):
            s += d**2
            h -= 0.3 * d / np.sqrt(s)
    return Field(*held)


# --- message passing -------------------------------------------------------------------------


def _logsum(x):
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None]).sum(1))


def marginals(unary, edges, field):
    """Log marginals of the labels by loopy sum-product with damping, all edges at once."""
    tables = np.stack([field.chain, *field.skip])
    # both directions: messages of an edge go from its first node to its second
    sent = np.r_[edges[:, 0], edges[:, 1]]
    got = np.r_[edges[:, 1], edges[:, 0]]
    of = np.concatenate([tables[edges[:, 2]], tables[edges[:, 2]].transpose(0, 2, 1)])
    m = len(edges)
    back = np.r_[np.arange(m, 2 * m), np.arange(m)]
    message = np.zeros((2 * m, LABELS))

    def beliefs():
        total = unary.copy()
        for k in range(LABELS):
            total[:, k] += np.bincount(got, message[:, k], len(unary))
        return total

    for _ in range(ROUNDS if m else 0):
        cavity = beliefs()[sent] - message[back]
        new = np.stack([_logsum(cavity + of[:, :, k]) for k in range(LABELS)], 1)
        new -= _logsum(new)[:, None]
        message = (message + new) / 2
    total = beliefs()
    return total - _logsum(total)[:, None]


def added(text, g, label):
    """The spans of a text that labels mean beyond the base ones and that pass their test.

    Neighbours of one kind are taken together, as many as pass its test, from the left.
    """
    kept = [(a, b) for _, a, b in sorted(g.spans, key=lambda s: s[1])]
    ends = {_digits(text[a:b])[-7:] for k, a, b in g.spans if k == 3}
    joined = np.zeros(len(g.core), bool)
    joined[g.edges[g.edges[:, 2] == 0][:, 0]] = True
    found, i = [], 0
    while i < len(g.core):
        kind, last = int(label[i]) - 1, i
        if kind < 0 or g.fixed[i]:
            i += 1
            continue
        while kind >= 2 and joined[last] and label[last + 1] == label[i] and not g.fixed[last + 1]:
            # more digits than any number has
            if g.core[last + 1][1] - g.core[i][0] > 40:
                break
            last += 1
        for j in range(last, i - 1, -1):
            start, end = g.core[i][0], g.core[j][1]
            while kind >= 2 and end > start and not "0" <= text[end - 1] <= "9":
                end -= 1
            if start < end and _passes(kind, text[start:end], ends):
                found.append((kind, start, end))
                i = j
                break
        i += 1
    return [s for s in found if not any(a < s[2] and s[1] < b for a, b in _near(kept, s))]


def _near(spans, span):
    """The spans that begin before the end of one, nearest first, while they may meet it."""
    at = bisect.bisect_left(spans, (span[2], 0))
    # spans of four kinds, each apart from its own: few cross any place
    return spans[max(0, at - 8) : at]


def _passes(kind, text, ends):
    digits = _digits(text)
    if kind == 0:
        at = text.find("@")
        return at > 0 and _DOMAIN.fullmatch(text, at + 1) is not None
    if kind == 1:
        return _FOUR.fullmatch(text) is not None and all(_small(p) for p in text.split("."))
    if kind == 2:
        return _CARD.fullmatch(text) is not None and 16 <= len(digits) <= 19 and luhn(digits)
    if text[0] == "+":
        return _PHONE.fullmatch(text) is not None and 8 <= len(digits) <= 15
    return 7 <= len(digits) <= 15 and digits[-7:] in ends


def find(texts, field):
    """(base spans, added spans) of each text, of a part in one go of message passing."""
    graphs = [graph(t) for t in texts]
    if field is None:
        return [(g.spans, []) for g in graphs]
    held = [i for i, g in enumerate(graphs) if g.core and not g.fixed.all()]
    more = [[] for _ in graphs]
    if held:
        sizes = np.array([len(graphs[i].core) for i in held])
        first = np.cumsum(sizes) - sizes
        unary = np.concatenate([graphs[i].features for i in held]) @ field.unary
        label = np.concatenate([graphs[i].label for i in held])
        fixed = np.flatnonzero(np.concatenate([graphs[i].fixed for i in held]))
        unary[fixed] = -60.0
        unary[fixed, label[fixed]] = 0.0
        edges = np.concatenate([graphs[i].edges + [[at, at, 0]] for i, at in zip(held, first)])
        best = marginals(unary, edges, field).argmax(1)
        for i, at, size in zip(held, first, sizes):
            more[i] = added(texts[i], graphs[i], best[at : at + size])
    return [(g.spans, m) for g, m in zip(graphs, more)]


def written(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_KINDS = {**{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string", "n_added": "long"}


def spans(docs, field):
    """``docs`` with the counts and digest of the base spans, all spans, and ``n_added``.

    Columns of these names are replaced.
    """
    docs, schema = widened(docs, **_KINDS)
    place = docs.columns.index("text")

    def run(batches):
        for batch in whole_rows(batches, place, PART_BYTES):
            texts = list(_texts(batch.column(place)))
            found = find(texts, field)
            columns = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            columns += [
                pa.array(digests, pa.string()),
                pa.array([written(base + more) for base, more in found], pa.string()),
                pa.array([len(more) for _, more in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *_KINDS])

    return docs.mapInArrow(run, schema)


def op11_pii(spark, sf_dir):
    """The contract's rows: counts and digest are those of the base spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spans(docs, fit(docs))
