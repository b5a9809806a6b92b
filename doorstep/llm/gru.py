"""A gated recurrent language model over words, and log-likelihoods of whole documents.

Tokens are a text's words, A-Z lowered, and one end.  The ``WORDS`` most frequent words of
the training documents have ids of their own.  All others, the rarer and the unseen ones,
share ``RARE`` ids by a hash of their last letters, which the network reads and predicts
like words; within such an id words are told apart by their smoothed frequency.  So every
token of any text has a probability, and no word is lost.  The output softmax is factored:
first the id's class, then the id among its class.

Training is truncated backpropagation through time in numpy, data-parallel: from common
weights every task runs over its own training documents, and the weights are averaged,
by tokens seen; ``ROUNDS`` times.  Every token of every training document is trained on,
in lanes of whole documents and windows of ``WINDOW`` steps; the state is carried from
window to window through a document and begins anew with the next.
Word counts, the vocabulary and the base score cover all tokens of all documents.

Scoring steps through whole documents.  Many run side by side in lanes, one behind the
other in each, and a window's state is carried into the next, so a document of any
length gets its complete log-likelihood.

Texts are read once: per part of the input its distinct words are numbered, and documents
become lists of these numbers.  The words, not the texts, are shuffled to be counted, and
their counts go back to the parts.

A null or empty text is the end alone.  Rows that repeat, and null or repeated ids, are
documents of their own (a null id is trained on).  Without training documents nothing is
known: base scores are those of the formula with N = V = 0, and the weights stay as they
were set.  An empty table gives an empty result; extra columns are ignored.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .shared import discard, stored
from .text import LOWER, buffers, fold, gathered, numbered, release, reuse, whole_rows, word_bounds

WORDS = 4094
#: Ids of all other words, by their last ENDING bytes.
RARE = 1024
ENDING = 2
CLASS_WORDS = 128
EMBED = 16
HIDDEN = 24
ROUNDS = 1
WINDOW = 32
TRAIN_LANES = 128
SCORE_LANES = 512
SCORE_TOKENS = 6_000_000
TRAIN_TOKENS = 2_000_000
RATE = 0.15
PART_BYTES = 16 << 20

_END = 0
_END_WORD = b"\n"  # no word holds white space


# --- counting ----------------------------------------------------------------------

_PARTS = (
    "part long, word binary, code int, n long,"
    " doc_ids array<long>, held array<boolean>, lengths array<long>, codes binary"
)


def _number_parts(batches):
    """Per part of a task: its distinct words with training counts, and its documents."""
    task, nth = TaskContext.get().partitionId(), 0
    for batch in whole_rows(gathered(batches, 1, PART_BYTES), 1, PART_BYTES):
        data, offsets = buffers(batch.column(1))
        data = LOWER[data]
        starts, ends, edges = word_bounds(data, offsets)
        codes, words = numbered(data, starts, ends)
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        lengths = np.diff(edges)
        counts = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(words))
        part = (task << 32) + nth
        nth += 1
        n = len(words) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, part)),
                pa.concat_arrays([words.cast(pa.binary()), pa.array([_END_WORD], pa.binary())]),
                pa.array(np.r_[np.arange(len(words)), -1].astype(np.int32)),
                pa.array(np.r_[counts, (~held).sum()].astype(np.int64)),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.bool_())),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()),
            ],
            names=_names(_PARTS),
        )
        one = [
            [part], [None], [None], [None], [batch.column(0).to_pylist()], [held.tolist()],
            [lengths.tolist()], [_packed(codes)],
        ]
        kinds = [
            pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
            pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(),
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(one, kinds)], names=_names(_PARTS)
        )


def _packed(codes):
    """Numbers as compressed planes of their bytes: frequent words have low ones, met first."""
    planes = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpacked(raw, n):
    planes = pa.Codec("zstd").decompress(raw, 4 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<i4").ravel()


def _names(schema):
    return [c.split()[0] for c in schema.split(",")]


_DOCS = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double,"
    " rare_score double, ids binary"
)


def _rare_id(word):
    """The shared id of words that have none of their own: 1 and more."""
    return F.pmod(F.xxhash64(F.substring(word, -ENDING, ENDING)), F.lit(RARE)).cast("int") + 1


def _score_base(total, kinds, rare):
    """From a part's documents and its words' counts: base scores, and ids for the model.

    ``rare`` is the total of each shared id's smoothed counts, its unseen words as one.
    """
    base = math.log10(total + 0.5 * (kinds + 1))
    low = np.zeros(1 << 16)
    low[1 : RARE + 1] = np.log10(rare)

    def run(key, words, parts):
        order = words.column("code").to_numpy()
        c, ids = np.zeros(len(order), np.int64), np.zeros(len(order), np.uint16)
        c[order] = words.column("c").to_numpy()  # the end's code, -1, is the last place
        ids[order] = words.column("id").to_numpy()
        log = np.log10(c + 0.5)
        rare = np.where((ids > _END) & (ids <= RARE), log - low[ids], 0.0)
        out = []
        for row in parts.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            codes = _unpacked(row["codes"], int(lengths.sum()))
            edges = np.r_[0, np.cumsum(lengths)]
            sums = [np.r_[0, np.cumsum(x[codes])] for x in (c > 0, log - base, rare)]
            known, score, within = (np.diff(s[edges]) + x[-1] for s, x in zip(sums, (c > 0, log - base, rare)))
            tokens = ids[codes]
            texts = [np.append(tokens[a:b], ids[-1]).astype("<u2").tobytes() for a, b in zip(edges[:-1], edges[1:])]
            out.append(
                pa.table(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                        pa.array(lengths + 1), pa.array(known.astype(np.int64)), pa.array(score),
                        pa.array(within), pa.array(texts, pa.binary()),
                    ],
                    names=_names(_DOCS),
                )
            )
        return pa.concat_tables(out)

    return run


def prepare(docs, held_out):
    """(documents ready for the model, N, V, words in order of their ids)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held"))
    parts = stored(rows.mapInArrow(_number_parts, _PARTS), "gru-parts", compression="zstd")
    words = parts.where("word IS NOT NULL").select("part", "word", "code", "n")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("c")), "gru-counts", compression="zstd")
    known = counts.where("c > 0")
    total, kinds = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    named = F.col("word") != F.lit(_END_WORD)
    # WORDS rows at most: a bound for what the driver holds and for the broadcast
    best = known.where(named).orderBy(F.desc("c"), "word").limit(WORDS).collect()
    spark = docs.sparkSession
    ids = [(bytes(r.word), RARE + 1 + i) for i, r in enumerate(best)] + [(_END_WORD, _END)]
    ends = known.where(~named).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    lookup = F.broadcast(spark.createDataFrame(ids, "word binary, id int"))
    looked = counts.join(lookup, "word", "left").withColumn("id", F.coalesce("id", _rare_id(F.col("word"))))
    # RARE rows
    shared = looked.where((F.col("id") > _END) & (F.col("id") <= RARE) & (F.col("c") > 0)).groupBy("id").agg(
        F.sum("c").alias("c"), F.count("*").alias("kinds")
    )
    rare = np.full(RARE, 0.5)
    for r in shared.collect():
        rare[r.id - 1] += r.c + 0.5 * r.kinds
    by_part = words.select("part", "word", "code").join(looked, "word").select("part", "code", "c", "id")
    texts = parts.where("codes IS NOT NULL").select(
        F.col("part").alias("of"), "doc_ids", "held", "lengths", "codes"
    )
    ready = by_part.groupBy("part").cogroup(texts.groupBy("of")).applyInArrow(_score_base(total, kinds, rare), _DOCS)
    ready = stored(ready, "gru-docs", compression="zstd")
    discard(parts)
    discard(counts)
    return ready, total, kinds, np.array([ends, *rare, *(r.c for r in best)], np.float64)


# --- the model ---------------------------------------------------------------------


class Model:
    """Weights, as named float32 arrays, and the classes they are laid out for."""

    def __init__(self, frequencies):
        words = len(frequencies)
        f = frequencies + 0.5
        rng = np.random.default_rng(5)

        def small(*shape):
            return rng.normal(0, 0.1, shape).astype(np.float32)

        # the end is a class of its own; shared ids follow, then words by frequency
        self.class_of = np.zeros(words, np.int64)
        self.class_of[1:] = 1 + (np.arange(words - 1) // CLASS_WORDS)
        classes = int(self.class_of[-1]) + 1
        mass = np.bincount(self.class_of, f)
        self.firsts = np.searchsorted(self.class_of, np.arange(classes + 1))
        self.w = {
            "embed": small(words, EMBED),
            "into": small(EMBED, 3 * HIDDEN),
            "back": small(HIDDEN, 3 * HIDDEN),
            "gate": np.zeros(3 * HIDDEN, np.float32),
            "classes": np.zeros((HIDDEN, classes), np.float32),  # at first, frequencies only
            "class_bias": np.log(mass / mass.sum()).astype(np.float32),
            "words": np.zeros((words, HIDDEN), np.float32),
            "word_bias": np.log(f / mass[self.class_of]).astype(np.float32),
        }

    def inputs(self):
        return self.w["embed"] @ self.w["into"] + self.w["gate"]

    def step(self, x, h):
        """One step from the inputs' rows ``x`` and the states' rows ``h``."""
        g = self.w["back"].T @ h.T
        gates, n = np.empty_like(g[: 2 * HIDDEN]), np.empty_like(g[:HIDDEN])
        return self._step(x.T, h.T, g, gates, n).T

    def _step(self, x, h, g, gates, n):
        """A column a lane, so that each gate is one stretch of memory; fills ``gates``, ``n``."""
        k, half = HIDDEN, np.float32(0.5)
        np.add(x[: 2 * k], g[: 2 * k], out=gates)
        gates *= half
        np.tanh(gates, out=gates)
        gates *= half
        gates += half
        np.multiply(gates[k:], g[2 * k :], out=n)
        n += x[2 * k :]
        np.tanh(n, out=n)
        after = h - n
        after *= gates[:k]
        after += n
        return after

    def window(self, inputs, h, begins=None):
        """The states of a window of inputs (steps x lanes), and what its gradient needs.

        ``h`` has a row a lane; all that is returned has steps, then a column a lane.  Where
        ``begins`` is set, a document does: the state is zero before that step.
        """
        w, k, (steps, lanes) = self.w, HIDDEN, inputs.shape
        fed = w["embed"][inputs]
        x = w["into"].T @ fed.transpose(0, 2, 1)
        x += w["gate"][:, None]
        states = np.empty((steps + 1, k, lanes), x.dtype)
        before = states if begins is None else np.empty_like(states)
        gates, n = np.empty((steps, 2 * k, lanes), x.dtype), np.empty((steps, k, lanes), x.dtype)
        back = np.empty_like(x)
        states[0] = h.T
        for t in range(steps):
            if begins is not None:
                np.multiply(states[t], ~begins[t], out=before[t])
            np.matmul(w["back"].T, before[t], out=back[t])
            states[t + 1] = self._step(x[t], before[t], back[t], gates[t], n[t])
        return states[1:], (fed, before[:-1], gates, n, back[:, 2 * k :])

    def log_likelihood(self, states, targets, gradient=None):
        """Natural log probability of each target; fills ``gradient`` if it is given.

        Gradients of words are lists of (place, gradient) of the classes met.
        """
        w = self.w
        kinds = self.class_of[targets]
        order = np.argsort(kinds.astype(np.int16), kind="stable")
        # by class: each has one stretch of the states
        kinds, states, targets = kinds[order], states[order], targets[order]
        logits = w["classes"].T @ states.T
        logits += w["class_bias"][:, None]
        found = _log_softmax(logits, kinds, gradient is not None)
        if gradient is not None:
            gradient["classes"] = (logits @ states).T
            gradient["class_bias"] = logits.sum(1)
            gradient["words"], met, bias = [], [], []
            back = (w["classes"] @ logits).T
        edges = np.searchsorted(kinds, np.arange(len(self.firsts)))
        for k in range(len(self.firsts) - 1):
            a, b = self.firsts[k], self.firsts[k + 1]
            mine = slice(edges[k], edges[k + 1])
            if b - a < 2 or edges[k] == edges[k + 1]:
                continue
            s = states[mine]
            logits = w["words"][a:b] @ s.T
            logits += w["word_bias"][a:b, None]
            found[mine] += _log_softmax(logits, targets[mine] - a, gradient is not None)
            if gradient is not None:
                gradient["words"].append((slice(a, b), logits @ s))
                bias.append(np.add.reduce(logits, 1))
                met.append(np.s_[a:b])
                back[mine] += (w["words"][a:b].T @ logits).T
        out = np.empty_like(found)
        out[order] = found
        if gradient is None:
            return out
        gradient["word_bias"] = [(np.r_[tuple(met)], np.concatenate(bias))] if met else []
        into = np.empty_like(back)
        into[order] = back
        return out, into

    # weights as one vector, to be averaged

    def vector(self):
        return np.concatenate([v.ravel() for v in self.w.values()])

    def load(self, vector):
        at = 0
        for name, v in self.w.items():
            self.w[name] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self


def _log_softmax(logits, chosen, gradient):
    """The log probability of each column's choice; ``logits`` become gradients if wanted."""
    n = logits.shape[1]
    flat, at = logits.reshape(-1), chosen * n + np.arange(n)
    logits -= np.maximum.reduce(logits, 0)
    out = flat.take(at)
    np.exp(logits, out=logits)
    total = np.add.reduce(logits, 0)
    if gradient:
        logits *= 1 / total
        flat[at] -= 1
    return out - np.log(total)


class Trainer:
    """Truncated backpropagation over lanes of documents, with Adagrad."""

    def __init__(self, model):
        self.model = model
        self.seen = {k: np.full(v.shape, 1e-2, np.float32) for k, v in model.w.items()}
        self.tokens = 0

    def run(self, inputs, targets, live, begins=None):
        """Windows over (lanes x steps) arrays; ``live`` marks targets that exist.

        Where ``begins`` is set, a document does: the state is zero before that step.
        """
        h = np.zeros((len(inputs), HIDDEN), np.float32)
        for at in range(0, inputs.shape[1], WINDOW):
            cut = slice(at, at + WINDOW)
            # lanes that end leave off: behind the others only long documents go on
            n = int(np.flatnonzero(live[:, at]).max(initial=-1)) + 1
            new = None if begins is None else begins[:n, cut].T
            h = self._window(
                inputs[:n, cut].T.astype(np.int64), targets[:n, cut].T.astype(np.int64), live[:n, cut].T, h[:n], new
            )

    def _window(self, inputs, targets, live, h, begins=None):
        m, w, k = self.model, self.model.w, HIDDEN
        states, (fed, before, gates, n, g) = m.window(inputs, h, begins)
        after = states[-1].T
        on = live.ravel()
        count = int(on.sum())
        if not count:
            return after
        self.tokens += count
        grad = {}
        rows = states.transpose(0, 2, 1).reshape(-1, k)
        _, back = m.log_likelihood(rows[on], targets.ravel()[on], grad)
        rows = np.zeros_like(rows)
        rows[on] = back
        into_state = rows.reshape(*inputs.shape, k).transpose(0, 2, 1).copy()
        # all that does not wait for the next step's gradient, for all steps at once
        z, r = gates[:, :k], gates[:, k:]
        to_n = (1 - z) * (1 - n * n)
        to_z = (before - n) * z * (1 - z)
        to_r = g * r * (1 - r)
        inner, dn = np.empty((len(z), 3 * k, z.shape[2]), z.dtype), np.empty_like(n)
        d_next = 0
        for t in range(len(inputs) - 1, -1, -1):
            d = into_state[t]
            d += d_next
            np.multiply(d, to_n[t], out=dn[t])
            np.multiply(d, to_z[t], out=inner[t, :k])
            np.multiply(dn[t], to_r[t], out=inner[t, k : 2 * k])
            np.multiply(dn[t], r[t], out=inner[t, 2 * k :])
            d_next = w["back"] @ inner[t]
            d *= z[t]
            d_next += d
            if begins is not None:
                d_next *= ~begins[t]
        grad["back"] = (before @ inner.transpose(0, 2, 1)).sum(0)
        inner[:, 2 * k :] = dn
        grad["gate"] = inner.sum((0, 2))
        grad["into"] = (fed.transpose(0, 2, 1) @ inner.transpose(0, 2, 1)).sum(0)
        ids = inputs.ravel()
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
        met = (w["into"] @ inner).transpose(0, 2, 1).reshape(len(ids), -1)
        grad["embed"] = [(ids[order[first]], np.add.reduceat(met[order], first))]
        # only what was met is touched: a window of few tokens costs little
        for name, g in grad.items():
            for at, part in g if isinstance(g, list) else [(slice(None), g)]:
                part *= 16 / count
                np.clip(part, -1, 1, out=part)
                seen = self.seen[name][at] + part * part
                self.seen[name][at] = seen
                part *= RATE
                part /= np.sqrt(seen, out=seen)
                w[name][at] -= part
        return after


def _in_lanes(texts, most):
    """(ids, their texts, where texts begin) as lanes x steps, and the lanes' lengths.

    Whole texts lie one behind the other in ``most`` lanes at most, the longest lane first.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    # as many lanes as the longest document leaves filled: they end at about one step
    width = int(lengths.sum()) // max(int(lengths.max(initial=0)), 1)
    lanes = [(0, i) for i in range(min(most, max(width, 1), len(texts)))]
    where = [[] for _ in lanes]
    for k in np.argsort(-lengths, kind="stable").tolist():
        used, lane = heapq.heappop(lanes)  # the shortest lane so far
        where[lane].append(k)
        heapq.heappush(lanes, (used + int(lengths[k]), lane))
    where.sort(key=lambda ks: -int(lengths[ks].sum()))
    sizes = np.array([lengths[ks].sum() for ks in where], np.int64)
    steps = int(sizes.max(initial=0))
    targets = np.zeros((len(where), steps), np.uint16)
    owner = np.zeros((len(where), steps), np.int32)
    begins = np.zeros((len(where), steps), bool)
    for i, ks in enumerate(where):
        at = 0
        for k in ks:
            n = int(lengths[k])
            targets[i, at : at + n], owner[i, at : at + n], begins[i, at] = texts[k], k, True
            at += n
    return targets, owner, begins, sizes


_WEIGHTS = "slot int, piece int, tokens long, weights binary"
_PIECE = 1 << 14


def _train(model):
    def run(batches):
        reuse()
        trainer = Trainer(model)
        held = []

        def flush():
            targets, _, begins, sizes = _in_lanes(held, TRAIN_LANES)
            inputs = np.zeros_like(targets)
            inputs[:, 1:] = targets[:, :-1]
            inputs[begins] = _END
            trainer.run(inputs, targets, np.arange(targets.shape[1]) < sizes[:, None], begins)
            held.clear()

        size = 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, "<u2")
                if held and size + len(ids) > TRAIN_TOKENS:
                    flush()
                    size = 0
                held.append(ids)
                size += len(ids)
        if held:
            flush()
        if trainer.tokens:
            vector = trainer.model.vector()
            slot = TaskContext.get().partitionId() % 64
            pieces = range(0, len(vector), _PIECE)
            yield pa.record_batch(
                [
                    pa.array([slot] * len(pieces), pa.int32()),
                    pa.array([p // _PIECE for p in pieces], pa.int32()),
                    pa.array([trainer.tokens] * len(pieces), pa.int64()),
                    pa.array([vector[p : p + _PIECE].astype("<f4").tobytes() for p in pieces], pa.binary()),
                ],
                names=_names(_WEIGHTS),
            )

    return run


def _average(key, table):
    """The mean of one piece of the weights, by tokens; rows come from a slot's tasks."""
    total, mean = 0, 0.0
    rows = sorted(zip(table.column("tokens").to_pylist(), table.column("weights").to_pylist()))
    for tokens, raw in rows:
        total += tokens
        mean = mean + (np.frombuffer(raw, "<f4").astype(np.float64) - mean) * (tokens / total)
    return pa.table(
        [
            pa.array([0], pa.int32()), pa.array([table.column("piece")[0].as_py()], pa.int32()),
            pa.array([total], pa.int64()), pa.array([mean.astype("<f4").tobytes()], pa.binary()),
        ],
        names=_names(_WEIGHTS),
    )


def train(ready, frequencies):
    """A model fitted to the documents that are not held out."""
    model = Model(frequencies)
    texts = ready.where(~F.col("held_out")).select("ids")
    for _ in range(ROUNDS):
        found = texts.mapInArrow(_train(model), _WEIGHTS)
        # by slots of tasks first, so that no group grows with the number of tasks alone
        for keys in (["slot", "piece"], ["piece"]):
            found = found.groupBy(*keys).applyInArrow(_average, _WEIGHTS)
        pieces = found.orderBy("piece").collect()  # one model's weights
        if pieces:
            model.load(np.frombuffer(b"".join(bytes(p.weights) for p in pieces), "<f4"))
    return model


def document_scores(model, texts):
    """Natural log-likelihood of each list of ids, the state carried to its end."""
    targets, owner, begins, sizes = _in_lanes(texts, SCORE_LANES)
    lanes, steps = targets.shape
    inputs = np.zeros_like(targets)
    inputs[:, 1:] = targets[:, :-1]
    inputs[begins] = _END
    score = np.zeros(len(texts))
    h = np.zeros((lanes, HIDDEN), np.float32)
    for at in range(0, steps, WINDOW):
        cut = slice(at, min(at + WINDOW, steps))
        live = np.arange(cut.start, cut.stop) < sizes[:, None]
        n = int((sizes > at).sum())
        states, _ = model.window(inputs[:n, cut].T, h[:n], begins[:n, cut].T)
        h = states[-1].T
        on = live[:n].T.ravel()
        rows = states.transpose(0, 2, 1).reshape(-1, HIDDEN)[on]
        found = model.log_likelihood(rows, targets[:n, cut].T.ravel()[on].astype(np.int64))
        score += np.bincount(owner[:n, cut].T.ravel()[on], found.astype(np.float64), len(texts))
    return score


def score(ready, model):
    """The documents with ``score``: the model's log10 probability of the whole text."""

    def run(batches):
        reuse()
        # two bytes a token
        for batch in gathered(batches, 6, 2 * SCORE_TOKENS):
            release()
            texts = [np.frombuffer(b, "<u2") for b in batch.column(6).to_pylist()]
            at = 0
            while at < len(texts):
                to, n = at, 0
                while to < len(texts) and (to == at or n + len(texts[to]) <= SCORE_TOKENS):
                    n += len(texts[to])
                    to += 1
                found = document_scores(model, texts[at:to]) / math.log(10)
                found += batch.column(5).slice(at, to - at).to_numpy()
                columns = [c.slice(at, to - at) for c in batch.columns[:5]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found)], names=[*batch.schema.names[:5], "score"]
                )
                at = to

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return ready.mapInArrow(run, kinds)


def score_documents(docs, held_out):
    """Every document's base and model score, learned from those not held out."""
    ready, total, _, frequencies = prepare(docs, held_out)
    model = train(ready, frequencies)
    return score(ready, model).withColumn("train_tokens", F.lit(total).cast("long"))


def op2_gru(spark, sf_dir):
    """The contract's rows: base and model log-likelihoods of all whole documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, fold("doc_id", 5) == 1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
