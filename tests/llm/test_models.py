"""Language model, language identification, quality trees and toxicity."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from doorstep.llm import gru, language, quality, toxicity
from doorstep.llm.text import buffers, fold

from .conftest import ODD, SF


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def in_fold(doc_id, parts, n):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == n


# --- 2: recurrent language model ---------------------------------------------------


def base_of(rows):
    counts = Counter()
    for i, t in rows:
        if not in_fold(i, 5, 1):
            counts.update(words(lower(t)) + ["\n"])
    total, kinds = sum(counts.values()), len(counts)

    def row(i, t):
        tokens = words(lower(t)) + ["\n"]
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        known = sum(counts[w] > 0 for w in tokens)
        return (i, in_fold(i, 5, 1), len(tokens), known, total, round(score, 6))

    return sorted((row(i, t) for i, t in rows), key=repr)


def test_base_scores(spark, sf, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = gru.op2_gru(spark, sf("odd")).collect()
    flat = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(flat, key=repr) == base_of(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_without_documents_and_without_training(spark, sf, odd):
    assert gru.op2_gru(spark, sf("empty")).count() == 0
    rows = gru.score_documents(odd, F.lit(True)).collect()
    assert len(rows) == odd.count()
    assert {r.train_tokens for r in rows} == {0} and {r.n_known for r in rows} == {0}
    assert all(abs(r.base_score) < 1e-9 and math.isfinite(r.score) for r in rows)


def small_model():
    rng = np.random.default_rng(1)
    return gru.Model(rng.integers(1, 50, 700).astype(float))


def test_probabilities_add_up():
    model = small_model()
    h = np.random.default_rng(2).normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(700)
    logs = model.log_likelihood(np.repeat(h, 700, 0), every)
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-4


def test_scoring_steps_through_whole_documents():
    model, rng = small_model(), np.random.default_rng(3)
    texts = [rng.integers(0, 700, n).astype(np.uint16) for n in (1, 5, 33, 700, 64, 2, 1)]
    table = model.inputs()
    want = []
    for ids in texts:
        h, before, total = np.zeros((1, gru.HIDDEN), np.float32), 0, 0.0
        for x in ids.tolist():
            h = model.step(table[[before]], h)
            total += float(model.log_likelihood(h, np.array([x]))[0])
            before = x
        want.append(total)
    assert np.allclose(gru.document_scores(model, texts), want, rtol=1e-4)
    assert np.allclose(gru.document_scores(model, texts[3:4]), want[3:4], rtol=1e-4)


def test_gradients():
    model, rng = small_model(), np.random.default_rng(4)
    for name in ("classes", "words"):
        model.w[name] = rng.normal(0, 0.1, model.w[name].shape)
    for name, v in model.w.items():
        model.w[name] = v.astype(np.float64)
    x = rng.integers(0, 700, (4, gru.WINDOW))
    y = rng.integers(0, 700, (4, gru.WINDOW))

    def loss():
        table, h, total = model.inputs(), np.zeros((4, gru.HIDDEN)), 0.0
        for t in range(gru.WINDOW):
            h = model.step(table[x[:, t]], h)
            total -= model.log_likelihood(h, y[:, t]).sum()
        return total

    for name, at in (("embed", (x[0, 3], 2)), ("into", (1, 5)), ("back", (3, 50)), ("gate", (7,)),
                     ("classes", (2, 3)), ("words", (y[1, 4], 1)), ("word_bias", (y[2, 9],))):
        kept = {k: v.copy() for k, v in model.w.items()}
        model.w[name][at] += 1e-5
        up = loss()
        model.w[name][at] -= 2e-5
        slope = (up - loss()) / 2e-5
        model.w = {k: v.copy() for k, v in kept.items()}
        trainer = gru.Trainer(model)
        trainer.seen = {k: np.full(v.shape, 1e12) for k, v in model.w.items()}  # a plain small step
        trainer.run(x, y, np.ones(x.shape, bool))
        moved = (kept[name][at] - model.w[name][at]) / gru.RATE * 1e6 * x.size / 16
        model.w = kept
        assert abs(moved - slope) < 1e-2 * abs(slope) + 1e-3, name


def test_training_sees_every_token_of_whole_documents(monkeypatch):
    rng, seen = np.random.default_rng(13), []
    texts = [np.append(rng.integers(1, 700, n), 0).astype("<u2") for n in (3, 900, 40, 2000, 1, 64, 513)]
    window = gru.Trainer._window

    def watched(self, inputs, targets, live, h, begins=None):
        fed = np.where(begins[0][:, None], 0, h)
        after = window(self, inputs, targets, live, h, begins)
        seen.append((targets[live], fed, after))
        return after

    monkeypatch.setattr(gru.Trainer, "_window", watched)
    batch = pa.record_batch([pa.array([t.tobytes() for t in texts], pa.binary())], names=["ids"])
    monkeypatch.setattr(gru, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    (found,) = gru._train(small_model())(iter([batch]))
    assert found.column("tokens")[0].as_py() == sum(map(len, texts))
    assert Counter(np.concatenate([s[0] for s in seen]).tolist()) == Counter(np.concatenate(texts).tolist())
    for (_, _, after), (_, fed, _) in zip(seen, seen[1:]):  # carried on, or begun anew
        same = (fed == after).all(1) | (fed == 0).all(1)
        assert same.all() and (fed != 0).any()


def test_gradient_ends_where_a_document_begins():
    """Two documents in one lane train like the same two in lanes of their own."""
    rng = np.random.default_rng(14)
    x, y = rng.integers(0, 700, (1, 32)), rng.integers(0, 700, (1, 32))
    begins = np.zeros((1, 32), bool)
    begins[0, [0, 10]] = True
    apart_x, apart_y, live = np.zeros((2, 22), int), np.zeros((2, 22), int), np.zeros((2, 22), bool)
    for i, (a, b) in enumerate(((0, 10), (10, 32))):
        apart_x[i, : b - a], apart_y[i, : b - a], live[i, : b - a] = x[0, a:b], y[0, a:b], True
    one, two = gru.Trainer(small_model()), gru.Trainer(small_model())
    for trainer in (one, two):
        for name in ("classes", "words"):
            trainer.model.w[name] = np.random.default_rng(15).normal(0, 0.1, trainer.model.w[name].shape).astype(np.float32)
    one.run(x, y, np.ones((1, 32), bool), begins)
    two.run(apart_x, apart_y, live)
    assert one.tokens == two.tokens == 32
    for name in one.model.w:
        assert np.allclose(one.model.w[name], two.model.w[name], atol=2e-3), name


def test_windows_take_over_each_others_memory(monkeypatch):
    """Clearing new pages for every window would take a fifth of the training's time."""
    import resource

    rng = np.random.default_rng(16)
    texts = [rng.integers(0, 700, 800).astype("<u2").tobytes() for _ in range(256)]
    batch = pa.record_batch([pa.array(texts, pa.binary())], names=["ids"])
    monkeypatch.setattr(gru, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    faults = []
    for _ in range(2):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
        list(gru._train(small_model())(iter([batch])))
        faults.append(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
    assert faults[1] < 100 * 1600 / gru.WINDOW


def test_codes_are_stored_in_less_than_half():
    rng = np.random.default_rng(17)
    for codes in (np.zeros(0, np.int32), np.array([7, 1 << 24], np.int32), np.minimum(rng.zipf(1.2, 100_000), 1 << 17).astype(np.int32)):
        raw = gru._packed(codes)
        assert gru._unpacked(raw, len(codes)).tolist() == codes.tolist()
    assert len(raw) < 2 * len(codes)


def test_model_beats_frequencies(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = gru.score_documents(docs, fold("doc_id", 5) == 1).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_rare_words_keep_their_identity(spark, monkeypatch):
    """Words without ids of their own are told apart within the ids that they share."""
    monkeypatch.setattr(gru, "WORDS", 100)
    texts = [" ".join(f"w{i}{'abcd'[i % 4]}x" for i in range(k, k + 40)) for k in range(0, 4000, 20)]
    texts += ["common " * 50] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ready, total, kinds, frequencies = gru.prepare(docs, F.lit(False))
    counts = Counter(w for t in texts for w in [*t.split(), "\n"])
    assert (total, kinds) == (sum(counts.values()), len(counts))
    assert abs(frequencies.sum() - total) <= 0.5 * (kinds + gru.RARE)
    model = gru.Model(frequencies)
    shared = {i for r in ready.collect() for i in np.frombuffer(bytes(r.ids), "<u2").tolist()}
    assert all(i < len(frequencies) for i in shared)
    # two unseen words of one ending differ from seen ones, and a rarer word scores lower
    more = docs.unionAll(spark.createDataFrame([(9001, "w3dx"), (9002, "w20ax"), (9003, "zzzqq")], docs.schema))
    rows = {r.doc_id: r for r in gru.score_documents(more, F.col("doc_id") > 9000).where("held_out").collect()}
    assert [rows[i].n_known for i in (9001, 9002, 9003)] == [2, 2, 1]
    assert rows[9003].score < rows[9001].score and all(math.isfinite(r.score) for r in rows.values())


# --- 3: language -------------------------------------------------------------------


def phrases_by_search(sample, text):
    n = 0
    for at in range(0, len(text), language.WINDOW):
        window = text[at : at + language.WINDOW]
        i = 0
        while i < len(window):
            k = 1
            while i + k < len(window) and window[i : i + k + 1] in sample:
                k += 1
            i, n = i + k, n + 1
    return n


def test_phrases_equal_plain_search():
    rng = np.random.default_rng(5)
    samples = {x: bytes(rng.choice(list(b"abcd "), 300)) for x in ("x", "y", "z")}
    parser = language.Parser(samples)
    texts = [bytes(rng.choice(list(b"abcde "), n)) for n in (0, 1, 7, 511, 512, 513, 1500)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = parser.phrases(data, offsets)
    for i, t in enumerate(texts):
        assert got[i].tolist() == [phrases_by_search(samples[x], t) for x in parser.languages]


def test_normalised():
    texts = ["Été 12!!x", "", " a", "ÀB×c", "b\n\nc "]
    data, offsets = language.normalised(*buffers(pa.array(texts)))
    got = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
    assert got == ["été x", "", "a", "àb×c", "b c "]


def test_a_text_alone_and_among_others():
    """Language, score and bits of a text do not depend on what stands before it."""
    rng = np.random.default_rng(8)
    parts = ["a", "Été", "the ", " ", "\n", "'", "€", "12", "×", "🙂", "hän", "日", "\u0301", "x y", '"', "ß."]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(1000)]
    texts += ["x", "x ", " x", '"x', "", " " * 600 + "x" * 600]
    parser = language.Parser({"en": b"the one x y and a ", "fr": "été hein à la ".encode(), "de": "hän ß der ".encode()})

    def found(some):
        names, score, bits = parser.identify(*buffers(pa.array(some)))
        return list(zip(names, score.tolist(), bits.tolist()))

    alone = {t: found([t])[0] for t in texts}
    for size in (2, 7, 300, len(texts)):
        order = [texts[i] for i in rng.permutation(len(texts))]
        for at in range(0, len(order), size):
            assert found(order[at : at + size]) == [alone[t] for t in order[at : at + size]]


def test_samples_are_whole_texts(spark):
    rows = [(i, f"word{'abc'[i % 3]} " * (i + 1), "en") for i in range(60)]
    rows += [(99, "long " * 30000, "xx"), (100, "very long text " * 3000, "en")]
    samples = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    forms = {language._sample_of(t.encode()) for _, t, x in rows if x == "en"}
    held = samples["en"]
    assert 0 < len(held) <= language.SAMPLE_BYTES + language.SAMPLE_DOCS
    whole = [f for f in forms if b" " + f in b" " + held]
    assert sum(len(f) + 1 for f in whole) >= len(held) // 2
    assert 0 < len(samples["xx"]) <= language.SAMPLE_BYTES + 1


def test_languages_of_odd_texts(spark, sf, odd):
    rows = language.op3_language(spark, sf("odd")).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    for r in rows:
        assert 0 <= r.score <= 1 and r.held_out == in_fold(r.doc_id, 4, 2)
        if r.doc_id is not None:
            letter = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred != "und") == letter, r
    assert language.op3_language(spark, sf("empty")).count() == 0
    nothing_known = language.identify(odd, {})
    assert {r.lang_pred for r in nothing_known.collect()} == {"und"}
    one = language.identify(odd, {"en": b"some text "})
    assert {r.lang_pred for r in one.collect()} == {"und", "en"}


def test_signs_are_no_letters(spark):
    signs = ["€ 12,50 – € 99,90", "1\u00a0000 – 2\u00a0000", "🙂🙂 🎉", "12 … 13 …", "«»", "×", "→ ① ½", "\u0301"]
    letters = ["€ 5 é", "日本", "…x…", "Ω", "𐐀", "हिन्दी"]
    docs = spark.createDataFrame(list(enumerate(signs + letters)), "doc_id long, text string")
    rows = {r.doc_id: r for r in language.identify(docs, {"en": b"some text ", "fr": "été à ".encode()}).collect()}
    for i in range(len(signs)):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0), signs[i]
    assert all(rows[i].lang_pred != "und" for i in range(len(signs), len(rows)))
    data, _ = language.without_signs(*buffers(pa.array(["a€b…é🙂हिँ"])))
    assert data.tobytes().decode() == "a   b   é    हिँ"


def test_held_out_languages(spark, small):
    rows = language.op3_language(spark, SF).where("held_out").collect()
    known = {r.doc_id: r.lang for r in small.collect()}
    assert np.mean([known[r.doc_id] == r.lang_pred for r in rows]) > 0.95


# --- 6: quality --------------------------------------------------------------------


def plain_statistics(text):
    text = text or ""
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    marked = {i + k for i in range(len(w) - 2) for k in range(3) if triples[tuple(w[i : i + 3])] > 1}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(w), sum(map(len, w)), symbols, repeated, len(marked)]


def test_statistics(small):
    texts = ODD + [r.text for r in small.limit(60).collect()] + ["a b c a b c", "x\n\nx\n x\n\r\nx"]
    found = quality.statistics(*buffers(pa.array(texts, pa.string())))
    got = np.stack([found[c] for c in quality.COUNTS], 1).tolist()
    assert got == [plain_statistics(t) for t in texts]


def test_repeated_words_with_many_kinds():
    rng = np.random.default_rng(6)
    codes, text = rng.integers(0, 5, 300), np.sort(rng.integers(0, 4, 300))
    assert np.array_equal(
        quality._repeated_words(codes, text, 5, 4), quality._repeated_words(codes, text, 1 << 22, 4)
    )


def test_trees_are_monotonic_and_separate():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] - x[:, 1] + rng.normal(0, 0.5, 2000)) > 0).astype(float)
    trees = quality.boost(x, y, [1, -1, 1])
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.8
    for j, d in enumerate((1, -1, 1)):
        a = rng.normal(size=(500, 3))
        b = a.copy()
        b[:, j] += rng.exponential(1, 500)
        assert ((trees.score(b) - trees.score(a)) * d >= -1e-12).all()


def plain_tree_score(trees, row):
    total = trees.bias
    for feature, threshold, leaves in zip(trees.feature, trees.threshold, trees.leaves):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += leaves[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def test_flat_trees_equal_node_by_node():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4))
    trees = quality.boost(x, (x[:, 0] * x[:, 1] > 0).astype(float), [0, 0, 0, 0])
    assert np.allclose(trees.score(x[:50]), [plain_tree_score(trees, r) for r in x[:50]])


@pytest.mark.parametrize("one_kind", [False, True])
def test_quality_of_odd_texts(spark, sf, odd, labels, one_kind):
    known = odd.sparkSession.createDataFrame(
        [(12, 1, 0), (13, 1, 0), (18, 1 if one_kind else 0, 0), (18, 0 if not one_kind else 1, 1), (7, None, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.op6_quality(spark, sf("odd", labels=known)).collect()
    texts = Counter((r.doc_id, *plain_statistics(r.text)) for r in odd.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == texts
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.op6_quality(spark, sf("empty", labels=known)).count() == 0


def test_quality_agrees_with_labels(spark, small, labels):
    rows = {r.doc_id: r for r in quality.op6_quality(spark, SF).collect()}
    for r in labels.collect():
        if r.quality == 0 and r.doc_id in rows:
            assert not rows[r.doc_id].kept
    good = [rows[r.doc_id] for r in labels.collect() if r.quality == 1 and not rows[r.doc_id].base_failed]
    assert np.mean([r.kept for r in good]) > 0.95


# --- 10: toxicity ------------------------------------------------------------------


def test_machine_learns_pairs():
    """Two terms that are harmless alone and toxic together: no linear weights do that."""
    rng = np.random.default_rng(9)
    lists, label = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        lists.append(([0] if a else []) + ([1] if b else []))
        label.append(int(a and b) if rng.random() < 0.98 else int(rng.random() < 0.5))
    table = pa.table({"terms": pa.array(lists, pa.list_(pa.int32())), "toxic": pa.array(label, pa.int32())})
    machine = toxicity._fit(table, np.array([10, 20]), np.mean(label))
    z = {}
    for pair in ((), (0,), (1,), (0, 1)):
        v = machine.factors[list(pair)]
        z[pair] = machine.bias + machine.weights[list(pair)].sum() + ((v.sum(0) ** 2) - (v**2).sum(0)).sum() / 2
    assert z[(0, 1)] > 0 > max(z[()], z[(0,)], z[(1,)])


def paired_texts(n, rng):
    """Two words are each as common in clean as in toxic texts; only together are they toxic."""
    texts, toxic = [], []
    for i in range(n):
        mine = (["plonk", "greens"], ["zorgon"], ["plonk"], ["greens"])[i % 4]
        filler = [f"{chr(97 + a % 26)}{chr(97 + a // 26)}fill" for a in rng.integers(0, 200, 12)]
        texts.append(" ".join(rng.permutation(filler + mine)))
        toxic.append(int(i % 4 < 2))
    return texts, toxic


def test_fit_learns_a_pair_of_harmless_words(spark):
    rng = np.random.default_rng(12)
    texts, toxic = paired_texts(1200, rng)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit(docs, labels)
    texts, toxic = paired_texts(400, rng)
    scores = toxicity._scores(machine, *buffers(pa.array(texts)))
    assert np.mean((scores >= 0.5) == np.array(toxic)) > 0.95


def plain_machine_score(machine, text):
    letters = re.findall(r"[a-z\u0080-\U0010ffff]+", "".join(c.lower() if c < "ß" and c != "×" else c for c in text or ""))
    place = {int(t): i for i, t in enumerate(machine.terms)}
    held = sorted({place[t] for w in letters for t in toxicity._terms_of(w.encode()) if t in place})
    z = machine.bias + machine.weights[held].sum()
    for i, a in enumerate(held):
        for b in held[i + 1 :]:
            z += machine.factors[a] @ machine.factors[b]
    return 1 / (1 + math.exp(-z))


def test_scores_equal_the_sum_over_pairs(spark, small, odd):
    rng = np.random.default_rng(10)
    texts = [r.text for r in small.limit(40).collect()] + ODD
    _, terms = toxicity.document_terms(*buffers(pa.array(texts[:40])))
    terms = np.unique(rng.choice(terms, 500))
    machine = toxicity.Machine(terms, -0.3, rng.normal(0, 0.1, len(terms)), rng.normal(0, 0.05, (len(terms), 6)))
    got = toxicity._scores(machine, *buffers(pa.array(texts, pa.string())))
    assert np.allclose(got, [plain_machine_score(machine, t) for t in texts])


def test_toxicity_of_odd_texts(spark, sf, odd):
    known = spark.createDataFrame(
        [(12, 1, 0), (13, 1, 0), (18, 0, 1), (18, 0, None), (7, None, 2), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for labels in (known, known.where("toxic = 0"), known.where("toxic > 5")):
        rows = toxicity.op10_toxicity(spark, sf("odd", labels=labels)).collect()
        assert len(rows) == odd.count()
        for r in rows:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
            assert r.held_out == in_fold(r.doc_id, 4, 2)
    assert toxicity.op10_toxicity(spark, sf("empty", labels=known)).count() == 0


def test_held_out_toxicity(spark):
    folder = SF.replace("0.001", "0.1")
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in toxicity.op10_toxicity(spark, folder).where("held_out").collect() if r.doc_id in truth]
    toxic = [r.predicted for r in rows if truth[r.doc_id] == 1]
    clean = [r.predicted for r in rows if truth[r.doc_id] == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02


# --- bounded samples ---------------------------------------------------------------


def test_samples_hold_one_row_an_id(spark, monkeypatch):
    rows = [(i % 6 if i < 300 else 0, f"{'good' if i % 2 else 'bad'} text number {i} of many") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame([(i, i % 2, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "_fit", lambda found, terms, share: taken.append(found.num_rows))
    monkeypatch.setattr(quality, "boost", lambda x, y, signs: taken.append(len(x)))
    toxicity.fit(docs, known)
    quality.fit(docs, known)
    assert taken == [6, 6]


def test_toxicity_fit_holds_its_sample_once(monkeypatch):
    """What the fit allocates besides its sample is small, and the order is that of content."""
    rng = np.random.default_rng(8)
    rows = [np.sort(rng.choice(5000, 2000, replace=False)).astype(np.int32) for _ in range(1500)]
    rows += rows[:5]
    label = rng.integers(0, 2, len(rows))
    table = pa.table([pa.chunked_array([pa.array(rows[i : i + 400], pa.list_(pa.int32())) for i in range(0, 1505, 400)]),
                      pa.array(label, pa.int32())], names=["terms", "toxic"])
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    tracemalloc.start()
    toxicity._fit(table, np.arange(5000), 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.5 * sum(r.nbytes for r in rows)
    want = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), label[i]))
    assert toxicity._by_content(rows, label) == want
