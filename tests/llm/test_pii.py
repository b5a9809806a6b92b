"""Base spans against the patterns as given, the field against enumeration and planted numbers."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from doorstep.llm import pii

# The patterns as they were given.
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in GIVEN.items()
        for m in re.finditer(pattern, text or "")
        if good(kind, m.group())
    ]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def named(spans):
    return [(pii.KINDS[k], a, b) for k, a, b in sorted(spans)]


def card(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    return next(n for c in range(10) if pii.luhn(n := "".join(map(str, [*digits, c]))))


def phone(rng):
    return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10**4):04}"


WORDS = "the river bank was quiet and old boats lay still under a pale sky version 4.0. of 2019".split()


def text_of(rng, *data):
    words = [rng.choice(WORDS) for _ in range(40)]
    for d in data:
        words.insert(rng.randrange(len(words)), d)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(240):
        p, c = phone(rng), card(rng)
        wrong = str(10**15 + rng.randrange(10**15))
        data = [[p], [c], [p, p], [c, c], [f"u{i}@mail{i % 9}.example.com"], [f"10.{i}.3.4"], [wrong], []][i % 8]
        rows.append(text_of(rng, *data))
    return rows


@pytest.fixture(scope="module")
def field(small):
    texts = sorted(r.text or "" for r in small.select("text").collect())
    held = [pii.examples(pii.graph(t))[:2] for t in texts if pii.graph(t).core]
    label, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
    return pii.train(label, x, np.ones(len(label)))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["1", "42", "255", "256", "007", ".", ".", "@", "a", "é", "mail.x", " ", "-", "+", "+1", "(", ")", "\n", "4111111111111111", "🙂"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 40)))
        assert named(pii.base_spans(text)[0]) == plain(text), text


def test_long_words_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 60_000, "a1" * 100_000, "@" * 100_000):
        pii.graph(text)


def test_messages_are_exact_on_chains(field):
    rng = np.random.default_rng(5)
    unary = rng.normal(size=(4, pii.LABELS))
    edges = np.array([[0, 1, 0], [1, 2, 1], [2, 3, 0]])
    tables = [field.chain, *field.skip]
    total = np.zeros((4, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=4):
        z = sum(unary[i, k] for i, k in enumerate(labels)) + sum(tables[k][labels[i], labels[j]] for i, j, k in edges)
        for i, k in enumerate(labels):
            total[i, k] += np.exp(z)
    total /= total.sum(1, keepdims=True)
    assert np.allclose(np.exp(pii.marginals(unary, edges, field)), total, atol=2e-3)


def test_messages_pull_equal_pieces_together(field):
    unary = np.zeros((2, pii.LABELS))
    unary[0] = -60.0
    unary[0, 4] = 0.0
    alone = pii.marginals(unary, np.zeros((0, 3), np.int64), field)
    linked = pii.marginals(unary, np.array([[0, 1, 1]]), field)
    assert linked[1][4] > alone[1][4]


def test_swallowed_and_repeated_numbers_are_added(field):
    rng = random.Random(9)
    swallowed = right = 0
    for _ in range(40):
        p, c, d = phone(rng), card(rng), card(rng)
        for text, wanted in (
            (text_of(rng, f"{p} 170.106.147.218"), [p]),
            (text_of(rng, f"{c} {d}"), [c, d]),
        ):
            (base, more), = pii.find([text], field)
            swallowed += len(wanted)
            right += Counter(text[a:b] for _, a, b in more) == Counter(wanted) and len(wanted)
    assert right >= 0.9 * swallowed
    repeated = "call +1 (843) 555-7672 now, or later (843) 555-7672 ok"
    (base, more), = pii.find([repeated], field)
    assert [repeated[a:b] for _, a, b in more] == ["(843) 555-7672"]
    # without the other mention there is nothing to agree with
    assert pii.find(["later (843) 555-7672 ok"], field) == [([], [])]


def test_clean_texts_are_left_alone(field):
    rng = random.Random(11)
    for _ in range(200):
        wrong = next(n for n in iter(lambda: str(10**15 + rng.randrange(9 * 10**15)), None) if not pii.luhn(n))
        text = text_of(rng, wrong, f"{rng.randrange(300, 999)}.1.2.3", "v1.2.3", "12:30", "555-1234", "a1b2c3d4e5f6")
        assert pii.find([text], field) == [([], [])]


def check(rows):
    for text, r in rows:
        base = plain(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in GIVEN]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        found = r.spans.split(",") if r.spans else []
        assert set(joined([s]) for s in base) <= set(found) and len(found) == len(base) + r.n_added
        order = [(list(GIVEN).index(s.split(":")[0]), int(s.split(":")[1])) for s in found]
        assert order == sorted(order)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pii.op11_pii(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check((texts[r.doc_id], r) for r in rows)


def test_rows_alone_and_in_batches(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "doc_id long, text string")
    field = pii.fit(docs.repartition(5))
    again = pii.fit(docs.repartition(2, "text"))
    assert all(np.array_equal(getattr(field, k), getattr(again, k)) for k in ("unary", "chain", "skip"))
    together = pii.find(corpus, field)
    assert together == [pii.find([t], field)[0] for t in corpus]


def test_odd_rows(spark, odd, nothing):
    more = odd.selectExpr("*", "'x' AS spans", "1 AS n_email", "map(1, 2) AS other")
    field = pii.fit(more)
    assert field is None
    rows = pii.spans(more, field).collect()
    assert len(rows) == odd.count() and {r.spans for r in rows} == {""}
    assert pii.spans(nothing, pii.fit(nothing)).collect() == []
    few = spark.createDataFrame([(1, "a@b.c x"), (None, "a@b.c x"), (1, "a@b.c x"), (2, None)], "doc_id long, text string")
    found = pii.spans(few, pii.fit(few)).collect()
    assert Counter(r.spans for r in found) == {"email:0:5": 3, "": 1}
