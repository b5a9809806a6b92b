"""Collocations against counting in Python, and their SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from doorstep.llm import bittable, phrases, sql
from doorstep.llm.text import LOWER


def plain(rows, least, first):
    """``rows`` of (text, lang)."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = (text or "").encode().translate(bytes(LOWER)).decode()
        of = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                of.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, of in counts.items():
        kept = {p: a for p, a in of.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in kept.items():
            if any(
                a <= b and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in kept.items()
            ):
                continue
            score, k = min(
                (1000 * a * totals[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for i, (score, a, p, l, r) in enumerate(sorted(rows)[:first]):
            found.append((lang, i + 1, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def mined(df, least, first=50, **more):
    return sorted(tuple(r) for r in phrases.collocations(df, least=least, first=first, **more).collect())


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    words = ["a", "A", "of", "the", "é", "ÉÉ", "x-y", "new", "york", "times", " ", " z"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " . ", ",", "\n", "\x0b", " "]) for _ in range(60))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    rows += [("New York Times today", "en")] * 120 + [(None, "en"), ("", None), (" \t.", "de"), ("w " * 3000, "fr")]
    return rows


def test_equals_plain_counting(spark, made):
    df = spark.createDataFrame(made, "text string, lang string").repartition(5)
    assert mined(df, 20) == plain(made, 20, 50)


@pytest.mark.parametrize("bits", [4, 7])
def test_phrases_that_meet_in_a_fingerprint(spark, made, bits):
    """So few bits that nearly all, or many, fingerprints stand for several phrases."""
    df = spark.createDataFrame(made[:120], "text string, lang string")
    assert mined(df, 20, bits=bits) == plain(made[:120], 20, 50)


def test_no_rows_and_nothing_frequent(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert mined(empty, 1) == []
    assert mined(spark.createDataFrame([(None, None), ("", "en"), ("one two", "en")], empty.schema), 2) == []


def test_least_of_one(spark):
    rows = [("One two; two ONE two", "en"), ("two one", None)]
    assert mined(spark.createDataFrame(rows, "text string, lang string"), 1) == plain(rows, 1, 50)


def test_other_columns_and_odd_texts(spark, odd):
    rows = [(r.text, r.lang) for r in odd.collect()]
    more = odd.selectExpr("*", "1 AS key", "map(1, 2) AS n", "'x' AS phrase", "2 AS size")
    assert mined(more, 3) == plain(rows, 3, 50)


def test_scores_beyond_64_bits(spark):
    values = [(10**13 + 7, 10**15 + 3, 10**13 + 9, 10**13 + 11), (10**9, 10**18, 10**9, 10**9 + 1), (3, 7, 5, 11)]
    df = spark.createDataFrame(values, "a long, n long, l long, r long")
    found = {(r.a, r.score) for r in df.withColumn("score", phrases.score()).collect()}
    assert found == {(a, 1000 * a * n // (l * r)) for a, n, l, r in values}


def test_sql(spark, sf_dir):
    engine = duckdb.connect()
    engine.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    text = sql.OP13_PHRASES.replace(">= 100", ">= 20")
    order = "lang, rank, phrase, a, l, r, n, score"
    found = sorted(engine.sql(f"SELECT {order} FROM ({text})").fetchall())
    rows = engine.sql("SELECT text, lang FROM documents").fetchall()
    assert found and found == plain(rows, 20, 2000)
    assert mined(spark.read.parquet(f"{sf_dir}/documents.parquet"), 20, 2000) == found


def test_bit_table_misses_no_key(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(random.Random(1).randrange(-(2**62), 2**62) for _ in range(3000))]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    table = bittable.BitTable(bittable.shipped(df.repartition(5)))
    assert table.has(np.array(keys, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 62, 3000, np.uint64)
    assert table.has(others).mean() < 0.01
    assert not bittable.BitTable(bittable.shipped(df.where("key IS NULL"))).has(others).any()
