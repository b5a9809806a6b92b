"""The manifest against a plain tree in Python, and its SQL."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from doorstep.llm import manifest, sql

KIND = "doc_id long, source string, lang string, n_chars long, text string"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The root, and of each node its (place in the run, siblings) level by level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, o in zip(paths, own):
            first = o - o % 3
            run = nodes[first : first + 3]
            path.append((o - first, run[: o - first] + run[o - first + 1 :]))
        nodes = [digest(nodes[a : a + 3]) for a in range(0, len(nodes), 3)]
        own = [o // 3 for o in own]
    return nodes[0] if nodes else None, paths


def plain(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        fixed = [field(x) for x in (doc_id, source, lang, n_chars)]
        own = changed = digest([*fixed, field(text)])
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = digest([*fixed, field(text.replace("\n", ""))])
        groups[source].append((doc_id is not None, doc_id or 0, own, changed, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda x: x[:3])
        trees[source] = tree([x[2] for x in groups[source]])
    root, tops = tree([trees[s][0] for s in order])
    found = []
    for source, top in zip(order, tops):
        for (*_, own, changed, doc_id), path in zip(groups[source], trees[source][1]):
            path = path + top
            folded = changed
            for place, siblings in path:
                folded = digest([*siblings[:place], folded, *siblings[place:]])
            proof = digest([s for _, siblings in path for s in siblings])
            found.append((doc_id, own, trees[source][0], root, proof, folded, folded == root))
    return found


def check(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    found = Counter(tuple(r) for r in manifest.manifest(df).collect())
    assert found == Counter(plain(rows))


def test_odd_rows(spark):
    check(
        spark,
        [
            (None, None, None, None, None),
            (None, "a", "en", 3, "x\ny"),
            (None, "a", "en", 3, "x\nz"),
            (5, "a", "en", 1, ""),
            (5, "a", "en", 1, ""),
            (5, "a", "fr", 1, "é\n"),
            (-7000, "a", None, 1, "q"),
            (2**62, "é", "x", 0, "t"),
            (1, "", "x", 0, "t\n\n"),
        ],
    )


@pytest.mark.parametrize("n", [0, 1, 4])
def test_few_rows(spark, n):
    check(spark, [(i, "s", "en", 1, "a\nb") for i in range(n)])


def test_several_steps_and_repeats(spark):
    rows = [(i // 3, None if i % 2 else "s", "e", i % 7, "a\nb" * (i % 4)) for i in range(3000)]
    # one id, and no id, with many rows each; equal rows among them
    rows += [(7, "s", "e", i % 50, "x\n") for i in range(400)]
    rows += [(None, "s", "e", i, f"y\n{i}") for i in range(300)]
    check(spark, rows)


def test_a_source_to_each_row(spark):
    check(spark, [(i, f"s{i}", "en", 1, "a\nb") for i in range(40)])


def test_other_columns_are_ignored(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    more = docs.selectExpr("*", "1 AS g", "'x' AS leaf", "map(1, 2) AS chunk", "0L AS place")
    kept = Counter(tuple(r) for r in manifest.manifest(more).collect())
    assert kept == Counter(plain([tuple(r) for r in docs.select(*manifest.FIELDS).collect()]))


def test_order_and_partitions_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = manifest.manifest(docs.repartition(7, "text")).collect()
    second = manifest.manifest(docs.orderBy("text").coalesce(1)).collect()
    assert sorted(first) == sorted(second)


def test_sql(spark, sf_dir):
    engine = duckdb.connect()
    engine.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = engine.sql("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    found = engine.sql(sql.OP12_MANIFEST).fetchall()
    assert sorted(found) == sorted(plain(rows))
    assert sorted(map(tuple, manifest.op12_manifest(spark, sf_dir).collect())) == sorted(found)


def test_containers():
    rng = np.random.default_rng(3)
    for share in (0, 0.01, 0.5, 1):
        counts = (rng.random(1 << manifest.CHUNK_BITS) < share) * rng.integers(1, 4, 1 << manifest.CHUNK_BITS)
        bits, again = manifest.unpacked(*manifest.packed(counts))
        lows = np.arange(len(counts))
        assert (manifest.rank(bits, again, lows) == np.r_[0, np.cumsum(counts)[:-1]]).all()


@pytest.mark.parametrize("bits", [2, 3])
def test_prefix_sums_in_several_levels(spark, monkeypatch, bits):
    monkeypatch.setattr(manifest, "FAN_BITS", bits)
    rows = [(g, k * 37 % 900 - 300, k % 5) for g in "ab" for k in range(100)]
    df = spark.createDataFrame(rows, "g string, k long, n long")
    found = manifest.before(df, ["g"], "k", "n", [-300, 600]).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.before == sum(n for g, k, n in rows if g == r.g and k < r.k)
