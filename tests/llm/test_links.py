"""SimHash components, pivot search and the corpus pipeline."""

import itertools
import re

import duckdb
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from doorstep.llm import packing, pivots, similar, simhash, sql
from doorstep.llm.text import buffers

from .conftest import ODD, SF


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """(id, fingerprint) to the smallest id reachable, by comparing all pairs."""
    owner = list(range(len(rows)))

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
            owner[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, fp, least.get(find(i))) for i, (doc, fp) in enumerate(rows)), key=repr)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    texts = ODD + ["one", "one two", "one two three", "A b\tC a B c a b c"]
    got = simhash.fingerprints(*buffers(pa.array(texts, pa.string())))
    assert [int(x) & (1 << 64) - 1 for x in got] == [plain_fingerprint(t) for t in texts]


def test_components_of_texts(spark, sf, odd):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    got = simhash.op5_simhash(spark, sf("odd")).collect()
    flat = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=repr)
    assert flat == plain_components(rows)
    assert simhash.op5_simhash(spark, sf("empty")).count() == 0


def check_links(spark, values):
    distinct = sorted(set(values))
    df = spark.createDataFrame([(signed(v),) for v in distinct], "fp long")
    found = {r.fp: r.root for r in simhash.components(simhash.links(df)).collect()}
    want = plain_components([(signed(v), v) for v in distinct])
    assert {doc: found.get(doc, doc) for doc, _, _ in want} == {doc: c for doc, _, c in want}


def test_links_of_crowded_and_chained_fingerprints(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = 0x9A3C_5F10_77E1_0BCD
    crowd = [centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 5) if a != b]
    chain = [0]
    for i in range(60):  # two bits further each time
        chain.append(chain[-1] ^ (1 << (2 * i % 64)) ^ (1 << ((2 * i + 1) % 64)))
    loose = [int(x) for x in rng.integers(0, 1 << 63, 150)]
    near = [v ^ (1 << int(rng.integers(64))) for v in loose[:50]] + [v ^ 7 for v in loose[50:80]]
    check_links(spark, loose + near + chain[:30])
    check_links(spark, crowd)
    monkeypatch.setattr(simhash, "CROWD", 2)  # everything takes the second way
    check_links(spark, loose + near + crowd[:300] + chain[:20])


# --- 7: pivot search ---------------------------------------------------------------


def plain_search(rows, k=20):
    usable = [
        (i, [int(np.floor(64 * float(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, v) in enumerate(usable):
        if q is None or q % 20:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for m, (i, w) in enumerate(usable) if m != n
        ]
        out += [(q, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    rows += [(400 + i, [0.25] * 8) for i in range(40)]  # ties
    rows += [(20, [0.5] * 8), (20, [0.5] * 8), (None, [0.5] * 8), (500, None), (520, [0.1, None] * 4)]
    rows += [(540, [float("nan")] * 8), (560, [float("inf")] * 8), (580, [0.5] * 3), (600, []), (620, [9.5] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rounded = [(r.vec_id, r.embedding) for r in df.collect()]
    for size, queries in ((4096, 1024), (64, 8)):
        monkeypatch.setattr(pivots, "BLOCK", size)
        monkeypatch.setattr(pivots, "QUERY_BLOCK", queries)
        got = pivots.top_k(pivots.vectors(df), F.col("vec_id") % 20 == 0).collect()
        assert sorted(map(tuple, got), key=repr) == plain_search(rounded)
    none = pivots.vectors(df.where("vec_id < 0"))
    assert pivots.top_k(none, F.col("vec_id") % 20 == 0).count() == 0
    assert pivots.top_k(pivots.vectors(df.where("vec_id % 20 != 0")), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_eliminate():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 40, (8, 16))
    x = np.floor(centres[rng.integers(0, 8, 4000)] + rng.normal(0, 2, (4000, 16))).astype(np.int64)
    p = pivots.choose_pivots(x[:500])
    evaluated = []

    class Counting(pivots._Best):
        def _evaluate(self, i, q, x, which, block):
            evaluated.append(len(which))
            super()._evaluate(i, q, x, which, block)

    def block(rows, prefix):
        uid = np.arange(len(rows))
        return pivots._Block(
            {
                prefix + "uid": uid.tobytes(), prefix + "ids": uid.tobytes(), prefix + "width": 16,
                prefix + "named": np.ones(len(rows), bool).tobytes(), prefix + "vectors": rows.tobytes(),
                prefix + "far": pivots.pivot_distances(rows, p).tobytes(),
            },
            prefix,
        )

    best = Counting(block(x[:40], "q_"))
    best.meet(block(x, ""))
    assert sum(evaluated) < 40 * 4000 / 2


# --- pipeline ----------------------------------------------------------------------


def test_stages_keep_the_documents_columns(spark, small):
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = packing.stored(stage(spark, docs, SF), f"test-{name}")
        assert kept.columns == docs.columns
        assert kept.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs = kept
    fps = [plain_fingerprint(r.text) for r in docs.collect()]
    assert all(bin(a ^ b).count("1") > 2 for a, b in itertools.combinations(fps, 2))


def test_pipeline_packs_what_the_stages_keep(spark, labels, small):
    rows = corpus_pipeline.run(spark, SF).collect()
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    packed = {r.doc_id for r in rows}
    assert len(toxic & packed) < 0.5 * len(toxic)
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in small.collect()]
    first = {doc for doc, _, least in plain_components(fps) if doc == least}
    assert len(clean & first & packed) > 0.97 * len(clean & first)
    for r in rows:
        assert 0 <= r.offset and r.offset + r.length <= 2048


def test_pipeline_takes_odd_texts(spark, odd, nothing, sf):
    known = spark.createDataFrame([(12, 1, 0), (18, 0, 1)], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, sf("odd", labels=known)).count() > 0
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:  # columns named like results stay
        docs = packing.stored(stage(spark, docs, sf("odd", labels=known)), f"odd-{name}")
        assert docs.columns == odd.columns and {r.fp for r in docs.select("fp").collect()} <= {"z", None}
        was = {r.doc_id: r.score for r in odd.collect()}
        kept = docs.where("doc_id IS NOT NULL").select("doc_id", "score").collect()
        assert all(was[r.doc_id] == r.score for r in kept)
    assert corpus_pipeline.run(spark, sf("empty", labels=known)).count() == 0


# --- near copies -------------------------------------------------------------------


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def test_shingle_sets():
    texts = ODD + ["one", "one two", "One  two", "a b c d e", "a b c d e a b c d e"]
    hashes, edges = similar.shingle_sets(*buffers(pa.array(texts, pa.string())))
    assert np.diff(edges).tolist() == [len(plain_set(t)) for t in texts]
    keys, sets = similar.keys(hashes, edges), [plain_set(t) for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert (keys[i] == keys[j]) == (sets[i] == sets[j])


def test_stage_drops_edited_copies(spark):
    rng = np.random.default_rng(4)
    kinds = [f"w{i}" for i in range(5000)]
    texts = []
    for n in range(40):
        base = list(rng.choice(kinds, 200))
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 12):  # twelve edits make another document
            other = list(base)
            for at in rng.choice(200, edits, replace=False):
                other[at] = "new" + str(rng.integers(1 << 30))
            texts.append(" ".join(other))
    crowd = list(rng.choice(kinds, 300))
    for n in range(60):  # near copies of one text, all different
        other = list(crowd)
        other[int(rng.integers(300))] = f"only{n}"
        texts.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()}
    sets = [plain_set(t) for t in texts]
    owner = list(range(len(sets)))

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        if alike(sets[i], sets[j]):
            a, b = sorted((find(i), find(j)))
            owner[b] = a
    assert kept == {find(i) for i in range(len(sets))}


def test_stage_meets_few_pairs_of_a_crowd(spark, monkeypatch):
    """Copies of one text with so many edits that about half of them are near none."""
    rng = np.random.default_rng(6)
    kinds = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(kinds, 150))
    texts = []
    for n in range(300):
        other = list(base)
        for at in rng.choice(150, 1 + n % 8, replace=False):
            other[at] = f"only{n}at{at}"
        texts.append(" ".join(other[: 150 - n % 5]))
    met, real = spark.sparkContext.accumulator(0), similar._verified

    def counted(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield from real([batch])

    monkeypatch.setattr(similar, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()}
    sets = [plain_set(t) for t in texts]
    root = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if root[i] != root[j] and alike(sets[i], sets[j]):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    assert kept == set(root) and 100 < len(kept) < 250
    assert 0 < met.value < 20 * len(texts)  # of 44,850


def test_sets_with_common_rare_shingles_meet(spark):
    """Every similar pair is in a group with room enough, whatever the sets share."""
    rng = np.random.default_rng(7)
    pools = [rng.integers(-(1 << 62), 1 << 62, 40) for _ in range(5)]
    held = {}
    for key in range(160):
        parts = [pools[i] for i in rng.choice(5, 2, replace=False)]
        some = np.concatenate(parts)[: int(rng.integers(50, 81))]
        held[key] = np.unique(np.r_[some, rng.integers(-(1 << 62), 1 << 62, int(rng.integers(0, 12)))])
    rows = [(k, bytearray(v.astype("<i8").tobytes())) for k, v in held.items()]
    groups = {}
    for r in similar.crowded(spark.createDataFrame(rows, "key long, held binary")).collect():
        groups.setdefault(r.value, []).append((r.key, r.room))
    met = set()
    for rows in groups.values():
        for (a, x), (b, y) in itertools.combinations(sorted(rows), 2):
            if min(x, y) >= 4 / 9 * (len(held[a]) + len(held[b])) - 1e-6:
                met.add((a, b))
    pairs = itertools.combinations(held, 2)
    want = {(a, b) for a, b in pairs if alike(set(held[a].tolist()), set(held[b].tolist()))}
    assert len(want) > 50 and want <= met


def test_stage_takes_candidates_from_simhash(spark, monkeypatch):
    """Sets of fingerprints two bits apart or fewer are paired, also those of equal ones."""
    values = [0, 0, 1, 7, 1 << 40, 0b1011 << 20, 0b1000 << 20, signed(1 << 63 | 1), 0x5555555555]
    one = spark.createDataFrame([(100 - i, v) for i, v in enumerate(values)], "key long, fp long")
    pairs = {(r.a, r.b) for r in similar.close(one).collect()}
    root = {100 - i: 100 - i for i in range(len(values))}
    for _ in values:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    rows = [(100 - i, v & (1 << 64) - 1) for i, v in enumerate(values)]
    assert {doc: c for doc, _, c in plain_components(rows)} == root
    calls, real = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda distinct: calls.append(1) or real(distinct))
    docs = spark.createDataFrame([(1, "a b c"), (2, "A  b c"), (3, "d")], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()} == {1, 3}
    assert calls


def test_stage_keeps_different_texts_of_one_id(spark):
    far = [" ".join(f"{a}{i}" for i in range(30)) for a in "abcdef"]
    rows = [(7, far[0]), (7, far[1]), (7, far[1]), (8, far[1]), (5, far[2]), (7, far[2]), (None, far[3]), (None, far[4])]
    rows += [(None, far[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()
    want = [(7, far[0]), (7, far[1]), (5, far[2]), (None, far[3]), (None, far[4])]
    assert sorted(map(tuple, kept), key=repr) == sorted(want, key=repr)


def test_stages_keep_columns_of_any_name_and_type(spark, labels, small):
    """Columns called like those that stages work with, and maps, come back as they were."""
    docs = small.limit(60).selectExpr(
        "*", "'a' AS _h1", "'b' AS h1", "'c' AS h2", "1.5 AS toxicity", "2.5 AS _toxicity", "'d' AS language_score",
        "'e' AS _language_score", "map('k', doc_id) AS m", "array(named_struct('x', map(1, text))) AS deep",
        "'f' AS key", "'g' AS root", "'h' AS bands", "'i' AS lang_pred",
    )
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.schema == docs.schema or name == "language" and found.columns == docs.columns
        rows = found.collect()
        assert rows and all(
            r[c] == before[r.doc_id][c] for r in rows for c in docs.columns if c != "lang"
        ), name


def test_rows_that_differ_in_a_map_alone_are_near_copies(spark):
    docs = spark.sql("SELECT 1 AS doc_id, 'some words to keep' AS text, map('a', v) AS m FROM VALUES (1), (1), (2) AS t(v)")
    assert len(similar.distinct_documents(docs).collect()) == 1
    assert len({(r.h1, r.h2) for r in similar.linked(docs).collect()}) == 2


def test_search_equals_its_sql(spark):
    engine = duckdb.connect()
    engine.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = sorted(engine.sql(f"SELECT query_id, rank, vec_id, score FROM ({sql.OP7_PIVOTS})").fetchall())
    rows = pivots.op7_pivots(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert found and sorted(map(tuple, rows)) == found
