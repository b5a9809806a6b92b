"""A Merkle manifest of a dataset by bitmap rank, with a proof and its check for each row.

Every row is a leaf: the sha256 of its id, source, language, length and text.  The leaves
of a source ascend by id, and every three neighbours become one node until one is left, the
source's subroot; the subroots, in order of their sources, become the root likewise.

**Coordinates without sorting.**  A task turns the ids that it reads into compressed
bitmaps of ``2**CHUNK_BITS`` ids per source (a list of the set places where that is
shorter), with a count for ids that repeat.  The bitmaps of a chunk are merged; prefix sums
of their populations, taken level by level with ``FAN`` chunks to a window, give the number
of leaves before each chunk, and a directory of populations per byte gives a leaf's rank in
its own.

**Levels.**  Nodes are keyed by (source, place div ``3**LEVELS``) and put in an array of
that many slots by their place, which is reduced ``LEVELS`` times in one step; the nodes
that come out are the next step's.  Then the siblings go down the same steps.

Rows without an id come before all others of their source.  Rows that share an id come in
order of their leaf, equal rows in any order.  Such rows are ranked by prefix sums over
their leaves' first bits, counted once if they are equal; so one id, or none, may hold any
share of the rows.  A null field is ``-``, a null source is a group of its own and the
first, and an empty text is no null.  No rows: no result.  Other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored

#: Ids to a bitmap: at most this many rows meet in a group, besides those that share an id.
CHUNK_BITS = 10
#: Rows of a window of prefix sums, as a number of bits.
FAN_BITS = 10
#: Levels of a tree that are reduced in one step.
LEVELS = 6
ARITY = 3
#: Ids that a task holds before it writes out their bitmaps.
HELD_IDS = 1 << 20

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

_CHUNK = 1 << CHUNK_BITS
_POPULATION = np.array([bin(b).count("1") for b in range(256)], np.int64)


# --- leaves ------------------------------------------------------------------------


def leaf(text=None):
    """The hex digest of a row's fields, with another ``text`` if one is given."""
    fields = [F.col(c).cast("string") for c in FIELDS]
    if text is not None:
        fields[-1] = text
    sized = [
        F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields
    ]
    return F.sha2(F.concat(*sized), 256)


def tampered():
    """Whether a row is changed to try the manifest: an even crc32 of its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))


def _rows(docs):
    """(doc_id, g, chunk, low, leaf, changed): g is the source as a key that is never null."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("g"),
        F.unhex(leaf()).alias("leaf"),
        F.unhex(F.when(tampered(), leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))).alias("changed"),
    )
    rows = stored(rows, "manifest-rows")
    least = rows.agg(F.min("doc_id")).first()[0]
    none = ((least or 0) >> CHUNK_BITS) - 1
    return rows.withColumns(
        {
            "chunk": F.coalesce(F.shiftright("doc_id", CHUNK_BITS), F.lit(none).cast("long")),
            "low": F.coalesce(F.col("doc_id").bitwiseAND(_CHUNK - 1), F.lit(0)).cast("int"),
        }
    )


# --- bitmaps -----------------------------------------------------------------------

_CONTAINER = "g string, chunk long, n long, held binary, again binary"
_AGAIN = np.dtype([("low", "<u2"), ("extra", "<i8")])


def packed(counts):
    """(bytes of the set places, bytes of the repeats) of the counts of a chunk's ids."""
    lows = np.flatnonzero(counts)
    dense = np.packbits(counts > 0, bitorder="little")
    sparse = lows.astype("<u2").tobytes()
    held = b"\0" + sparse if len(sparse) < len(dense) else b"\1" + dense.tobytes()
    many = lows[counts[lows] > 1]
    again = np.zeros(len(many), _AGAIN)
    again["low"], again["extra"] = many, counts[many] - 1
    return held, again.tobytes()


def unpacked(held, again):
    """(bitmap as bytes of eight ids, repeats) of a container."""
    if held[:1] == b"\1":
        bits = np.frombuffer(held, np.uint8, offset=1)
    else:
        marks = np.zeros(_CHUNK, np.uint8)
        marks[np.frombuffer(held, "<u2", offset=1)] = 1
        bits = np.packbits(marks, bitorder="little")
    return bits, np.frombuffer(again, _AGAIN)


def rank(bits, again, lows):
    """Leaves of the chunk before each id of ``lows``, by a directory of populations."""
    directory = np.r_[0, np.cumsum(_POPULATION[bits])]
    byte, bit = lows >> 3, lows & 7
    before = directory[byte] + _POPULATION[bits[byte] & ((1 << bit) - 1)]
    extra = np.r_[0, np.cumsum(again["extra"])]
    return before + extra[np.searchsorted(again["low"], lows)]


def _containers(keys):
    """One batch of containers of the (g, chunk, low) held."""
    table = pa.Table.from_batches(keys).combine_chunks()
    names = table.column("g").combine_chunks().dictionary_encode()
    g = names.indices.to_numpy(zero_copy_only=False)
    chunk, low = table.column("chunk").to_numpy(), table.column("low").to_numpy()
    order = np.lexsort((chunk, g))
    g, chunk, low = g[order], chunk[order], low[order]
    edges = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1]), True])
    rows = []
    for a, b in zip(edges, edges[1:]):
        rows.append((b - a, *packed(np.bincount(low[a:b], minlength=_CHUNK))))
    return pa.record_batch(
        [
            names.dictionary.take(pa.array(g[edges[:-1]])),
            pa.array(chunk[edges[:-1]]),
            pa.array([int(r[0]) for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.binary()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        names=["g", "chunk", "n", "held", "again"],
    )


def _partial(batches):
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= HELD_IDS:
            yield _containers(held)
            held, size = [], 0
    if size:
        yield _containers(held)


def _merged(key, table):
    counts = np.zeros(_CHUNK, np.int64)
    for held, again in zip(table.column("held").to_pylist(), table.column("again").to_pylist()):
        bits, more = unpacked(held, again)
        counts += np.unpackbits(bits, bitorder="little")
        counts[more["low"]] += more["extra"]
    held, again = packed(counts)
    return pa.table(
        {
            "g": pa.array([key[0].as_py()], pa.string()), "chunk": pa.array([key[1].as_py()], pa.int64()),
            "n": pa.array([int(counts.sum())]), "held": pa.array([held], pa.binary()),
            "again": pa.array([again], pa.binary()),
        }
    )


def before(table, group, key, n, span):
    """``table`` with the column ``before``: the sum of ``n`` over smaller keys of its group.

    ``span`` holds the least and greatest key.  Keys are distinct within their group, so no
    window holds more than ``2**FAN_BITS`` rows.
    """
    order = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    if span[1] - span[0] < 1 << FAN_BITS:
        return table.withColumn("before", F.coalesce(F.sum(n).over(order.partitionBy(*group)), F.lit(0)))
    up, theirs = F.shiftright(key, FAN_BITS), [f"_of_{c}" for c in group]
    above = table.groupBy(*group, up.alias(f"_{key}")).agg(F.sum(n).alias(f"_{n}"))
    above = before(above, group, f"_{key}", f"_{n}", [x >> FAN_BITS for x in span])
    above = above.select(
        *[F.col(c).alias(t) for c, t in zip(group, theirs)], F.col(f"_{key}").alias("_above"),
        F.col("before").alias("_before"),
    )
    here = F.coalesce(F.sum(n).over(order.partitionBy(*group, up)), F.lit(0))
    same = up == F.col("_above")
    for c, t in zip(group, theirs):
        same = same & (F.col(c) == F.col(t))
    joined = table.withColumn("before", here).join(above, same)
    return joined.withColumn("before", F.col("before") + F.col("_before")).drop("_above", "_before", *theirs)


def bitmaps(rows):
    """The merged containers with ``before`` and ``total``, the leaves of their source."""
    parts = rows.select("g", "chunk", "low").mapInArrow(_partial, _CONTAINER)
    merged = stored(parts.groupBy("g", "chunk").applyInArrow(_merged, _CONTAINER), "manifest-bitmaps")
    span = merged.agg(F.min("chunk"), F.max("chunk")).first()
    if span[0] is None:
        span = (0, 0)
    totals = merged.groupBy("g").agg(F.sum("n").alias("total")).withColumnRenamed("g", "_g")
    placed = before(merged, ["g"], "chunk", "n", list(span))
    placed = placed.join(totals, F.col("g") == F.col("_g")).drop("_g")
    return stored(placed, "manifest-directory")


# --- places of the leaves -------------------------------------------------------------

_PLACED = "doc_id long, g string, place long, total long, leaf binary, changed binary"


def _ranked(rows, containers):
    """The places of a chunk's leaves."""
    if not rows.num_rows:
        return pa.table({f: pa.array([], t) for f, t in _arrow_kinds()})
    one = containers.slice(0, 1).to_pylist()[0]
    found = rank(*unpacked(one["held"], one["again"]), rows.column("low").to_numpy().astype(np.int64))
    n = rows.num_rows
    return pa.table(
        [
            rows.column("doc_id"), rows.column("g"), pa.array(found + one["before"]),
            pa.array(np.full(n, one["total"])), rows.column("leaf"), rows.column("changed"),
        ],
        names=["doc_id", "g", "place", "total", "leaf", "changed"],
    )


def _arrow_kinds():
    return [
        ("doc_id", pa.int64()), ("g", pa.string()), ("place", pa.int64()), ("total", pa.int64()),
        ("leaf", pa.binary()), ("changed", pa.binary()),
    ]


def _repeated(batches):
    """(g, chunk, low, first place, total) of the ids that repeat."""
    for batch in batches:
        for row in batch.to_pylist():
            bits, again = unpacked(row["held"], row["again"])
            lows = again["low"].astype(np.int64)
            n = len(lows)
            yield pa.record_batch(
                [
                    pa.array([row["g"]] * n, pa.string()), pa.array([row["chunk"]] * n, pa.int64()),
                    pa.array(lows.astype(np.int32)), pa.array(rank(bits, again, lows) + row["before"]),
                    pa.array([row["total"]] * n, pa.int64()),
                ],
                names=["_g", "_chunk", "_low", "first", "total"],
            )


def leaves(docs):
    """Every row with its leaf's place in its source: (doc_id, g, place, total, leaf, changed)."""
    rows = _rows(docs)
    maps = bitmaps(rows)
    repeats = maps.where(F.octet_length("again") > 0)
    single, many = rows, None
    if not repeats.isEmpty():
        ids = repeats.select("g", "chunk", "held", "again", "before", "total").mapInArrow(
            _repeated, "_g string, _chunk long, _low int, first long, total long"
        )
        ids = stored(ids, "manifest-repeats")
        same = (F.col("g") == F.col("_g")) & (F.col("chunk") == F.col("_chunk")) & (F.col("low") == F.col("_low"))
        single = rows.join(ids, same, "left_anti")
        many = _tied(rows.join(ids, same))
    keyed = single.groupBy("g", "chunk").cogroup(maps.groupBy("g", "chunk"))
    placed = keyed.applyInArrow(_ranked, _PLACED)
    if many is not None:
        placed = placed.unionByName(many)
    return stored(placed, "manifest-leaves")


def _tied(rows):
    """Places of rows that share an id: by leaf, equal rows counted and spread out again."""
    rows = rows.groupBy("doc_id", "g", "first", "total", "leaf", "changed").agg(F.count(F.lit(1)).alias("n"))
    # the leaves' first 20 bits: uniform, so a value stands for a millionth of the rows
    start = F.conv(F.hex(F.substring("leaf", 1, 4)), 16, 10).cast("long")
    rows = stored(rows.withColumn("start", F.shiftright(start, 12)), "manifest-tied")
    group = ["g", "first"]
    starts = rows.groupBy(*group, "start").agg(F.sum("n").alias("n_start"))
    starts = before(starts, group, "start", "n_start", [0, (1 << 20) - 1])
    starts = starts.select(*[F.col(c).alias(f"_{c}") for c in [*group, "start"]], "before")
    order = Window.partitionBy(*group, "start").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("n").over(order), F.lit(0)))
    same = (F.col("g") == F.col("_g")) & (F.col("first") == F.col("_first")) & (F.col("start") == F.col("_start"))
    rows = rows.join(starts, same).withColumn("place", F.col("first") + F.col("before") + F.col("within"))
    # two steps, so that no row holds a long list
    step = 1 << 12
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {step}"))))
    size = F.least(F.lit(step), F.col("n") - F.col("_block") * step)
    rows = rows.withColumn("_in", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    place = F.col("place") + F.col("_block") * step + F.col("_in")
    return rows.select("doc_id", "g", place.alias("place"), "total", "leaf", "changed")


# --- levels ------------------------------------------------------------------------


def _heights(total):
    """(levels of this step, nodes that are left) of a tree of ``total`` nodes."""
    levels = 0
    while total > 1 and levels < LEVELS:
        total, levels = -(-total // ARITY), levels + 1
    return levels, total


def _digest(parts):
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def _slots(place, digest):
    """The nodes of a step's group as an array by place, and the levels above them."""
    width = ARITY**LEVELS
    slots = [None] * len(place)
    for p, d in zip(place, digest):
        slots[p % width] = d
    return slots


def _levels(slots, levels):
    rows = [slots]
    for _ in range(levels):
        slots = [_digest(slots[i : i + ARITY]) for i in range(0, len(slots), ARITY)]
        rows.append(slots)
    return rows


_NODE = "g string, place long, total long, digest binary"


def _block():
    return F.expr(f"place div {ARITY**LEVELS}").alias("block")



def _reduced(key, table):
    levels, left = _heights(table.column("total")[0].as_py())
    rows = _levels(_slots(table.column("place").to_pylist(), table.column("digest").to_pylist()), levels)
    return pa.table(
        {
            "g": pa.array([key[0].as_py()], pa.string()), "place": pa.array([key[1].as_py()], pa.int64()),
            "total": pa.array([left], pa.int64()), "digest": pa.array(rows[-1], pa.binary()),
        }
    )


def _steps(nodes, largest, name):
    """The nodes (g, place, total, digest) of all steps; a tree is done when its total is 1."""
    found = [nodes]
    while largest > 1:
        more = found[-1].where("total > 1").groupBy("g", _block())
        found.append(stored(more.applyInArrow(_reduced, _NODE), f"manifest-{name}"))
        largest = _heights(largest)[1]
    return found


def _own_paths(place, digest, total):
    """Per slot its siblings level by level, as bytes: its place in the run, theirs after it."""
    levels = _heights(total)[0]
    rows = _levels(_slots(place, digest), levels)
    paths = [b""]
    for row in reversed(rows[:-1]):
        paths = [_step(row, i) + paths[i // ARITY] for i in range(len(row))]
    return paths


def _step(row, i):
    first = i - i % ARITY
    run = row[first : first + ARITY]
    return bytes([i - first, len(run)]) + b"".join(run[: i - first] + run[i - first + 1 :])


def parsed(path):
    """The (place in the run, siblings) of a path, from the leaf up."""
    at, found = 0, []
    while at < len(path):
        place, size = path[at], path[at + 1]
        at += 2
        found.append((place, [path[at + 32 * k : at + 32 * k + 32] for k in range(size - 1)]))
        at += 32 * (size - 1)
    return found


def folded(digest, path):
    """The root that a leaf and its siblings lead to."""
    for place, siblings in path:
        digest = _digest([*siblings[:place], digest, *siblings[place:]])
    return digest


def proof_digest(path):
    """The hex digest of all siblings, level by level and left to right."""
    return _digest([s for _, siblings in path for s in siblings]).hex()


_PATH = "g string, place long, path binary, subroot binary, root binary"


def _down(nodes, above):
    """The paths of a group's nodes: their own levels, then those above the group."""
    if not nodes.num_rows:
        return pa.table({f: pa.array([], t) for f, t in zip(_PATH_NAMES, _PATH_KINDS)})
    up = above.slice(0, 1).to_pylist()[0]
    place = nodes.column("place").to_pylist()
    total = nodes.column("total")[0].as_py()
    own = _own_paths(place, nodes.column("digest").to_pylist(), total)
    width = ARITY**LEVELS
    n = len(place)
    return pa.table(
        [
            nodes.column("g"), nodes.column("place"),
            pa.array([own[p % width] + up["path"] for p in place], pa.binary()),
            pa.array([up["subroot"]] * n, pa.binary()), pa.array([up["root"]] * n, pa.binary()),
        ],
        names=_PATH_NAMES,
    )


_PATH_NAMES = ["g", "place", "path", "subroot", "root"]
_PATH_KINDS = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _paths(steps, tops, name):
    """The paths of the first step's parents: from the roots' (with their ``step``) down."""
    above = None
    for step in range(len(steps) - 1, 0, -1):
        here = tops.where(F.col("step") == step).select(*_PATH_NAMES)
        if above is not None:
            here = here.unionByName(above)
        if step == 1:
            return here
        above = stored(_cogrouped(steps[step - 1].where("total > 1"), here, _down, _PATH), f"manifest-{name}")
    return None


def _cogrouped(nodes, above, function, kinds):
    """The nodes of each group with the path of their parent."""
    left = nodes.groupBy("g", _block())
    return left.cogroup(above.groupBy("g", F.col("place").alias("block"))).applyInArrow(function, kinds)


_CHECKED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _checked(nodes, above):
    rows = []
    if nodes.num_rows:
        up = above.slice(0, 1).to_pylist()[0]
        upper = parsed(up["path"])
        place, digest = nodes.column("place").to_pylist(), nodes.column("leaf").to_pylist()
        own = _own_paths(place, digest, nodes.column("total")[0].as_py())
        width = ARITY**LEVELS
        for p, d, new in zip(place, digest, nodes.column("changed").to_pylist()):
            path = parsed(own[p % width]) + upper
            root = folded(d if new is None else new, path)
            rows.append((d.hex(), proof_digest(path), root.hex(), root == up["root"]))
        subroot, root = up["subroot"].hex(), up["root"].hex()
    else:
        subroot = root = None
    n = len(rows)
    return pa.table(
        [
            nodes.column("doc_id").cast(pa.int64()), pa.array([r[0] for r in rows], pa.string()),
            pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
            pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()),
            pa.array([r[3] for r in rows], pa.bool_()),
        ],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


def _numbered(subroots):
    """(g, source, place, total, digest) of the tree over the sources, in their order."""
    ordered = subroots.orderBy("g").withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered, "manifest-sources")
    # one row a task of the sort
    parts = ordered.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("total"),
    )
    joined = ordered.join(parts, F.shiftright("_id", 33) == F.col("_part"))
    place = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return joined.select(F.lit("").alias("g"), F.col("g").alias("source"), place.alias("place"), "total", "digest", "step")


def manifest(docs):
    """One row a document: its leaf, subroot, root, proof, and the check of the tampered rows.

    The columns are doc_id, leaf, subroot, root, proof_sha256, folded_root and verified;
    ``folded_root`` is recomputed from the tampered leaf where a row is tampered with.
    """
    placed = leaves(docs)
    largest = placed.agg(F.max("total")).first()[0] or 0
    nodes = placed.select("g", "place", "total", F.col("leaf").alias("digest"))
    steps = _steps(nodes, largest, "nodes")
    subroots = None
    for i, found in enumerate(steps):
        done = found.where("total = 1").select("g", "digest", F.lit(i).alias("step"))
        subroots = done if subroots is None else subroots.unionByName(done)
    sources = stored(_numbered(subroots), "manifest-top")
    n = sources.agg(F.max("total")).first()[0] or 0
    top = _steps(sources.select("g", "place", "total", "digest"), n, "top-nodes")
    none = F.lit(b"")
    root = top[-1].select(
        "g", "place", none.alias("path"), none.alias("subroot"), F.col("digest").alias("root"),
        F.lit(len(top) - 1).alias("step"),
    )
    if len(top) > 1:
        above = _paths(top, root, "top-paths")
        top_paths = _cogrouped(top[0], above, _down, _PATH)
    else:
        top_paths = root.select(*_PATH_NAMES)
    at = top_paths.select(F.col("place").alias("_place"), "path", "root")
    tops = sources.join(at, F.col("place") == F.col("_place")).select(
        F.col("source").alias("g"), F.lit(0).cast("long").alias("place"), "path",
        F.col("digest").alias("subroot"), "root", "step",
    )
    tops = stored(tops, "manifest-roots")
    above = tops.where("step = 0").select(*_PATH_NAMES)
    if len(steps) > 1:
        above = above.unionByName(_paths(steps, tops, "paths"))
    return _cogrouped(placed, above, _checked, _CHECKED)


def op12_manifest(spark, sf_dir):
    """The contract's rows over all documents."""
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
