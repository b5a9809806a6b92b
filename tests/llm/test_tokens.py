"""Separator scan, packing, token files and chunk reuse against the tokenizers library."""

import hashlib
import os
import tracemalloc
import zlib

import numpy as np
import pytest

from doorstep.llm import chunks, packing, rangecoder, separators, tokenfiles, vocab
from doorstep.llm.vocab import PieceEncoder, tokenizer_path

from .conftest import ODD, SF

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# --- 1: separators -----------------------------------------------------------------


def test_scan_equals_direct_counts(spark, sf, odd, nothing):
    encode = PieceEncoder(WORD, plain_special=True)
    want = sorted(((i, len(encode.raw(t or ""))) for i, t in texts_of(odd)), key=repr)
    got = separators.op1_separators(spark, sf("odd"))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert separators.op1_separators(spark, sf("empty")).count() == 0


def test_scan_stitches_over_blocks_and_runs(spark, tmp_path, odd):
    files = {
        "a.ids": [5, 9, 9, 1, 2, 3, 4, 5, 6, 7, 8, 9, 1],  # empty document, open end
        "b.ids": [9],
        "c.ids": list(range(10, 60)) + [9] + [3] * 20 + [9],
        "d.ids": [],
        "e.ids": [4, 4],
    }
    want = set()
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        start = n = 0
        for i, x in enumerate(ids):
            if x == 9:
                want.add((name, n, start, i - start, True))
                n, start = n + 1, i + 1
        if start < len(ids):
            want.add((name, n, start, len(ids) - start, False))
    for block, run in ((1, 2), (3, 2), (7, 1), (1000, 1000)):
        got = separators.scan(spark, str(tmp_path), 9, block_tokens=block, run_blocks=run)
        assert set(map(tuple, got.collect())) == want
    (tmp_path / "f.ids").write_bytes(b"abc")
    with pytest.raises(ValueError):
        separators.scan(spark, str(tmp_path), 9)


# --- 4: packing --------------------------------------------------------------------


def test_first_fit_decreasing_equals_plain_search():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 257):
        lengths = rng.integers(0, 101, n)
        sequence, offset = packing.first_fit_decreasing(lengths, 100)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
            if k == len(room):
                room.append(100)
            want[int(i)] = (k, 100 - room[k])
            room[k] -= lengths[i]
        assert {i: (int(s), int(o)) for i, (s, o) in enumerate(zip(sequence, offset))} == want
    with pytest.raises(ValueError):
        packing.first_fit_decreasing([101], 100)


def test_packing_holds_every_id_once(spark, sf, odd, nothing):
    encode = PieceEncoder(WORD)
    rows = packing.op4_packing(spark, sf("odd")).collect()
    pieces = sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows), key=repr)
    want = []
    for i, t in texts_of(odd):
        ids = encode.raw(t or "") + [1]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want.append((i, at, len(part), crc(part), len(ids)))
    assert pieces == sorted(want, key=repr)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.op4_packing(spark, sf("empty")).count() == 0


def test_sequences_join_the_ids(spark, odd):
    encode = PieceEncoder(WORD)
    pieces = packing.stored(packing.token_pieces(odd, WORD, with_ids=True), "test-pieces")
    packed = packing.stored(packing.pack(pieces), "test-packed")
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, whole.values())) == sum(len(encode.raw(t or "")) + 1 for _, t in texts_of(odd))


# --- 8: range-coded token files ----------------------------------------------------


def test_coder_round_trip():
    rng = np.random.default_rng(0)
    blocks = [
        [], [5], [0] * 4096, np.arange(4096), rng.integers(0, 2**32, 4096), rng.integers(0, 3, 777),
        np.tile([1, 2, 3, 70000], 999), rng.zipf(1.3, 4095) % 50257, rng.integers(0, 9, 64), [2**32 - 1] * 65,
    ]
    codes = rangecoder.encode_blocks(blocks)
    for block, ids in zip(blocks, rangecoder.decode_blocks(codes, [len(b) for b in blocks])):
        assert ids.tolist() == list(block)
    # blocks are reset: one alone has the same ids, and repetition shrinks
    assert rangecoder.decode_blocks([codes[7]], [4095])[0].tolist() == list(blocks[7])
    assert len(codes[2]) < 100 and len(codes[6]) < 1000


def test_coder_carries():
    rng = np.random.default_rng(3)
    for seed in range(20):
        blocks = [rng.integers(0, 1 + rng.integers(1, 300), rng.integers(0, 4097)) for _ in range(20)]
        found = rangecoder.decode_blocks(rangecoder.encode_blocks(blocks), [len(b) for b in blocks])
        assert all(np.array_equal(a, b) for a, b in zip(blocks, found)), seed


def test_coder_works_in_little_memory():
    rng = np.random.default_rng(4)
    blocks = list((rng.zipf(1.3, (512, 4096)) % 50257).astype(np.uint32))
    tracemalloc.start()
    codes = rangecoder.encode_blocks(blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28 * 512 * 4096
    found = rangecoder.decode_blocks(codes, [4096] * 512)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, found))
    assert rangecoder.encode_blocks([]) == []


def test_pieces_are_remembered_in_little_memory(monkeypatch):
    import pyarrow as pa

    from doorstep.llm.text import buffers

    monkeypatch.setattr(vocab, "CACHE_PIECES", 300)
    encode, rng = PieceEncoder(BYTE), np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeéß"), 8)) for _ in range(1000)] + ["x" * 400]
    for n in (100, 300, 0, 1001, 250, 250):  # within the bound, beyond it, none, far beyond it
        column = pa.array([" ".join(rng.permutation(words)[:n])])
        ids, bounds = encode.encode_column(column, *buffers(column))
        assert ids.tolist() == encode.raw(column[0].as_py())
        assert len(encode.pieces) == len(encode.lengths) <= 300
        assert len(encode.pool) == encode.lengths.sum()
        assert not any(len(p) > vocab.CACHE_BYTES for p in encode.pieces.to_pylist())
    assert encode.pieces.nbytes + encode.lengths.nbytes + encode.pool.nbytes < 60 * 300


def test_token_files_hold_the_corpus(spark, sf, odd, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_CHARS", 20_000)
    encode = PieceEncoder(BYTE)
    rows = tokenfiles.op8_tokens(spark, sf("odd")).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(
        ((i, len(encode.raw(t or "")) + 1, crc(encode.raw(t or "") + [0])) for i, t in texts_of(odd)), key=repr
    )
    ordered = sorted(rows, key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    assert tokenfiles.op8_tokens(spark, sf("empty")).count() == 0


def test_damage_is_found(spark, odd, tmp_path):
    tokenfiles.write(odd.where("doc_id = 15"), str(tmp_path), BYTE)
    (file,) = [f for f in tmp_path.iterdir() if f.suffix == ".tokens"]
    raw = bytearray(file.read_bytes())

    def read(raw):
        file.write_bytes(raw)
        with tokenfiles.opened(str(file))[0].open_input_file(str(file)) as f:
            return [ids for _, ids, _ in tokenfiles.TokenReader(f).documents()]

    assert read(raw)
    for damaged in (raw[:-3], raw[:40] + bytes([raw[40] ^ 8]) + raw[41:], b"", raw[: len(raw) // 2]):
        with pytest.raises(ValueError):
            read(bytes(damaged))


# --- 9: chunk reuse ----------------------------------------------------------------


def test_chunks_encode_as_the_library_does(spark, sf, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD)
    plain.no_truncation()
    plain.no_padding()

    def want(text):
        ids = plain.encode(text or "", add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(" ".join(map(str, ids))), sha(decoded)

    long = " ".join(t for t in ODD if t)
    more = spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate([long, long[1:], "x" + long, long + "!", long[7:-9], long * 2])],
        "doc_id long, text string",
    )
    docs = odd.select("doc_id", "text").unionAll(more)
    got = sorted((tuple(r) for r in chunks.encode_and_decode(docs).collect()), key=repr)
    assert got == sorted(((i, *want(t)) for i, t in texts_of(docs)), key=repr)
    assert chunks.op9_chunks(spark, sf("empty")).count() == 0


def test_chunks_follow_content():
    import pyarrow as pa

    from doorstep.llm.text import buffers

    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abcdefgh é\n"), 40_000))
    texts = [passage, "head " + passage, passage[100:]]
    data, offsets = buffers(pa.array(texts))
    starts, edges = chunks.chunk_bounds(data, offsets)
    ends = np.r_[starts[1:], len(data)]
    raw = data.tobytes()
    sets = [{raw[starts[k] : ends[k]] for k in range(edges[i], edges[i + 1])} for i in range(3)]
    assert len(sets[0] & sets[1]) > 0.8 * len(sets[0])
    assert len(sets[0] & sets[2]) > 0.8 * len(sets[0])
    for i, t in enumerate(texts):
        assert b"".join(raw[starts[k] : ends[k]] for k in range(edges[i], edges[i + 1])).decode() == t


def test_shared_texts_are_encoded_once(spark, odd):
    kinds = chunks.encode_texts(odd.select("doc_id", "text"), WORD)
    assert kinds.count() == kinds.select("key").distinct().count()


assert os.path.isdir(SF)
