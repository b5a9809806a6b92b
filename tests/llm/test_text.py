import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from doorstep.llm.text import buffers, numbered, whole_rows, word_bounds
from doorstep.llm.vocab import PieceEncoder, tokenizer_path

from .conftest import ODD

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab é　\n\t '.,<|>×12ÀİΩ🙂"))), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offsets = buffers(pa.array(texts, pa.string()))
    starts, ends, edges = word_bounds(data, offsets)
    raw = data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(starts, ends)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert got == sum(want, [])
    assert [int(b - a) for a, b in zip(edges, edges[1:])] == [len(w) for w in want]
    codes, distinct = numbered(data, starts, ends)
    assert [distinct[int(c)].as_py().decode() for c in codes] == got


ENCODERS = {n: PieceEncoder(tokenizer_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def _same(texts):
    column = pa.array(texts, pa.string())
    for encode in ENCODERS.values():
        ids, bounds = encode.encode_column(column.fill_null(""), *buffers(column))
        for t, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == encode.raw(t or "")


def test_odd_texts_encode_as_the_library_does():
    _same(ODD)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_encoding_by_pieces(texts):
    _same(texts)


def test_parts_hold_whole_rows():
    batch = pa.record_batch([pa.array(["aa", "b" * 50, "", "cc", "dd"])], names=["text"])
    parts = [p.column(0).to_pylist() for p in whole_rows([batch], 0, limit=4)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert ["b" * 50] in [p for p in parts if len(p) == 1] or any("b" * 50 in p for p in parts)
