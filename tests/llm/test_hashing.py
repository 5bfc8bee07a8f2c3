"""Words of byte tables against Python's own splitting."""
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import hashing as H

TEXT = st.text(alphabet="aBé \n\t\x0b\x85\xa0.9ß–", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_and_grams(rows):
    w = H.Words(*H.texts(pa.array(rows, pa.string())), H.byte_table("space"))
    seen = {}
    for i, r in enumerate(rows):
        own = (r or "").encode().lower().split()
        assert [w.data[a:b].tobytes().lower() for a, b in zip(w.start, w.end)][w.first[i]:w.first[i + 1]] == own
        for word, h in zip(own, w.hash[w.first[i]:w.first[i + 1]].tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    grams, inside = w.grams(2)
    expect = sum(max(0, len((r or "").encode().split()) - 1) for r in rows)
    assert int(inside.sum()) == expect


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i}" for i in range(5000))
    column = pa.array([text, "w1 w2", None], pa.string())
    whole = H.Words(*H.texts(column), H.byte_table("space")).hash
    monkeypatch.setattr(H, "PIECE", 64)
    assert np.array_equal(H.Words(*H.texts(column), H.byte_table("space")).hash, whole)
    assert whole[1] == whole[-2] and whole[2] == whole[-1]


def test_slices_cover_batches(monkeypatch):
    monkeypatch.setattr(H, "SLICE", 10)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["a" * 30, None, "b" * 4, "c" * 5])], ["id", "text"])
    parts = list(H.slices(batch, "text"))
    assert [x for p in parts for x in p.column("id").to_pylist()] == [1, 2, 3, 4] and len(parts) > 1
    assert list(H.slices(batch.slice(0, 0), "text")) == []
