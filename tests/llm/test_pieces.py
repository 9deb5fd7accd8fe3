from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest

from salesloom.llm import common, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab the  in.\n\t▁éß漢😀\x00 er ing  <s></s> 12ñ"


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


def texts():
    chance = random.Random(7)
    made = ["".join(chance.choice(ALPHABET) for _ in range(chance.randint(0, 70))) for _ in range(600)]
    return made + ["", " ", "  ", "   x", "▁", "▁▁a b", "x▁y", "<0x41>", "a" * 300 + " " * 300 + "ab" * 200, "the " * 500]


def test_equals_the_library(model):
    for text, (ids, wrong) in zip(texts(), model.encode(texts(), True)):
        want = model.library.encode(text, add_eos=True)
        assert ids.tolist() == want, text
        assert wrong == 0
        assert model.decode(want) == model.library.decode(want), text


def test_decode_of_any_ids(model):
    chance = random.Random(11)
    for _ in range(2000):
        ids = [chance.choice([chance.randrange(300), chance.randrange(32000), 2, 0]) for _ in range(chance.randint(0, 9))]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_heap_and_arrays_agree(model):
    for text in texts():
        for segment in model.segments(text):
            symbols, lengths = model._symbols_of([segment])
            merged, _ = model._arrays(symbols, lengths)
            assert merged.tolist() == model._heap(symbols.tolist())


def test_small_memory_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 50)
    some = texts()[:50]
    for text, (ids, _) in zip(some, pieces.PieceModel(MODEL).encode(some, False)):
        assert ids.tolist() == model.library.encode(text)


def test_table_with_nulls_and_clashing_columns(spark):
    common.prepared(spark)
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (None, None, "y"), (3, "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, piece_ids string")
    found = pieces.with_pieces(frame, MODEL).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in found] == [None, 1, 1, 3]
    assert found[0]["piece_ids"] == [2] and found[0]["piece_text"] == ""
    assert found[1]["piece_text"] == "the cat" and found[1] == found[2]
    assert set(found[0].asDict()) == {"doc_id", "text", "piece_ids", "piece_text", "piece_disagreements"}
    assert pieces.with_pieces(frame.limit(0), MODEL).count() == 0


def test_decoding_a_batch_equals_decoding_each(model, monkeypatch):
    chance = random.Random(13)
    made = [[chance.choice([chance.randrange(300), chance.randrange(32000), 2, 0]) for _ in range(chance.randint(0, 9))] for _ in range(600)]
    valid = [model.library.encode(text, add_eos=True) for text in texts()]
    for lists in (made, made[:1], valid, [*valid, None, []], [None], [], [[2]], [[2, 300]]):
        want = [model.library.decode(ids) if ids else "" for ids in lists]
        assert model.decode_all(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == want
    assert model.decode_all(pa.array([[7, 8], *valid], pa.list_(pa.int32())).slice(1)).to_pylist() == [model.library.decode(i) for i in valid]
    monkeypatch.setattr(pieces.PieceModel, "decode", None)  # encoded texts need no walk over their ids
    model.decode_all(pa.array(valid, pa.list_(pa.int32())))


def test_disagreements_with_the_library_are_counted(monkeypatch):
    other = pieces.PieceModel(MODEL)
    assert [bad for _, bad in other.encode(["the cat", "  x", "▁", " "], True)] == [0, 0, 0, 0]
    library, other = other.library, pieces.PieceModel(MODEL)

    class Wrong:
        def encode(self, segments, num_threads):
            return [[5, *ids] if s == "cat" else [6, *ids[1:]] if s == "dog" else ids for s, ids in zip(segments, library.encode(segments))]

    other.library = Wrong()
    assert [bad for _, bad in other.encode(["the cat saw a cat", "a dog", "  x", "a"], True)] == [2, 1, 0, 0]


def test_a_task_leaves_no_segments_behind():
    (found,) = pieces.encoder(MODEL, True).func(iter([pa.array(["the cat", "the dog"])]))
    model = pieces.piece_model(MODEL)
    assert found.field("ids").to_pylist() == [model.library.encode(t, add_eos=True) for t in ("the cat", "the dog")]
    assert not model.memory
