import random

import numpy as np
import pytest
from cases import clashing, documents, frame
from test_token_counts import texts

from cairnlake.llm import packing as op
from cairnlake.llm.prefix_sums import sums_before

vocabularies = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return vocabularies.path("word_bpe_49k.json")


def odd():
    rng = random.Random(2)
    alphabet = "aB ćÅ \x01 \x1c　  Σ'S9½\n\t<|endoftext|>"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return made + ["\x01", " \x01 ", "a \x01 b\x01", "<|startoftext|>x <|endoftext|>", "e ́", "ΑΣ Σ", "İI ıŉŊſ ÀÖØöøįĲſ×÷ Ç'S Ç", "K Å ẞ ÉÈ'VE"]


@pytest.mark.parametrize("stretch", [1 << 20, 7])
def test_pieces_hold_the_librarys_ids(spark, monkeypatch, path, stretch):
    monkeypatch.setattr(op, "STRETCH", stretch)
    monkeypatch.setattr(op, "REMEMBERED", 700)
    library = tokenizers.Tokenizer.from_file(path)
    rows = documents() + list(enumerate(texts() + odd(), 1000))
    pieces = op.packed_pieces(clashing(frame(spark, rows)), path, window=64)
    got = pieces.collect()
    true = {}
    for i, t in rows:
        true.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [op.END_ID])
    held, place = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        held.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, lists in true.items():
        for n in {len(ids) for ids in lists}:
            # rows of one key and number of ids can't be told apart: their pieces must hold the same ids
            same = sorted(tuple(x) for x in lists if len(x) == n)
            found = [x for _, piece in sorted(held.pop((i, n))) for x in piece]
            assert sorted(found) == sorted(x for ids in same for x in ids)
            if len(same) == 1:
                assert tuple(found) == same[0]
    assert not held
    assert sorted(place) == list(range(len(place)))
    for number, parts in place.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or number == len(place) - 1


def test_sequences_and_boundary_records(spark, path):
    rows = documents()
    pieces = op.packed_pieces(frame(spark, rows), path, window=128).cache()
    found = op.sequences(pieces, window=128, pad_id=7).collect()
    total = sum(r.length for r in pieces.collect())
    assert len(found) == -(-total // 128)
    again = {}
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 128 and (ids[r.n_tokens :] == 7).all()
        assert sum(b.length for b in r.boundaries) == r.n_tokens
        for b in r.boundaries:
            again.setdefault((b.doc_id, b.doc_tokens), {})[b.start] = ids[b.offset : b.offset + b.length].tolist()
    library = tokenizers.Tokenizer.from_file(path)
    for i, t in rows:
        if i in (80, None):
            continue
        ids = library.encode(t or "", add_special_tokens=False).ids + [op.END_ID]
        assert [x for _, piece in sorted(again[i, len(ids)].items()) for x in piece] == ids


def test_empty_table_and_other_vocabularies(spark, path):
    assert op.packed_pieces(frame(spark, [], 1), path).collect() == []
    one = op.packed_pieces(frame(spark, [(4, None)], 1), path).collect()
    assert [(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in one] == [(4, 0, 1, 0, 0)]
    with pytest.raises(ValueError):
        op.packed_pieces(frame(spark, [], 1), vocabularies.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("block", [1024, 3])
def test_sums_before(spark, block):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 0, 1, 5, 1 << 40])) for i in rng.sample(range(200), 70)]
    got = {r.i: r.before for r in sums_before(spark.createDataFrame(rows, "i long, v long"), "i", "v", block).collect()}
    assert got == {i: sum(w or 0 for j, w in rows if j < i) for i, _ in rows}
    assert sums_before(spark.createDataFrame([], "i long, v long"), "i", "v").collect() == []
