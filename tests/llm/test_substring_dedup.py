from collections import Counter

import pytest
from cases import WORD, clashing, collected, documents, frame

from cairnlake.llm import substring_dedup as op


def brute(rows, window):
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[j : j + window]) for _, w in split for j in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j : j + window])] > 1:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = documents()
    assert collected(op.drop_repeated_windows(frame(spark, rows))) == brute(rows, 35)


def test_many_parts_and_a_crowded_sketch_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(op.P, "PART_BYTES", 4000)
    monkeypatch.setattr(op.P.part_count, "__defaults__", (4000,))
    monkeypatch.setattr(op, "CELLS_PER_BYTE", 0.02)  # nearly all windows are estimated repeated
    monkeypatch.setattr(op, "SHARD_CELLS", 300)
    rows = documents()
    assert collected(op.drop_repeated_windows(clashing(frame(spark, rows)), window=10)) == brute(rows, 10)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "a b")]])
def test_nothing_to_remove(spark, rows):
    assert collected(op.drop_repeated_windows(frame(spark, rows, 1))) == brute(rows, 35)
