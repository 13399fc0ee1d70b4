import numpy as np
import pytest
from cases import clashing, collected, documents, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnlake.llm import suffix_array as sa
from cairnlake.llm import suffix_dedup as op


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: float("inf") if i is None else i
    least = {}
    for i, b in texts:
        for j in range(len(b) - length + 1):
            s = b[j : j + length]
            least[s] = min(least.get(s, order(i)), order(i))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if least[b[j : j + length]] < order(i):
                gone[j : j + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def found(df):
    rows = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.collect()]
    return sorted(rows, key=repr)


def test_equals_brute_force(spark):
    rows = documents()
    assert found(op.drop_earlier_strings(frame(spark, rows))) == brute(rows, 50)


@pytest.mark.parametrize("hot", [0, 2])
def test_split_anchors_and_many_shards(spark, monkeypatch, hot):
    monkeypatch.setattr(op.P.part_count, "__defaults__", (4000,))
    monkeypatch.setattr(op, "SHARD_BYTES", 3000)
    rows = documents()
    got = op.drop_earlier_strings(clashing(frame(spark, rows)), length=30, hot=hot)
    assert found(got) == brute(rows, 30)


def test_empty_table(spark):
    assert found(op.drop_earlier_strings(frame(spark, [], 1))) == []
    assert collected(op.drop_earlier_strings(frame(spark, [(1, None)], 1))) == [(1, 0, 0, 0, b"")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), max_size=120), st.sampled_from([1, 10_000]))
def test_suffix_array_is_the_sorted_order(symbols, calls):
    t = np.array([*symbols, 0], np.int32)
    before, sa.SYMBOLS_PER_CALL = sa.SYMBOLS_PER_CALL, calls  # bucket by bucket, or entry by entry
    try:
        got = sa.suffix_array(t).tolist()
    finally:
        sa.SYMBOLS_PER_CALL = before
    text = t.tolist()
    assert got == sorted(range(len(text)), key=lambda i: text[i:])
    shared = sa.permuted_prefixes(t, np.array(got), 10)
    for a, b in zip(got, got[1:]):
        same = 0
        while same < 10 and max(a, b) + same < len(text) and text[a + same] == text[b + same]:
            same += 1
        assert shared[b] == same


@pytest.mark.parametrize("units", [1, 5])
def test_larger_parts_and_shards(spark, monkeypatch, units):
    monkeypatch.setattr(op.P.part_count, "__defaults__", (4000,))
    monkeypatch.setattr(op, "SHARD_BYTES", 3000)
    monkeypatch.setattr(op, "UNITS", units)
    rows = documents()
    assert found(op.drop_earlier_strings(frame(spark, rows), length=55, hot=3)) == brute(rows, 55)


def test_messages_do_not_grow_with_the_square():
    for size in (1 << 30, 10 << 30, 50 << 30):
        parts, shards = op._units(-(-size // op.P.PART_BYTES), 4), op._units(-(-size // op.SHARD_BYTES), 8)
        assert parts * shards < 250_000 * (size >> 30)  # one of each 4 and 2 MB: 1,300,000 a GB at 10 GB
        assert parts >= 128 and size / parts <= 16 << 20 and size / shards <= 16 << 20
    assert [op._units(n, 4) for n in (0, 1, 100, 200, 600)] == [1, 1, 100, 128, 150]


@pytest.mark.parametrize("most", [1, 400, 1 << 20])
def test_marks_do_not_depend_on_how_much_is_sorted_at_once(monkeypatch, most):
    monkeypatch.setattr(op, "SORTED_BYTES", most)
    rng = np.random.default_rng(5)
    anchors = [rng.integers(97, 123, 24).astype(np.uint8).tobytes() for _ in range(9)]
    tails = [rng.integers(97, 99, 12).astype(np.uint8).tobytes() for _ in range(4)]
    fragments = []
    for doc in range(120):
        a = int(rng.integers(9))
        text = anchors[a] + tails[rng.integers(4)][: rng.integers(6, 12)]
        fragments.append((a, doc % 50, tails[rng.integers(4)][: rng.integers(0, 7)] + text))
    least = {}
    for a, doc, text in fragments:
        for j in range(len(text) - 30 + 1):
            least[text[j : j + 30]] = min(doc, least.get(text[j : j + 30], doc))
    want = [
        sum((least[text[j : j + 30]] < doc) << j for j in range(len(text) - 30 + 1)) for _, doc, text in fragments
    ]
    size = np.array([len(x) for *_, x in fragments])
    data = np.frombuffer(b"".join(x for *_, x in fragments) + bytes(op.PAD), np.uint8)
    route, doc = np.array([x[0] for x in fragments], np.uint64), np.array([x[1] for x in fragments])
    got = op._matched(size, doc, data, route, 30)
    assert [int(m) & (1 << n - 29) - 1 for m, n in zip(got, size)] == want


def test_contents_that_24_bits_do_not_tell_apart():
    route = np.array([7, 7, 7, 7, 3], np.uint64)
    h1 = np.array([1, 2, 1, 2, 9], np.uint64)
    h2 = np.array([5 << 40, 5 << 40, 5 << 40, 5 << 40, 1], np.uint64)
    for turn in (np.arange(5), np.array([1, 3, 0, 4, 2])):
        order, fresh = op._alike(route[turn], h1[turn], h2[turn])
        assert h1[turn][order].tolist() == [9, 1, 1, 2, 2]
        assert fresh.tolist() == [True, True, False, True, False]


def test_anchors_count_once_a_row():
    f, row = np.array([5, 3, 5, 5, 3], np.uint64), np.array([1, 0, 1, 0, 0])
    for rows in (2, 1 << 25):
        assert op._one_a_row(f, row, rows).tolist() == [3, 5, 5]


def test_values_are_found_where_upper_bits_repeat():
    known = np.array([0, 1, 2, 3, (1 << 40) - 2], np.uint64)
    place, there = op._places(known)(np.array([3, 4, 0, (1 << 40) - 1, (1 << 40) - 2], np.uint64))
    assert there.tolist() == [True, False, True, False, True]
    assert place[there].tolist() == [3, 0, 4]


def test_long_runs_over_many_symbols_are_sorted():
    t = np.r_[np.repeat(np.arange(1, 400), 50), 0].astype(np.int32)  # too few of each for bucket-wise steps
    text = t.tolist()
    assert sa.suffix_array(t).tolist() == sorted(range(len(text)), key=lambda i: text[i : i + 120])
