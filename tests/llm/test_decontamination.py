import pytest
from cases import WORD, altered, clashing, documents, frame, prose

from cairnlake.llm import decontamination as op

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs, items):
    out = []
    for i, t in docs:
        own = shingles(t)
        for k, b in items:
            s = shingles(b)
            if s and 100 * len(s & own) >= 75 * len(s):
                out.append((i, k, len(s), len(s & own)))
    return sorted(out, key=repr)


def tables(spark):
    docs = documents()
    items = [(k, prose(2, 60)) for k in (1, 2)] + [(3, prose(7, 6000)[100:900]), (4, "ONE two"), (5, "two"), (6, None), (7, " ")]
    items += [(10 + i, altered(prose(1, 120), i, 0.01 * i)) for i in range(8)] + [(None, prose(2, 60)), (30, prose(7, 6000))]
    docs += [(200 + i, prose(400 + i, 300) + " " + altered(prose(1, 120), 60 + i, 0.01 * i)) for i in range(8)]
    df = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, key int")
    return docs, items, clashing(frame(spark, docs)), df


@pytest.mark.parametrize("block", [1 << 24, 3000])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    docs, items, d, b = tables(spark)
    got = sorted((tuple(r) for r in op.contained_items(d, b).collect()), key=repr)
    assert got == brute(docs, items)
    assert len(got) > 20


def test_empty_tables(spark):
    docs, items, d, b = tables(spark)
    assert op.contained_items(d, b.limit(0)).collect() == []
    assert op.contained_items(d.limit(0), b).collect() == []


def test_an_item_at_the_threshold_is_hardly_missed():
    needed = op.hits_needed(32, 0.75, 1e-6)
    assert 8 <= needed < 24
