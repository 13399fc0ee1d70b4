import random

import pytest
from cases import WORD, altered, clashing, documents, frame, prose

from cairnlake.llm import jaccard_join as op
from cairnlake.llm.shared import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, percent=75):
    """Rows of equal keys are one node; a null key is alone."""
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        s = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets.append((i, s))
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and None not in (i, j) and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("frequent", [16, 2])
def test_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(op, "FREQUENT", frequent)
    monkeypatch.setattr(op.P.part_count, "__defaults__", (20_000,))
    monkeypatch.setattr(op, "SHARD_BYTES", 10_000)
    rows = documents()
    assert found(op.similar_documents(clashing(frame(spark, rows)))) == brute(rows)


@pytest.mark.parametrize("frequent", [16, 3])
def test_links_that_no_centre_has(spark, monkeypatch, frequent):
    """Chains of small changes: neighbours are alike, the ends are not, and no text is the source of all."""
    monkeypatch.setattr(op, "FREQUENT", frequent)
    rows, n = [], 0
    for chain in range(3):
        text = prose(chain, 90)
        for step in range(12):
            rows.append((n, text))
            n += 1
            text = altered(text, 50 * chain + step, 0.03)
    common = prose(77, 80)
    rows += [(1000 + i, common + " " + prose(900 + i, random.Random(i).randint(5, 60))) for i in range(15)]
    random.Random(1).shuffle(rows)
    assert found(op.similar_documents(frame(spark, rows))) == brute(rows)


def template(rows, words, own):
    """Texts of one template, each with a run of its own words: alike, but for any two below 0.75."""
    base = prose(400, words)
    return [(i, base + " " + prose(5000 + i, own + i % 3)) for i in range(rows)]


@pytest.mark.parametrize("sharing", [False, True])
def test_a_template_of_most_rows_makes_no_pairs(spark, monkeypatch, sharing):
    """Candidates grow with the rows, not with their pairs; also where extra words are shared by a few."""
    made = []
    verified = op._verified
    monkeypatch.setattr(op, "_verified", lambda pairs, *rest: made.append(pairs) or verified(pairs, *rest))
    rows = template(160, 90, 20)
    if sharing:
        rows = [(i, t + " " + prose(9000 + i // 4, 9)) for i, t in rows]
    rows += [(1000 + i, prose(100 + i, 60)) for i in range(40)]
    assert found(op.similar_documents(frame(spark, rows))) == brute(rows)
    assert sum(p.count() for p in made) <= 2 * len(rows)


def test_empty_table(spark):
    assert found(op.similar_documents(frame(spark, [], 1))) == []
    assert found(op.similar_documents(frame(spark, [(3, None), (4, " ")], 1))) == [(3, 0, 3), (4, 0, 4)]


def test_components_of_long_paths(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(60, 55), (55, 60), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {55: 55, 60: 55}


def test_a_centre_leaves_its_posting(spark, monkeypatch):
    """Each text shares a half with each of two others: every posting holds two texts, which the first star settles."""
    rng = random.Random(5)
    blocks = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(40)) for _ in range(12)]
    rows = [(i, f"{blocks[i]} {blocks[i - 1]}") for i in range(12)]
    left = []
    known = op._meeting
    monkeypatch.setattr(op, "_meeting", lambda postings, percent: left.append(postings.count()) or known(postings, percent))
    assert found(op.similar_documents(frame(spark, rows))) == brute(rows)
    assert left == [0]


def test_altered_texts_of_a_template_seldom_meet(spark, monkeypatch):
    """Each text loses other words of the template: most pairs are below 0.75 though each of them shares many signatures."""
    base = prose(400, 150)
    rows = [(i, altered(base, 600 + i, 0.01 + 0.0004 * i)) for i in range(120)]
    met, pairs = [], op._pairs
    monkeypatch.setattr(op, "_pairs", lambda r, a, b: met.append(r.count()) or pairs(r, a, b))
    assert found(op.similar_documents(frame(spark, rows))) == brute(rows)
    assert met[-1] <= len(rows) // 4  # after the stars


def test_an_entry_that_admits_no_size_of_its_posting_leaves(spark, monkeypatch):
    """Texts of about one size, with so many words of their own that only shorter ones could be alike."""
    rows, left = template(60, 90, 20), []
    known = op._meeting
    monkeypatch.setattr(op, "_meeting", lambda postings, percent: left.append(postings.count()) or known(postings, percent))
    assert found(op.similar_documents(frame(spark, rows))) == brute(rows)
    assert left == [0]
