import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import clashing, documents, frame, prose
from test_token_counts import texts

from cairnlake.llm import alignment as op

vocabularies = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def paths():
    return tuple(map(vocabularies.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def odd():
    rng = random.Random(4)
    alphabet = "ab cé  \n\t\x1c　漢字😀́١½2'st<|endoftext|><s>\x00_"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 70))) for _ in range(200)]
    return made + [" ", "  a", "a ", "\n", "▁", "one ▁ two", "🀀" * 40, "日本語テキスト" * 9, "ß" * 90 + " x", "<|endoftext|> <s>"]


def brute(rows, paths):
    a_lib, b_lib = tokenizers.Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_lib.encode_special_tokens = True
    a_bytes, b_bytes = op.byte_level(a_lib), op.pieces(b_lib)
    held = []
    for key, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        whole = (" " + (text or "")).encode()
        groups = []
        if text and b"".join(a_bytes[i] for i in a) == whole == b"".join(b_bytes[i] for i in b):
            i = j = x = y = 0
            group = ([], [])
            while i < len(a) or j < len(b):
                if x <= y and i < len(a) and not (x == y and group[0]):
                    group[0].append(a[i])
                    x += len(a_bytes[a[i]])
                    i += 1
                else:
                    group[1].append(b[j])
                    y += len(b_bytes[b[j]])
                    j += 1
                if x == y and group[0] and group[1]:
                    groups.append(group)
                    group = ([], [])
        held.append((key, groups))
    count = Counter()
    for _, groups in held:
        count.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for key, groups in held:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), shown,
        ))
    return out, count, best


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, paths, small):
    if small:
        for name, value in {"PART": 900, "BLOCK": 60, "REMEMBERED": 40, "LINKS": 50, "LUMP": 3}.items():
            monkeypatch.setattr(op, name, value)
    rows = [r for r in documents() if not small or len(r[1] or "") < 2000] + list(enumerate(texts()[:150] + odd(), 1000))
    rows = [(i, t and t[:3000]) for i, t in rows]
    found, pairs = op.align_tokenizers(clashing(frame(spark, rows)), *paths)
    true, count, best = brute(rows, paths)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(true, key=repr)
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.collect()} == {x: (n, n == best[x[0]]) for x, n in count.items()}


def test_digest_and_empty_table(spark, paths):
    rows = [(1, "some words, and ümläute"), (2, None), (3, ""), (4, "▁")]
    (whole, _), (hashed, _) = (op.align_tokenizers(frame(spark, rows), *paths, digest=d) for d in (False, True))
    shown = {r.doc_id: r.groups for r in whole.collect()}
    assert {r.doc_id: r.groups for r in hashed.collect()} == {
        i: s and hashlib.sha256(s.encode()).hexdigest() for i, s in shown.items()
    }
    assert shown[1] and not shown[2] and not shown[3] and not shown[4]
    documents, pairs = op.align_tokenizers(frame(spark, [], 1), *paths)
    assert documents.collect() == [] and pairs.collect() == []


def test_common_ends_of_uneven_intervals():
    rng = np.random.default_rng(1)
    for trial in range(300):
        a_first, b_first, a, b, true = [0], [0], [], [], []
        base = 0
        for _ in range(rng.integers(1, 6)):
            size = int(rng.integers(1, 400))
            dense, sparse = rng.random(2) ** 3
            x = np.flatnonzero(rng.random(size) < dense) + 1
            y = np.flatnonzero(rng.random(size) < sparse) + 1
            x, y = (np.union1d(z, [size]) + base for z in (x, y))
            a, b = np.r_[a, x], np.r_[b, y]
            base += size
            a_first.append(len(a))
            b_first.append(len(b))
        a, b = a.astype(np.int64), b.astype(np.int64)
        both = np.intersect1d(a, b)
        got = op.common_ends(a, b, np.array(a_first), np.array(b_first))
        assert (got[0] == np.searchsorted(a, both) + 1).all() and (got[1] == np.searchsorted(b, both) + 1).all()


def test_long_text_without_a_common_end_inside(spark, paths):
    """Tens of thousands of tokens in one group are counted without making all their pairs."""
    a = b = np.zeros(30_000, np.int64)
    key, times = op.links(a, b, np.array([30_000]), np.array([30_000]), np.array([0]), 5, 5)
    assert key.tolist() == [0] and times.tolist() == [900_000_000]


def test_long_prose(spark, paths):
    rows = [(0, prose(3, 40_000)), (1, "x" * 100_000)]
    found, _ = op.align_tokenizers(frame(spark, rows), *paths)
    true, _, _ = brute(rows, paths)
    assert sorted(tuple(r) for r in found.collect()) == sorted(true)


def test_a_word_is_divided_once(paths, monkeypatch):
    """However often a word comes in a task's texts, also where B does not keep a word beside it."""
    divided = []
    known = op.common_ends
    monkeypatch.setattr(op, "common_ends", lambda a, b, *first: divided.append(len(first[0]) - 1) or known(a, b, *first))
    v = op.Vocabularies(open(paths[0], encoding="utf-8").read(), open(paths[1], "rb").read())
    part = op._Part(v, digest=False)
    for i in range(40):
        part.add(i, "the same seven unusual words again and again " * 50 + f"alignment{i % 4}")
        part.settle()
    part.add(40, "the ▁ words")
    part.settle()
    assert sum(divided) == 7 + 4 and part.wrong == {40}
