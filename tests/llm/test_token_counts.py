import random

import pytest
from cases import clashing, documents, frame

from cairnlake.llm import token_counts as op

vocabularies = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
ODD = "aaaabc  \t\n\x85\x1c\x1f　é漢字😀́١٢3²½'s're'LL!?#_-ʰª"


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    made = [t + rng.choice(["", "<|endoftext|>", "  ", "'ve", "<|endoftext|><|endoftext|> a"]) for t in made]
    return made + ["", "a" * 5000, " " * 3000, "\n\n\n x", "<|endoftext|>"]


@pytest.fixture(scope="module")
def path():
    return vocabularies.path("byte_bpe_50k.json")


@pytest.mark.parametrize("long", [1 << 20, 20])
def test_equals_the_library(spark, monkeypatch, path, long):
    monkeypatch.setattr(op, "LONG_TEXT", long)
    monkeypatch.setattr(op, "REMEMBERED", 500)
    library = tokenizers.Tokenizer.from_file(path)
    rows = documents() + list(enumerate(texts(), 1000))
    got = sorted((tuple(r) for r in op.count_tokens(clashing(frame(spark, rows)), path, limit=60).collect()), key=repr)
    true = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        true.append((i, len((t or "").encode()), n, n > 60))
    assert got == sorted(true, key=repr)


def test_empty_table(spark, path):
    assert op.count_tokens(frame(spark, [], 1), path).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        op.Merges(vocabularies.path("word_bpe_49k.json"))
