import random
from binascii import crc32
from hashlib import sha256

import pytest
from cases import clashing, collected
from pyspark.sql import functions as F

from cairnlake.llm import manifest as op

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root of the nodes, and each one's siblings with its place among them, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for i, path in enumerate(paths):
            run, k = runs[at[i] // 3], at[i] % 3
            path.append((run[:k], run[k + 1 :]))
            at[i] //= 3
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows_ in groups.values():
        rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for row, path in zip(groups[s], trees[s][1]):
            steps = path + top
            siblings = "".join("".join(a + b) for a, b in steps)
            claim = row
            if row[0] is not None and crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                claim = (*row[:4], row[4].replace("\n", ""))
            node = leaf(claim)
            for a, b in steps:
                node = h(*a, node, *b)
            out.append((row[0], leaf(row), trees[s][0], root, h(siblings), node, node == root))
    return sorted(out, key=repr)


def rows_of(sizes):
    rng = random.Random(6)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            i = rng.randrange(10**12)
            text = rng.choice([None, "", "one line", "two\nlines", "ümläut\n" * 3, "\n", "tab\t'"])
            rows.append((i, source, rng.choice([None, "", "en"]), rng.choice([None, 0, 7]), text))
    rng.shuffle(rows)
    return rows


def found(spark, docs, levels):
    tampered = F.translate("text", "\n", "")
    claimed = op.leaf_of(*(tampered if f == "text" else F.col(f) for f in FIELDS))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = op.manifest(docs, "doc_id", "source", FIELDS, F.when(even, claimed), levels)
    siblings = F.translate(F.array_join("proof", ""), "*", "").cast("binary")
    return collected(got.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256), "folded_root", "verified"))


SIZES = {"a": 1, "b": 90, "é": 27, "Z": 28, None: 10, "": 3, "hot": 300, "ü": 9, "bb": 2} | {f"s{i}": 1 for i in range(14)}


@pytest.mark.parametrize("levels", [1, 6])
def test_equals_brute_force(spark, levels):
    rows = rows_of(SIZES)
    rows += [(None, "a", None, None, None), (5, "b", "en", 1, "x"), (5, "b", "en", 1, "x\ny"), (1 << 62, "hot", "", 0, "q\n")]
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    assert found(spark, docs, levels) == brute(rows)


def test_repeated_rows(spark):
    """A third of all rows are the same row."""
    rows = rows_of({"a": 40, "b": 7}) + [(9, "a", "en", 1, "same\n")] * 25
    assert found(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), 1) == brute(rows)


@pytest.mark.parametrize("sizes", [{}, {"a": 1}, {None: 1, "b": 1}])
def test_few_rows(spark, sizes):
    rows = rows_of(sizes)
    assert found(spark, spark.createDataFrame(rows, SCHEMA), 6) == (brute(rows) if rows else [])


def test_the_query(spark, tmp_path):
    rows = rows_of({"a": 20, "b": 5, None: 1})
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert collected(op.op13_merkle_manifest(spark, str(tmp_path))) == brute(rows)
