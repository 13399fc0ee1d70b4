from cases import clashing, documents, frame

from cairnlake.llm import line_dedup as op

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < min_docs or i == max(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = documents()
    df = clashing(frame(spark, rows))
    got = op.drop_shared_lines(df)
    assert got.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr) == brute(rows)
    assert got.select("source", "component_id").distinct().count() == 3


def test_every_document_has_the_line(spark):
    rows = [(i, f"a line that all of them have\nnumber {i}") for i in range(60)] + [(None, "a line that all of them have")]
    got = op.drop_shared_lines(frame(spark, rows)).select("doc_id", "n_lines", "n_dropped", "text")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert op.drop_shared_lines(frame(spark, [], 1)).collect() == []
