import duckdb
from cases import SCHEMA, WORD, documents, prose
from test_decontamination import brute as contained
from test_jaccard_join import brute as groups
from test_line_dedup import brute as lines

import corpus_pipeline
from cairnlake.llm import mixing, registered


def tables(spark, folder, rows):
    full = [(i, t, ["en", "de"][n % 2], f"s{n % 4}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    items = [(1, prose(2, 60)), (2, "one two"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_every_stage_against_brute_force(spark, tmp_path):
    rows = [(i, t) for n, (i, t) in enumerate(documents()) if i is not None and i != 80]
    rows += [(300 + i, prose(700 + i, 60)) for i in range(40)]
    items = tables(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        given = [(r.doc_id, r.text) for r in before.collect()]
        if name != "source_mixing":
            assert docs.columns == columns
        if name == "language_id":
            assert {i for i, t in given if not t or not any(c.isalpha() for c in t)}.isdisjoint(kept[name])
            assert {i for i, t in given if t and len(WORD.findall(t)) > 20 and i >= 300} <= set(kept[name])
        if name == "line_dedup":
            assert {i: r.text for i, r in kept[name].items()} == {r[0]: r[3] for r in lines(given)}
            assert all(r.n_chars == len(r.text) for r in kept[name].values())
        if name == "ngram_jaccard_join":
            assert set(kept[name]) == {i for i, _, c in groups(given) if i == c}
        if name == "benchmark_decontamination":
            assert set(kept[name]) == {i for i, _ in given} - {r[0] for r in contained(given, items)}
        if name == "source_mixing":
            con = duckdb.connect()
            con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
            con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(r) for r in before.collect()])
            true = {r[0] for r in con.execute(mixing.OP10_SQL).fetchall() if r[3]}
            assert set(kept[name]) == true and docs.columns == [*columns, "n_tokens", "p"]


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    """Null and repeated ids: one row of each group stays, whatever its id, and no leak."""
    rows = documents() + [(90, prose(2, 60)), (90, prose(901, 50)), (None, prose(2, 60) + " end"), (91, " "), (91, " ")]
    items = tables(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    members = {}
    for n, size, c in groups([(n, t) for n, (_, t) in enumerate(rows)]):
        members.setdefault(("linked", c) if size else rows[n], []).append(rows[n])
    left = sorted((min(r[0] is None for r in g), min((r[0] for r in g if r[0] is not None), default=0)) for g in members.values())
    out = [(r.doc_id, r.text) for r in corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()]
    assert sorted((i is None, i or 0) for i, _ in out) == left
    assert (80, prose(9, 50)) in out and sum(t == prose(1, 120) for _, t in out) == 1 and out.count((91, " ")) == 1

    out = [(r.doc_id, r.text) for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()]
    leaks = {r[0] for r in contained([(n, t) for n, (_, t) in enumerate(rows)], items)}
    assert sorted(out, key=repr) == sorted((r for n, r in enumerate(rows) if n not in leaks), key=repr)
    assert (90, prose(901, 50)) in out and (None, prose(2, 60) + " end") not in out


def test_run_goes_through_all_stages(spark, tmp_path):
    tables(spark, str(tmp_path), [(i, prose(i, 40)) for i in range(60)] + [(100, None), (101, prose(2, 60))])
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got < set(range(60)) and len(got) > 10


def test_empty_documents(spark, tmp_path):
    tables(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    names = list(registered.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(registered.oracle_sql()) <= set(names)
