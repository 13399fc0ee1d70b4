import duckdb
import pytest
from cases import SCHEMA, clashing, prose

from cairnlake.llm import mixing as op


def rows():
    made = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 5}"
        made.append((i, prose(i, 5 + i * 7 % 900), ["en", "de", None][i % 3 if i % 11 else 2], source, None))
    return made + [(500, None, "en", "blank", 0), (501, " \n", "en", "blank", 0), (502, "", "xx", "s1", 0), (1, "again", "en", "s1", 0), (None, "no key", "en", "hot", 0)]


def test_equals_the_sql(spark):
    data = [r for r in rows() if r[0] is not None and r != (1, "again", "en", "s1", 0)]
    got = op.mixed(spark.createDataFrame(data, SCHEMA).repartition(3)).select("doc_id", "n_tokens", "p", "kept")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", data)
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(op.OP10_SQL).fetchall())


def test_raking_meets_the_marginals(spark):
    cells = [(s, l, t, 10.0 + 3 * i) for i, (s, l, t) in enumerate((s, l, t) for s in "abc" for l in "xy" for t in "pq")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.9, "y": 0.1}, "topic": 0.0}
    got = op.raked_cells(df, targets).collect()
    share = lambda c, v: sum(r.weight for r in got if r[c] == v)
    assert share("source", "a") == pytest.approx(0.5, abs=1e-6)
    assert share("lang", "y") == pytest.approx(0.1, abs=1e-6)
    assert share("topic", "p") == pytest.approx(0.5, abs=1e-6)


def test_raking_goes_on_until_skewed_marginals_are_met(spark):
    """Sources of one main language each (98%) and unlike sizes: 12 rounds leave them off."""
    sizes = [1000.0, 300.0, 80.0, 20.0, 5.0, 1.0]
    cells = [(f"s{i}", f"l{j}", "t", n * (0.98 if j == i % 3 else 0.01)) for i, n in enumerate(sizes) for j in range(3)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    wanted = {"source": {f"s{i}": 1 / 6 for i in range(6)}, "lang": {"l0": 0.6, "l1": 0.3, "l2": 0.1}, "topic": 1.0}
    with pytest.warns(RuntimeWarning, match="0.0022"):
        op.raked_cells(df, wanted)
    got = op.raked_cells(df, wanted, tolerance=1e-4).collect()
    for c in ("source", "lang"):
        for value, share in wanted[c].items():
            assert sum(r.weight for r in got if r[c] == value) == pytest.approx(share, abs=1e-4)


def test_marginals_out_of_reach_are_reported(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0)], "source string, lang string, tokens double")
    with pytest.warns(RuntimeWarning, match="0.4"):
        op.raked_cells(df, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.5, "y": 0.5}}, tolerance=1e-4)


def test_probabilities_meet_the_budget(spark):
    cells = [("a", 1000, 0.1), ("b", 100, 0.5), ("c", 500, 0.4), ("d", 0, 0.0)]
    df = spark.createDataFrame(cells, "source string, tokens long, weight double")
    got = {r.source: r for r in op.with_probabilities(df, 0.5).collect()}
    assert sum(r.p * r.tokens for r in got.values()) == pytest.approx(800)
    assert got["b"].p == got["c"].p == 1.0 and got["d"].p == 0.0 and 0 < got["a"].p < 1


def test_odd_rows_and_clashing_names(spark):
    df = clashing(spark.createDataFrame(rows(), SCHEMA).repartition(3))
    got = op.mixed(df)
    assert got.columns == [c for c in df.columns if c not in ("n_tokens", "P", "kept")] + ["n_tokens", "p", "kept"]
    found = {(r.doc_id, r.text): r for r in got.collect()}
    assert len(found) == len(rows())
    assert found[500, None].p == 0 and not found[501, " \n"].kept
    assert all(0 <= r.p <= 1 for r in found.values())
    assert op.mixed(df, topic="topic").count() == len(rows())


def test_empty_table(spark):
    assert op.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
