"""Operator 10. Mixing sources to target weights, by iterative proportional fitting.

Tokens are summed for each cell of source, language and topic. Raking multiplies the cells' weights by
what each marginal lacks, one marginal after another, ROUNDS rounds at a time until no marginal is off by
more than the tolerance, or the largest error hardly falls because the cells cannot meet all targets; a
warning then tells what error remains. A cell's documents are sampled with a probability in proportion to its
weight for each token, scaled until the budget is met with no probability above one, and drawn by a hash of
the key: the same documents on every run. The query's SQL goes on by the same rules.

Only DataFrame operations. Documents are read twice and never shuffled but for the join with the cells,
which is a broadcast if Spark finds them small; cells number sources times languages times topics.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnlake.llm.shared import others, unused, written

#: Rounds between two looks at the error.
ROUNDS = 12
#: Rounds in one plan.
AT_ONCE = 4
#: Share of all tokens that a marginal may be off; error that another ROUNDS may leave of the last.
TOLERANCE, FALLS = 1e-4, 0.95
BUDGET = 0.5
#: Marginals: a number tempers the corpus' own shares (1 leaves them, 0 levels them).
TARGETS = {"source": 0.5, "lang": 0.5, "topic": 0.8}

WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_topic(tokens: Column) -> Column:
    """Stands in for a topic where a table has none: what kind of text its length makes it."""
    return F.when(tokens < 150, "note").when(tokens < 600, "article").otherwise("paper")


def raked_cells(
    cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], rounds: int = ROUNDS, tolerance: float | None = None
) -> DataFrame:
    """`cells` (the columns of `targets`, tokens) with their weight, summing to 1 over all cells.

    A target is an exponent for the shares that the column's values have in the corpus, or a map from
    value to share (values that it lacks get none). Null is a value like others. Cells without tokens
    keep a weight of 0. With a `tolerance`, raking goes on by `rounds` more while a marginal is further
    off and the error falls. A RuntimeWarning tells of an error above it (or TOLERANCE) that remains.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state = cells.withColumn("weight", F.col("tokens") / F.lit(float(total or 1)))
    for c, target in targets.items():
        if isinstance(target, Mapping):
            wanted = F.create_map(*(x for v, s in target.items() for x in (F.lit(v), F.lit(float(s)))))
            values = state.groupBy(c).agg(F.sum("tokens").alias("share"))
            share = F.when(F.col("share") > 0, F.coalesce(wanted[F.col(c)], F.lit(0.0))).otherwise(0.0)
            values = values.select(c, share.alias("want"))
        else:
            values = state.groupBy(c).agg(F.sum("weight").alias("share"))
            values = values.select(c, F.when(F.col("share") > 0, F.pow("share", F.lit(float(target)))).otherwise(0.0).alias("want"))
        norm = values.agg(F.sum("want")).first()[0] or 1.0
        values = values.select(F.col(c).alias("_value"), (F.col("want") / F.lit(norm)).alias(f"want_{c}"))
        state = state.join(values, state[c].eqNullSafe(values["_value"])).drop("_value")
    state = written(state, "cells")
    error = float("inf")
    while True:
        for number in range(1, rounds + 1):
            for c in targets:
                have = F.sum("weight").over(Window.partitionBy(c))
                state = state.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"want_{c}") / have).otherwise(0.0))
            if number % AT_ONCE == 0 or number == rounds:
                state = written(state, "cells")  # cuts the plan: a few rounds are one small job
        error, before = largest_error(state, targets), error
        if error <= (TOLERANCE if tolerance is None else tolerance):
            break
        if tolerance is None or error > FALLS * before:
            warnings.warn(f"raking leaves a marginal {error:.6f} off its target", RuntimeWarning, stacklevel=2)
            break
    return state.drop(*(f"want_{c}" for c in targets))


def largest_error(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]]) -> float:
    """How far the weights of a value, summed, are from the share wanted (column want_...), at most."""
    off = [
        cells.groupBy(c).agg(F.abs(F.sum("weight") - F.max(f"want_{c}")).alias("off")).select("off") for c in targets
    ]
    return reduce(DataFrame.union, off).agg(F.max("off")).first()[0] or 0.0 if off else 0.0


def with_probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """`cells` (tokens, weight) with the probability `p`: weight for each token, scaled and at most 1.

    The expected tokens are `budget` of all, unless the cells with a weight hold less than that. Cells whose
    probability comes to one are full, and the rest is scaled up again until no other cell gets full.
    """
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = cells.withColumn("rate", rate)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted, scale = budget * total, float(total) * budget
    before = -1
    while True:
        full = F.lit(scale) * F.col("rate") >= 1
        found = cells.agg(
            F.count_if(full).alias("count"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("rest"),
        ).first()
        if not found.rest or wanted <= found.full or found["count"] <= before:
            break
        scale, before = (wanted - found.full) / found.rest, found["count"]
    return cells.withColumn("p", F.least(F.lit(1.0), F.lit(scale) * F.col("rate"))).drop("rate")


def drawn(key: Column) -> Column:
    """A number from 0 to below 1 that follows from the key."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    targets: Mapping[str, float | Mapping[str, float]] = TARGETS,
    budget: float = BUDGET,
    tolerance: float | None = TOLERANCE,
) -> DataFrame:
    """`docs` with n_tokens, p and kept put last (columns of these names are replaced).

    Tokens are runs of characters other than white space. `topic` names a column; None takes the
    length class. `tolerance` is that of `raked_cells`. Null source, language or topic is a value of its own. A text that is null, empty or
    blank has no tokens; where all of a cell's are such, p is 0 and none is kept. Rows with equal keys
    draw alike. Other columns stay as they are; an empty table stays empty.
    """
    other = others(docs.columns, "n_tokens", "p", "kept")
    rows = docs.select(*other, token_count(F.col(text)).alias("n_tokens"))
    kind = length_topic(F.col("n_tokens")) if topic is None else F.col(topic)
    dims = {"source": F.col(source), "lang": F.col(lang), "topic": kind}
    cells = rows.groupBy(*(d.alias(c) for c, d in dims.items())).agg(F.sum("n_tokens").alias("tokens"))
    cells = with_probabilities(raked_cells(written(cells, "cells"), targets, tolerance=tolerance), budget)
    names = {c: unused(docs.columns, f"_{c}") for c in dims}
    cells = cells.select(*(F.col(c).alias(names[c]) for c in dims), "p")
    on = reduce(lambda x, y: x & y, (d.eqNullSafe(F.col(names[c])) for c, d in dims.items()))
    return rows.join(cells, on).select(
        *other, "n_tokens", F.round("p", 6).alias("p"), (drawn(F.col(key)) < F.col("p")).alias("kept")
    )


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return mixed(docs).select("doc_id", "n_tokens", "p", "kept")


def _op10_sql() -> str:
    steps = [
        r"""
docs AS (
  SELECT doc_id, source, lang,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
  FROM documents
),
rows AS (
  SELECT *, CASE WHEN n_tokens < 150 THEN 'note' WHEN n_tokens < 600 THEN 'article' ELSE 'paper' END AS topic
  FROM docs
),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL),
w0 AS (SELECT *, tokens / sum(tokens) OVER () AS weight FROM cells)"""
    ]
    for c, exponent in TARGETS.items():
        steps.append(f"t_{c}_raw AS (SELECT {c}, CASE WHEN sum(weight) > 0 THEN sum(weight) ** {exponent} ELSE 0 END AS want FROM w0 GROUP BY {c})")
        steps.append(f"t_{c} AS (SELECT {c}, want / sum(want) OVER () AS want_{c} FROM t_{c}_raw)")
    wants = ", ".join(f"want_{c}" for c in TARGETS)
    joins = " ".join(f"JOIN t_{c} ON w0.{c} IS NOT DISTINCT FROM t_{c}.{c}" for c in TARGETS)
    step = "SELECT * FROM rake WHERE going"
    for c in TARGETS:
        have = f"sum(weight) OVER (PARTITION BY {c})"
        step = f"SELECT * REPLACE (CASE WHEN {have} > 0 THEN weight * want_{c} / {have} ELSE 0 END AS weight)\n    FROM ({step})"
    off = ", ".join(f"abs(sum(weight) OVER (PARTITION BY {c}) - want_{c})" for c in TARGETS)
    steps.append(f"""
rake AS (
  SELECT 0 AS round, w0.source, w0.lang, w0.topic, tokens, weight, {wants}, 'Infinity'::DOUBLE AS before, true AS going
  FROM w0 {joins}
  UNION ALL
  SELECT round + 1, source, lang, topic, tokens, weight, {wants},
         CASE WHEN (round + 1) % {ROUNDS} = 0 THEN error ELSE before END,
         (round + 1) % {ROUNDS} <> 0 OR (error > {TOLERANCE} AND error <= {FALLS} * before)
  FROM (SELECT *, max(off) OVER () AS error FROM (SELECT *, greatest({off}) AS off
    FROM ({step})))
),
r AS MATERIALIZED (
  SELECT source, lang, topic, tokens, weight, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS rate
  FROM rake WHERE round = (SELECT max(round) FROM rake)
),
fills AS (
  SELECT 0 AS fill, {BUDGET} * sum(tokens) AS scale, {BUDGET} * sum(tokens) AS wanted, -1 AS before, true AS going FROM r
  UNION ALL
  SELECT fill + 1, CASE WHEN more THEN (wanted - full_) / rest ELSE scale END, wanted, count_, more
  FROM (SELECT *, rest > 0 AND wanted > full_ AND count_ > before AS more FROM (
    SELECT fill, scale, wanted, before, count(*) FILTER (scale * rate >= 1) AS count_,
           sum(CASE WHEN scale * rate >= 1 THEN tokens ELSE 0 END) AS full_,
           sum(CASE WHEN scale * rate >= 1 THEN 0 ELSE weight END) AS rest
    FROM fills, r WHERE going GROUP BY fill, scale, wanted, before))
),
p AS (
  SELECT source, lang, topic, least(1.0, scale * rate) AS p
  FROM r, (SELECT scale FROM fills ORDER BY fill DESC LIMIT 1)
)""")
    return (
        "WITH RECURSIVE "
        + ",\n".join(steps)
        + """
SELECT doc_id, n_tokens, round(p, 6) AS p,
       ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT / 4294967296.0 < p.p AS kept
FROM rows JOIN p ON rows.source IS NOT DISTINCT FROM p.source AND rows.lang IS NOT DISTINCT FROM p.lang
  AND rows.topic = p.topic
"""
    )


OP10_SQL = _op10_sql()
