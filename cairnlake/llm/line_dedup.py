"""Operator 4. Lines that many documents share, kept in one document only.

Lines are exploded and hashed (128 bits of their key), documents are counted for each hash, and the
places of lines to drop go back to their documents, which are put together again by position. Only
hashes and places are shuffled besides the texts themselves, and those once. A line in a third of all
documents is spread by document while it is made distinct and counted in partial sums; the join that
finds its places is salted, and its shuffles are its own, so that adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.shared import others, written

MIN_CHARS = 20
MIN_DOCS = 3
SALTS = 4

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, UPPER.lower())


def drop_shared_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """`docs` with `text` lessened, and the columns n_lines and n_dropped put last.

    Lines end at \\n. A line's key is `line_key`; keys of at least `min_chars` code points found under
    at least `min_docs` different values of `key` lose all lines but those under the largest value.
    Null text is taken as empty: one empty line, text ''. Rows with equal keys are one document when
    documents are counted, and each keeps or loses its lines alike; a null key counts as no document
    and keeps none of the lines that go. Other columns stay as they are; a column called n_lines or
    n_dropped is replaced. An empty table stays empty.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    same = F.xxhash64("_text").alias("_same")  # rows of one key and one text drop the same places
    places = (
        rows.select("_key", same, F.posexplode(F.split("_text", "\n")).alias("_place", "_line"))
        .select("_key", "_same", "_place", line_key(F.col("_line")).alias("_line"))
        .where(F.char_length("_line") >= min_chars)
        .select(
            "_key", "_same", "_place",
            F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"),
        )
    )
    places = written(places, "places")  # hashes and places only, read twice
    shared = (
        places.where(F.col("_key").isNotNull())
        .select("_h1", "_h2", "_key")
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count("*").alias("_docs"), F.max("_key").alias("_last"))
        .where(F.col("_docs") >= min_docs)
        .drop("_docs")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    )
    drops = (
        places.withColumn("_salt", F.pmod(F.xxhash64("_same", "_key", "_place"), F.lit(SALTS)))
        .join(shared, ["_h1", "_h2", "_salt"])
        .where(~F.col("_key").eqNullSafe(F.col("_last")))
        .groupBy("_key", "_same")
        .agg(F.collect_set("_place").alias("_places"))
    )
    whole = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    d, gone = whole.alias("d"), drops.alias("gone")
    joined = d.join(
        gone,
        F.col(f"d.{key}").eqNullSafe(F.col("gone._key"))
        & (F.xxhash64(F.col(f"d.{text}")) == F.col("gone._same")),
        "left",
    )
    lines = F.split(F.col(f"d.{text}"), "\n")
    n_lines = F.size(lines)
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("gone._places"))
    kept = F.when(F.col("gone._places").isNull(), F.col(f"d.{text}")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    )
    other = others(docs.columns, "n_lines", "n_dropped")
    return joined.select(
        *(kept.alias(c) if c == text else F.col(f"d.{c}") for c in other),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size(F.col("gone._places")), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT doc_id, line, place,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT keyed.doc_id, line, place, shared.k IS NOT NULL AND keyed.doc_id <> last AS gone
  FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
