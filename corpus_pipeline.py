"""A corpus from raw documents: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept. All but
the last return the columns of `documents`; the last adds n_tokens and p.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.decontamination import contained_items
from cairnlake.llm.jaccard_join import similar_documents
from cairnlake.llm.language_id import held_out, predicted_languages, trained
from cairnlake.llm.line_dedup import drop_shared_lines
from cairnlake.llm.mixing import mixed
from cairnlake.llm.shared import unused, written
from cairnlake.session import work_dir

#: A document is rejected when no language is found in it, or none with at least this score.
MIN_SCORE = 0.35


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter go, and those that fit no language."""
    net = trained(docs.where(~held_out()))
    judged = predicted_languages(docs, net, lang="_lang", score="_score")
    return judged.where((F.col("_lang") != "und") & (F.col("_score") >= MIN_SCORE)).drop("_lang", "_score")


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that many documents share stay in one; n_chars follows the text."""
    kept = drop_shared_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents one row stays.

    It is the one with the smallest doc_id; rows without a doc_id come after all others. Every row is
    judged by its own text, also where several bear one doc_id. Texts without a word are linked with
    nothing; of those that are equal and have equal doc_ids (or none) one stays.
    """
    row = unused(docs.columns, "_row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = similar_documents(rows.select(row, "text"), row)
    wordless = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), None).otherwise(F.col("text"))
    judged = groups.join(rows.select(row, "doc_id", wordless.alias("wordless")), row)
    linked = F.col("n_shingles") > 0
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = (
        judged.groupBy(F.when(linked, F.col("component_id")), F.when(~linked, F.col("doc_id")), "wordless")
        .agg(first.alias("first"))
        .select(F.col(f"first.{row}"))
    )
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows whose text holds three quarters of an item's shingles go.

    The text alone decides (by its MD5): a row without a doc_id goes like others, and a clean text
    stays though another row of its doc_id goes.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    mark = unused(docs.columns, "_mark")
    rows = docs.withColumn(mark, F.md5(F.col("text").cast("binary")))
    leaks = contained_items(rows.select(mark, "text"), items, mark).select(mark).distinct()
    return rows.join(leaks, mark, "left_anti").select(*docs.columns)


def sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a sample that meets the marginals in expectation.

    Raking goes on to the operator's tolerance; a warning tells what the cells cannot meet.
    """
    return mixed(docs).where("kept").drop("kept")


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_shared_lines),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", sampled),
]

#: Training the net and walking link components can't be put into one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
