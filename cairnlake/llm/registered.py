"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cairnlake.llm.alignment import op12_tokenizer_alignment
from cairnlake.llm.decontamination import OP6_SQL, op6_benchmark_decontamination
from cairnlake.llm.embedding_dedup import op3_embedding_near_dedup
from cairnlake.llm.jaccard_join import op2_ngram_jaccard_join
from cairnlake.llm.language_id import op9_language_id
from cairnlake.llm.line_dedup import OP4_SQL, op4_line_dedup
from cairnlake.llm.manifest import OP13_SQL, op13_merkle_manifest
from cairnlake.llm.mixing import OP10_SQL, op10_source_mixing
from cairnlake.llm.packing import op11_packing
from cairnlake.llm.substring_dedup import op1_substring_dedup
from cairnlake.llm.suffix_dedup import op7_suffix_array_dedup
from cairnlake.llm.token_counts import op8_token_counts
from cairnlake.llm.url_reputation import OP5_SQL, op5_url_filters

QUERIES = [
    op1_substring_dedup,
    op2_ngram_jaccard_join,
    op3_embedding_near_dedup,
    op4_line_dedup,
    op5_url_filters,
    op6_benchmark_decontamination,
    op7_suffix_array_dedup,
    op8_token_counts,
    op9_language_id,
    op10_source_mixing,
    op11_packing,
    op12_tokenizer_alignment,
    op13_merkle_manifest,
]
SQL = {
    op4_line_dedup: OP4_SQL,
    op5_url_filters: OP5_SQL,
    op6_benchmark_decontamination: OP6_SQL,
    op10_source_mixing: OP10_SQL,
    op13_merkle_manifest: OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {query.__name__: sql for query, sql in SQL.items()}
