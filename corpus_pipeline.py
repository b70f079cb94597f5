"""The corpus pipeline: quality rules, line dedup, near copies, benchmark passages, encoding.

Each stage takes what the one before kept. All but the last return the columns of documents. Its stages have no SQL
form (a trained lexicon, SimHash groups, exact set joins, an automaton, a codec), so ORACLE_SQL is None; the stages are
tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontaminate, line_dedup, piece_codec, quality_rules, shingle_join, spread

STAGES = [
    ("quality_rules", quality_rules.quality_stage),
    ("line_dedup", line_dedup.line_stage),
    ("near_copies", shingle_join.near_copy_stage),
    ("decontamination", decontaminate.decontamination_stage),
    ("piece_codec", piece_codec.encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = spread.stash(docs)
    return docs
