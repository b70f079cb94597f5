"""Queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import centroids, decontaminate, line_dedup, phrase_dedup, pii_crf, piece_codec, quality_rules, secret_scan, seekable, shingle_join, token_counts, transcripts, turn_repair

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = [
        line_dedup.op1_line_simhash,
        token_counts.op2_trie_token_counts,
        pii_crf.op3_pii_crf,
        shingle_join.op4_signature_tree,
        decontaminate.op5_suffix_automaton,
        transcripts.op6_transcript_hmm,
        phrase_dedup.op7_phrase_automata,
        quality_rules.op8_rule_ledger,
        quality_rules.rule_ablations,
        piece_codec.op9_piece_codec,
        secret_scan.op10_markov_secrets,
        seekable.op11_seekable_warc,
        turn_repair.op12_tight_arcs,
        centroids.op13_centroids,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op10_markov_secrets": secret_scan.oracle(), "op11_seekable_warc": seekable.oracle(), "op13_centroids": centroids.oracle()}
