"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgersieve.llm import chat, lexical, phrases, pii, secretscan, winnow
from ledgersieve.llm.ann import nearest
from ledgersieve.llm.bpe import encode_decode
from ledgersieve.llm.katz import lm_scores
from ledgersieve.llm.minhash import near_duplicates
from ledgersieve.llm.sentences import repeated_sentences
from ledgersieve.llm.store import table
from ledgersieve.llm.suffixes import repeated_passages
from ledgersieve.llm.toxicity import toxicity




def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file, at the same path on every machine."""
    folder = os.environ.get("LEDGERSIEVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hilbert_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_sentences(table(spark, sf_dir, "documents"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_digests(chat.with_probe(table(spark, sf_dir, "conversations")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary())


def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_digests(table(spark, sf_dir, "documents"))


def op12_itemset_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_hilbert_curves, op2_sparse_suffixes, op3_sentence_spans, op4_winnowing, op5_reply_trees, op6_toxicity,
        op7_prob_minhash, op8_distinct_word_bpe, op9_katz_backoff, op10_boosted_candidates,
        op11_secret_scan, op12_itemset_phrases, op13_geometric_blocks)}


def oracle_sql() -> dict[str, str]:
    """SQL for the operators it can express; the others are tested against brute force."""
    return {"op4_winnowing": winnow.ORACLE_SQL, "op5_reply_trees": chat.ORACLE_SQL,
            "op12_itemset_phrases": phrases.ORACLE_SQL, "op13_geometric_blocks": lexical.ORACLE_SQL}
