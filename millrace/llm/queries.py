"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    ann, bpe_chunks, exact_dedup, line_dedup, merkle, mixing, phrases, pieces, secret_scan, simhash, token_counts, toxicity, warc,
)
from millrace.llm.texts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op10_sentencepiece")
def op10(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


def rank_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op4_secrets")
def op4(spark, sf_dir):
    return secret_scan.digests(table(spark, sf_dir, "documents"))


@query("op7_token_counts")
def op7(spark, sf_dir):
    return token_counts.section_rows(table(spark, sf_dir, "documents"), *rank_file())


@query("op6_toxicity")
def op6(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.similar_documents(table(spark, sf_dir, "documents"))


@query("op9_line_dedup", line_dedup.ORACLE)
def op9(spark, sf_dir):
    return line_dedup.digests(table(spark, sf_dir, "documents"))


@query("op5_mixing", mixing.ORACLE)
def op5(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op1_exact_dedup", exact_dedup.ORACLE)
def op1(spark, sf_dir):
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


@query("op3_warc", warc.ORACLE)
def op3(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


@query("op2_nn_descent")
def op2(spark, sf_dir):
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def word_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op11_bpe_chunks")
def op11(spark, sf_dir):
    return bpe_chunks.digests(table(spark, sf_dir, "documents"), word_model())


@query("op12_collocations", phrases.ORACLE)
def op12(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_merkle", merkle.ORACLE)
def op13(spark, sf_dir):
    return merkle.tampering(table(spark, sf_dir, "documents"))
