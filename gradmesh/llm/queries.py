"""Queries over the corpus tables, one per operator, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from gradmesh.llm import ordinal_quality, sql
from gradmesh.llm.anchors import pii_digest
from gradmesh.llm.common import table
from gradmesh.llm.line_windows import dedup_lines
from gradmesh.llm.log_bilinear import lm_scores
from gradmesh.llm.order_minhash import near_duplicates
from gradmesh.llm.packing import pack_documents
from gradmesh.llm.prefix_trie import conversation_trie
from gradmesh.llm.quality_rules import rules_report
from gradmesh.llm.template_leaks import leaks
from gradmesh.llm.token_secrets import secret_digest
from gradmesh.llm.url_templates import UrlRule, url_filter
from gradmesh.llm.whitening import whitened
from gradmesh.llm.word_bpe import encoded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


#: The vocabulary as ranks; its place is a parameter of the operators.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Fixed rules of the URL query.
URL_RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@query("op1_ordinal_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, ordinal_quality.graded(table(spark, sf_dir, "labels")))
    return ordinal_quality.score_documents(docs, model)


@query("op2_url_templates", sql.urls(URL_RULES))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES).withColumn("purity", F.round("purity", 9))


@query("op5_template_leaks", sql.LEAKS)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_sum_of_squares")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_order_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_log_bilinear")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query("op9_rule_cascade", sql.RULES)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_report(table(spark, sf_dir, "documents"))


@query("op3_line_windows", sql.LINES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), length_col="n_chars").select("doc_id", "n_chars", "text")


@query("op4_anchor_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


@query("op10_token_efficiency")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"), RANKS)


@query("op11_splitter_trie", sql.TRIE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op12_jacobi_davidson")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query("op13_word_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
