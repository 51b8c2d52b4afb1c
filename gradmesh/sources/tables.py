"""Table adapters: turn the given parquet tables into samples, text lines and control logs.

These are test plumbing (see FIXTURES.md §2), not operators. Every adapter reads its
whole table and derives rows with built-in column expressions only.

Samples schema: ``shard_id INT, row_id BIGINT, x ARRAY<DOUBLE>, y DOUBLE``.
Lines schema:   ``shard_id INT, pos STRUCT<file STRING, file_block_start BIGINT, id BIGINT>,
value STRING``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_SHARDS = 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lineitem_shard() -> Column:
    return (F.col("l_orderkey") % N_SHARDS + 1).cast("int")


def _lineitem_row_id() -> Column:
    # TPC-H line numbers are 1..7, so (orderkey, linenumber) packs into one key.
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint")


def _lineitem_label() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0))


def lineitem_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-LI: four scaled numeric columns, label = returned."""
    li = read_table(spark, sf_dir, "lineitem")
    x = F.array(
        (F.col("l_quantity") / 50.0).cast("double"),
        (F.col("l_extendedprice") / 100000.0).cast("double"),
        (F.col("l_discount") * 10.0).cast("double"),
        (F.col("l_tax") * 10.0).cast("double"),
    )
    return li.select(
        _lineitem_shard().alias("shard_id"),
        _lineitem_row_id().alias("row_id"),
        x.alias("x"),
        _lineitem_label().alias("y"),
    )


def customer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-LI with a run of its own for every customer: ``run_id`` is the order's customer."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("run_id"))
    samples = lineitem_samples(spark, sf_dir).withColumn("o_orderkey", F.floor(F.col("row_id") / 8))
    return samples.join(orders, "o_orderkey").select("run_id", "shard_id", "x", "y")


def wide_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EMB twice over: 128 features, more than the reference's weight slots."""
    return embedding_samples(spark, sf_dir).withColumn("x", F.concat("x", F.transform("x", lambda v: v * v)))


def crossed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EMB with 1,024 features: each slot times the one 0 to 15 places on, cyclically."""
    twice = F.concat("x", "x")
    shifted = [F.zip_with("x", F.slice(twice, s + 1, F.size("x")), lambda a, b: a * b) for s in range(16)]
    return embedding_samples(spark, sf_dir).withColumn("x", F.concat(*shifted))


def embedding_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EMB: 64-d embeddings, label parity."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        (F.col("vec_id") % N_SHARDS + 1).cast("int").alias("shard_id"),
        F.col("vec_id").cast("bigint").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("x"),
        (F.col("label") % 2).cast("double").alias("y"),
    )


def ragged_embedding_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-RAG: shard s keeps the first 16*s embedding slots (widths 16, 32, 48)."""
    s = embedding_samples(spark, sf_dir)
    return s.withColumn("x", F.slice("x", F.lit(1), F.col("shard_id") * 16))


def _line_pos() -> Column:
    return F.struct(
        F.lit("lineitem").alias("file"),
        F.col("l_orderkey").cast("bigint").alias("file_block_start"),
        F.col("l_linenumber").cast("bigint").alias("id"),
    )


def _num(c: str) -> Column:
    """``%.4f`` text of a column with at most two decimals, via a DECIMAL(18,4) cast
    (same digits, and far cheaper per row than a formatter)."""
    return F.col(c).cast("decimal(18,4)").cast("string")


def _label_text() -> Column:
    return _lineitem_label().cast("decimal(2,1)").cast("string")


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-TXT: one clean text line per lineitem row, ``q p d t label``."""
    li = read_table(spark, sf_dir, "lineitem")
    value = F.concat_ws(
        " ", _num("l_quantity"), _num("l_extendedprice"), _num("l_discount"), _num("l_tax"),
        _label_text(),
    )
    return li.select(_lineitem_shard().alias("shard_id"), _line_pos().alias("pos"), value.alias("value"))


def lineitem_dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-TXT with the reader's edge cases, chosen by line number.

    1 clean; 2 CRLF ending; 3 tabs and double blanks; 4 junk suffixes and extra tokens;
    5 comment; 6 short row (two tokens); 7 blank, or white space only when the row is 'A'.
    Line 1 always exists, so each shard's first data line is a clean five-token line.
    """
    li = read_table(spark, sf_dir, "lineitem")
    q, p, d, t = _num("l_quantity"), _num("l_extendedprice"), _num("l_discount"), _num("l_tax")
    lab = _label_text()
    clean = F.concat_ws(" ", q, p, d, t, lab)
    ln = F.col("l_linenumber")
    value = (
        F.when(ln == 2, F.concat(clean, F.lit("\r")))
        .when(ln == 3, F.concat(q, F.lit("\t"), p, F.lit("  "), d, F.lit("\t\t"), t, F.lit(" "), lab))
        .when(ln == 4, F.concat_ws(" ", q, p, F.concat(d, F.lit("abc")), F.concat(t, F.lit("e")), lab,
                                   F.lit("extra"), F.lit("99")))
        .when(ln == 5, F.concat(F.lit("# "), clean))
        .when(ln == 6, F.concat_ws(" ", q, p))
        .when(ln == 7, F.when(F.col("l_returnflag") == "A", F.lit("   ")).otherwise(F.lit("")))
        .otherwise(clean)
    )
    return li.select(_lineitem_shard().alias("shard_id"), _line_pos().alias("pos"), value.alias("value"))


# ---- control logs from events ------------------------------------------------------

def events_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-CTL: decoded control events, run = user, seq = event id; invalid ops dropped."""
    return control_from_events(read_table(spark, sf_dir, "events"))


def control_from_events(ev: DataFrame) -> DataFrame:
    """F-CTL mapping over an events frame (batch or streaming)."""
    et = F.col("event_type")
    op = (
        F.when(et == "error", F.lit("PAUSE"))
        .when(et == "view", F.lit("RESUME"))
        .when(et == "click", F.lit("ADJUST_LR"))
        .when(et == "purchase", F.lit("QUERY_PROGRESS"))
        .when((et == "signup") & (F.col("event_id") % 10 == 0), F.lit("TERMINATE"))
    )
    new_lr = F.when(et == "click", (F.col("value") / 10000.0).cast("double"))
    out = ev.select(
        F.col("user_id").cast("bigint").alias("run_id"),
        F.col("event_id").cast("bigint").alias("seq"),
        op.alias("op"),
        new_lr.alias("new_lr"),
    )
    return out.where(F.col("op").isNotNull())


def events_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-CMD: raw menu lines, run = user, seq = event id."""
    return commands_from_events(read_table(spark, sf_dir, "events"))


def commands_from_events(ev: DataFrame) -> DataFrame:
    """F-CMD mapping over an events frame (batch or streaming)."""
    et = F.col("event_type")
    value = (
        F.when(et == "purchase", F.lit("1"))
        .when(et == "click", F.lit("2"))
        .when(et == "error", F.lit("3"))
        .when(et == "view", F.lit("4"))
        .otherwise(F.col("value").cast("string"))
    )
    return ev.select(
        F.col("user_id").cast("bigint").alias("run_id"),
        F.col("event_id").cast("bigint").alias("seq"),
        value.alias("value"),
    )
