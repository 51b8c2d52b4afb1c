"""Gradient operators over a samples frame ``(shard_id INT, x ARRAY<DOUBLE>, y DOUBLE, ...)``.

A1 shard_gradient, A2 shard_stats, A3 combined_gradient, A4/A5 in combined_gradient,
A6 alive_shards, J1 with_weights, J2 exclude_failed, P4 sample_gradients.

The weight vector is an array literal on every row (J1). Per-shard work uses grouped
aggregates with map-side partial aggregation, so a shard holding most of the rows still
spreads over all tasks and only one partial row per shard and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmesh.functions.model import WEIGHT_SLOTS, gradient_rms, linear_score, residual, sample_gradient, sigmoid


def weights_literal(w: Sequence[float]) -> Column:
    """The weight vector as an array literal on every row; its size is the slot count."""
    return F.array(*[F.lit(float(v)) for v in w]).cast("array<double>")


def with_weights(samples: DataFrame, w: Sequence[float]) -> DataFrame:
    """Attach the weight vector ``_w`` to every sample (no shuffle)."""
    return samples.withColumn("_w", weights_literal(w))


def residuals(samples: DataFrame, w: Sequence[float]) -> DataFrame:
    """P1-P3 per sample: adds ``z``, ``p`` and ``err`` columns."""
    j = with_weights(samples, w)
    z = linear_score("x", "_w")
    return (
        j.withColumn("z", z)
        .withColumn("p", sigmoid(F.col("z")))
        .withColumn("err", F.col("p") - F.col("y"))
        .drop("_w")
    )


def sample_gradients(samples: DataFrame, w: Sequence[float]) -> DataFrame:
    """Per-sample gradient ``err * x`` as an array column ``g``."""
    r = residuals(samples, w)
    return r.withColumn("g", sample_gradient("x", F.col("err")))


def shard_gradient(samples: DataFrame, w: Sequence[float], k: int | None = None) -> DataFrame:
    """A1: per-shard mean gradient ``(shard_id, n, g ARRAY<DOUBLE>)``.

    ``g`` has the shard's own width (its widest sample, at most ``k``); each slot is
    ``avg(err * x_j)`` over the shard's samples. One hash aggregate, partial then final.
    """
    k = len(w) if k is None else int(k)
    j = with_weights(samples, w)
    err = residual("x", "_w", "y")
    j = j.select("shard_id", "x", err.alias("_err"))
    aggs = [F.avg(F.col("_err") * F.coalesce(F.get("x", i), F.lit(0.0))).alias(f"_g{i}") for i in range(k)]
    per = j.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("_k"), *aggs
    )
    g = F.slice(F.array(*[F.col(f"_g{i}") for i in range(k)]), F.lit(1), F.least(F.col("_k"), F.lit(k)))
    return per.select("shard_id", "n", g.alias("g"))


def combined_gradient(shard_grads: DataFrame, k: int, norm_slots: int = WEIGHT_SLOTS) -> DataFrame:
    """A3-A5: mean of the responding shards' gradients, response count and RMS.

    A slot missing from a narrow shard counts as 0 (``sum(coalesce) / count``, not ``avg``).
    Returns one row ``(responses BIGINT, g ARRAY<DOUBLE>, grad_norm DOUBLE)``;
    with no responses ``g`` and ``grad_norm`` are NULL.
    """
    resp = F.count(F.lit(1))
    slots = [
        F.try_divide(F.sum(F.coalesce(F.get("g", i), F.lit(0.0))), resp).alias(f"_c{i}") for i in range(k)
    ]
    one = shard_grads.agg(resp.alias("responses"), *slots)
    g = F.when(F.col("responses") > 0, F.array(*[F.col(f"_c{i}") for i in range(k)]))
    return one.select("responses", g.alias("g")).withColumn("grad_norm", gradient_rms("g", norm_slots))


def shard_stats(samples: DataFrame) -> DataFrame:
    """A2: rows and features per shard."""
    return samples.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_samples"), F.max(F.size("x")).cast("int").alias("n_features")
    )


def exclude_failed(samples: DataFrame, failures: DataFrame | None, round_id: int) -> DataFrame:
    """Drop shards whose failure round is at or before ``round_id`` (anti join)."""
    if failures is None:
        return samples
    dead = failures.where(F.col("failed_from_round") <= F.lit(int(round_id))).select("shard_id").distinct()
    return samples.join(dead, "shard_id", "left_anti")


def alive_shards(samples: DataFrame, failures: DataFrame | None, rounds: int) -> DataFrame:
    """Per round, the number of shards with data that have not failed.

    Shards (one row each) are counted by the round that first misses them; each count then
    stands for all rounds before, so neither the plan nor a row grows with the rounds.
    """
    shards = samples.select("shard_id").distinct()
    if failures is None:
        ends = shards.withColumn("fail", F.lit(int(rounds)))
    else:
        first = failures.groupBy("shard_id").agg(F.min("failed_from_round").alias("fail"))
        ends = shards.join(first, "shard_id", "left").withColumn("fail", F.least(F.coalesce("fail", F.lit(int(rounds))), F.lit(int(rounds))))
    counts = ends.groupBy("fail").agg(F.count(F.lit(1)).alias("shards"))
    spread = counts.where("fail > 0").select(F.explode(F.sequence(F.lit(0), F.col("fail") - 1)).alias("round_id"), "shards")
    grid = samples.sparkSession.range(int(rounds)).select(F.col("id").cast("int").alias("round_id"), F.lit(0).cast("bigint").alias("shards"))
    both = grid.unionByName(spread.select(F.col("round_id").cast("int").alias("round_id"), "shards"))
    return both.groupBy("round_id").agg(F.sum("shards").cast("bigint").alias("alive_shards"))
