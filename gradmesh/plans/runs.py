"""T1-T6 for many runs at once: every run owns its samples, its shards and its settings.

Samples carry ``run_id`` and are laid out once, hash-partitioned by ``(run_id, part)`` and cached:
an ordinary run is one part, a run of more than ``PART_ROWS`` samples is dealt over several, so
that no task holds a hot run. The state (weights, norm, status) is a frame with one row per run. A
round brings the state to the samples by the same key, sums within parts and then over a run's
parts: only state and one row per part are shuffled, never samples. Plan and generated code are the
same in every round. Each round's state is written to the shared checkpoint folder, which cuts the
lineage and survives lost executors; only "is any run left" comes back.

Commands that arrive while the runs train are for ``gradmesh.plans.live``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.functions.model import DEFAULT_LR, DEFAULT_ROUNDS, DEFAULT_THRESHOLD, WEIGHT_SLOTS, gradient_rms, sigmoid, weight_step, zero_weights
from gradmesh.plans.training import NEVER, TrainResult, clamped, shard_failures, xcols
from gradmesh.session import shared_path


#: Samples of a part; a run of more is dealt over several.
PART_ROWS = 1_000_000
HISTORY = ("run_id", "round_id", "lr", "grad_norm", "responses", "alive_shards", "status", "w")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_settings(runs: DataFrame, stops: DataFrame | None, schedule: DataFrame | None, rounds: int, lr: float) -> DataFrame:
    """``run_id, stop_round, stop_outcome, lrs``: of every run of ``runs(run_id)``.

    Runs without a row in ``stops(run_id, stop_round, outcome)`` or ``schedule(run_id,
    round_id, lr)`` (see ``gradmesh.operators.control``) get the default plan.
    """
    out = runs.select("run_id").distinct()
    if stops is None:
        return out.select("run_id", F.lit(rounds).alias("stop_round"), F.lit("completed").alias("stop_outcome"), F.array_repeat(F.lit(float(lr)), rounds).alias("lrs"))
    rates = schedule.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("round_id", "lr"))).alias("by_round"))
    out = out.join(stops.select("run_id", "stop_round", "outcome"), "run_id", "left").join(rates, "run_id", "left")
    stop = F.coalesce("stop_round", F.lit(rounds))
    each = F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda r: F.coalesce(F.try_element_at("by_round", r), F.lit(float(lr))))
    return out.select("run_id", stop.alias("stop_round"), F.when(stop < rounds, F.col("outcome")).otherwise("completed").alias("stop_outcome"), each.alias("lrs"))


@dataclass
class RunSamples:
    """Samples of all runs, laid out, and per run ``run_id, parts, n_shards, alive`` (the number
    of live shards of each round)."""

    flat: DataFrame
    runs: DataFrame
    xs: list[str]

    @property
    def k(self) -> int:
        return len(self.xs)


@contextmanager
def laid_out(samples: DataFrame, rounds: int, folder: str, failures: DataFrame | None = None, max_features: int | None = None, part_rows: int = PART_ROWS) -> Iterator[RunSamples]:
    """``samples(run_id, shard_id, x, y)`` in flat columns, partitioned by ``(run_id, part)``."""
    spark = samples.sparkSession
    base = samples.select("run_id", "shard_id", clamped("x", max_features).alias("x"), F.col("y").cast("double").alias("y"))
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    flat = None
    try:
        shards = base.groupBy("run_id", "shard_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("k"))
        if failures is None:
            shards = shards.withColumn("fail_round", F.lit(NEVER))
        else:
            shards = shards.join(shard_failures(failures, "run_id", "shard_id"), ["run_id", "shard_id"], "left").withColumn("fail_round", F.coalesce("fail_round", F.lit(NEVER)))
        shards = _write(shards, f"{folder}/shards")
        k = shards.agg(F.max("k")).first()[0] or 0
        xs = xcols(k)
        ends = shards.groupBy("run_id").agg(F.collect_list("fail_round").alias("ends"), F.ceil(F.sum("n") / part_rows).cast("int").alias("parts"))
        alive = F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda r: F.size(F.filter("ends", lambda e: e > r)).cast("bigint"))
        runs = _write(ends.select("run_id", "parts", F.size("ends").cast("bigint").alias("n_shards"), alive.alias("alive")), f"{folder}/runs")
        side = shards.join(runs.select("run_id", "parts"), "run_id").select("run_id", "shard_id", (F.lit(1.0) / F.col("n")).alias("inv_n"), "fail_round", "parts")
        part = F.pmod(F.monotonically_increasing_id(), F.col("parts")).cast("int")
        rows = base.join(side, ["run_id", "shard_id"]).select("run_id", part.alias("part"), "inv_n", "fail_round", "y", *[F.coalesce(F.get("x", j), F.lit(0.0)).alias(c) for j, c in enumerate(xs)])
        rows = _write(rows, f"{folder}/samples")  # so that a part is the same whenever it is read
        base.unpersist()
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # sorted once, so that no round sorts them for its join
        flat = rows.repartition(n, "run_id", "part").sortWithinPartitions("run_id", "part").persist(StorageLevel.MEMORY_AND_DISK)
        yield RunSamples(flat, runs, xs)
    finally:
        base.unpersist()
        if flat is not None:
            flat.unpersist()


def train_runs(
    samples: DataFrame,
    stops: DataFrame | None = None,
    schedule: DataFrame | None = None,
    rounds: int = DEFAULT_ROUNDS,
    lr: float = DEFAULT_LR,
    threshold: float = DEFAULT_THRESHOLD,
    failures: DataFrame | None = None,
    norm_slots: int = WEIGHT_SLOTS,
    max_features: int | None = None,
    part_rows: int = PART_ROWS,
) -> TrainResult:
    """Trains every run of ``samples(run_id, shard_id, x, y)``, as ``train`` does one.

    ``failures(run_id, shard_id, failed_from_round)`` drops shards of a run (J2). Frames of
    the result have one row per run and round (history) or per run (weights, summary; the
    latter with ``n_shards``).
    """
    folder = shared_path(samples.sparkSession, "train-runs")
    with laid_out(samples, rounds, folder, failures, max_features, part_rows) as laid:
        settings = run_settings(laid.runs, stops, schedule, rounds, lr)
        settings = _write(settings.join(laid.runs, "run_id"), f"{folder}/settings")
        state = settings.select("run_id", zero_weights(laid.k).alias("w"))
        history = []
        for r in range(rounds):
            active = state.join(settings.where(F.col("stop_round") > r), "run_id")
            at = lambda c: F.element_at(c, r + 1)  # noqa: B023, E731
            active = active.select("run_id", F.lit(r).alias("round_id"), "w", at("lrs").alias("lr"), at("alive").alias("alive_shards"), "parts")
            done = _write(one_round(laid, active, threshold, norm_slots), f"{folder}/round-{r}")
            history.append(done)
            state = done.where("status = 0").select("run_id", "w")
            if done.isEmpty():
                break
        all_rounds = reduce(DataFrame.union, history).select(*HISTORY)
        return TrainResult(all_rounds, *run_results(all_rounds, settings, laid.k))


def one_round(laid: RunSamples, active: DataFrame, threshold: float, norm_slots: int) -> DataFrame:
    """History rows of one round of the runs of ``active(run_id, round_id, w, lr, alive_shards,
    parts)``; each run trains its own ``round_id``."""
    xs = laid.xs
    keyed = active.select("run_id", "round_id", "w", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    live = laid.flat.join(keyed, ["run_id", "part"]).where(F.col("fail_round") > F.col("round_id"))
    score = reduce(lambda a, b: a + b, [F.element_at("w", j + 1) * F.col(x) for j, x in enumerate(xs)], F.lit(0.0))
    errors = live.select("run_id", "part", ((sigmoid(score) - F.col("y")) * F.col("inv_n")).alias("e"), *xs)
    if xs:
        parts = errors.groupBy("run_id", "part").agg(*[F.sum(F.col("e") * F.col(x)).alias(x) for x in xs])
        sums = parts.groupBy("run_id").agg(*[F.sum(x).alias(x) for x in xs]).select("run_id", F.array(*xs).alias("sums"))
        both = active.join(sums, "run_id", "left")
    else:
        both = active.withColumn("sums", F.lit(None).cast("array<double>"))
    g = F.when(F.col("sums").isNotNull() & (F.col("alive_shards") > 0), F.transform("sums", lambda s: s / F.col("alive_shards")))
    stepped = both.withColumn("g", g).withColumn("grad_norm", gradient_rms("g", norm_slots))
    w = F.when(F.col("g").isNull(), F.col("w")).otherwise(weight_step("w", "g", F.col("lr")))
    return stepped.select(
        "run_id", "round_id", "lr", "grad_norm", F.when(F.col("g").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("alive_shards")).alias("responses"),
        "alive_shards", F.coalesce((F.col("grad_norm") < threshold).cast("int"), F.lit(0)).alias("status"), w.alias("w"),
    )


def run_results(history: DataFrame, settings: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Last weights and summary of every run, from its last round."""
    last = F.max_by(F.struct("round_id", "alive_shards", "status", "w"), "round_id").alias("last")
    normed = F.when(F.col("grad_norm").isNotNull(), F.col("round_id"))
    ends = history.groupBy("run_id").agg(F.count(F.lit(1)).cast("int").alias("rounds_run"), F.max_by("grad_norm", normed).alias("final_norm"), last)
    both = settings.join(ends, "run_id", "left")
    converged = F.coalesce(F.col("last.status") == 1, F.lit(False))
    weights = both.select("run_id", F.coalesce("last.round_id", F.lit(-1)).alias("round_id"), F.coalesce("last.w", zero_weights(k)).alias("w"))
    summary = both.select(
        "run_id", F.when(converged, F.col("last.round_id")).otherwise(F.col("stop_round")).alias("final_round"), F.coalesce("rounds_run", F.lit(0)).alias("rounds_run"),
        F.coalesce("last.alive_shards", "n_shards").alias("alive_shards"), F.when(converged, "converged").otherwise(F.col("stop_outcome")).alias("outcome"), "final_norm", "n_shards",
    )
    return weights, summary
