"""Synchronous full-batch training over sharded samples.

Data flow of one round (one Spark job, two stages):

    cached samples, fail_round > round_id (J2), weights shipped with the tasks (J1) -->
    err * x / n_shard summed per task (one row) --> final sum (one row)

The mean of shard means is ``sum_s (1/n_s) sum_{i in s} err_i x_i / S``. Each row carries
``inv_n = 1/n_s`` of its shard, computed once, so a round needs no per-shard grouping and
no key-based shuffle: every task emits one partial row whatever the shard sizes, and a
shard holding most of the data costs nothing extra. The driver receives k sums, steps the
weights (P5), computes the RMS (A5) and tests convergence (T3).

Up to ``NARROW`` features the samples are flat columns and a round is generated JVM code. Wider
samples are packed into blocks, each as wide as its own rows are (rows are sorted by width within a
partition, so that narrow shards store no slots they don't have), and a round is two matrix products
a block: plan and code are the same in every round and for every width.

Many runs, each with its own samples and its own control log, are trained by
``gradmesh.plans.runs``; nothing per run reaches the driver there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmesh.functions.model import (
    DEFAULT_LR,
    DEFAULT_ROUNDS,
    DEFAULT_THRESHOLD,
    WEIGHT_SLOTS,
    rms_of,
    sigmoid,
    weight_step,
)
from gradmesh.operators.control import PROGRESS_SCHEMA, fold_control
from gradmesh.operators.gradients import combined_gradient, shard_gradient, weights_literal

NEVER = 2**31 - 1
NARROW = 16  # features that are held as columns
BLOCK_BYTES = 1 << 21  # of a block of wide samples, one row at least

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("round_id", T.IntegerType(), False),
        T.StructField("lr", T.DoubleType(), False),
        T.StructField("grad_norm", T.DoubleType(), True),
        T.StructField("responses", T.LongType(), False),
        T.StructField("alive_shards", T.LongType(), False),
        T.StructField("status", T.IntegerType(), False),
        T.StructField("w", T.ArrayType(T.DoubleType(), False), False),
    ]
)
WEIGHTS_SCHEMA = "run_id BIGINT, round_id INT, w ARRAY<DOUBLE>"
SUMMARY_SCHEMA = "run_id BIGINT, final_round INT, rounds_run INT, alive_shards BIGINT, outcome STRING, final_norm DOUBLE"


@dataclass
class RunPlan:
    """Settings of one run: its rates, and where and why it stops early."""

    run_id: int
    lrs: list[float]
    stop_round: int  # first boundary that does not run; ``rounds`` if none
    stop_outcome: str = "completed"  # terminated | stalled | waiting when stop_round < rounds


@dataclass
class Prepared:
    """Cached flat samples plus per-shard facts."""

    df: DataFrame | None
    k: int
    n_shards: int
    alive: list[int]
    blocks: bool = False
    per_shard: DataFrame | None = None
    gone: list[int] = field(default_factory=list)  # shards lost while the run trains

    def lose(self, shards: Iterable[int], r: int) -> None:
        """Leaves shards out from round ``r`` on (J2, A6); those without samples change nothing."""
        new = sorted({int(s) for s in shards} - set(self.gone))
        if not new:
            return
        self.gone += new
        for row in self.per_shard.where(F.col("shard_id").isin(new)).select("fail_round").collect():
            for k in range(r, min(row["fail_round"], len(self.alive))):
                self.alive[k] -= 1


@dataclass
class TrainResult:
    history: DataFrame
    weights: DataFrame
    summary: DataFrame
    n_shards: int = 0
    answers: DataFrame | None = None  # of progress queries, under live control

    def __iter__(self):
        return iter((self.history, self.weights))


def xcols(k: int) -> list[str]:
    return [f"x{j}" for j in range(k)]


def clamped(x, max_features: int | None):
    """S8, on request only: the first ``max_features`` slots."""
    x = F.col(x).cast("array<double>")
    return x if max_features is None else F.slice(x, 1, int(max_features))


def shard_failures(failures: DataFrame, *keys: str) -> DataFrame:
    """The first failure of each shard, as ``fail_round``."""
    return failures.groupBy(*(F.col(k) for k in keys)).agg(F.min(F.col("failed_from_round").cast("int")).alias("fail_round"))


@contextmanager
def prepared(
    samples: DataFrame,
    rounds: int,
    failures: DataFrame | None = None,
    max_features: int | None = None,
    partitions: int | None = None,
) -> Iterator[Prepared]:
    """Counts per shard, attaches ``inv_n`` / ``fail_round`` and caches flat columns.

    The source is read once, into a cache from which the shard counts (one grouped
    aggregate) and the flat table are made. The join with the per-shard facts is planned
    from their cached size. Every round scans the flat table: ``partitions`` spreads it
    evenly where the input has few splits; without it the scan's splits are kept. A lost
    executor's part is recomputed from the source.
    """
    base = samples.select(
        F.col("shard_id").cast("int").alias("shard_id"), clamped("x", max_features).alias("x"), F.col("y").cast("double").alias("y")
    )
    if partitions:
        base = base.repartition(int(partitions))
    cached = [base.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        per_shard = base.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("k"))
        if failures is None:
            per_shard = per_shard.withColumn("fail_round", F.lit(NEVER))
        else:
            first = shard_failures(failures.withColumn("shard_id", F.col("shard_id").cast("int")), "shard_id")
            per_shard = per_shard.join(first, "shard_id", "left").withColumn("fail_round", F.coalesce("fail_round", F.lit(NEVER)))
        cached.append(per_shard.persist(StorageLevel.MEMORY_AND_DISK))
        # at most rounds + 1 rows: shards by the round that first misses them
        ends = F.greatest(F.lit(0), F.least("fail_round", F.lit(rounds)))
        by_end = per_shard.groupBy(ends.alias("end")).agg(F.count(F.lit(1)).alias("shards"), F.max("k").alias("k")).collect()
        alive = [sum(e["shards"] for e in by_end if e["end"] > r) for r in range(rounds)]
        n_shards, k = sum(e["shards"] for e in by_end), max([0, *(e["k"] or 0 for e in by_end)])
        if not n_shards or not k:
            yield Prepared(None, 0, n_shards, alive, False, per_shard)
            return
        side = per_shard.select("shard_id", (F.lit(1.0) / F.col("n")).alias("inv_n"), "fail_round")
        if k > NARROW:
            packed = in_blocks(base.join(side, "shard_id")).persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(packed)
            packed.count()
            base.unpersist()
            yield Prepared(packed, k, n_shards, alive, True, per_shard)
            return
        flat = base.join(side, "shard_id").select(
            "shard_id", "inv_n", "fail_round", "y", *[F.coalesce(F.get("x", j), F.lit(0.0)).alias(c) for j, c in enumerate(xcols(k))]
        )
        cached.append(flat.persist(StorageLevel.MEMORY_AND_DISK))
        flat.count()
        base.unpersist()
        yield Prepared(flat, k, n_shards, alive, False, per_shard)
    finally:
        for d in cached:
            d.unpersist()


_BLOCK = "width int, x binary, y binary, inv_n binary, fail_round binary, shard_id binary"


def in_blocks(rows: DataFrame) -> DataFrame:
    """``x, y, inv_n, fail_round`` packed: matrices of samples, row by row, with their width."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths = b.column("width").to_numpy()
            at = 0
            while at < len(widths):
                most = max(1, BLOCK_BYTES // (8 * max(int(widths[at]), 1)))
                end = min(int(np.searchsorted(widths, widths[at], "right")), at + most)  # rows of one width
                part = b.slice(at, end - at)
                cols = {"width": pa.array([int(widths[at])], pa.int32()), "x": pa.array([np.ascontiguousarray(part.column("x").flatten().to_numpy(zero_copy_only=False)).tobytes()], pa.binary())}
                cols |= {c: pa.array([part.column(c).to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in ("y", "inv_n", "fail_round", "shard_id")}
                yield pa.RecordBatch.from_pydict(cols)
                at = end

    # a row without a label has no error: it counts in its shard and adds nothing
    x = F.transform("x", lambda v: F.coalesce(v, F.lit(0.0)))
    inv_n = F.when(F.col("y").isNull(), F.lit(0.0)).otherwise(F.col("inv_n"))
    given = rows.where("x IS NOT NULL").select(F.size("x").alias("width"), x.alias("x"), F.coalesce("y", F.lit(0.0)).alias("y"), inv_n.alias("inv_n"), "fail_round", "shard_id")
    return given.sortWithinPartitions("width").mapInArrow(pack, _BLOCK)


def block_sums(prep: Prepared, w: Sequence[float], round_id: int) -> tuple[int, list[float]]:
    """:func:`round_sums` over blocks: per block one product for the scores, one for the sums."""
    k, weights, gone = prep.k, np.array(w), prep.gone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + 1)
        with np.errstate(all="ignore"):
            for b in batches:
                for width, *parts in zip(*(b.column(c) for c in ("width", "x", "y", "inv_n", "fail_round", "shard_id")), strict=True):
                    x, y, inv_n = (np.frombuffer(p.as_buffer(), np.float64) for p in parts[:3])
                    fail_round, shard = (np.frombuffer(p.as_buffer(), np.int32) for p in parts[3:])
                    live = (fail_round > round_id) & ~np.isin(shard, gone)
                    x = x.reshape(len(live), width.as_py())[live]
                    e = (1.0 / (1.0 + np.exp(-(x @ weights[: x.shape[1]]))) - y[live]) * inv_n[live]
                    total[: x.shape[1]] += e @ x
                    total[k] += len(x)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total], pa.list_(pa.float64()))})

    parts = prep.df.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("j", "v"))
    got = {r["j"]: r["v"] for r in parts.groupBy("j").agg(F.sum("v").alias("v")).collect()}
    return int(got.get(k, 0)), [got.get(j, 0.0) for j in range(k)]


def round_sums(prep: Prepared, w: Sequence[float], round_id: int) -> tuple[int, list[float]]:
    """``(rows, [sum err*x_j/n_s])`` over live shards.

    Narrow samples: in generated JVM code. The weights enter as literal columns (any double, NaN
    and infinities included), the live-shard test is the J2 filter. Score, sigmoid, residual and
    the k sums fuse into one whole-stage-codegen pipeline over the cached columns; each task
    emits one partial row.
    """
    if prep.blocks:
        return block_sums(prep, w, round_id)
    xs = xcols(prep.k)
    score = reduce(lambda a, b: a + b, [F.lit(float(v)) * F.col(x) for v, x in zip(w, xs, strict=True)])
    live = F.col("fail_round") > round_id
    if prep.gone:
        live &= ~F.col("shard_id").isin(prep.gone)
    rows = prep.df.where(live).select(((sigmoid(score) - F.col("y")) * F.col("inv_n")).alias("e"), *xs)
    got = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col("e") * F.col(x)).alias(f"s_{x}") for x in xs]).first()
    return int(got["rows"]), [float(got[f"s_{x}"]) if got["rows"] else 0.0 for x in xs]


# ---- control of one run ------------------------------------------------------------------

@dataclass
class LiveControl:
    """Commands of one run, polled from a table that may still grow.

    ``read()`` returns the control table as it stands, with ``seq`` and the command columns;
    one command is taken per round boundary, by ``seq``. While paused, the table is read again
    every ``wait_s`` seconds until RESUME or TERMINATE arrives; after ``max_waits`` vain
    reads the run counts as stalled. With ``wait_for_start`` the run waits likewise for its first
    RESUME and drops what comes before (C7). A progress query is answered at its boundary (C6):
    ``on_answer`` gets the record at once, and the result has them all. An ADJUST_LR without a rate
    changes nothing. Each poll fetches the next command only.
    """

    read: Callable[[], DataFrame]
    wait_s: float = 1.0
    max_waits: int = 0
    wait_for_start: bool = False
    on_answer: Callable[[dict], None] | None = None
    last_seq: int | None = None
    answers: list[dict] = field(default_factory=list)

    def _next(self):
        c = self.read().where(F.col("op").isNotNull())
        if self.last_seq is not None:
            c = c.where(F.col("seq") > self.last_seq)
        row = c.select("seq", "op", "new_lr").orderBy("seq").first()
        if row:
            self.last_seq = row["seq"]
        return row

    def _until_resumed(self) -> str | None:
        """Takes commands up to a RESUME (None) or TERMINATE; ``stalled`` if neither comes."""
        waits = 0
        while True:
            row = self._next()
            if row is None:
                if waits >= self.max_waits:
                    return "stalled"
                waits += 1
                time.sleep(self.wait_s)
            elif row["op"] == "TERMINATE":
                return "terminated"
            elif row["op"] == "RESUME":
                return None

    def gate(self) -> str | None:
        """Why the run doesn't start, if it doesn't."""
        if not self.wait_for_start:
            return None
        stop = self._until_resumed()
        return "waiting" if stop == "stalled" else stop

    def poll(self, answer: Callable[[], dict]) -> tuple[str | None, float | None]:
        """``(stop outcome, new rate)`` of the command taken at this boundary; ``answer()`` gives
        the progress as it stands."""
        row = self._next()
        if row is None:
            return None, None
        if row["op"] == "TERMINATE":
            return "terminated", None
        if row["op"] == "ADJUST_LR":
            return None, None if row["new_lr"] is None else float(row["new_lr"])
        if row["op"] == "QUERY_PROGRESS":
            self.answers.append({"seq": row["seq"], **answer()})
            if self.on_answer:
                self.on_answer(self.answers[-1])
        return (self._until_resumed() if row["op"] == "PAUSE" else None), None


def plan_from_control(control: DataFrame, rounds: int = DEFAULT_ROUNDS, lr: float = DEFAULT_LR, wait_for_start: bool = False) -> RunPlan:
    """The plan that a finished log of one run folds to (C2-C7, J3): ``rounds`` rates and a
    stop. Logs of many runs are for ``gradmesh.plans.runs``."""
    with fold_control(control, rounds, lr, wait_for_start) as (_, stops, schedule):
        found = stops.limit(2).collect()
        if len(found) != 1:
            raise ValueError("the log must have commands of one run")
        lrs = [float(lr)] * rounds
        for row in schedule.collect():
            lrs[row["round_id"]] = float(row["lr"])
    stop = found[0]["stop_round"]
    return RunPlan(found[0]["run_id"], lrs, stop, found[0]["outcome"] if stop < rounds else "completed")


# ---- the loop ----------------------------------------------------------------------------

def train(
    samples: DataFrame,
    rounds: int = DEFAULT_ROUNDS,
    lr: float = DEFAULT_LR,
    threshold: float = DEFAULT_THRESHOLD,
    failures: DataFrame | None = None,
    plan: RunPlan | None = None,
    live: LiveControl | None = None,
    norm_slots: int = WEIGHT_SLOTS,
    max_features: int | None = None,
    partitions: int | None = None,
    on_round: Callable[[int, float | None], None] | None = None,
    lost: Callable[[], Iterable[int]] | None = None,
) -> TrainResult:
    """Train one run for up to ``rounds`` synchronous rounds.

    Semantics: round 0 starts from zero weights; each round averages per-shard mean
    gradients over the responding shards (missing slots count as zero), applies
    ``w -= lr * g``, and then stops if ``rms(g, norm_slots) < threshold`` (status 1; a NaN
    norm never does). A round with no live shard leaves the weights unchanged and has no
    norm (T5). All features count unless ``max_features`` clamps them (S8). ``plan`` carries
    rates and an early stop known beforehand; ``live`` is asked at every round boundary.
    ``on_round(round_id, norm)`` is called after each round. ``lost()`` is asked at every boundary for
    the shards that have failed by then (``gradmesh.sources.text.ShardFiles.lost``): they are left
    out for good, from that round on, as shards of ``failures`` are.
    """
    spark = samples.sparkSession
    rounds = int(rounds)
    plan = plan or RunPlan(0, [float(lr)] * rounds, rounds)
    with prepared(samples, rounds, failures, max_features, partitions) as prep:
        w, rate, last_norm, history = [0.0] * prep.k, float(lr), None, []
        final_round, outcome = min(plan.stop_round, rounds), plan.stop_outcome
        if live is not None and (stop := live.gate()):
            final_round, outcome = 0, stop
        for r in range(final_round):
            if live is not None:
                stop, new_rate = live.poll(lambda: _progress(prep, plan.run_id, r, rounds, rate, last_norm))  # noqa: B023
                rate = rate if new_rate is None else new_rate
                if stop:
                    final_round, outcome = r, stop
                    break
            if lost is not None:
                prep.lose(lost(), r)
            lr_r = rate if live is not None else float(plan.lrs[r])
            rows, sums = round_sums(prep, w, r) if prep.df is not None else (0, [])
            alive, norm, status = prep.alive[r], None, 0
            if rows and alive:
                g = [v / alive for v in sums]
                w = [wj - lr_r * gj for wj, gj in zip(w, g, strict=True)]
                last_norm = norm = rms_of(g, norm_slots)
                status = int(norm < threshold)
            history.append((plan.run_id, r, lr_r, norm, alive if norm is not None else 0, alive, status, list(w)))
            if on_round:
                on_round(r, norm)
            if status:
                final_round, outcome = r, "converged"
                break
        last = len(history) - 1
        alive = prep.alive[last] if last >= 0 else prep.n_shards
        return TrainResult(
            spark.createDataFrame(history, HISTORY_SCHEMA),
            spark.createDataFrame([(plan.run_id, last, w)], WEIGHTS_SCHEMA),
            spark.createDataFrame([(plan.run_id, final_round, len(history), alive, outcome, last_norm)], SUMMARY_SCHEMA),
            prep.n_shards,
            spark.createDataFrame(live.answers, PROGRESS_SCHEMA) if live is not None else None,
        )


def _progress(prep: Prepared, run_id: int, r: int, rounds: int, rate: float, last_norm: float | None) -> dict:
    """C6 at boundary r: the rate in force, the loss of the last round that had one."""
    active = prep.alive[r - 1] if r else prep.n_shards
    return {
        "run_id": run_id, "total_rounds": rounds, "current_round": max(r - 1, 0), "active_workers": active, "failed_workers": prep.n_shards - active,
        "current_lr": rate, "current_loss": 0.0 if last_norm is None else last_norm,
    }


def train_one_round(samples: DataFrame, w: Sequence[float], lr: float = DEFAULT_LR,
                    norm_slots: int = WEIGHT_SLOTS) -> DataFrame:
    """T2 as one DataFrame: A1 -> A3 -> A5 -> P5.

    One row ``(responses, grad_norm, g ARRAY<DOUBLE>, w ARRAY<DOUBLE>)``; ``w`` is the
    stepped vector (unchanged when no shard responds).
    """
    k = len(w)
    per_shard = shard_gradient(samples, w, k)
    comb = combined_gradient(per_shard, k, norm_slots)
    stepped = F.when(F.col("responses") > 0, weight_step(weights_literal(w), "g", lr)).otherwise(weights_literal(w))
    return comb.select("responses", "grad_norm", "g", stepped.alias("w"))
