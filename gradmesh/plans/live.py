"""Live control of many runs: commands and progress queries that arrive while the runs train.

At every boundary the commands that have come since the last one are folded (C2, C3, C7) with what
the state frame carries of each run: is it paused, has its gate opened, which boundary does its
next command take. A command takes the boundary behind the run's last command, or the one the run
stands at if that is later; what is paused ends with the RESUME, whenever that comes. A run whose
boundary holds a PAUSE without its RESUME waits there while the others train on, so that each run
counts its own rounds. The work of a boundary follows the new commands, the runs that still train
and their samples; runs that have ended leave the frame.

A progress query is answered once, when its run reaches the query's boundary, from the state as it
then stands (C6): the answers of a boundary are written before its round is trained.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.functions.model import DEFAULT_LR, DEFAULT_ROUNDS, DEFAULT_THRESHOLD, WEIGHT_SLOTS, zero_weights
from gradmesh.operators.control import ADJUST_LR, KEY, ORDER, QUERY_PROGRESS, TERMINATE
from gradmesh.plans.runs import HISTORY, PART_ROWS, _write, laid_out, one_round, run_results
from gradmesh.plans.training import TrainResult
from gradmesh.session import shared_path
from gradmesh.streaming.control_stream import OUTPUT_SCHEMA, fold_batch


@dataclass
class LiveRuns:
    """Where commands come from.

    ``poll(n)`` is called before the n-th boundary and returns the commands ``(run_id, seq, op,
    new_lr)`` that have come since the call before, each once, or None; later commands of a run
    have larger ``seq``. ``gradmesh.streaming.control_stream.Arrivals`` does this for a stream.
    Where no run can train and nothing comes, it is asked again every ``wait_s`` seconds; after
    ``max_waits`` vain calls the runs left are stalled (``waiting`` behind a shut gate).
    """

    poll: Callable[[int], DataFrame | None]
    wait_for_start: bool = False
    wait_s: float = 1.0
    max_waits: int = 0


def train_live_runs(
    samples: DataFrame,
    live: LiveRuns,
    rounds: int = DEFAULT_ROUNDS,
    lr: float = DEFAULT_LR,
    threshold: float = DEFAULT_THRESHOLD,
    failures: DataFrame | None = None,
    norm_slots: int = WEIGHT_SLOTS,
    max_features: int | None = None,
    part_rows: int = PART_ROWS,
) -> TrainResult:
    """Trains every run of ``samples(run_id, shard_id, x, y)`` under live control.

    The result is that of ``train_runs``, with ``answers``: the progress records of the queries
    (the columns of ``gradmesh.operators.control.progress``). Commands of runs without samples are
    ignored, as are those of runs that have ended.
    """
    spark = samples.sparkSession
    folder = shared_path(spark, "live-runs")
    with laid_out(samples, rounds, folder, failures, max_features, part_rows) as laid:
        state = laid.runs.select(
            KEY, F.lit(0).alias("round_id"), zero_weights(laid.k).alias("w"), F.lit(float(lr)).alias("lr"), F.lit(None).cast("double").alias("loss"),
            F.lit(False).alias("paused"), F.lit(0).cast("bigint").alias("boundary"), F.lit(False).alias("terminated"), F.lit(not live.wait_for_start).alias("opened"),
            "parts", "n_shards", "alive",
        )
        state = _write(state, f"{folder}/state")
        queue = spark.createDataFrame([], OUTPUT_SCHEMA)
        history, answers, ended, waits, at = [], [], [], 0, 0
        while True:
            here = f"{folder}/boundary-{at}"
            new = live.poll(at)
            came = new is not None and not new.isEmpty()
            if came:
                state, queue = _folded(state, queue, new, live.wait_for_start, here)
            ready = _ready(state, queue).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                answers.append(_write(_answers(ready, queue, rounds), f"{here}/answers"))
                active = ready.where("NOT ends AND NOT waits").select(KEY, "round_id", "w", "lr", F.element_at("alive", F.col("round_id") + 1).alias("alive_shards"), "parts")
                done = _write(one_round(laid, active, threshold, norm_slots), f"{here}/round")
                history.append(done)
                after = _write(_after(ready, done, rounds), f"{here}/after")
            finally:
                ready.unpersist()
            ended.append(after.where("stop_outcome IS NOT NULL"))
            state = after.where("stop_outcome IS NULL").drop("stop_outcome", "stop_round")
            left, trained = after.agg(F.count_if(F.col("stop_outcome").isNull()), F.count_if("trained")).first()
            state, at = state.drop("trained"), at + 1
            if not left:
                break
            waits = 0 if came or trained else waits + 1
            if waits > live.max_waits:
                outcome = F.when(F.col("opened"), "stalled").otherwise("waiting")
                ended.append(state.withColumns({"stop_outcome": outcome, "stop_round": F.col("round_id"), "trained": F.lit(False)}))
                break
            if waits:
                time.sleep(live.wait_s)
        settings = reduce(DataFrame.unionByName, [e.select(KEY, "stop_round", "stop_outcome", "n_shards") for e in ended])
        all_rounds = reduce(DataFrame.union, history).select(*HISTORY)
        result = TrainResult(all_rounds, *run_results(all_rounds, settings, laid.k))
        result.answers = reduce(DataFrame.union, answers)
        return result


def _folded(state: DataFrame, queue: DataFrame, new: DataFrame, gated: bool, here: str) -> tuple[DataFrame, DataFrame]:
    """State and queue (commands not yet taken) with the new commands folded in."""
    new = _write(new.select(KEY, ORDER, "op", F.col("new_lr").cast("double").alias("new_lr")).join(state.select(KEY), KEY, "left_semi"), f"{here}/new")
    start = F.when(F.col("paused"), F.col("boundary")).otherwise(F.greatest("boundary", F.col("round_id").cast("bigint")))
    carry = state.join(new.select(KEY).distinct(), KEY, "left_semi").select(KEY, "paused", start.alias("boundary"), "lr", "terminated", "opened")
    rows, carried = fold_batch(new, carry, wait_for_start=gated)
    rows = _write(_left(queue, state).unionByName(rows.select(*queue.columns)), f"{here}/queue")
    carried = _write(carried.select(KEY, *[F.col(c).alias(f"_{c}") for c in ("paused", "boundary", "terminated", "opened")]), f"{here}/carry")
    both = state.join(carried, KEY, "left")
    changed = {c: F.coalesce(f"_{c}", c) for c in ("paused", "boundary", "terminated", "opened")}
    return both.withColumns(changed).select(*state.columns), rows


def _left(queue: DataFrame, state: DataFrame) -> DataFrame:
    """Commands of the runs left that take the run's next boundary or a later one."""
    next_one = state.select(KEY, F.col("round_id").alias("_next"))
    return queue.join(next_one, KEY).where(F.col("round_id") >= F.col("_next")).select(*queue.columns)


def _ready(state: DataFrame, queue: DataFrame) -> DataFrame:
    """The state at the boundary: rates set, and who ``ends`` or ``waits`` there."""
    due = queue.join(state.select(KEY, "round_id"), [KEY, "round_id"], "left_semi")
    rate = F.when((F.col("op") == ADJUST_LR) & F.col("effective") & F.col("new_lr").isNotNull(), F.col(ORDER))
    taken = due.groupBy(KEY).agg(F.max_by("new_lr", rate).alias("_lr"), F.bool_or(F.col("op") == TERMINATE).alias("_ends"))
    both = state.join(taken, KEY, "left")
    ends = F.coalesce("_ends", F.lit(False)) | (F.col("terminated") & ~F.col("opened"))
    waits = ~F.col("opened") | (F.col("paused") & (F.col("boundary") - 1 <= F.col("round_id")))
    return both.select(*[F.coalesce("_lr", "lr").alias("lr") if c == "lr" else F.col(c) for c in state.columns], ends.alias("ends"), waits.alias("waits"))


def _answers(ready: DataFrame, queue: DataFrame, rounds: int) -> DataFrame:
    """Progress records of the queries whose boundary their run has reached."""
    asked = queue.where((F.col("op") == QUERY_PROGRESS) & F.col("effective")).select(KEY, ORDER, "round_id")
    r = F.col("round_id")
    active = F.when(r > 0, F.try_element_at("alive", r)).otherwise(F.col("n_shards"))
    both = asked.join(ready.where("NOT ends"), [KEY, "round_id"])
    return both.select(
        KEY, ORDER, F.lit(int(rounds)).alias("total_rounds"), F.greatest(r - 1, F.lit(0)).cast("int").alias("current_round"), active.cast("int").alias("active_workers"),
        (F.col("n_shards") - active).cast("int").alias("failed_workers"), F.col("lr").alias("current_lr"), F.coalesce("loss", F.lit(0.0)).alias("current_loss"),
    )


def _after(ready: DataFrame, done: DataFrame, rounds: int) -> DataFrame:
    """The state behind the boundary, with why and where a run stopped."""
    now = done.select(KEY, F.col("w").alias("_w"), "grad_norm", "status")
    both = ready.join(now, KEY, "left").withColumn("trained", F.col("status").isNotNull())
    next_one = F.col("round_id") + F.col("trained").cast("int")
    outcome = F.when(F.col("ends"), "terminated").when(F.col("status") == 1, "converged").when(next_one >= rounds, "completed")
    cols = {"round_id": next_one, "w": F.coalesce("_w", "w"), "loss": F.coalesce("grad_norm", "loss")}
    kept = [cols[c].alias(c) if c in cols else F.col(c) for c in ready.columns if c not in ("ends", "waits")]
    return both.select(*kept, "trained", outcome.alias("stop_outcome"), F.when(F.col("status") == 1, F.col("round_id")).otherwise(next_one).alias("stop_round"))
