"""The control fold on an unbounded command stream (Structured Streaming).

Each micro-batch is folded by the batch scan (``gradmesh.operators.control``), whose chunks
split a hot run over tasks; what a run carries from batch to batch is one small row:
``(paused, boundary, lr, terminated, opened)``. Batch n reads the carry of the runs that it
touches and writes their new carry (``gradmesh.streaming.carry``) and its rows to folders of its
own number, overwriting what an earlier attempt left: a restarted query repeats a batch with the
same result, and runs without new commands cost nothing. Carries and output live under
``spark.checkpoint.dir``, and the trigger's ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``
bound a batch. Progress queries come out with the boundary they are taken at; they are answered
where the training runs (``gradmesh.plans.live``).

Within a micro-batch a run's events are ordered by ``seq``; across micro-batches arrival
order is kept, as a FIFO does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmesh.functions.model import DEFAULT_LR
from gradmesh.operators.control import ADJUST_LR, KEY, ORDER, PAUSE, RESUME, TERMINATE, as_control, command_rounds, odd, pause_marker, read_commands, start_gate
from gradmesh.operators.scan import CHUNK, Running, chunked, running, written
from gradmesh.session import shared_path
from gradmesh.sources import console
from gradmesh.streaming.carry import Carry

CONTROL_SCHEMA = "run_id BIGINT, seq BIGINT, op STRING, new_lr DOUBLE"
OUTPUT_SCHEMA = f"{CONTROL_SCHEMA}, paused_before BOOLEAN, effective BOOLEAN, round_id INT, lr DOUBLE"
#: What a run carries from batch to batch: of its events, and of its console lines.
CARRIES = {
    "runs": "run_id BIGINT, paused BOOLEAN, boundary BIGINT, lr DOUBLE, terminated BOOLEAN, opened BOOLEAN",
    "lines": "run_id BIGINT, pending BIGINT, ended BOOLEAN",
}


def fold_batch(events: DataFrame, carry: DataFrame, lr: float = DEFAULT_LR, wait_for_start: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, new carry)`` of one micro-batch of control events.

    Rows are those of ``command_rounds`` with ``lr``, the rate in force once the command is
    taken. A run that was paused at the batch's start gets a PAUSE ahead of its events, so that
    the batch fold sees it; rounds and rates then continue from the carry. An ADJUST_LR without a
    rate changes nothing. ``carry`` needs the runs of ``events`` only, and the new carry has those.
    """
    cols = (KEY, ORDER, "op", "new_lr")
    events = events.where(F.col("op").isNotNull()).select(*cols)
    # runs that have ended drop out; a gate still shut is looked for in this batch
    live = events.join(carry.where("terminated").select(KEY), KEY, "left_anti")
    if wait_for_start:
        opened = carry.where("opened").select(KEY)
        shut = live.join(opened, KEY, "left_anti")
        rest, gates = start_gate(shut)
        rows = live.join(opened, KEY, "left_semi").unionByName(rest)
        gates = gates.where("gate_op IS NOT NULL").select(KEY, (F.col("gate_op") == RESUME).alias("gate_opened"))
    else:
        rows, gates = live, None
    ahead = rows.groupBy(KEY).agg((F.min(ORDER) - 1).alias("_ahead")).join(carry.where("paused AND NOT terminated").select(KEY), KEY, "left_semi")
    log = chunked(rows.unionByName(ahead.select(KEY, F.col("_ahead").alias(ORDER), F.lit(PAUSE).alias("op"), F.lit(None).cast("double").alias("new_lr"))), KEY, ORDER)
    folded = command_rounds(log)
    rate = F.when((F.col("op") == ADJUST_LR) & F.col("effective") & F.col("new_lr").isNotNull(), F.struct(ORDER, "new_lr"))
    folded = written(running(folded, KEY, ORDER, [Running("_rate", "max", rate)]), "folded")  # for the rows and the carry
    before = carry.select(KEY, F.col("boundary").alias("_boundary"), F.col("lr").alias("_lr"), F.col("paused").alias("_paused"))
    both = folded.join(before.join(ahead, KEY, "left"), KEY, "left")
    # the PAUSE put ahead took boundary 0, which is the carried pause's own
    start = F.coalesce("_boundary", F.lit(0)) - F.when(F.coalesce("_paused", F.lit(False)), 1).otherwise(0)
    both = both.withColumns({
        "round_id": (F.col("round_id") + start).cast("int"),
        "lr": F.coalesce(F.col("_rate.new_lr"), F.col("_lr"), F.lit(float(lr))),
    })
    out = both.where(F.col("_ahead").isNull() | (F.col(ORDER) > F.col("_ahead"))).select(*cols, "paused_before", "effective", "round_id", "lr")

    ends = both.groupBy(KEY).agg(
        F.coalesce(odd(F.max(pause_marker())), F.lit(False)).alias("paused"), (F.max("round_id") + 1).cast("bigint").alias("boundary"),
        F.max_by("lr", ORDER).alias("lr"), F.bool_or(F.col("op") == TERMINATE).alias("terminated"),
    )
    old = carry.select(KEY, *[F.col(c).alias(f"_{c}") for c in ("paused", "boundary", "lr", "terminated", "opened")])
    new = ends.join(old, KEY, "full")
    if gates is not None:
        new = new.join(gates, KEY, "full")
    else:
        new = new.withColumn("gate_opened", F.lit(True))
    shut_for_good = F.coalesce(~F.col("gate_opened"), F.lit(False))
    new = new.select(
        KEY, F.coalesce("paused", "_paused", F.lit(False)).alias("paused"), F.coalesce("boundary", "_boundary", F.lit(0)).cast("bigint").alias("boundary"),
        F.coalesce("lr", "_lr", F.lit(float(lr))).alias("lr"), (F.coalesce("terminated", F.lit(False)) | F.coalesce("_terminated", F.lit(False)) | shut_for_good).alias("terminated"),
        (F.coalesce("_opened", F.lit(False)) | F.coalesce("gate_opened", F.lit(False))).alias("opened"),
    )
    return out, new


def decode_batch(lines: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C1 on a micro-batch of console lines: ``(control events, new carry)``.

    Between lines a console either waits for a command or, behind a "2", for its value. Such a
    "2" is carried and put ahead of the run's next lines; a run that has ended takes no more.
    """
    lines = lines.select(KEY, ORDER, "value").join(carry.where("ended").select(KEY), KEY, "left_anti")
    waiting = carry.where("pending IS NOT NULL AND NOT ended").select(KEY, F.col("pending").alias(ORDER), F.lit("2").alias("value"))
    commands = written(read_commands(chunked(lines.unionByName(waiting), KEY, ORDER)), "commands")  # read by all that follows
    pending = F.when((F.col("code") == 2) & F.col("following").isNull(), F.col(ORDER))
    now = commands.groupBy(KEY).agg(F.max(pending).alias("pending"), F.bool_or("ends").alias("ended"))
    done = carry.where("ended").join(now.select(KEY), KEY, "left_anti").select(KEY, "pending", "ended")
    return as_control(commands).drop(CHUNK), now.unionByName(done)


def control_events(batch: DataFrame, batch_id: int, base: str) -> DataFrame:
    """The control events of a micro-batch: of events as they are, of console lines (``run_id,
    seq, value``) decoded, of console files (:func:`console_stream`) numbered and decoded. What a
    run's lines carry over is kept under ``base``."""
    session = batch.sparkSession
    if "file" in batch.columns:
        places = Carry(session, f"{base}/places", console.CARRY)
        batch, lines = console.numbered(batch, places.all(batch_id - 1))  # one small row a run
        places.write(batch_id, lines)
    if "value" not in batch.columns:
        return batch
    waiting = Carry(session, f"{base}/lines", CARRIES["lines"])
    events, left = decode_batch(batch, waiting.before(batch_id, batch))
    waiting.write(batch_id, left)
    return events


def run_to_table(stream: DataFrame, spark: SparkSession, base: str | None = None, lr: float = DEFAULT_LR, wait_for_start: bool = False) -> DataFrame:
    """Drains a stream with ``availableNow`` and returns all rows so far.

    The stream has control events, console lines (``run_id, seq, value``) or the lines of console
    files (``gradmesh.sources.console``), which are decoded first. ``base`` is the folder of the
    query's checkpoint, carries and output, a fresh one in the shared folder if not given; called
    again with the same folder it goes on where it stopped. Batch numbers come from the checkpoint,
    so they are without gaps from 0.
    """
    base = base or shared_path(spark, "control_stream")
    spark.createDataFrame([], OUTPUT_SCHEMA).write.mode("ignore").parquet(f"{base}/out/batch=-1")

    def fold(batch: DataFrame, batch_id: int) -> None:
        events = control_events(batch, batch_id, base)
        runs = Carry(batch.sparkSession, f"{base}/runs", CARRIES["runs"])
        out, new = fold_batch(events, runs.before(batch_id, events), lr, wait_for_start)
        out.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")
        runs.write(batch_id, new)

    query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(f"{OUTPUT_SCHEMA}, batch INT").parquet(f"{base}/out").drop("batch")


class Arrivals:
    """New commands of a stream, each once: a ``poll`` for ``gradmesh.plans.live.LiveRuns``.

    Every call drains ``stream()`` (see :func:`control_events`) with
    ``availableNow`` under one checkpoint, and returns the commands that came since the last call.
    """

    def __init__(self, spark: SparkSession, stream: Callable[[], DataFrame], base: str | None = None) -> None:
        self.spark, self.stream, self.base = spark, stream, base or shared_path(spark, "arrivals")
        self.batches: list[int] = []

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        events = control_events(batch, batch_id, self.base)
        events.where("op IS NOT NULL").select(KEY, ORDER, "op", "new_lr").write.mode("overwrite").parquet(f"{self.base}/arrived/{batch_id}")
        self.batches.append(batch_id)

    def __call__(self, boundary: int) -> DataFrame | None:
        self.batches = []
        query = self.stream().writeStream.foreachBatch(self._take).option("checkpointLocation", f"{self.base}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        if not self.batches:
            return None
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(*[f"{self.base}/arrived/{b}" for b in self.batches])
