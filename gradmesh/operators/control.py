"""The operator control log, folded into per-round settings.

Input of the fold: ``control(run_id BIGINT, seq BIGINT, op STRING, new_lr DOUBLE)`` with
``op`` in QUERY_PROGRESS, ADJUST_LR, PAUSE, RESUME, TERMINATE. Each run is one training
run; ``seq`` is the order commands were queued in. At each round boundary the trainer
takes one command; a PAUSE takes every command up to its RESUME (or TERMINATE) at the
same boundary, swallowing the rest.

All steps are grouped aggregates or segmented scans over chunks cut by row rank
(``gradmesh.operators.scan``), so no run, however long, is processed by one task, and no join
is made on a run's rows. A log is chunked (written) once; everything derived from it keeps the
chunks. Only per-run facts (stop round, outcome) and the per-round schedule (``rounds`` rows
per run) are small.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradmesh.functions.model import DEFAULT_LR, DEFAULT_ROUNDS
from gradmesh.functions.numeric import lenient_double, lenient_int
from gradmesh.operators.scan import CHUNK, Running, across, before, chunked, running, within

# Menu codes of the operator console and the command names.
QUERY_PROGRESS, ADJUST_LR, PAUSE, RESUME, TERMINATE = (
    "QUERY_PROGRESS", "ADJUST_LR", "PAUSE", "RESUME", "TERMINATE",
)
MENU = {1: QUERY_PROGRESS, 2: ADJUST_LR, 3: PAUSE, 4: RESUME, 5: TERMINATE}
KEY, ORDER = "run_id", "seq"
#: One answered progress query.
PROGRESS_SCHEMA = "run_id BIGINT, seq BIGINT, total_rounds INT, current_round INT, active_workers INT, failed_workers INT, current_lr DOUBLE, current_loss DOUBLE"


def _without_chunk(df: DataFrame, given: DataFrame) -> DataFrame:
    """Chunks are kept only where the caller's frame had them."""
    return df if CHUNK in given.columns else df.drop(CHUNK)


# ---- C1 ---------------------------------------------------------------------------------

def _roles(lines: DataFrame) -> DataFrame:
    """Lines with ``code``, ``is_value`` and ``following`` (the next line's text).

    A line's place within its run of lines "2" tells its role: with ``at`` counting lines and
    ``other`` the place of the last line that isn't 2, an odd distance makes it a value.
    Places and the next line cross chunk borders by one summary row per chunk.
    """
    rows = chunked(lines.select(KEY, ORDER, "value"), KEY, ORDER).withColumn("code", lenient_int("value"))
    w = within(KEY, ORDER)
    rows = rows.withColumn("at", F.row_number().over(w))
    not2 = F.when(F.col("code") != 2, F.col("at"))
    local = rows.withColumns({"other": F.max(not2).over(before(w)), "next": F.lead("value").over(w)})
    sums = rows.groupBy(KEY, CHUNK).agg(F.count(F.lit(1)).alias("n"), F.max(not2).alias("last_other"), F.min_by("value", "at").alias("first"))
    start = F.coalesce(F.sum("n").over(before(across(KEY))), F.lit(0))
    sums = sums.withColumns({"start": start, "next_first": F.lead("first").over(across(KEY))})
    sums = sums.withColumn("carried", F.max(F.col("start") + F.col("last_other")).over(before(across(KEY))))
    both = local.join(sums.select(KEY, CHUNK, "n", "start", "carried", "next_first"), [KEY, CHUNK])
    other = F.coalesce(F.col("start") + F.col("other"), F.col("carried"), F.lit(0))
    return both.select(
        KEY, ORDER, CHUNK, "code", ((F.col("start") + F.col("at") - other - 1) % 2 == 1).alias("is_value"),
        F.when(F.col("at") == F.col("n"), F.col("next_first")).otherwise(F.col("next")).alias("following"),
    )


def read_commands(lines: DataFrame) -> DataFrame:
    """The lines that are commands, up to the one that ends the log: ``code``, ``following``
    (for code 2 its value's text, NULL while that has not come) and ``ends``."""
    cmds = _roles(lines).where(~F.col("is_value")).withColumn("ends", (F.col("code") < 0) | (F.col("code") == 5))
    cmds = running(cmds, KEY, ORDER, [Running("ended", "sum", F.col("ends").cast("int"), inclusive=False)])
    return cmds.where(F.col("ended") == 0).select(KEY, ORDER, "code", "following", "ends", CHUNK)


def decode_commands(lines: DataFrame) -> DataFrame:
    """Raw console lines ``(run_id, seq, value)`` -> ``(run_id, seq, op, new_lr)``.

    A line is read as ``atoi``; code 2 takes the next line as its rate (``strtof``).
    A negative code ends the log, code 5 ends it after the TERMINATE; codes 0 and 6+
    are invalid (``op`` NULL). Line roles follow from runs of consecutive "2" lines:
    inside such a run lines alternate command / value, and the line after an odd-length
    run is a value. A trailing "2" with no value line yet is not a command yet.
    """
    return _without_chunk(as_control(read_commands(lines)), lines)


def as_control(commands: DataFrame) -> DataFrame:
    """Control events of :func:`read_commands`, without a "2" that waits for its value."""
    pending = (F.col("code") == 2) & F.col("following").isNull()
    op = F.create_map(*[x for k, v in MENU.items() for x in (F.lit(k).cast("bigint"), F.lit(v))])[F.col("code")]
    return commands.where((F.col("code") >= 0) & ~pending).select(
        KEY, ORDER, op.alias("op"), F.when(F.col("code") == 2, lenient_double("following")).alias("new_lr"), CHUNK
    )


# ---- C7 ----------------------------------------------------------------------------------

def gates(control: DataFrame) -> DataFrame:
    """``run_id, gate_op``: the first RESUME or TERMINATE of each run, NULL if there is none."""
    opening = F.when(F.col("op").isin(RESUME, TERMINATE), F.col(ORDER))
    return control.where(F.col("op").isNotNull()).groupBy(KEY).agg(F.min_by("op", opening).alias("gate_op"))


def start_gate(control: DataFrame) -> tuple[DataFrame, DataFrame]:
    """With a start gate, commands up to the first RESUME or TERMINATE are used up.

    Returns ``(remaining commands, gates(run_id, gate_op))``; ``gate_op`` is RESUME,
    TERMINATE, or NULL for a run still waiting. Runs that never opened keep no commands.
    """
    c = chunked(control.where(F.col("op").isNotNull()), KEY, ORDER)
    # the smallest opening command so far, its low bit telling TERMINATE
    opening = F.when(F.col("op") == RESUME, F.col(ORDER) * 2).when(F.col("op") == TERMINATE, F.col(ORDER) * 2 + 1)
    rest = running(c, KEY, ORDER, [Running("_gate", "min", opening, inclusive=False)]).where(~odd(F.col("_gate"))).drop("_gate")
    return _without_chunk(rest, control), gates(c)


# ---- C2, C3, C5 (cut) ----------------------------------------------------------------------

def odd(c: Column) -> Column:
    return F.pmod(c, F.lit(2)) == 1


def pause_marker() -> Column:
    """Its maximum tells the last PAUSE / RESUME: the larger seq wins, the low bit says PAUSE."""
    op = F.col("op")
    return F.when(op == PAUSE, F.col(ORDER) * 2 + 1).when(op == RESUME, F.col(ORDER) * 2)


def command_rounds(control: DataFrame) -> DataFrame:
    """C2 + C3: every command up to a run's first TERMINATE, with

    ``paused_before``: a PAUSE is in force when it arrives. Such commands are swallowed,
    except RESUME (ends the pause) and TERMINATE (honoured). ``effective``: it acts (RESUME
    outside a pause is a no-op but still takes its boundary). ``round_id``: the boundary at
    which it is taken, one per boundary; those taken inside a pause share the pause's.

    One scan: a chunk's summary counts its commands that take a boundary in either case,
    paused or not when it begins, so that the carry over chunks settles both.
    """
    c = chunked(control.where(F.col("op").isNotNull()).select(KEY, ORDER, "op", "new_lr", *([CHUNK] if CHUNK in control.columns else [])), KEY, ORDER)
    w = within(KEY, ORDER)
    terminate = (F.col("op") == TERMINATE).cast("int")
    local = c.withColumns({"mark": F.max(pause_marker()).over(before(w)), "stops": F.coalesce(F.sum(terminate).over(before(w)), F.lit(0))})
    live = F.col("stops") == 0
    sums = local.groupBy(KEY, CHUNK).agg(
        F.max(pause_marker()).alias("last_mark"), F.sum(terminate).alias("all_stops"),
        F.count_if(live & F.col("mark").isNull()).alias("open"), F.count_if(live & ~odd(F.col("mark"))).alias("known"),
    )
    over = before(across(KEY))
    sums = sums.withColumns({"mark_in": F.max("last_mark").over(over), "stops_in": F.coalesce(F.sum("all_stops").over(over), F.lit(0))})
    paused_in = F.coalesce(odd(F.col("mark_in")), F.lit(False))
    sums = sums.withColumn("paused_in", paused_in).withColumn("starts", F.col("known") + F.when(F.col("paused_in"), 0).otherwise(F.col("open")))
    sums = sums.withColumn("starts_in", F.coalesce(F.sum("starts").over(over), F.lit(0)))
    both = local.join(sums.select(KEY, CHUNK, "paused_in", "stops_in", "starts_in"), [KEY, CHUNK])
    both = both.where(live & (F.col("stops_in") == 0)).withColumn("paused_before", F.coalesce(odd(F.col("mark")), F.col("paused_in")))
    taken = F.sum((~F.col("paused_before")).cast("int")).over(before(w, inclusive=True))
    out = both.select(
        KEY, ORDER, "op", "new_lr", "paused_before", (~F.col("paused_before") | F.col("op").isin(RESUME, TERMINATE)).alias("effective"),
        (F.col("starts_in") + taken - 1).cast("int").alias("round_id"), CHUNK,
    )
    return _without_chunk(out, control)


def effective_commands(control: DataFrame) -> DataFrame:
    """C2 alone: ``command_rounds`` without the round."""
    return command_rounds(control).drop("round_id")


def _gated_rounds(control: DataFrame, wait_for_start: bool) -> tuple[DataFrame, DataFrame | None]:
    c = chunked(control.where(F.col("op").isNotNull()), KEY, ORDER)
    opened = None
    if wait_for_start:
        c, opened = start_gate(c)
    return command_rounds(c), opened


# ---- C5 ------------------------------------------------------------------------------------

def terminations(
    control: DataFrame,
    rounds: int = DEFAULT_ROUNDS,
    wait_for_start: bool = False,
    rounds_df: DataFrame | None = None,
) -> DataFrame:
    """C5 (+C7, stalls): per run ``(run_id, stop_round, outcome)``.

    ``stop_round`` is the first boundary that does not run a round (``rounds`` if the log
    never stops it). Outcomes: ``terminated``, ``stalled`` (log ends inside a pause),
    ``waiting`` (gate never opened), or ``running`` (the log does not stop the run).
    """
    rounds = int(rounds)
    if rounds_df is None:
        control = chunked(control, KEY, ORDER)
        rounds_df, _ = _gated_rounds(control, wait_for_start)
    per = rounds_df.groupBy(KEY).agg(
        F.min(F.when(F.col("op") == TERMINATE, F.col("round_id"))).alias("term_round"),
        F.max(pause_marker()).alias("_m"),
        F.max("round_id").alias("last_round"),
    )
    stalled = odd(F.col("_m"))
    stop = F.coalesce("term_round", F.when(stalled, F.col("last_round")))
    outcome = F.when(F.col("term_round").isNotNull(), "terminated").when(stalled, "stalled")
    res = gates(control).join(per, KEY, "left").select(KEY, "gate_op", stop.alias("stop_round"), outcome.alias("outcome"))
    if wait_for_start:
        res = res.select(
            KEY,
            F.when(F.col("gate_op") == RESUME, F.col("stop_round")).otherwise(F.lit(0)).alias("stop_round"),
            F.when(F.col("gate_op") == TERMINATE, "terminated").when(F.col("gate_op").isNull(), "waiting").otherwise(F.col("outcome")).alias("outcome"),
        )
    late = F.col("stop_round").isNull() | (F.col("stop_round") >= rounds)
    return res.select(
        KEY,
        F.when(late, F.lit(rounds)).otherwise(F.col("stop_round")).cast("int").alias("stop_round"),
        F.when(late, "running").otherwise(F.col("outcome")).alias("outcome"),
    )


# ---- C4 / J3 --------------------------------------------------------------------------------

def lr_schedule(
    control: DataFrame,
    rounds: int = DEFAULT_ROUNDS,
    lr: float = DEFAULT_LR,
    wait_for_start: bool = False,
    rounds_df: DataFrame | None = None,
    stops: DataFrame | None = None,
) -> DataFrame:
    """C4 + J3: ``(run_id, round_id, lr)`` for every round that the log lets run.

    The rate of round r is the last effective ADJUST_LR taken at a boundary <= r (as-of
    lookup), else ``lr``. Values are not validated: 0 or negative rates are kept.
    """
    rounds = int(rounds)
    if rounds_df is None:
        control = chunked(control, KEY, ORDER)
        rounds_df, _ = _gated_rounds(control, wait_for_start)
    adj = rounds_df.where((F.col("op") == ADJUST_LR) & F.col("effective") & (F.col("round_id") < rounds)).select(
        KEY, "round_id", F.col("new_lr").cast("double").alias("new_lr")
    )
    if stops is None:
        stops = terminations(control, rounds, wait_for_start, rounds_df)
    grid = stops.select(KEY, F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round_id"), "stop_round")
    grid = grid.where(F.col("round_id") < F.col("stop_round")).select(
        KEY, "round_id", F.lit(None).cast("double").alias("new_lr"), F.lit(1).alias("_grid")
    )
    # As-of lookup as a running "last value" over at most 2 * rounds rows per run: one
    # command is taken at a boundary, so a run has one adjustment per round at most.
    both = grid.unionByName(adj.withColumn("_grid", F.lit(0)))
    w = Window.partitionBy(KEY).orderBy("round_id", "_grid").rowsBetween(Window.unboundedPreceding, 0)
    asof = both.withColumn("_lr", F.last("new_lr", ignorenulls=True).over(w))
    return asof.where(F.col("_grid") == 1).select(
        KEY, F.col("round_id").cast("int").alias("round_id"),
        F.coalesce("_lr", F.lit(float(lr))).alias("lr"),
    )


# ---- C6 -----------------------------------------------------------------------------------

def progress(
    folded: DataFrame,
    schedule: DataFrame,
    history: DataFrame,
    summary: DataFrame,
    rounds: int = DEFAULT_ROUNDS,
    lr: float = DEFAULT_LR,
) -> DataFrame:
    """One progress record per answered QUERY_PROGRESS.

    Takes the command rounds and the schedule of one :func:`fold_control`, and the history and
    summary (with ``n_shards``) of the runs. At boundary r: ``current_round = max(r-1, 0)``,
    ``current_lr`` = rate as of r, ``current_loss`` = gradient RMS of the last round before r
    that had responses (0.0 before any), active / failed shards after round r-1. A query is
    answered only if its boundary is reached (before the stop round, not after convergence);
    queries swallowed by a pause are not answered (the reference's console would hang there).
    """
    rounds = int(rounds)
    q = folded.where((F.col("op") == QUERY_PROGRESS) & F.col("effective")).select(KEY, ORDER, "round_id")
    q = q.join(summary.select(KEY, "final_round", "n_shards"), KEY).where((F.col("round_id") < rounds) & (F.col("round_id") <= F.col("final_round")))
    q = q.join(schedule, [KEY, "round_id"], "left")
    # Loss as of r: last non-null norm among rounds < r (as-of over rounds, small per run).
    w = Window.partitionBy(KEY).orderBy("h_round").rowsBetween(Window.unboundedPreceding, 0)
    h = history.select(KEY, F.col("round_id").alias("h_round"), "grad_norm", "alive_shards")
    h = h.withColumn("loss", F.last("grad_norm", ignorenulls=True).over(w)).select(KEY, (F.col("h_round") + 1).alias("round_id"), "loss", "alive_shards")
    active = F.coalesce("alive_shards", "n_shards")
    return q.join(h, [KEY, "round_id"], "left").select(
        KEY, ORDER,
        F.lit(rounds).cast("int").alias("total_rounds"),
        F.greatest(F.col("round_id") - 1, F.lit(0)).cast("int").alias("current_round"),
        active.cast("int").alias("active_workers"),
        (F.col("n_shards") - active).cast("int").alias("failed_workers"),
        F.coalesce("lr", F.lit(float(lr))).alias("current_lr"),
        F.coalesce("loss", F.lit(0.0)).alias("current_loss"),
    )


@contextmanager
def fold_control(control: DataFrame, rounds: int = DEFAULT_ROUNDS, lr: float = DEFAULT_LR, wait_for_start: bool = False):
    """C2-C7 + J3 at once: ``(command_rounds, stops, lr_schedule)`` while the context lasts.

    The command fold (the size of the log) and the stops are persisted for the context, so
    that everything derived from them folds the log once.
    """
    log = chunked(control, KEY, ORDER)
    folded, _ = _gated_rounds(log, wait_for_start)
    folded = folded.persist()
    stops = None
    try:
        stops = terminations(log, rounds, wait_for_start, folded).persist()
        yield folded, stops, lr_schedule(log, rounds, lr, wait_for_start, folded, stops)
    finally:
        for df in (stops, folded):
            if df is not None:
                df.unpersist()
