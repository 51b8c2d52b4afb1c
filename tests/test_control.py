"""Control log: fixed cases, and all operators against a plain sequential reading of random logs."""

import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import samples_df
from gradmesh.operators import control as C
from gradmesh.operators.scan import CHUNK, Running, chunked, running
from gradmesh.plans import runs as RN
from gradmesh.plans import training as TR
from gradmesh.sources.console import OWN_FILES, console_stream, write_consoles
from gradmesh.streaming.control_stream import run_to_table

SCHEMA = "run_id BIGINT, seq BIGINT, op STRING, new_lr DOUBLE"
C1 = [
    ("ADJUST_LR", 0.05), ("PAUSE", None), ("ADJUST_LR", 0.5), ("PAUSE", None), ("RESUME", None),
    ("QUERY_PROGRESS", None), ("RESUME", None), ("ADJUST_LR", 0.02), ("TERMINATE", None), ("ADJUST_LR", 0.9),
]


def ctl_df(spark, events, run=1):
    return spark.createDataFrame([(run, i, op, lr) for i, (op, lr) in enumerate(events)], SCHEMA)


def test_c1_rounds_schedule_and_stop(spark):
    ctl = ctl_df(spark, C1)
    rounds = {r.seq: r.round_id for r in C.command_rounds(ctl).collect()}
    assert rounds == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 3, 7: 4, 8: 5}
    stop = C.terminations(ctl).collect()[0]
    assert (stop.stop_round, stop.outcome) == (5, "terminated")
    lrs = [r.lr for r in sorted(C.lr_schedule(ctl).collect(), key=lambda r: r.round_id)]
    assert lrs == [0.05, 0.05, 0.05, 0.05, 0.02]


def progress_of(spark, ctl, samples, **options):
    with C.fold_control(ctl, **options) as (folded, stops, schedule):
        res = RN.train_runs(samples.withColumn("run_id", F.lit(1).cast("long")), stops, schedule)
        return C.progress(folded, schedule, res.history, res.summary).collect(), res


def test_c1_progress_against_training(spark):
    ctl = ctl_df(spark, C1)
    s = samples_df(spark, [(1, [1, 2], 1), (1, [3, 4], 0), (2, [5, -1], 1)])
    p, res = progress_of(spark, ctl, s)
    h = sorted(res.history.collect(), key=lambda r: r.round_id)
    assert len(h) == 5 and [r.lr for r in h] == [0.05, 0.05, 0.05, 0.05, 0.02]
    assert len(p) == 1
    assert (p[0].current_round, p[0].current_lr) == (1, 0.05)
    assert p[0].current_loss == pytest.approx(h[1].grad_norm)
    assert res.summary.collect()[0].outcome == "terminated"
    single = TR.train(s, plan=TR.plan_from_control(ctl))
    assert [r.w for r in sorted(single.history.collect(), key=lambda r: r.round_id)] == [pytest.approx(r.w, abs=1e-12) for r in h]
    with pytest.raises(ValueError):
        TR.plan_from_control(ctl.union(ctl_df(spark, C1, run=2)))


def test_c1_with_start_gate(spark):
    ctl = ctl_df(spark, C1)
    stop = C.terminations(ctl, wait_for_start=True).collect()[0]
    assert (stop.stop_round, stop.outcome) == (3, "terminated")
    lrs = [r.lr for r in sorted(C.lr_schedule(ctl, wait_for_start=True).collect(), key=lambda r: r.round_id)]
    assert lrs == [0.01, 0.01, 0.02]
    p, _ = progress_of(spark, ctl, samples_df(spark, [(1, [1, 2], 1), (2, [5, -1], 1)]), wait_for_start=True)
    assert [(r.current_round, r.current_lr, r.current_loss) for r in p] == [(0, 0.01, 0.0)]


def test_c1_variants_stall_and_early_terminate(spark):
    cut = C.terminations(ctl_df(spark, C1[:4])).collect()[0]
    assert (cut.stop_round, cut.outcome) == (1, "stalled")
    early = C1[:2] + [("TERMINATE", None)] + C1[3:]
    t = C.terminations(ctl_df(spark, early)).collect()[0]
    assert (t.stop_round, t.outcome) == (1, "terminated")
    waiting = C.terminations(ctl_df(spark, [("PAUSE", None)]), wait_for_start=True).collect()[0]
    assert (waiting.stop_round, waiting.outcome) == (0, "waiting")


def test_c2_decode_command_lines(spark):
    vals = ["2", "2", "2", "0.5", "4", "abc", "2", "-1", "1", "-3", "5"]
    lines = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "run_id BIGINT, seq BIGINT, value STRING")
    got = [(r.op, r.new_lr) for r in sorted(C.decode_commands(chunked(lines, "run_id", "seq", 3)).collect(), key=lambda r: r.seq)]
    assert got == [("ADJUST_LR", 2.0), ("ADJUST_LR", 0.5), ("RESUME", None), (None, None),
                   ("ADJUST_LR", -1.0), ("QUERY_PROGRESS", None)]


# ---- a plain sequential reading, written from the survey's description --------------------


def read_lines(values):
    """What the console makes of its lines, one by one."""
    out, k = [], 0
    while k < len(values):
        m = re.match(r"\s*([+-]?\d+)", values[k])
        code, at = int(m[1]) if m else 0, k
        if code < 0:
            break
        if code == 2:
            if k + 1 == len(values):
                break
            k += 1
            m = re.match(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", values[k])
            out.append((at, "ADJUST_LR", float(m[0]) if m else 0.0))
        else:
            out.append((at, {1: "QUERY_PROGRESS", 3: "PAUSE", 4: "RESUME", 5: "TERMINATE"}.get(code), None))
        if code == 5:
            break
        k += 1
    return out


def read_log(events, rounds=10, gated=False):
    """``(rows, stop round, outcome, rates)`` of ``events(seq, op, new_lr)``."""
    events = [e for e in events if e[1]]
    if gated:
        opening = next((k for k, e in enumerate(events) if e[1] in ("RESUME", "TERMINATE")), None)
        if opening is None:
            return [], 0, "waiting", []
        if events[opening][1] == "TERMINATE":
            return [], 0, "terminated", []
        events = events[opening + 1 :]
    rows, boundary, paused, rate, rates, stop, outcome = [], 0, False, 0.01, {}, None, "running"
    for seq, op, new in events:
        was = paused
        if not was:
            at, boundary = boundary, boundary + 1
        if op == "PAUSE":
            paused = True
        elif op == "RESUME":
            paused = False
        elif op == "ADJUST_LR" and not was:
            rate = new
        rates[at] = rate
        rows.append((seq, op, at, was, not was or op in ("RESUME", "TERMINATE"), rate))
        if op == "TERMINATE":
            stop, outcome = at, "terminated"
            break
    if outcome == "running" and paused:
        stop, outcome = boundary - 1, "stalled"
    if stop is None or stop >= rounds:
        stop, outcome = rounds, "running"
    lrs, rate = [], 0.01
    for r in range(stop):
        rate = rates.get(r, rate)
        lrs.append(rate)
    return rows, stop, outcome, lrs


def random_logs(n_runs=120, seed=3):
    """Sparse and dense sequence numbers, long pauses, TERMINATE inside one, empty rates."""
    rnd = random.Random(seed)
    ops = ["PAUSE", "RESUME", "ADJUST_LR", "QUERY_PROGRESS", "TERMINATE"]
    rows = []
    for run in range(n_runs):
        seq, step = rnd.choice([-50, 0, 10**12]), rnd.choice([1, 5, 1_000_003])
        weights = rnd.choice([[3, 3, 3, 3, 1], [1, 1, 4, 4, 0.1], [9, 1, 2, 2, 0.5]])
        for _ in range(rnd.randint(1, 40)):
            seq += rnd.randint(1, step)
            op = rnd.choices(ops, weights)[0]
            rows.append((run, seq, op, round(rnd.uniform(-1, 1), 3) if op == "ADJUST_LR" else None))
    rnd.shuffle(rows)
    return rows


def by_run(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(tuple(r[1:]))
    return out


@pytest.mark.parametrize("chunks", [None, 40])
@pytest.mark.parametrize("gated", [False, True])
def test_fold_equals_sequential_reading(spark, chunks, gated):
    rows = random_logs()
    ctl = spark.createDataFrame(rows, SCHEMA)
    ctl = chunked(ctl, "run_id", "seq", chunks) if chunks else ctl
    want = {run: read_log(events, gated=gated) for run, events in by_run(rows).items()}
    with C.fold_control(ctl, wait_for_start=gated) as (folded, stops, schedule):
        got = by_run([(r.run_id, r.seq, r.op, r.round_id, r.paused_before, r.effective) for r in folded.collect()])
        assert got == {run: [x[:5] for x in w[0]] for run, w in want.items() if w[0]}
        assert {r.run_id: (r.stop_round, r.outcome) for r in stops.collect()} == {run: w[1:3] for run, w in want.items()}
        lrs = by_run([(r.run_id, r.round_id, r.lr) for r in schedule.collect()])
        assert lrs == {run: list(enumerate(w[3])) for run, w in want.items() if w[3]}


@pytest.mark.parametrize("chunks", [None, 30])
def test_decode_equals_sequential_reading(spark, chunks):
    rnd = random.Random(8)
    values = ["1", "2", "2", "2", "3", "4", "0.5", "abc", "7", " 2x", "-0.25", "1e-3"]
    logs = {run: [rnd.choice(["2"] if run % 7 == 0 and k < 30 else values) for k in range(rnd.randint(1, 60))] for run in range(150)}
    for run, log in logs.items():
        if run % 5 == 0:
            log.insert(rnd.randrange(len(log) + 1), rnd.choice(["5", "-1"]))
    rows = [(run, 3 + k * 1_000_003, v) for run, log in logs.items() for k, v in enumerate(log)]
    lines = spark.createDataFrame(rows, "run_id BIGINT, seq BIGINT, value STRING")
    lines = chunked(lines, "run_id", "seq", chunks) if chunks else lines
    got = by_run([(r.run_id, r.seq, r.op, r.new_lr) for r in C.decode_commands(lines).collect()])
    want = {run: [(3 + at * 1_000_003, op, lr) for at, op, lr in read_lines(log)] for run, log in logs.items()}
    assert got == {run: w for run, w in want.items() if w}


def test_segmented_scan_equals_plain_window(spark):
    df = spark.createDataFrame([(r, s, float(s % 7)) for r, s, _, _ in random_logs(20)], "k BIGINT, s BIGINT, v DOUBLE")
    specs = [Running("cs", "sum", F.col("v")), Running("mx", "max", F.col("v") * -1, inclusive=False), Running("mn", "min", F.col("v"))]
    got = running(chunked(df, "k", "s", 25), "k", "s", specs)
    w = Window.partitionBy("k").orderBy("s")
    now, was = (w.rowsBetween(Window.unboundedPreceding, n) for n in (0, -1))
    ref = df.withColumns({"cs": F.sum("v").over(now), "mx": F.max(F.col("v") * -1).over(was), "mn": F.min("v").over(now)})
    cols = ["k", "s", "cs", "mx", "mn"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, ref.select(cols).collect()))


def test_chunks_are_even_for_one_sparse_run(spark):
    """One run holds every row, far apart: no chunk gets much more than its share."""
    df = spark.range(20_000).selectExpr("1L AS run_id", "id * 1000003 AS seq", "'QUERY_PROGRESS' AS op", "CAST(NULL AS DOUBLE) AS new_lr")
    cut = chunked(df, "run_id", "seq", 16)
    sizes = [r["count"] for r in cut.groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 2.5 * 20_000 / 16
    rounds = C.command_rounds(cut).agg(F.count("*"), F.max("round_id"), F.countDistinct("round_id")).first()
    assert tuple(rounds) == (20_000, 19_999, 20_000)


@pytest.mark.parametrize("gated", [False, True])
def test_stream_equals_sequential_reading(spark, tmp_path, gated):
    """Micro-batches cut anywhere, pauses across them, a restart between."""
    rows = [(run, k, op, lr) for run, events in by_run(random_logs(40, seed=11)).items() for k, (_, op, lr) in enumerate(events)]
    src, base = str(tmp_path / "src"), str(tmp_path / "query")
    out = None
    for low, high in ((0, 3), (3, 4), (4, 15), (15, 1000)):
        spark.createDataFrame([r for r in rows if low <= r[1] < high], SCHEMA).write.mode("append").parquet(src)
        time.sleep(0.1)
        out = run_to_table(spark.readStream.schema(SCHEMA).parquet(src), spark, base, wait_for_start=gated)
    got = by_run([(r.run_id, r.seq, r.op, r.round_id, r.paused_before, r.effective, r.lr) for r in out.collect()])
    want = {run: read_log(events, gated=gated)[0] for run, events in by_run(rows).items()}
    assert got == {run: w for run, w in want.items() if w}


def test_line_stream_equals_sequential_reading(spark, tmp_path):
    """Console lines cut anywhere, also between a "2" and its value."""
    rnd = random.Random(21)
    logs = {run: [rnd.choice(["2", "2", "1", "3", "4", "0.5", "x", "-0.5"]) for _ in range(rnd.randint(1, 25))] for run in range(60)}
    for run in range(0, 60, 4):
        logs[run].insert(rnd.randrange(len(logs[run]) + 1), rnd.choice(["5", "-1"]))
    rows = [(run, k, v) for run, log in logs.items() for k, v in enumerate(log)]
    schema = "run_id BIGINT, seq BIGINT, value STRING"
    src, base, out = str(tmp_path / "src"), str(tmp_path / "query"), None
    for low, high in ((0, 4), (4, 5), (5, 100)):
        spark.createDataFrame([r for r in rows if low <= r[1] < high], schema).write.mode("append").parquet(src)
        out = run_to_table(spark.readStream.schema(schema).parquet(src), spark, base)
    got = by_run([(r.run_id, r.seq, r.op, r.round_id, r.paused_before, r.effective, r.lr) for r in out.collect()])
    want = {run: read_log(read_lines(log))[0] for run, log in logs.items()}
    assert got == {run: w for run, w in want.items() if w}


def test_console_files_equal_sequential_reading(spark, tmp_path):
    """Raw text files per run, by folder and by name, lines numbered across micro-batches."""
    rnd = random.Random(5)
    logs = {run: [rnd.choice(["2", "2", "1", "3", "4", "0.5", " x", "-0.5", ""]) for _ in range(rnd.randint(1, 20))] for run in range(12)}
    src, base, out = tmp_path / "src", str(tmp_path / "query"), None
    src.mkdir()
    (src / "notes.txt").write_text("5\n5\n")  # of no run
    for batch, (low, cut, high) in enumerate(((0, 2, 4), (4, 5, 7), (7, 9, 99))):
        for run, log in logs.items():
            for k, lines in enumerate((log[low:cut], log[cut:high])):
                if lines and run % 2:
                    (src / f"run_{run}-{batch}{k}.txt").write_text("".join(f"{x}\n" for x in lines))
                elif lines:
                    (src / f"run_id={run}").mkdir(exist_ok=True)
                    (src / f"run_id={run}" / f"part-{batch}-{k}.txt").write_text("\n".join(lines))
        out = run_to_table(console_stream(spark, str(src)), spark, base)
    got = by_run([(r.run_id, r.seq, r.op, r.round_id, r.paused_before, r.effective, r.lr) for r in out.collect()])
    want = {run: read_log(read_lines(log))[0] for run, log in logs.items()}
    assert got == {run: w for run, w in want.items() if w}


def test_consoles_share_files(spark, tmp_path):
    """Files don't grow in number with the runs; a hot run's lines keep their order in both kinds."""
    rnd = random.Random(8)
    logs = {run: [rnd.choice(["2", "1", "3", "4", "0.5", " x", "a\tb", ""]) for _ in range(40 if run < 20 else rnd.randint(1, 9))] for run in range(-3, 300)}
    src, base, out = str(tmp_path / "src"), str(tmp_path / "query"), None
    for low, high in ((0, 3), (3, 99)):
        rows = [(run, 7 * k, x) for run, log in logs.items() for k, x in enumerate(log) if low <= k < high]
        write_consoles(spark.createDataFrame([*rows, (None, 1, "1")], "run_id BIGINT, seq BIGINT, value STRING").repartition(5), src)
        out = run_to_table(console_stream(spark, src), spark, base)
    got = by_run([(r.run_id, r.seq, r.op, r.round_id, r.paused_before, r.effective, r.lr) for r in out.collect()])
    want = {run: read_log(read_lines(log))[0] for run, log in logs.items()}
    assert got == {run: w for run, w in want.items() if w}
    files = [p for p in (tmp_path / "src").rglob("part-*") if p.is_file()]
    assert len({p.parent for p in files}) <= 2 * OWN_FILES + 1 and len(files) < 100


def test_a_batch_is_decoded_and_folded_once(spark):
    """Rows and carry of a micro-batch read what was folded, not the log again."""
    from gradmesh.streaming.control_stream import CARRIES, decode_batch, fold_batch

    lines = spark.createDataFrame([(1, k, x) for k, x in enumerate(["2", "0.5", "3", "1", "4", "2"])], "run_id BIGINT, seq BIGINT, value STRING")
    events, left = decode_batch(lines, spark.createDataFrame([], CARRIES["lines"]))
    rows, carry = fold_batch(events, spark.createDataFrame([], CARRIES["runs"]))
    for df in (events, left, rows, carry):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in left.collect()] == [(1, 5, False)]
    assert sorted((r.seq, r.op, r.round_id, r.lr) for r in rows.collect()) == [(0, "ADJUST_LR", 0, 0.5), (2, "PAUSE", 1, 0.5), (3, "QUERY_PROGRESS", 1, 0.5), (4, "RESUME", 1, 0.5)]
    assert [tuple(r) for r in carry.collect()] == [(1, False, 2, 0.5, False, True)]
