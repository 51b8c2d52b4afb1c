"""Live control: commands that arrive while runs train, against a queue read one by one."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import samples_df
from gradmesh.plans import runs as RN
from gradmesh.plans import training as TR
from gradmesh.plans.live import LiveRuns, train_live_runs
from gradmesh.streaming.carry import Carry
from gradmesh.streaming.control_stream import CARRIES, Arrivals, run_to_table

SCHEMA = "run_id BIGINT, seq BIGINT, op STRING, new_lr DOUBLE"
ROWS = [(1, [1, 2], 1), (1, [3, 4], 0), (2, [5, -1], 1), (2, [0.5, 1], 0)]


def simulate(events, rounds, gated, polls):
    """``(rates by round, stop, outcome, answers)`` of one run; events are ``(seq, op, lr, poll)``."""
    queue, rates, answers, rate, shut, paused, b = [], [], [], 0.01, gated, False, 0
    for at in range(polls):
        queue += [e for e in events if e[3] == at]
        if b == rounds:
            break
        while shut and queue:
            op = queue.pop(0)[1]
            if op == "TERMINATE":
                return rates, b, "terminated", answers
            shut = op != "RESUME"
        if shut:
            continue
        if not paused and queue:
            seq, op, lr, _ = queue.pop(0)
            if op == "TERMINATE":
                return rates, b, "terminated", answers
            if op == "QUERY_PROGRESS":
                answers.append((seq, max(b - 1, 0), rate))
            if op == "ADJUST_LR" and lr is not None:
                rate = lr
            paused = op == "PAUSE"
        while paused and queue:
            op = queue.pop(0)[1]
            if op == "TERMINATE":
                return rates, b, "terminated", answers
            paused = op != "RESUME"
        if not paused:
            rates.append(rate)
            b += 1
    return rates, b, "completed" if b == rounds else "waiting" if shut else "stalled", answers


def random_events(rnd):
    ops = ["PAUSE", "RESUME", "ADJUST_LR", "QUERY_PROGRESS", "TERMINATE"]
    out, at = [], 0
    for seq in range(rnd.randint(0, 9)):
        at = min(at + rnd.choice([0, 0, 0, 1, 1, 3]), 5)
        op = rnd.choices(ops, [2, 3, 3, 4, 0.3])[0]
        out.append((seq * 7, op, rnd.choice([None, 0.5, 0.02, -0.1]) if op == "ADJUST_LR" else None, at))
    return out


@pytest.mark.parametrize("gated", [False, True])
def test_many_runs_equal_queues(spark, gated):
    rnd = random.Random(4 + gated)
    logs = {run: random_events(rnd) for run in range(60)}
    samples = samples_df(spark, ROWS).crossJoin(spark.range(60).withColumnRenamed("id", "run_id"))
    last = max(e[3] for log in logs.values() for e in log)

    def poll(at):
        new = [(run, *e[:3]) for run, log in logs.items() for e in log if e[3] == at] + [(999, at, "QUERY_PROGRESS", None)]
        return spark.createDataFrame(new, SCHEMA) if at <= last else None

    res = train_live_runs(samples, LiveRuns(poll, wait_for_start=gated, wait_s=0), rounds=4)
    history, summary, answers = res.history.collect(), {r.run_id: r for r in res.summary.collect()}, res.answers.collect()
    norms = {(r.run_id, r.round_id): r.grad_norm for r in history}
    for run, log in logs.items():
        rates, stop, outcome, asked = simulate(log, 4, gated, last + 9)
        assert [r.lr for r in sorted((r for r in history if r.run_id == run), key=lambda r: r.round_id)] == rates, run
        assert (summary[run].final_round, summary[run].outcome, summary[run].rounds_run) == (stop, outcome, len(rates)), run
        got = sorted((a.seq, a.current_round, a.current_lr) for a in answers if a.run_id == run)
        assert got == asked, run
    taken = {(run, seq): b for run, log in logs.items() for seq, b, _ in simulate(log, 4, gated, last + 9)[3]}
    for a in answers:
        assert (a.total_rounds, a.active_workers, a.failed_workers) == (4, 2, 0) and (a.run_id, a.seq) in taken
        assert a.current_loss in (0.0, norms.get((a.run_id, a.current_round)))
        assert (a.current_loss == 0.0) <= (a.current_round == 0)


def test_many_runs_equal_the_single_run(spark):
    """Failures, convergence and losses: the same as one run under its own live control."""
    events = [(0, "QUERY_PROGRESS", None, 0), (1, "ADJUST_LR", 0.3, 1), (2, "QUERY_PROGRESS", None, 3)]
    s = samples_df(spark, ROWS)
    failures = spark.createDataFrame([(5, 2, 2)], "run_id BIGINT, shard_id INT, failed_from_round INT")
    poll = lambda at: spark.createDataFrame([(5, *e[:3]) for e in events if e[3] == at], SCHEMA)
    many = train_live_runs(s.withColumn("run_id", F.lit(5).cast("long")), LiveRuns(poll), rounds=5, failures=failures, part_rows=1)
    now = []
    live = TR.LiveControl(lambda: spark.createDataFrame([e[:3] for e in events if e[3] <= len(now)], "seq BIGINT, op STRING, new_lr DOUBLE"))
    one = TR.train(s, rounds=5, live=live, failures=failures.drop("run_id"), on_round=lambda r, norm: now.append(r))
    for a, b in zip(sorted(many.history.collect(), key=lambda r: r.round_id), sorted(one.history.collect(), key=lambda r: r.round_id), strict=True):
        assert (a.lr, a.responses, a.alive_shards) == (b.lr, b.responses, b.alive_shards) and a.w == pytest.approx(b.w) and a.grad_norm == pytest.approx(b.grad_norm)
    got, want = (sorted(r.answers.drop("run_id").collect()) for r in (many, one))
    assert [x[:6] for x in got] == [x[:6] for x in want] and [x[6] for x in got] == pytest.approx([x[6] for x in want])
    assert [(r.seq, r.current_round, r.active_workers, r.failed_workers) for r in want] == [(0, 0, 2, 0), (2, 2, 1, 1)]


def test_samples_stay_where_they_are(spark):
    """No exchange above the samples in a round, and a hot run in several parts."""
    s = samples_df(spark, ROWS * 50).withColumn("run_id", F.when(F.rand(1) < 0.8, 1).otherwise(2).cast("long"))
    with RN.laid_out(s, 2, str(TR.__name__) and _fresh(spark), part_rows=20) as laid:
        parts = {(r.run_id, r.part): r["count"] for r in laid.flat.groupBy("run_id", "part").count().collect()}
        assert len([k for k in parts if k[0] == 1]) > 5 and max(parts.values()) < 40
        active = laid.runs.select("run_id", F.lit(1).alias("round_id"), F.array(F.lit(0.1), F.lit(0.2)).alias("w"), F.lit(0.01).alias("lr"), F.lit(2).cast("bigint").alias("alive_shards"), "parts")
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                done = RN.one_round(laid, active, 1e-4, 64)
                done.collect()
                plan = done._jdf.queryExecution().executedPlan().toString()
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            lines = plan.split("== Initial Plan ==")[0].splitlines()
            scan = next(k for k, x in enumerate(lines) if "InMemoryTableScan" in x)
            depth = lambda x: len(x) - len(x.lstrip(" :+-*|"))
            above, level = [], depth(lines[scan])
            for x in reversed(lines[:scan]):
                if depth(x) < level:
                    above.append(x.strip())
                    level = depth(x)
            first = next(k for k, x in enumerate(above) if "Exchange" in x)
            assert any("HashAggregate" in x and "partial_sum" in x for x in above[:first]), above


def test_rounds_do_not_sort_samples(spark):
    """They are laid out in the order of the round's join."""
    s = samples_df(spark, ROWS * 50).withColumn("run_id", F.floor(F.rand(1) * 9))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with RN.laid_out(s, 2, _fresh(spark), part_rows=20) as laid:
            active = laid.runs.select("run_id", F.lit(1).alias("round_id"), F.array(F.lit(0.1), F.lit(0.2)).alias("w"), F.lit(0.01).alias("lr"), F.lit(2).cast("bigint").alias("alive_shards"), "parts")
            done = RN.one_round(laid, active, 1e-4, 64)
            done.collect()
            lines = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(k for k, x in enumerate(lines) if "InMemoryTableScan" in x)
    join = max(k for k, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
    assert join < scan and not any(" Sort [" in x for x in lines[join:scan])


def _fresh(spark):
    from gradmesh.session import shared_path

    return shared_path(spark, "laid")


def live_rows(spark, rows, **options):
    live = TR.LiveControl(lambda: spark.createDataFrame(rows, "seq BIGINT, op STRING, new_lr DOUBLE"), **options)
    return TR.train(samples_df(spark, ROWS), live=live, rounds=5)


def test_single_run_gate_answers_and_empty_rate(spark):
    seen = []
    rows = [(0, "ADJUST_LR", 9.0), (1, "RESUME", None), (2, "ADJUST_LR", None), (3, "ADJUST_LR", 0.2), (4, "PAUSE", None), (5, "QUERY_PROGRESS", None), (6, "RESUME", None), (7, "QUERY_PROGRESS", None)]
    res = live_rows(spark, rows, wait_for_start=True, on_answer=seen.append)
    h = sorted(res.history.collect(), key=lambda r: r.round_id)
    assert [r.lr for r in h] == [0.01, 0.2, 0.2, 0.2, 0.2]
    a = res.answers.collect()
    assert [(r.seq, r.total_rounds, r.current_round, r.current_lr, r.active_workers) for r in a] == [(7, 5, 2, 0.2, 2)]
    assert a[0].current_loss == pytest.approx(h[2].grad_norm) and [x["seq"] for x in seen] == [7]
    for rows, outcome in (([(0, "PAUSE", None)], "waiting"), ([(0, "TERMINATE", None)], "terminated")):
        s = live_rows(spark, rows, wait_for_start=True).summary.first()
        assert (s.outcome, s.final_round, s.rounds_run) == (outcome, 0, 0)


def test_arrivals_from_console_lines(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "run_id BIGINT, seq BIGINT, value STRING"
    came = Arrivals(spark, lambda: spark.readStream.schema(schema).parquet(src), str(tmp_path / "arrivals"))
    got = []
    for lines in ([(1, 0, "1"), (1, 1, "2")], [], [(1, 2, "0.5"), (2, 0, "5"), (2, 1, "1")]):
        spark.createDataFrame(lines, schema).write.mode("append").parquet(src)
        new = came(0)
        got.append(sorted(tuple(r) for r in new.collect()) if new is not None else [])
    assert got == [[(1, 0, "QUERY_PROGRESS", None)], [], [(1, 1, "ADJUST_LR", 0.5), (2, 0, "TERMINATE", None)]]


def test_carry_follows_the_batch(spark, tmp_path):
    """100,000 idle runs: a batch writes its own runs, and what it reads back is the newest."""
    base = str(tmp_path / "carry")
    carry = Carry(spark, base, CARRIES["runs"])
    rows = lambda low, high, at: spark.range(low, high).selectExpr("id AS run_id", "false AS paused", f"{at}L AS boundary", "0.5D AS lr", "false AS terminated", "true AS opened")
    carry.write(0, rows(0, 100_000, 0))
    sizes = []
    for batch in range(1, 12):
        before = folder_bytes(base)
        carry.write(batch, rows(10 * batch, 10 * batch + 15, batch))
        sizes.append(folder_bytes(base) - before)
    assert max(sizes) < 60_000 < before
    assert len(carry.segments(11)) <= 6 and len([d for d in os.listdir(base) if d.startswith("batch")]) <= 10
    got = {r.run_id: r.boundary for r in carry.before(12, spark.createDataFrame([(5,), (12,), (22,), (119,), (120,), (10**6,)], "run_id BIGINT")).collect()}
    assert got == {5: 0, 12: 1, 22: 2, 119: 11, 120: 11}
    again = [(r.run_id, r.boundary) for r in carry.all(11).where("run_id < 200").orderBy("run_id").collect()]
    carry.write(11, rows(110, 125, 11))  # repeated
    assert [(r.run_id, r.boundary) for r in carry.all(11).where("run_id < 200").orderBy("run_id").collect()] == again
    assert carry.all(11).count() == 100_000


def folder_bytes(base):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(base) for f in names)


def test_stream_ignores_an_empty_rate(spark, tmp_path):
    """An ADJUST_LR without a rate leaves the one before in force, also within a batch."""
    src = str(tmp_path / "src")
    rows = [(1, 0, "ADJUST_LR", 0.5), (1, 1, "ADJUST_LR", None), (1, 2, "QUERY_PROGRESS", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    out = run_to_table(spark.readStream.schema(SCHEMA).parquet(src), spark, str(tmp_path / "query"))
    assert [r.lr for r in sorted(out.collect(), key=lambda r: r.seq)] == [0.5, 0.5, 0.5]
