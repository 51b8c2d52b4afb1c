import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import samples_df
from gradmesh.operators import gradients as G
from gradmesh.plans import runs as RN
from gradmesh.plans import training as TR

M1 = [(1, [1, 2], 1), (1, [3, 4], 0), (2, [5, -1], 1)]


def hist(res):
    return sorted(res.history.collect(), key=lambda r: (r.run_id, r.round_id))


def one_run(spark, samples, **options):
    """The many-run engine on one run."""
    return RN.train_runs(samples.withColumn("run_id", F.lit(0).cast("long")), **options)


@pytest.mark.parametrize("engine", ["one", "many"])
def test_m1_mean_of_means_and_divisor_64(spark, engine):
    s = samples_df(spark, M1)
    h = hist(TR.train(s, rounds=2) if engine == "one" else one_run(spark, s, rounds=2))
    assert h[0].grad_norm == pytest.approx(math.sqrt(1.25) / 8, abs=1e-15)
    assert h[0].w == pytest.approx([0.01, -0.005], abs=1e-15)
    assert h[1].w == pytest.approx([0.019637586783690, -0.009956267117157], abs=1e-13)
    assert h[1].grad_norm == pytest.approx(0.135466591101459, abs=1e-13)
    assert [r.responses for r in h] == [2, 2]


def test_m2_converges_in_round_zero(spark):
    res = TR.train(samples_df(spark, [(1, [1], 0), (1, [1], 1)]))
    h = hist(res)
    assert len(h) == 1 and h[0].status == 1 and h[0].grad_norm == 0.0
    s = res.summary.collect()[0]
    assert s.outcome == "converged" and s.final_round == 0


def test_m3_all_failed_rounds_pass_through(spark):
    f = spark.createDataFrame([(1, 0), (2, 0)], "shard_id INT, failed_from_round INT")
    h = hist(TR.train(samples_df(spark, M1), failures=f))
    assert len(h) == 10
    assert all(r.responses == 0 and r.grad_norm is None and r.w == [0.0, 0.0] for r in h)


def test_m4_ragged_missing_slots_are_zero(spark):
    s = samples_df(spark, [(1, [1, 2, 4], 1), (2, [2], 0)])
    h = hist(TR.train(s, rounds=1))
    assert h[0].grad_norm == pytest.approx(0.143205490467370, abs=1e-13)
    assert h[0].w == pytest.approx([-0.0025, 0.005, 0.01], abs=1e-15)
    one = TR.train_one_round(s, [0.0, 0.0, 0.0]).collect()[0]
    assert one.g == pytest.approx([0.25, -0.5, -1.0])


def test_m5_failed_shard_excluded_from_later_rounds(spark):
    f = spark.createDataFrame([(2, 1)], "shard_id INT, failed_from_round INT")
    h = hist(TR.train(samples_df(spark, M1), rounds=2, failures=f))
    g1 = [0.503749968750312, 0.504999958333750]
    w1 = [0.01 - 0.01 * g1[0], -0.005 - 0.01 * g1[1]]
    assert h[1].responses == 1 and h[1].alive_shards == 1
    assert h[1].w == pytest.approx(w1, abs=1e-13)


def test_m6_strict_threshold(spark):
    h = hist(TR.train(samples_df(spark, [(1, [1], 0), (1, [1], 1)]), threshold=0.0))
    assert len(h) == 10 and all(r.status == 0 for r in h)


def test_invariant_to_partitioning_and_duplicates(spark):
    base = samples_df(spark, M1)
    a = hist(TR.train(base, rounds=3))
    b = hist(TR.train(base.repartition(5), rounds=3, partitions=3))
    dup = base.union(base.where(F.col("shard_id") == 1))  # doubles shard 1: same mean
    c = hist(TR.train(dup, rounds=3))
    for x, y, z in zip(a, b, c):
        assert x.w == pytest.approx(y.w, abs=1e-12)
        assert x.w == pytest.approx(z.w, abs=1e-12)


def test_many_runs_equal_single_runs(spark):
    """Runs of their own samples, rates, stops, failures and widths."""
    rows = {0: M1, 1: M1[:1] + [(3, [0.5, 0.25, 4.0], 0)], 2: [(1, [1.0], 0), (1, [1.0], 1)], 3: [(1, [2.0, 1.0], 1)], 4: M1}
    s = spark.createDataFrame([(r, a, [float(v) for v in x], float(y)) for r, rs in rows.items() for a, x, y in rs], "run_id LONG, shard_id INT, x ARRAY<DOUBLE>, y DOUBLE")
    stops = spark.createDataFrame([(0, 3, "terminated"), (3, 0, "waiting"), (4, 4, "running"), (9, 2, "terminated")], "run_id LONG, stop_round INT, outcome STRING")
    schedule = spark.createDataFrame([(0, 1, 0.5), (0, 2, -0.1), (4, 0, 0.2)], "run_id LONG, round_id INT, lr DOUBLE")
    failures = spark.createDataFrame([(4, 1, 2), (4, 2, 1)], "run_id LONG, shard_id INT, failed_from_round INT")
    res = RN.train_runs(s, stops, schedule, rounds=4, failures=failures)
    many, summary = hist(res), {r.run_id: r for r in res.summary.collect()}
    weights = {r.run_id: r.w for r in res.weights.collect()}
    lrs = {0: [0.01, 0.5, -0.1, 0.01], 4: [0.2, 0.01, 0.01, 0.01]}
    ends = {0: (3, "terminated"), 3: (0, "waiting")}
    assert set(summary) == set(rows)
    for run, own in rows.items():
        stop, outcome = ends.get(run, (4, "completed"))
        plan = TR.RunPlan(run, lrs.get(run, [0.01] * 4), stop, outcome)
        f = spark.createDataFrame([(1, 2), (2, 1)], "shard_id INT, failed_from_round INT") if run == 4 else None
        single = TR.train(samples_df(spark, own), rounds=4, plan=plan, failures=f)
        mine, other = [r for r in many if r.run_id == run], hist(single)
        assert [(r.round_id, r.lr, r.responses, r.alive_shards, r.status) for r in mine] == [(r.round_id, r.lr, r.responses, r.alive_shards, r.status) for r in other]
        for x, y in zip(mine, other):
            assert x.w[: len(y.w)] == pytest.approx(y.w, abs=1e-12) and not any(x.w[len(y.w) :])
            assert (x.grad_norm is None) == (y.grad_norm is None) and (x.grad_norm is None or x.grad_norm == pytest.approx(y.grad_norm, abs=1e-12))
        want = single.summary.first()
        assert tuple(summary[run])[:5] == tuple(want)[:5]
        assert weights[run][: len(single.weights.first().w)] == pytest.approx(single.weights.first().w, abs=1e-12)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_nan_and_infinity_propagate(spark, bad):
    s = samples_df(spark, M1 + [(2, [bad, 1.0], 0)])
    for res in (TR.train(s), one_run(spark, s)):
        h = hist(res)
        assert len(h) == 10 and all(r.status == 0 for r in h)
        assert all(math.isnan(r.grad_norm) for r in h[1:])
        assert res.summary.first().outcome == "completed"


def test_features_are_clamped_on_request_only(spark):
    s = samples_df(spark, [(1, [0.01 * j for j in range(70)], 1), (2, [0.02] * 70, 0)])
    for train in (TR.train, lambda s, **o: one_run(spark, s, **o)):
        assert {len(r.w) for r in hist(train(s, rounds=2))} == {70}
        assert hist(train(s, rounds=2))[1].w[69] != 0
        assert {len(r.w) for r in hist(train(s, rounds=2, max_features=64))} == {64}


def test_live_commands(spark, tmp_path):
    path, schema = str(tmp_path / "live"), "seq BIGINT, op STRING, new_lr DOUBLE"
    spark.createDataFrame([(0, "QUERY_PROGRESS", None)], schema).write.parquet(path)
    later = {1: [(1, "ADJUST_LR", 0.5)], 3: [(2, "PAUSE", None), (3, "QUERY_PROGRESS", None), (4, "RESUME", None), (5, "RESUME", None)], 6: [(6, "PAUSE", None)]}

    def arrive(round_id, norm):
        if round_id in later:
            spark.createDataFrame(later[round_id], schema).write.mode("append").parquet(path)

    live = TR.LiveControl(lambda: spark.read.schema(schema).parquet(path), wait_s=0.1, max_waits=2)
    res = TR.train(samples_df(spark, M1), live=live, on_round=arrive)
    assert [r.lr for r in hist(res)] == [0.01, 0.01] + [0.5] * 5
    assert [(a["seq"], a["current_round"], a["current_loss"]) for a in live.answers] == [(0, 0, 0.0)]
    assert tuple(res.summary.first())[1:3] == (7, 7) and res.summary.first().outcome == "stalled"


def test_exclude_failed(spark):
    f = spark.createDataFrame([(2, 1), (1, 5)], "shard_id INT, failed_from_round INT")
    s = samples_df(spark, M1)
    assert [{r.shard_id for r in G.exclude_failed(s, f, r).collect()} for r in (0, 1, 5)] == [{1, 2}, {1}, set()]
    assert G.exclude_failed(s, None, 3).count() == 3


def test_shard_gradient_and_combine(spark):
    s = samples_df(spark, M1)
    sg = {r.shard_id: r.g for r in G.shard_gradient(s, [0.0, 0.0]).collect()}
    assert sg[1] == pytest.approx([0.5, 0.5]) and sg[2] == pytest.approx([-2.5, 0.5])
    cg = G.combined_gradient(G.shard_gradient(s, [0.0, 0.0]), 2).collect()[0]
    assert cg.responses == 2 and cg.g == pytest.approx([-1.0, 0.5])


def test_alive_shards(spark):
    f = spark.createDataFrame([(2, 3)], "shard_id INT, failed_from_round INT")
    a = {r.round_id: r.alive_shards for r in G.alive_shards(samples_df(spark, M1), f, 5).collect()}
    assert a == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1}


def test_blocks_equal_columns(spark, monkeypatch):
    """Ragged and wide samples, null labels and slots, failures: the same by either layout."""
    rng = np.random.default_rng(3)
    rows = [(1 + k % 4, [None if k == 9 else float(v) for v in rng.standard_normal(5 * (1 + k % 4))], None if k == 17 else float(k % 2)) for k in range(90)]
    s = spark.createDataFrame(rows, "shard_id INT, x ARRAY<DOUBLE>, y DOUBLE")
    failures = spark.createDataFrame([(2, 1), (4, 2)], "shard_id INT, failed_from_round INT")
    blocks = hist(TR.train(s, rounds=4, lr=0.5, failures=failures))
    with TR.prepared(s, 4) as prep:
        assert prep.blocks and sorted({r.width for r in prep.df.collect()}) == [5, 10, 15, 20]
        assert sum(len(r.x) for r in prep.df.collect()) == 8 * sum(len(x) for _, x, _ in rows)  # stored slots only
    monkeypatch.setattr(TR, "NARROW", 10**6)
    for a, b in zip(blocks, hist(TR.train(s, rounds=4, lr=0.5, failures=failures)), strict=True):
        assert (a.responses, a.alive_shards, a.status) == (b.responses, b.alive_shards, b.status)
        assert a.grad_norm == pytest.approx(b.grad_norm, rel=1e-12) and a.w == pytest.approx(b.w, rel=1e-12, abs=1e-15)
