import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gradmesh.functions.numeric import lenient_double, lenient_int
from gradmesh.plans import training as TR
from gradmesh.sources import generator as GEN
from gradmesh.sources import text as TX


def lines_df(spark, shard, values):
    rows = [(shard, ("f", 0, i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "shard_id INT, pos STRUCT<file: STRING, file_block_start: BIGINT, id: BIGINT>, value STRING")


def parse(spark, shard, values):
    samples, rejects, schema = TX.lines_to_samples(lines_df(spark, shard, values))
    good = sorted((r.x, r.y) for r in samples.collect())
    bad = sorted(r.value for r in rejects.collect())
    sch = {r.shard_id: (r.width, r.accepted) for r in schema.collect()}
    return good, bad, sch


def test_p1_width_comments_blanks_and_rejects(spark):
    vals = ["# c", "", "1.0 2.0 1.0", "3.0\t4.0  0.0", "  ", "5 x 1", "7 8", "9 9 1 9"]
    good, bad, sch = parse(spark, 1, vals)
    assert sch == {1: (3, True)}
    assert good == [([1.0, 2.0], 1.0), ([3.0, 4.0], 0.0), ([5.0, 0.0], 1.0), ([9.0, 9.0], 1.0)]
    assert bad == ["  ", "7 8"]


def test_p2_comment_only_shard_is_absent(spark):
    good, bad, sch = parse(spark, 1, ["# only"])
    assert good == [] and sch == {}


def test_p3_crlf(spark):
    good, bad, sch = parse(spark, 1, ["0.5 0.25 0\r", "\r"])
    assert sch == {1: (3, True)}
    assert good == [([0.5, 0.25], 0.0)] and bad == ["\r"]


def test_p4_single_column_shard_rejected(spark):
    good, bad, sch = parse(spark, 1, ["7", "8"])
    assert sch == {1: (1, False)} and good == [] and sorted(bad) == ["7", "8"]


def test_schema_of_many_splits_neither_sorts_lines_nor_deals_them_by_shard(spark, tmp_path):
    """The first line with a token decides, whatever splits and ids; no task gets a shard's lines."""
    rows = [(1, ("b", 0, 1), "9 9 9 9"), (1, ("a", 64, 2**62), "8 8"), (1, ("a", 0, 2**62 + 5), " \t "), (1, ("a", 0, 2**62 + 7), "1 2\t 3 "), (1, ("a", 0, 2**62 + 9), "7"), (2, ("a", 0, 0), "\t"), (3, ("z", 0, 0), "\r 1")]
    lines = spark.createDataFrame(rows, "shard_id INT, pos STRUCT<file: STRING, file_block_start: BIGINT, id: BIGINT>, value STRING")
    found = TX.shard_schema(lines)
    assert sorted(map(tuple, found.collect())) == [(1, 3, 5, True), (2, 0, 1, False), (3, 2, 1, True)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "HashAggregate" in [x for x in plan.splitlines() if "Aggregate(" in x][-1]  # above the lines
    spark.conf.set("spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin", "0.9")  # few shards, many partitions
    try:
        samples, rejects, _ = TX.lines_to_samples(lines)
        for df in (samples, rejects):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin")


def test_lenient_numbers(spark):
    toks = ["1e", "1.5e3x", "inf", "-Infinity", "abc", ".5", "+3", "1.", "-", "0x1A", " 7", "2.5\r", "1.2.3", "+-5", "1d", "", "5-"]
    df = spark.createDataFrame([(t,) for t in toks], "t STRING")
    got = [r.v for r in df.select(lenient_double("t").alias("v")).collect()]
    assert got[:3] == [1.0, 1500.0, float("inf")]
    assert got[3] == float("-inf")
    assert got[4:] == [0.0, 0.5, 3.0, 1.0, 0.0, 0.0, 7.0, 2.5, 1.2, 0.0, 1.0, 0.0, 5.0]
    nans = spark.createDataFrame([("NaN",), ("-nan",), ("+NAN",), ("nanx",)], "t STRING").select(lenient_double("t").alias("v")).collect()
    assert all(r.v != r.v for r in nans)
    ints = spark.createDataFrame([(t,) for t in ["2", " -3x", "abc", "2.9", "+5"]], "t STRING")
    assert [r.v for r in ints.select(lenient_int("t").alias("v")).collect()] == [2, -3, 0, 2, 5]


def test_read_shard_files(spark):
    d = tempfile.mkdtemp(prefix="gm-shards-")
    with open(os.path.join(d, "shard_1.txt"), "w") as f:
        f.write("# header\n1 2 1\n3 4 0\n")
    with open(os.path.join(d, "shard_2.txt"), "w") as f:
        f.write("5 -1 1\n7 8\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("1 1 1\n")
    samples, rejects, schema = TX.load_shards(spark, os.path.join(d, "*.txt"))
    got = sorted((r.shard_id, r.x, r.y) for r in samples.collect())
    assert got == [(1, [1.0, 2.0], 1.0), (1, [3.0, 4.0], 0.0), (2, [5.0, -1.0], 1.0)]
    bad = sorted(((r.shard_id, r.value, r.reason) for r in rejects.collect()), key=str)
    assert bad == [(2, "7 8", "short_row"), (None, "1 1 1", "no_shard_id")]
    assert sorted(r.shard_id for r in schema.collect()) == [1, 2]
    clamped, _, _ = TX.load_shards(spark, os.path.join(d, "*.txt"), max_features=1)
    assert {len(r.x) for r in clamped.collect()} == {1}


def test_named_shard_folders_and_misnamed_files(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"{i} {k} 1", k) for i in (1, 2) for k in range(5)], "shard_id INT, value STRING, pos INT")
    paths = GEN.write_named_shards(lines, str(tmp_path))
    lines = lines.drop("pos")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["shard_1.txt", "shard_2.txt"]
    (tmp_path / "shard_3.txt.bak").write_text("3 3 1\n")
    back = TX.read_shards(spark, [*paths, str(tmp_path / "shard_3.txt.bak")])
    assert sorted((r.shard_id, r.value) for r in back.where("shard_id IS NOT NULL").collect()) == sorted(map(tuple, lines.collect()))
    assert [r.value for r in back.where("shard_id IS NULL").collect()] == ["3 3 1"]


def test_a_thousand_shards_are_written_in_one_scan(spark, tmp_path):
    """Each in its order, a large one by several tasks; the input is read once (and sampled)."""
    lines = spark.range(0, 30_000, 1, 6).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1000 END AS INT) AS shard_id", "CAST(id AS STRING) AS value", "30000 - id AS pos")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else Spark makes one part of so few rows
    try:
        paths = GEN.write_named_shards(lines, str(tmp_path / "shards"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(paths) == 1000 and sorted(os.listdir(tmp_path / "shards")) == sorted(p.rsplit("/", 1)[1] for p in paths)
    assert len([f for f in os.listdir(paths[0]) if f.startswith("part-")]) > 1
    for i in (0, 1, 998):
        files = sorted(f for f in os.listdir(paths[i]) if f.startswith("part-"))
        got = [int(x) for f in files for x in (tmp_path / "shards" / f"shard_{i}.txt" / f).read_text().split()]
        assert got == [k for k in range(29_999, -1, -1) if (0 if k % 3 == 0 else k % 1000) == i]
    back = TX.read_shards(spark, str(tmp_path / "shards" / "shard_*.txt"))
    assert sorted((r.shard_id, r.value) for r in back.collect()) == sorted((r.shard_id, r.value) for r in lines.collect())


def test_text_to_training_leaves_a_failed_load_out(spark, tmp_path):
    (tmp_path / "shard_1.txt").write_text("# h\n1 2 1\n3 4 0\n")
    (tmp_path / "shard_2.txt").write_text("5 -1 1\n")
    (tmp_path / "shard_3.txt").write_text("7\n8\n")
    samples, rejects, schema = TX.load_shards(spark, str(tmp_path / "*.txt"))
    h = sorted(TR.train(samples, rounds=2).history.collect(), key=lambda r: r.round_id)
    assert [r.responses for r in h] == [2, 2]
    assert h[0].w == pytest.approx([0.01, -0.005], abs=1e-15)
    assert {r.reason for r in rejects.collect()} == {"shard_rejected"}


def test_generator_roundtrip(spark):
    s = GEN.generate_samples(spark, n_shards=3, per_shard=40, k=4, seed=7)
    rows = s.collect()
    again = GEN.with_gaussian_features(spark.range(120).withColumnRenamed("id", "row_id").repartition(7), 4, 7)
    assert sorted(tuple(r.x) for r in again.collect()) == sorted(tuple(r.x) for r in rows)
    draws = [v for r in GEN.generate_samples(spark, per_shard=1500, k=2).collect() for v in r.x]
    mean = sum(draws) / len(draws)
    assert abs(mean) < 0.05 and abs(sum((v - mean) ** 2 for v in draws) / len(draws) - 1) < 0.08
    assert len(rows) == 120
    for r in rows:
        score = 0.5 * r.x[0] + 0.3 * r.x[1] - 0.2 * r.x[2] + 0.1 * r.x[3]
        assert r.y == (1.0 if score > 0 else 0.0)
    path = os.path.join(tempfile.mkdtemp(prefix="gm-gen-"), "shards")
    GEN.write_shards(GEN.format_lines(s), path)
    back, rejects, schema = TX.load_shards(spark, path)
    assert back.count() == 120 and rejects.count() == 0
    assert sorted(r.shard_id for r in schema.collect()) == [1, 2, 3]
    assert {r.width for r in schema.collect()} == {5}
    assert back.groupBy("shard_id").count().where(F.col("count") != 40).count() == 0


@pytest.mark.parametrize("narrow", [16, 1])
def test_shards_lost_while_training(spark, tmp_path, monkeypatch, narrow):
    """A file removed after round 0 and one cut short after round 2: the survivors' mean goes on,
    and the losses are counted in participation, summary and answers."""
    monkeypatch.setattr(TR, "NARROW", narrow)
    lines = {1: "1 2 1\n3 4 0\n", 2: "5 -1 1\n2 2 0\n", 3: "0.5 1 1\n", 4: "7\n"}
    for i, text in lines.items():
        (tmp_path / f"shard_{i}.txt").write_text(text)
    samples, _, _ = TX.load_shards(spark, str(tmp_path / "shard_*.txt"))
    rows = samples.collect()  # what a run holds outlives its files
    held = spark.createDataFrame([(r.shard_id, r.x, r.y) for r in rows], "shard_id INT, x ARRAY<DOUBLE>, y DOUBLE")
    files = TX.ShardFiles(spark, str(tmp_path / "shard_*.txt"))

    def fail(r, norm):
        if r == 0:
            (tmp_path / "shard_2.txt").unlink()
            (tmp_path / "shard_4.txt").unlink()  # had no samples
        if r == 2:
            (tmp_path / "shard_3.txt").write_text("0.5")

    live = TR.LiveControl(lambda: spark.createDataFrame([(k, "QUERY_PROGRESS", None) for k in range(9)], "seq BIGINT, op STRING, new_lr DOUBLE"))
    res = TR.train(held, rounds=5, on_round=fail, lost=files.lost, live=live)
    failures = spark.createDataFrame([(2, 1), (3, 3)], "shard_id INT, failed_from_round INT")
    want = sorted(TR.train(held, rounds=5, failures=failures).history.collect(), key=lambda r: r.round_id)
    got = sorted(res.history.collect(), key=lambda r: r.round_id)
    assert [r.alive_shards for r in got] == [3, 2, 2, 1, 1] == [r.responses for r in got]
    for a, b in zip(got, want, strict=True):
        assert a.w == pytest.approx(b.w, abs=1e-14) and a.grad_norm == pytest.approx(b.grad_norm)
    assert res.summary.first().alive_shards == 1
    assert [(a["active_workers"], a["failed_workers"]) for a in live.answers] == [(3, 0), (3, 0), (2, 1), (2, 1), (1, 2)]
    for f in tmp_path.glob("shard_*.txt"):
        f.unlink()
    assert sorted(files.lost()) == [1, 2, 3, 4]
