"""Ordinal classifier on held-out labels; the pipeline stage by stage."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from gradmesh.llm import ordinal_quality as Q
from gradmesh.llm.common import table

SF = "/root/testdata/sf0.01"


def test_fit_recovers_ordered_thresholds():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 12)) for _ in range(3000)]
    truth = rng.normal(size=50)
    s = np.array([truth[r].sum() for r in rows])
    grades = np.digitize(s + rng.logistic(size=len(s)) * 0.1, [-1.0, 1.0])
    m = Q.fit(rows, grades)
    got = np.array([m.score(r) for r in rows])
    expected, tail = m.grades(got, 2)
    assert (np.diff(m.thresholds) > 0).all()
    assert np.corrcoef(got, s)[0, 1] > 0.95
    assert ((tail >= 0.5) == (grades == 2)).mean() > 0.93
    assert np.abs(expected - grades).mean() < 0.3


def test_held_out_accuracy(spark):
    docs, grades = table(spark, "/root/testdata/sf0.1", "documents"), Q.graded(table(spark, "/root/testdata/sf0.1", "labels"))
    model = Q.train(docs, grades.where("doc_id % 2 = 1"))
    got = Q.score_documents(docs, model).join(grades.where("doc_id % 2 = 0"), "doc_id").collect()
    by = defaultdict(list)
    for r in got:
        by[r.grade].append(r.kept)
    assert np.mean(by[2]) > 0.99
    assert np.mean(by[0]) < 0.1
    assert np.mean(by[1]) < 0.2


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (None, "x " * 20_000, 9.0), (2, "", 9.0)], "doc_id long, text string, kept double")
    none = Q.graded(spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int"))
    model = Q.train(docs, none)
    assert [r.kept for r in Q.score_documents(docs, model).collect()] == [True] * 4
    assert Q.keep_good(docs, model).columns == docs.columns and Q.keep_good(docs, model).count() == 4
    assert Q.score_documents(docs.where("false"), model).count() == 0
    lowest = Q.graded(spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(tuple, lowest)) == [(1, 1), (2, 0)]


def test_bound_of_the_sample(spark):
    docs = spark.createDataFrame([(k, "good words here" if k % 2 else "bad bad words") for k in range(100)], "doc_id long, text string")
    grades = docs.selectExpr("doc_id", "if(doc_id % 2 = 1, 2, 0) AS grade")
    model = Q.train(docs, grades, max_rows=40)
    kept = {r.doc_id for r in Q.score_documents(docs, model).collect() if r.kept}
    assert kept == set(range(1, 100, 2))


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents").selectExpr("*", "doc_id * 2 AS extra")
    before, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        rows = after.collect()
        counts.append(len(rows))
        before = spark.createDataFrame(rows, docs.schema)
    assert 1000 > counts[0] == counts[1] > counts[2] > counts[3] > 500
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id: r.text for r in before.collect()}
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert not [1 for t in kept.values() for i in items if i in t]
    assert any(i in t for t in texts.values() for i in items)
    assert len({tuple((t or "").split()) for t in kept.values()}) == len(kept)
    packed = corpus_pipeline.pack(spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, docs.select(cols).collect()))


def test_repeated_rows_of_a_labelled_id_reach_the_driver_once(spark, monkeypatch):
    monkeypatch.setattr(Q, "fit", lambda found, grades: grades.tolist())
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "no label")] + [(1, f"some text {k % 3}") for k in range(300)], "doc_id long, text string")
    grades = spark.createDataFrame([(1, 0), (2, 2)], "doc_id long, grade int")
    assert Q.train(docs, grades) == [0, 2]


def test_stages_on_empty_null_and_repeated_rows(spark):
    """Every stage on no rows, and on null texts and ids, repeated rows and an id with two texts."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.where("doc_id < 30").collect()
    one = rows[0].asDict()
    odd = [*rows, *rows[:5], {**one, "doc_id": None}, {**one, "text": None}, {**one, "doc_id": None, "text": None}, {**one, "text": ""}, {**one, "doc_id": rows[1]["doc_id"]}]
    for given in ([], [tuple(r[c] for c in docs.columns) if isinstance(r, dict) else tuple(r) for r in odd]):
        now = spark.createDataFrame(given, docs.schema)
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, now, "/root/testdata/sf0.001")
            got = after.collect()
            if name != "pack":
                assert after.columns == docs.columns and len(got) <= now.count(), name
                now = spark.createDataFrame(got, docs.schema)
            else:
                assert {r.doc_id for r in got} == {r.doc_id for r in now.collect()} and (got or not given)
