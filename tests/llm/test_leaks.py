"""Template decontamination: planted leaks, re-parameterised ones, slot consistency, edge cases."""

import random

import pytest

from gradmesh.llm import template_leaks as T

ITEM = "Ann has 3 apples and gives Ben 2 of her apples while walking 3 km home; how many apples does she have left?"
ITEMS = [(1, ITEM), (2, "a short one"), (3, None), (4, "Twelve grey geese fly over seven misty hills before the cold rain starts falling"), (4, ""), (None, "nobody knows which of these rows has lost its own number today")]
SCHEMA = "item_id long, text string, h string"


def found(spark, docs, items=ITEMS, **options):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, h string")
    i = spark.createDataFrame([(k, t, "clash") for k, t in items], SCHEMA)
    return {(r.doc_id, r.item_id): r for r in T.leaks(d, i, **options).collect()}


def filler(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice("some plain words that fill a page with no meaning at all".split()) for _ in range(n))


DOCS = [
    (10, filler(1) + ". " + ITEM + " " + filler(2)),
    (11, filler(3) + ".\nAnn has 7 apples and gives Zoe 5 of her apples while walking 7 km home; how many apples does she have left? " + filler(4)),
    (12, "Ann has 7 apples and gives Zoe 5 of her apples while walking 9 km home; how many apples does she have left?"),
    (13, "TWELVE GREY geese, fly over seven misty hills before the cold rain starts falling!"),
    (14, filler(5, 3000)), (15, None), (16, ""), (17, "a short one"), (18, "Ann has 3 apples and gives Ben"), (None, ITEM), (10, "again the same id"),
    (19, "nobody knows which of these rows has lost its own number today"),
]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_leaks(spark, threshold):
    """Whether Spark broadcasts the benchmark or not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = found(spark, DOCS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {k for k in got if k[1] is not None} == {(10, 1), (11, 1), (13, 4)}
    assert not got[10, 1].reparameterised and got[11, 1].reparameterised
    assert got[10, 1].n_found == got[10, 1].n_windows


def test_filter_keeps_clean_rows_and_columns(spark):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, _leaking int, h string")
    kept = T.without_leaks(d, spark.createDataFrame([(k, t, "") for k, t in ITEMS], SCHEMA))
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [12, 14, 15, 16, 17, 18, 19, None]


def test_empty_tables(spark):
    assert found(spark, [(1, ITEM)], []) == {}
    assert found(spark, [], ITEMS) == {}


def test_an_item_in_a_third_of_all_documents(spark):
    docs = [(k, (ITEM if k % 3 == 0 else "") + " " + filler(k)) for k in range(300)]
    assert {k for k, _ in found(spark, docs)} == set(range(0, 300, 3))


def test_a_near_verbatim_copy_with_one_changed_value_is_dropped(spark):
    docs = [(1, filler(8) + " " + ITEM.replace("walking 3 km", "walking 9 km") + " " + filler(9)), (2, ITEM.replace("3", "7", 1)), (3, filler(10))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, t, "") for k, t in ITEMS], SCHEMA)
    assert [r.doc_id for r in T.without_leaks(d, i).collect()] == [3]
    got = found(spark, docs)
    assert set(got) == {(1, 1), (2, 1)} and got[1, 1].n_found < got[1, 1].n_windows and not got[1, 1].reparameterised
