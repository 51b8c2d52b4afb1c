"""Order MinHash, alignment and components against brute force."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from gradmesh.llm import order_minhash as M
from gradmesh.llm.common import WordHash
from gradmesh.llm.components import components


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
        row = out
    return row[-1]


def brute_similarity(s, t):
    """Longest common subsequence of the labelled shingles, by the plain quadratic table."""

    def kmers(text):
        ws, seen, out = text.split(), defaultdict(int), []
        for i in range(max(1, len(ws) - 4) if ws else 0):
            g = tuple(ws[i : i + 5])
            out.append((g, seen[g]))
            seen[g] += 1
        return out

    a, b = kmers(s), kmers(t)
    m = lcs(a, b)
    return m / (len(a) + len(b) - m) if a or b else 1.0


def edited(rng, words, edits):
    ws = list(words)
    for _ in range(edits):
        k = rng.randrange(len(ws))
        ws[k : k + 1] = rng.choice([[], [f"new{rng.randrange(9999)}"], [ws[k], "more"]])
    return " ".join(ws)


def corpus():
    rng = random.Random(11)
    rows, k = [], 0
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.randrange(1, 9)):
            rows.append((k, edited(rng, base, rng.randrange(0, 6))))
            k += 1
    half = [f"h{j}" for j in range(100)]
    rows += [(k, " ".join(half)), (k + 1, " ".join(half[50:] + half[:50])), (k + 2, "  ".join(half) + "\n"), (k + 3, "x " * 100), (k + 4, "x " * 104), (k + 5, "x " * 300)]
    rows += [(k + 6, "a b"), (k + 7, "a b"), (k + 8, "a c"), (k + 9, None), (k + 10, ""), (k + 11, " \n")]
    rng.shuffle(rows)
    return rows


def brute_classes(rows):
    ids = [i for i, _ in rows]
    texts = {i: t or "" for i, t in rows}
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if texts[a].split() == texts[b].split() or brute_similarity(texts[a], texts[b]) >= 0.8]
    return union_find(ids, edges)


def test_classes_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "q", 5) for i, t in rows], "doc_id long, text string, digest string, n int")
    got = dict(map(tuple, M.near_duplicates(df).collect()))
    want = brute_classes(rows)
    assert got == want
    kept = M.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_null_and_repeated_ids(spark):
    t = " ".join(f"w{k}" for k in range(40))
    rows = [(None, t), (None, t), (1, t), (1, t), (2, t + " end"), (3, "other words are here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(map(tuple, M.near_duplicates(df).collect())) == {1: 1, 2: 1, 3: 3}
    assert sorted((r.doc_id for r in M.one_of_each(df).collect()), key=str) == [1, 3, None, None]
    assert M.one_of_each(df.where("false")).count() == 0


def test_an_id_with_several_texts(spark):
    """No text goes without a similar one that stays, and classes that share an id are one."""
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "y"), (5, b, "x"), (9, b + " end", "x"), (7, "some text of its own", "x"), (None, b, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(4)
    assert dict(map(tuple, M.near_duplicates(df).collect())) == {3: 3, 5: 3, 9: 3, 7: 7}
    kept = M.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([(3, a, "x"), (5, b, "x"), (7, "some text of its own", "x"), (None, b, "x")], key=str)


def test_parity_words_bound_the_difference(spark):
    rng, w = random.Random(6), WordHash()
    base = [f"w{k}" for k in range(300)]
    kmers = [M.labelled_kmers(w.of(edited(rng, base, rng.randrange(0, 60)))) for _ in range(30)] + [M.labelled_kmers(w.of(t)) for t in ("", "a", "a b c d e f")]
    df = spark.createDataFrame([(k, M.parity(x).tolist()) for k, x in enumerate(kmers)], "k int, p array<bigint>")
    both = df.join(df.select(F.col("k").alias("l"), F.col("p").alias("q")), F.col("k") < F.col("l")).select("k", "l", M.differing("p", "q").alias("d")).collect()
    gaps = [len(np.setxor1d(kmers[r.k], kmers[r.l])) - r.d for r in both]
    assert min(gaps) >= 0 and sum(g == 0 for g in gaps) > 3


def test_alignment_is_exact():
    rng, w = random.Random(2), WordHash()
    for _ in range(200):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 120))]
        s, t = edited(rng, base, rng.randrange(6)), edited(rng, base, rng.randrange(6))
        want = brute_similarity(s, t)
        got = M.similarity(M.labelled_kmers(w.of(s)), M.labelled_kmers(w.of(t)))
        assert (got >= 0.8) == (want >= 0.8), (got, want)
        assert want < 0.8 or abs(got - want) < 1e-12


def test_sketches_keep_order_and_depend_on_text_only():
    w = WordHash(limit=3)
    a = M.labelled_kmers(w.of("a b c d e f g h i j k l m n o p q r s t u v w x y z"))
    assert (M.sketches(a) == M.sketches(a.copy())).all()
    assert not np.intersect1d(M.sketches(a), M.sketches(a[::-1].copy())).size
    long = np.arange(1, 300_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(M.sketches(long)) == M.SKETCHES


def test_components_of_a_chain_a_star_and_noise(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(60)]
    star = [(500, 500 - k) for k in range(1, 40)]
    noise = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)] + [(7, 7)]
    edges = chain + star + noise
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == union_find(nodes, [(a, b) for a, b in edges if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_family_on_both_sides_of_the_threshold(spark):
    """Each two similar texts are in one class, though most of them are never hubs."""
    rng, w = random.Random(1), WordHash()
    base = [f"w{k}" for k in range(150)]
    rows = [(k, edited(rng, base, rng.randrange(3, 6))) for k in range(400)]
    kmers = [M.labelled_kmers(w.of(t)) for _, t in rows]
    edges = [(a, b) for b in range(len(rows)) for a in range(b) if M.similarity(kmers[a], kmers[b]) >= 0.8]
    got = dict(map(tuple, M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == union_find(range(len(rows)), edges)
