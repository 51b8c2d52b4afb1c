"""Language-model scores: base against plain Python, the model by normalisation and held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gradmesh.llm import log_bilinear as L


def brute(rows):
    def fold(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10

    def toks(t):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]

    c = Counter(w for i, t in rows if fold(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)) for _, t in rows]
    return [(i, fold(i) == 0, len(toks(t)), sum(c[w] > 0 for w in toks(t)), n, b) for (i, t), b in zip(rows, base)]


def corpus(n, seed=3):
    rng = random.Random(seed)
    langs = [[f"{p}{k}" for k in range(300)] for p in ("A", "é", "Ö")]
    out = []
    for k in range(n):
        words = rng.choice(langs)
        out.append((k, " ".join(words[min(299, int(rng.paretovariate(0.7)) - 1)] for _ in range(rng.randrange(1, 200)))))
    return out


@pytest.mark.parametrize("head", [L.HEAD, 20])
def test_base_equals_brute_force(spark, monkeypatch, head):
    """head 20: most words take the join."""
    monkeypatch.setattr(L, "HEAD", head)
    rows = corpus(150) + [(None, "A1 unseen"), (1000, None), (1001, ""), (1002, "İ ſ K Straße x a\x0bb"), (1000, None), (1003, "deep " * 30_000)]
    got = L.lm_scores(spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")).collect()
    key = lambda r: (str(r[0]), r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute(rows), key=key), strict=True):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9)
        assert g[6] < 0 and math.isfinite(g[6])


def test_model_beats_the_unigram_on_held_out_text(spark):
    rows = corpus(3000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [r for r in L.lm_scores(df).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.02 * sum(r.n_tokens for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    p = L.Parameters(rng.normal(size=(9, 4)), rng.normal(size=(9, 4)), rng.normal(size=(2, 4, 4)), rng.normal(size=9)).as32()
    score = L.Scorer(p)
    for c in ((0, 0), (3, 8), (3, 8)):
        total = 10 ** score(np.arange(9), np.full(9, c[0]), np.full(9, c[1]))
        assert math.isclose(total.sum(), 1, rel_tol=1e-5)


def test_flat_round_trip():
    p = L.Parameters.start(np.full(5, 0.2))
    assert all((x == y).all() for x, y in zip(p.arrays(), p.like(p.flat()).arrays()))


def test_without_training_documents(spark):
    held = [i for i in range(200) if L.fold(i) == 0]
    got = L.lm_scores(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert {(r.n_known, r.train_tokens, r.n_tokens) for r in got} == {(0, 0, 3)}
    assert all(math.isfinite(r.score) and r.base_score == 0 for r in got)
    assert L.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
