"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a latent score ``s``; ordered thresholds
cut it into grades, ``P(grade <= k) = sigmoid(theta_k - s)``. The expected grade and the tail
probability ``P(grade >= keep_grade)`` select documents.

Features are binary: words, their five-letter beginnings, what trails a word ("!!", "%%%"),
and buckets of style measures, all hashed into ``2**BITS`` slots. L1 shrinkage keeps the many
words that tell nothing at zero, so long texts gather no noise.

The model is fitted with numpy on at most ``max_rows`` labelled rows (default ``MAX_ROWS``),
chosen by a hash of their id; only their hashed features reach the driver. Every document is
then scored in one pass without a shuffle.

Defined cases: a null text is empty (it has style features only); labels without a usable
grade, without an id or of unknown documents are left out; of several labels of one document
the lowest grade counts; repeated rows are scored alike; with no usable label everything is
kept with tail probability 1; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import texts

BITS = 18
MAX_ROWS = 8192
MIN_DF = 3  # features of fewer sampled documents carry no weight
ITERATIONS = 150
L1_SCALE = 0.045  # the shrinkage is this over the square root of the sampled rows
GRADES = 3  # toxic, poor, good
KEEP_GRADE = 2
MIN_TAIL = 0.5

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#*$%&|<>!"
_TAIL = re.compile(r"^(.*?)(\W*)$", re.DOTALL)


def _slot(kind: str, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{value}") & ((1 << BITS) - 1)


class _Slots(dict):
    """Word (bytes) to its slots, packed into one integer: word, beginning, tail."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        stem, tail = _TAIL.match(word.decode("utf-8", "replace").lower()).groups()
        stem = stem.lstrip("\"'([{¿¡")
        parts = _slot("w", stem), _slot("b", stem[:5]), _slot("t", tail[:4])
        v = self[word] = parts[0] | parts[1] << BITS | parts[2] << 2 * BITS
        return v


def _bucket(share: float) -> str:
    return str(min(9, int(share * 20)))


def slots(text: str, cache: _Slots) -> np.ndarray:
    """Sorted distinct feature slots of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    ws = raw.split()
    n = max(len(ws), 1)
    distinct = set(ws)
    packed = np.fromiter(map(cache.__getitem__, distinct), np.int64, len(distinct))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = (len(raw) - len(raw.translate(None, _UPPER))) / max(len(raw), 1)
    symbols = (len(raw) - len(raw.translate(None, _SYMBOLS))) / n
    style = [
        _slot("upper", _bucket(upper)), _slot("symbols", _bucket(symbols / 2)), _slot("distinct", _bucket(len(distinct) / n / 2)),
        _slot("lines", _bucket(1 - len(set(lines)) / max(len(lines), 1))), _slot("size", str(len(ws).bit_length())),
    ]
    mask = (1 << BITS) - 1
    return np.unique(np.concatenate([packed & mask, packed >> BITS & mask, packed >> 2 * BITS, np.array(style, np.int64)])).astype(np.int32)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # float32, 2**BITS
    thresholds: np.ndarray  # ascending, one fewer than grades; empty: no evidence

    def grades(self, s: np.ndarray, keep_grade: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= keep_grade) of latent scores."""
        if not len(self.thresholds):
            return np.full(len(s), float(GRADES - 1)), np.ones(len(s))
        above = _sigmoid(s[:, None] - self.thresholds[None, :])  # P(grade > k)
        return above.sum(1), above[:, keep_grade - 1]

    def score(self, feature_slots: np.ndarray) -> float:
        return float(self.weights[feature_slots].sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, iterations: int = ITERATIONS, l1_scale: float = L1_SCALE) -> OrdinalModel:
    """Proximal Adagrad on the mean log likelihood of the cumulative-link model."""
    w = np.zeros(1 << BITS)
    if not len(rows):
        return OrdinalModel(w.astype(np.float32), np.zeros(0))
    flat = np.concatenate(rows)
    keep = np.bincount(flat, minlength=len(w)) >= min(MIN_DF, len(rows))
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[keep[flat]]
    flat = flat[keep[flat]]
    used, flat = np.unique(flat, return_inverse=True)
    v, n = np.zeros(len(used)), len(rows)
    l1 = l1_scale / np.sqrt(n)
    below = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n, 0.01, 0.99)
    cut = np.log(below / (1 - below))
    cut = np.maximum.accumulate(cut + 1e-3 * np.arange(len(cut)))
    first, gaps = cut[0], np.log(np.maximum(np.diff(cut), 1e-3))
    square_v, square_t, rate = np.full(len(used), 1e-6), np.full(1 + len(gaps), 1e-6), 0.3
    for _ in range(iterations):
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        s = np.bincount(doc, weights=v[flat], minlength=n)
        hi, lo = _sigmoid(edges[grades + 1] - s), _sigmoid(edges[grades] - s)
        mass = np.maximum(hi - lo, 1e-9)
        up = np.bincount(grades, weights=hi * (1 - hi) / mass, minlength=n_grades)[:-1]
        down = np.bincount(grades, weights=lo * (1 - lo) / mass, minlength=n_grades)[1:]
        g_theta = (up - down) / n
        g_t = np.concatenate([[g_theta.sum()], [g_theta[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))]])
        g_v = np.bincount(flat, weights=(hi + lo - 1)[doc], minlength=len(used)) / n
        square_v += g_v**2
        square_t += g_t**2
        step = rate / np.sqrt(square_v)
        v = v + step * g_v
        v = np.sign(v) * np.maximum(np.abs(v) - step * l1, 0)
        t = rate * g_t / np.sqrt(square_t)
        first, gaps = first + t[0], gaps + t[1:]
    w[used] = v
    return OrdinalModel(w.astype(np.float32), first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: toxic 0, poor 1, good 2; the lowest of a document's labels."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fits on at most ``max_rows`` graded documents; that bound is also what is broadcast, and
    what the driver gets: of repeated rows of one id the smallest text stands for all."""
    sample = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Slots()
        for b in batches:
            found = [slots(t.as_py(), cache) for t in b.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "grade": b.column("grade"), "slots": pa.array(found, pa.list_(pa.int32()))})

    one = texts(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    rows = one.mapInArrow(featurise, "doc_id bigint, grade int, slots array<int>")
    got = rows.toArrow().sort_by([("doc_id", "ascending")])
    return fit([np.asarray(x.values) for x in got.column("slots")], got.column("grade").to_numpy().astype(np.int64))


def _scores(batch: pa.RecordBatch, text_col: str, model: OrdinalModel, cache: _Slots, keep_grade: int) -> tuple[np.ndarray, np.ndarray]:
    s = np.array([model.score(slots(t.as_py() or "", cache)) for t in batch.column(text_col)])
    return model.grades(s, keep_grade)


def score_documents(docs: DataFrame, model: OrdinalModel, keep_grade: int = KEEP_GRADE, min_tail: float = MIN_TAIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Slots()
        for b in batches:
            expected, tail = _scores(b, "text", shared.value, cache, keep_grade)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "expected_grade": pa.array(expected), "tail_probability": pa.array(tail), "kept": pa.array(tail >= min_tail)})

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: OrdinalModel, keep_grade: int = KEEP_GRADE, min_tail: float = MIN_TAIL, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model keeps, all their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Slots()
        for b in batches:
            yield b.filter(pa.array(_scores(b, text_col, shared.value, cache, keep_grade)[1] >= min_tail))

    return docs.mapInArrow(run, docs.schema)
