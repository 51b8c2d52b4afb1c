"""Language-model scores by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are the lower-cased (A-Z) words of a text and one end. The model's vocabulary are the
``VOCABULARY`` most frequent training words, a class for all others, and the end. The two
tokens before give a vector ``r = E[c1] @ C1 + E[c2] @ C2``, and ``P(w | c1, c2)`` is the softmax
of ``r @ Q[w] + b[w]``. Words outside the vocabulary share their class by smoothed frequency.

* Counts: every training token is counted, by task and then by word. The most frequent
  words, at most ``HEAD`` at any size, are broadcast; scores of the others come by an
  equi-join on the word, since the vocabulary of a corpus grows with it.
* Training covers every training document, in ``ROUNDS`` disjoint parts. In a round each task
  trains a copy of the parameters in numpy over its documents (minibatches of distinct
  trigrams with their counts, noise words shared by a minibatch, Adagrad); Spark then averages
  the copies, weighted by tokens, with one aggregate over the parameters' positions.
* Scoring normalises exactly: the log of the partition function of each context is worked out
  by batched matrix products, once per context and task.

Seeds are fixed per round and task and results are written, so lost tasks are repeated alike.

Defined cases: null and empty texts have one token, the end; a null id counts as an empty
one, whose remainder is 0 (held out); repeated rows are counted and scored row by row; ties in
frequency are broken by the word; without training documents all counts are 0 and the model
is uniform; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import texts, written

VOCABULARY = 1022
HEAD = 131_072
WIDTH = 16
NOISE = 64
BATCH = 2048
CHUNK = 1 << 20  # tokens whose distinct trigrams are trained on together
ROUNDS = 2
RATE = 0.1
FLUSH = 400_000  # distinct words that a task counts before it hands them on
FOLDS = 10


def tokens(text: str) -> list[bytes]:
    """Lower-cased words; bytes.lower and bytes.split know A-Z and the six blanks only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


# ---- the model, in numpy ---------------------------------------------------------------


@dataclass
class Parameters:
    E: np.ndarray
    Q: np.ndarray
    C: np.ndarray
    b: np.ndarray

    @classmethod
    def start(cls, unigram: np.ndarray, width: int = WIDTH) -> Parameters:
        rng, n = np.random.default_rng(7), len(unigram)
        C = np.stack([np.eye(width) * 0.5] * 2)
        return cls(rng.normal(0, 0.1, (n, width)), rng.normal(0, 0.1, (n, width)), C, np.log(unigram)).as32()

    def arrays(self) -> list[np.ndarray]:
        return [self.E, self.Q, self.C, self.b]

    def as32(self) -> Parameters:
        return Parameters(*(x.astype(np.float32) for x in self.arrays()))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def like(self, flat: np.ndarray) -> Parameters:
        ends = np.cumsum([x.size for x in self.arrays()])
        return Parameters(*(p.reshape(x.shape).astype(np.float32) for p, x in zip(np.split(flat, ends[:-1]), self.arrays(), strict=True)))

    def copy(self) -> Parameters:
        return Parameters(*(x.copy() for x in self.arrays()))


def _scatter(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by index."""
    return np.stack([np.bincount(index, weights=rows[:, j], minlength=n) for j in range(rows.shape[1])], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Noise-contrastive estimation over the tokens that it is given."""

    def __init__(self, start: Parameters, unigram: np.ndarray, seed: int) -> None:
        self.p = start.copy()
        self.noise_p = unigram
        self.log_kp = np.log(NOISE * unigram).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.square = [np.full(x.shape, 1e-4, np.float32) for x in self.p.arrays()]
        self.seen = 0
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray, end: int) -> None:
        """The ids of one document, its end included."""
        before = np.concatenate([[end, end], ids])
        n = len(self.noise_p)
        self.held.append((before[:-2] * n + before[1:-1]) * n + ids)
        self.size += len(ids)
        if self.size >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if not self.size:
            return
        n = len(self.noise_p)
        keys, counts = np.unique(np.concatenate(self.held), return_counts=True)
        self.seen += self.size
        self.held, self.size = [], 0
        order = self.rng.permutation(len(keys))
        keys, counts = keys[order], counts[order].astype(np.float32)
        for s in range(0, len(keys), BATCH):
            k = keys[s : s + BATCH]
            self.step(k // (n * n), k // n % n, k % n, counts[s : s + BATCH])

    def step(self, c2: np.ndarray, c1: np.ndarray, w: np.ndarray, weight: np.ndarray) -> None:
        """One minibatch; c1 stands right before w, c2 before that."""
        E, Q, C, b = self.p.arrays()
        n = len(b)
        noise = self.rng.choice(n, NOISE, p=self.noise_p)
        e1, e2, qw, qn = E[c1], E[c2], Q[w], Q[noise]
        r = e1 @ C[0] + e2 @ C[1]
        weight = weight / weight.mean()
        up = weight * (1 - _sigmoid((r * qw).sum(1) + b[w] - self.log_kp[w]))
        down = -weight[:, None] * _sigmoid(r @ qn.T + (b - self.log_kp)[noise])
        to_r = up[:, None] * qw + down @ qn
        to_q = _scatter(w, up[:, None] * r, n)
        np.add.at(to_q, noise, down.T @ r)
        to_b = np.bincount(w, weights=up, minlength=n) + np.bincount(noise, weights=down.sum(0), minlength=n)
        to_e = _scatter(c1, to_r @ C[0].T, n) + _scatter(c2, to_r @ C[1].T, n)
        for x, square, g in zip(self.p.arrays(), self.square, (to_e, to_q, np.stack([e1.T @ to_r, e2.T @ to_r]), to_b), strict=True):
            g = g / len(w)
            square += g * g
            x += RATE * g / np.sqrt(square)


class Scorer:
    """Normalised log10 probabilities; the partition function is kept by context."""

    def __init__(self, p: Parameters) -> None:
        self.p, self.n = p, len(p.b)
        self.log_z = np.full(self.n * self.n, np.nan, np.float32)

    def __call__(self, ids: np.ndarray, c2: np.ndarray, c1: np.ndarray) -> np.ndarray:
        """Of each token id in its context."""
        E, Q, C, b = self.p.arrays()
        key = c2 * self.n + c1
        new = np.unique(key[np.isnan(self.log_z[key])])
        for s in range(0, len(new), 4096):
            k = new[s : s + 4096]
            logits = (E[k % self.n] @ C[0] + E[k // self.n] @ C[1]) @ Q.T + b
            top = logits.max(1)
            self.log_z[k] = top + np.log(np.exp(logits - top[:, None]).sum(1))
        r = E[c1] @ C[0] + E[c2] @ C[1]
        return ((r * Q[ids]).sum(1) + b[ids] - self.log_z[key]).astype(np.float64) / math.log(10)


# ---- the work on Spark -----------------------------------------------------------------


@dataclass
class Lexicon:
    """What the corpus counts give; bounded by HEAD words."""

    index: dict[bytes, int]  # the most frequent words, by rank
    counts: np.ndarray  # of those words
    n_tokens: int  # N, ends included
    n_distinct: int  # V, the end included
    n_docs: int

    @property
    def n_model(self) -> int:
        return min(VOCABULARY, len(self.counts))

    @property
    def other(self) -> int:
        """Class of the words outside the model's vocabulary; the end is the next id."""
        return self.n_model

    @property
    def end(self) -> int:
        return self.n_model + 1

    def unigram(self) -> np.ndarray:
        known = self.counts[: self.n_model]
        c = np.concatenate([known, [self.n_tokens - self.n_docs - known.sum(), self.n_docs]]) + 0.1
        return c / c.sum()

    def log10_share_of_other(self) -> float:
        """log10 of what the smoothed counts of words outside the vocabulary sum to."""
        known = self.counts[: self.n_model]
        distinct = max(0, self.n_distinct - 1) - self.n_model
        return math.log10(max(self.n_tokens - self.n_docs - known.sum(), 0) + 0.1 * (max(distinct, 0) + 1))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 outside the head."""
        get = self.index.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def classes(self, ranks: np.ndarray) -> np.ndarray:
        """Model ids of a document by its ranks, with the end."""
        known = (ranks >= 0) & (ranks < self.n_model)
        return np.append(np.where(known, ranks, self.other), self.end)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over the training documents; the row of word null counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        n = 0

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array([w.decode("utf-8", "surrogatepass") for w in found], pa.string()), "c": pa.array(found.values(), pa.int64())})
            found.clear()
            return out

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                if fold(i):
                    n += 1
                    found.update(tokens(t.as_py()))
                    if len(found) > FLUSH:
                        yield rows()
        yield rows()
        if n:
            yield pa.RecordBatch.from_pydict({"word": pa.array([None], pa.string()), "c": pa.array([n], pa.int64())})

    return docs.mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def lexicon(counts: DataFrame) -> Lexicon:
    sums = counts.agg(F.sum("c").alias("n"), F.count("word").alias("v"), F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("d")).first()
    # words by bucket of their count, 16 to a doubling: the highest buckets that fit in HEAD,
    # so that no task sorts the words of all others
    known = counts.where("word IS NOT NULL").withColumn("bucket", F.floor(F.log2("c") * 16))
    room, least = HEAD, math.inf
    for b in sorted(known.groupBy("bucket").agg(F.count("*").alias("n")).collect(), key=lambda b: -b["bucket"]):
        room -= b["n"]
        if room < 0:
            break
        least = b["bucket"]
    top = known.where(F.col("bucket") >= F.lit(float(least))).select("word", "c").toArrow()
    top = top.sort_by([("c", "descending"), ("word", "ascending")])
    index = {w.encode(): k for k, w in enumerate(top.column("word").to_pylist())}
    n_docs = sums["d"] or 0
    return Lexicon(index, top.column("c").to_numpy().astype(np.int64), sums["n"] or 0, sums["v"] + (n_docs > 0), n_docs)


def train(docs: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> Parameters:
    """Parameters averaged over the tasks of each round."""
    sc = docs.sparkSession.sparkContext
    unigram = lex.unigram()
    p = Parameters.start(unigram)
    shared_lex = sc.broadcast(lex)
    for r in range(rounds if lex.n_docs else 0):
        shared = sc.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch], r: int = r, shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared_lex.value
            trainer = Trainer(shared.value, unigram, 1000 * TaskContext.get().partitionId() + r)
            for b in batches:
                for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    if (f := fold(i)) and f % rounds == r:
                        trainer.add(own.classes(own.ranks(tokens(t.as_py()))), own.end)
            trainer.flush()
            if trainer.seen:
                yield pa.RecordBatch.from_pydict({"weight": pa.array([float(trainer.seen)]), "p": pa.array([trainer.p.flat()], pa.list_(pa.float32()))})

        copies = docs.mapInArrow(run, "weight double, p array<float>").select("weight", F.posexplode("p").alias("at", "x"))
        mean = copies.groupBy("at").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x")).toArrow().sort_by("at")
        if mean.num_rows:
            p = p.like(mean.column("x").to_numpy())
    return p


SCORED = "row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<string>, times array<int>"


def scored(docs: DataFrame, lex: Lexicon, p: Parameters) -> DataFrame:
    """A row per document: sums over its end and head words, and its other words with their
    numbers. ``base`` lacks the denominators, ``score`` the other words' shares of their class."""
    sc = docs.sparkSession.sparkContext
    shared_lex, shared = sc.broadcast(lex), sc.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, score = shared_lex.value, Scorer(shared.value)
        log_c = np.log10(np.append(own.counts + 0.1, 0.0 + 1.0))  # rank -1 reads 0
        first = TaskContext.get().partitionId() << 33
        at = 0
        for b in batches:
            out: dict[str, list] = {k.split()[0]: [] for k in SCORED.split(", ")}
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ws = tokens(t.as_py())
                ranks = own.ranks(ws)
                ids = own.classes(ranks)
                before = np.concatenate([[own.end, own.end], ids])
                rare = Counter(ws[k] for k in np.flatnonzero(ranks < 0).tolist())
                head = log_c[ranks]
                values = {
                    "row_id": first + at, "doc_id": i, "held_out": fold(i) == 0, "n_tokens": len(ids),
                    "n_known": int((ranks >= 0).sum()) + (own.n_docs > 0), "base": float(head.sum()) + math.log10(own.n_docs + 0.1),
                    "score": float(score(ids, before[:-2], before[1:-1]).sum()) + float(head[ranks >= own.n_model].sum()) - int((ids == own.other).sum()) * own.log10_share_of_other(),
                    "rare": [w.decode("utf-8", "surrogatepass") for w in rare], "times": list(rare.values()),
                }
                at += 1
                for k, v in values.items():
                    out[k].append(v)
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(v, ty) for v, ty in zip(out.values(), types, strict=True)], list(out))

    return docs.mapInArrow(run, SCORED)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    rows = texts(docs, id_col, text_col)
    counts = written(word_counts(rows), "lm-counts")
    lex = lexicon(counts)
    done = written(scored(rows, lex, train(rows, lex)), "lm-scored")
    rare = done.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row_id", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = met.groupBy("row_id").agg(F.sum(F.log10(F.col("c") + 0.1) * F.col("times")).alias("rare_sum"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("rare_known"))
    denominator = math.log10(lex.n_tokens + 0.1 * (lex.n_distinct + 1))
    none = F.lit(0.0)
    return done.join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(lex.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_sum", none) - F.col("n_tokens") * denominator).alias("base_score"), (F.col("score") + F.coalesce("rare_sum", none)).alias("score"),
    )
