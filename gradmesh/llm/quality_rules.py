"""Quality rules as a short-circuit cascade (DataFrame functions only).

A rule is a condition that rejects a text. :func:`measure` estimates on a random sample
what each rule costs (seconds per row) and how much it rejects; :func:`order_rules` sorts
them by rejection per cost, which minimises the expected cost of a sequence of independent
tests; :func:`apply_cascade` evaluates them in that order inside one CASE, so a row that a
cheap rule rejects never pays for a costly one.

Defined cases: a null text counts as empty; an empty text has no words and is rejected as
too short; ties in the order are broken by rule name; repeated rows and null ids are judged
row by row; an empty table gives an empty result (and the rules keep their given order).
The sample only sets the order of evaluation, never a verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import WS, texts, words, written

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SAMPLE_ROWS = 256  # expected
REPEATS = 8  # of a rule on each sampled row
FLOOR = 0.05


@dataclass(frozen=True)
class Rule:
    """``rejects``: a boolean column over the columns of :func:`features`."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Measured:
    rule: Rule
    cost: float  # seconds per row
    rejected: float  # share of the sampled rows

    @property
    def rank(self) -> float:
        return self.rejected / max(self.cost, 1e-9)


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def n_symbols(text: Column) -> Column:
    return F.length(text) - _without(text, SYMBOLS)


def word_chars(text: Column) -> Column:
    return _without(text, WS)


def word_lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.translate(line, WS, "") != "")


def n_dup_lines(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def windows(ws: Column, size: int = WINDOW) -> Column:
    """64-bit hash of each window of ``size`` consecutive words; empty if there is none."""
    starts = F.sequence(F.lit(1), F.size(ws) - (size - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, size)))
    return F.when(F.size(ws) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def repeated_words(wins: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows that occur twice or more; n log n in the words.

    The (hash, start) pairs are sorted, those with an equal neighbour are repeated; their
    starts in text order cover min(size, distance to the next) words each.
    """
    pairs = F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts_of(p: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(p, at)["h"] == x["h"], F.lit(False))
        return F.filter(p, lambda x, i: same(x, i - 1) | same(x, i + 1))

    def covered(s: Column) -> Column:
        return F.transform(s, lambda at, i: F.least(F.lit(size), F.coalesce(F.get(s, i + 1), at + size) - at))

    # One-element arrays bind a value once for the lambdas that use it more than once.
    starts = F.transform(F.array(pairs), lambda p: F.array_sort(F.transform(starts_of(p), lambda x: x["i"])))
    total = F.transform(starts, lambda s: F.aggregate(covered(s), F.lit(0), lambda a, b: a + b))
    return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0)).otherwise(F.element_at(total, 1))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, words, lines``: what the rules read, split once per text."""
    t = texts(docs, id_col, text_col)
    return t.select("doc_id", "text", words(t["text"]).alias("words"), word_lines(t["text"]).alias("lines"))


def default_rules(symbols: Column | None = None, dup_lines: Column | None = None, repeats: Column | None = None) -> list[Rule]:
    """Five rules on the text, its words and its lines; measures worked out already may be given."""
    text, ws, lines = F.col("text"), F.col("words"), F.col("lines")
    upper, lower = F.length(text) - _without(text, UPPER), F.length(text) - _without(text, LOWER)
    symbols = n_symbols(text) if symbols is None else symbols
    dup_lines = n_dup_lines(lines) if dup_lines is None else dup_lines
    repeats = repeated_words(windows(ws)) if repeats is None else repeats
    return [
        Rule("too_short", F.size(ws) < MIN_WORDS),
        Rule("symbols", symbols * 10 > F.size(ws)),
        Rule("shouting", upper > lower),
        Rule("duplicate_lines", dup_lines * 10 > F.size(lines) * 3),
        Rule("repeated_windows", repeats * 100 > F.size(ws) * REPEAT_PERCENT),
    ]


def measure(feats: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = REPEATS) -> list[Measured]:
    """Cost and selectivity of each rule on a random sample of about ``sample_rows`` rows.

    The sample is drawn from all partitions and written; nothing of it comes to the driver. A rule
    is run ``repeats`` times over each row, so that its own time dominates, and the time of the
    same job without a rule is taken off; the less of two runs counts. Costs under ``FLOOR`` of the
    largest are noise and count as that, so that cheap rules are ordered by what they reject.
    """
    n = feats.count()
    if not n:
        return [Measured(r, 0.0, 0.0) for r in rules]
    sample = written(feats.sample(min(1.0, sample_rows / n), 7), "rule-sample")
    many = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def run(rejects: Column) -> tuple[float, float]:
        took, got = [], None
        for _ in range(3):  # the first compiles
            began = time.monotonic()
            got = many.agg(F.count_if(rejects).alias("hit"), F.count("*").alias("rows")).first()
            took.append(time.monotonic() - began)
        return min(took[1:]) / max(got["rows"], 1), got["hit"] / max(got["rows"], 1)

    idle, _ = run(F.col("again") < 0)
    found = [(rule, *run(rule.rejects)) for rule in rules]
    least = FLOOR * max(max(cost - idle, 0.0) for _, cost, _ in found)
    return [Measured(rule, max(cost - idle, least), rejected) for rule, cost, rejected in found]


def order_rules(measured: Sequence[Measured]) -> list[Rule]:
    return [m.rule for m in sorted(measured, key=lambda m: (-m.rank, m.rule.name))]


def apply_cascade(feats: DataFrame, ordered: Sequence[Rule], keep: str = "kept", by: str = "rejected_by") -> DataFrame:
    """Adds ``kept`` and the name of the first rule (in evaluation order) that rejected."""
    first = F.lit(None).cast("string")
    for rule in reversed(ordered):
        first = F.when(rule.rejects, F.lit(rule.name)).otherwise(first)
    return feats.withColumn(by, first).withColumn(keep, F.col(by).isNull())


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, words, lines, rejected_by, kept`` for every row of ``docs``."""
    feats = features(docs, id_col, text_col)
    return apply_cascade(feats, order_rules(measure(feats, rules or default_rules(), sample_rows)))


def rules_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The base measures of every row beside the cascade's verdict.

    The order comes from the rules as they stand alone; here they read the measures that
    are returned for every row anyway, so that nothing is worked out twice.
    """
    feats = features(docs)
    order = [r.name for r in order_rules(measure(feats, default_rules(), sample_rows))]
    text, ws, lines = F.col("text"), F.col("words"), F.col("lines")
    base = feats.withColumn("wins", windows(ws)).select(
        "doc_id", "text", "words", "lines", F.size(ws).cast("long").alias("n_words"), word_chars(text).cast("long").alias("word_chars"),
        n_symbols(text).cast("long").alias("n_symbols"), n_dup_lines(lines).cast("long").alias("n_dup_lines"), repeated_words(F.col("wins")).cast("long").alias("n_repeat_words"),
    )
    rules = {r.name: r for r in default_rules(F.col("n_symbols"), F.col("n_dup_lines"), F.col("n_repeat_words"))}
    judged = apply_cascade(base, [rules[name] for name in order])
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))
