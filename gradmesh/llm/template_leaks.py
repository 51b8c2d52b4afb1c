"""Benchmark decontamination by templates (DataFrame functions only).

Texts become templates: numbers, units behind a number and names (capitalised inside a
sentence) turn into typed placeholders, the rest loses case and punctuation. Every window of
``SIZE`` template words of the documents is hash-joined with those of the benchmark items. For
the windows found, the values behind the placeholders are compared: along one diagonal (document
position minus item position) the same value of the item must always stand for the same value
of the document. So "Ann has 3 apples and eats 3" is found in "Bob has 5 apples and eats 5",
but not in "Bob has 5 apples and eats 2".

An item leaks into a document if consistent diagonals cover at least ``min_coverage`` of its
distinct windows. Of a diagonal that isn't consistent only the windows count whose values equal the
item's: so a near-verbatim copy with one changed name or number is found. Windows with fewer than ``MIN_LITERAL`` words besides placeholders say
nothing and don't count.

Spark broadcasts the benchmark's windows, a written table of known size, if they are small, and
else shuffles both sides by hash. The documents' windows carry an id, a place, a hash and the values of their slots, if any; never the text. Hits are
aggregated per document and item.

Defined cases: null texts are empty; an item with fewer than ``SIZE`` words, or without a
telling window or an id, is never found; rows without an id are kept and not reported; repeated rows
of one id are judged together; equal items are each reported; empty tables give an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import WS, texts, words, written

SIZE = 5
MIN_LITERAL = 2
MIN_COVERAGE = 0.5
PUNCTUATION = ".,;:!?\"'()[]{}"
#: Fixed list of unit words; they count as units right behind a number.
UNITS = (
    "%", "$", "€", "£", "kg", "g", "mg", "km", "m", "cm", "mm", "mi", "ft", "in", "l", "ml", "s", "ms", "h", "hr", "min", "kmh", "mph", "usd", "eur",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "percent", "meter", "meters", "metre", "metres", "mile", "miles", "hour", "hours",
    "minute", "minutes", "second", "seconds", "day", "days", "week", "weeks", "year", "years", "gram", "grams", "liter", "liters", "litre", "litres",
)
#: Placeholders: control characters, so that no word can be taken for one. A name's value
#: keeps the mark in front.
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"


def plain(text: Column) -> Column:
    """Lower case without punctuation, names marked; its words are the values of the slots."""
    marked = F.regexp_replace(text, rf"(?=\p{{Lu}}\p{{Ll}})(?<=[\p{{Ll}},;][{WS}])", NAME)
    return F.lower(F.translate(marked, PUNCTUATION, ""))


def template(plain_text: Column) -> Column:
    """Array of template words, one for each word of the plain text."""
    t = F.regexp_replace(F.regexp_replace(plain_text, rf"{NAME}\S*", NAME), "[0-9]+", NUMBER)
    units = "|".join(map(re.escape, UNITS))
    return words(F.regexp_replace(t, rf"{NUMBER}([{WS}]+)(?:{units})(?!\S)", f"{NUMBER}$1{UNIT}"))


def _is_slot(word: Column) -> Column:
    """Placeholders sort before all other characters; a number's may stand inside a word."""
    return (word < "\x04") | word.contains(NUMBER)


def _rows(table: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``name, slots, words`` of the rows that have an id; ``words`` only where there is a slot."""
    rows = texts(table, id_col, text_col).where("doc_id IS NOT NULL").select(F.col("doc_id").alias(name), plain(F.col("text")).alias("plain"))
    rows = rows.withColumn("slots", template(F.col("plain")))
    return rows.select(name, "slots", F.when(F.exists("slots", _is_slot), words(F.col("plain"))).alias("words"))


def _windows(rows: DataFrame, name: str, size: int) -> DataFrame:
    """``name, at, h, window, values``: a row per window with the hash of its template words, and
    the values behind its placeholders. (The outer form of explode spares a filter that would
    work out the templates twice.)"""

    def window(i: Column) -> Column:
        part = F.slice("slots", i + 1, size)
        both = F.arrays_zip(part.alias("slot"), F.slice("words", i + 1, size).alias("word"))
        values = F.transform(F.filter(both, lambda x: _is_slot(x["slot"])), lambda x: x["word"])
        some = F.col("words").isNotNull() & F.exists(part, _is_slot)
        return F.struct(i.alias("at"), F.xxhash64(part).alias("h"), F.when(some, values).alias("values"))

    each = F.when(F.size("slots") >= size, F.transform(F.sequence(F.lit(0), F.size("slots") - size), window))
    made = rows.select(name, F.explode_outer(each).alias("w")).where("w IS NOT NULL")
    return made.select(name, "w.at", "w.h", F.coalesce("w.values", F.array().cast("array<string>")).alias("values"))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``item_id, item_at, h, item_values`` of the telling windows."""
    rows = _rows(items, id_col, text_col, "item_id")
    literal = F.filter("slots", lambda w: ~_is_slot(w))
    starts = F.sequence(F.lit(0), F.size("slots") - size)
    telling = F.filter(starts, lambda i: F.size(F.array_distinct(F.filter(F.slice("slots", i + 1, size), lambda w: ~_is_slot(w)))) >= MIN_LITERAL)
    kept = rows.where((F.size("slots") >= size) & (F.size(literal) >= MIN_LITERAL)).select("item_id", F.explode(telling).alias("at"))
    made = _windows(rows, "item_id", size).join(kept.distinct(), ["item_id", "at"])
    return made.select("item_id", F.col("at").alias("item_at"), "h", F.col("values").alias("item_values"))


def leaks(docs: DataFrame, items: DataFrame, min_coverage: float = MIN_COVERAGE, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_found, n_windows, reparameterised`` of every leak."""
    bench = written(benchmark_windows(items, size=size), "benchmark-windows")
    hits = _windows(_rows(docs, id_col, text_col, "doc_id"), "doc_id", size).join(bench, "h")
    pairs = F.arrays_zip(F.col("item_values").alias("a"), F.col("values").alias("b"))
    found = hits.where(F.size("item_values") == F.size("values")).select("doc_id", "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("diagonal"), pairs.alias("pairs"), (F.col("item_values") == F.col("values")).alias("equal"))
    # per diagonal the values must map one to one way: as many pairs as item values
    lined = found.groupBy("doc_id", "item_id", "diagonal").agg(
        F.collect_set("item_at").alias("ats"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"), F.collect_set(F.when(F.col("equal"), F.col("item_at"))).alias("equal_ats")
    )
    fits = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"])))
    changed = fits & F.exists("pairs", lambda p: p["a"] != p["b"])
    consistent = lined.withColumn("ats", F.when(fits, F.col("ats")).otherwise(F.col("equal_ats"))).where(F.size("ats") > 0)
    per_item = consistent.groupBy("doc_id", "item_id").agg(F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"), F.min(changed).alias("reparameterised"))
    totals = bench.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    judged = per_item.join(totals, "item_id").select("doc_id", "item_id", F.size("ats").cast("long").alias("n_found"), "n_windows", "reparameterised")
    return judged.where(F.col("n_found") >= min_coverage * F.col("n_windows"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, all their columns unchanged."""
    found = leaks(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = found.select(F.col("doc_id").alias("_leaking")).distinct()
    return docs.join(bad, docs[id_col] == bad["_leaking"], "left_anti")
