"""Line deduplication by overlapping windows of three lines.

Lines are compared without outer white space; lines without a word are skipped. Every window
of three consecutive lines gets two 64-bit hashes. Of the places of one window over all
documents the first, by (id, position), stays; every later one covers its three lines, and
the blank ones between. Covered places that overlap merge and are removed from the text.

Every removed line is part of a window that stands earlier, so by induction each distinct
line of the input survives at least once.

Counting is a two-phase aggregate; finding the later places is an equi-join of the windows
with the repeated ones (one row each), whose hot keys AQE splits. Per document only its own
places are gathered. The windows are written once, so texts are not split twice.

Defined cases: null text stays null; texts of fewer than three lines with a word have no
window and stay as they are; rows without an id stay and are not compared; repeated rows of
one id with the same text are one document and stay alike; within one document a repeated
window counts as later too; an empty table gives an empty result; other columns, whatever
their names, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import WS, fresh, written

SIZE = 3


def worded_lines(text: Column) -> Column:
    """Array of (at, line) of the lines with a word, trimmed."""
    pairs = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(WS)).alias("line")))
    return F.filter(pairs, lambda p: p["line"] != "")


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``doc_id, th, first, last, h1, h2`` of each window: the lines it spans and its hashes.

    ``th`` is a hash of the whole text; with the id it names the row.
    """
    rows = docs.where(docs[id_col].isNotNull() & docs[text_col].isNotNull())
    rows = rows.select(rows[id_col].alias("doc_id"), F.xxhash64(rows[text_col]).alias("th"), worded_lines(rows[text_col]).alias("ls"))
    starts = F.sequence(F.lit(1), F.size("ls") - (size - 1))

    def window(i: Column) -> Column:
        part = F.slice("ls", i, size)
        lines = F.transform(part, lambda p: p["line"])
        return F.struct(
            F.element_at(part, 1)["at"].alias("first"), F.element_at(part, -1)["at"].alias("last"), F.xxhash64(lines).alias("h1"), F.xxhash64(F.lit(1), lines).alias("h2")
        )

    made = rows.where(F.size("ls") >= size).select("doc_id", "th", F.explode(F.transform(starts, window)).alias("w"))
    return made.select("doc_id", "th", "w.*")


def later_places(windows: DataFrame) -> DataFrame:
    """``doc_id, th, spans``: sorted spans (first, last line) of windows that stand earlier too."""
    place = F.struct("doc_id", "th", "first")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("kept"), F.max(place).alias("end")).where("kept != end").drop("end")
    later = windows.join(repeated, ["h1", "h2"]).where(F.struct("doc_id", "th", "first") != F.col("kept"))
    return later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"))


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the lines that the sorted spans cover; linear in lines and spans.

    Spans that overlap or touch merge: a run of covered lines begins where a span starts
    behind the end of the one before (ends never decrease here). What lies between runs stays.
    """
    lines = F.split(text, "\n")
    begins = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i - 1)["last"] + 1 < s["first"], F.lit(True)))
    ends = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["first"] > s["last"] + 1, F.lit(True)))
    begin_at = F.concat(F.transform(begins, lambda s: s["first"]), F.array(F.size(lines)))
    resume_at = F.concat(F.array(F.lit(0)), F.transform(ends, lambda s: s["last"] + 1))
    kept = F.zip_with(resume_at, begin_at, lambda a, b: F.slice(lines, a + 1, F.greatest(b - a, F.lit(0))))
    return F.array_join(F.flatten(kept), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the later places of repeated windows cut out of the text, same columns.

    ``length_col``, if given, is set to the new text's length in code points.
    """
    h, at, th, spans, new = fresh(docs, "row_hash", "span_id", "span_hash", "spans", "new_text")
    later = later_places(written(line_windows(docs, id_col, text_col), "line-windows"))
    later = later.select(later["doc_id"].alias(at), later["th"].alias(th), later["spans"].alias(spans))
    keyed = docs.withColumn(h, F.xxhash64(docs[text_col]))
    both = keyed.join(later, (keyed[id_col] == later[at]) & (keyed[h] == later[th]), "left")
    out = both.withColumn(new, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(without_spans(F.col(text_col), F.col(spans))))
    change = {text_col: F.col(new)} | ({length_col: F.length(new).cast(docs.schema[length_col].dataType)} if length_col else {})
    return out.select(*(change.get(c, F.col(c)).alias(c) for c in docs.columns))
