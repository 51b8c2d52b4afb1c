"""Segmented running aggregates (prefix scans) that do not put one key in one task.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one task;
a control log holding a third of all events would then be scanned by a single task.
Here the rows are cut by rank: :func:`chunked` range-partitions them by ``(key, order)``, so
that partitions are even whatever the spacing of the order column and however the rows are
spread over keys, and the partition a row falls in is its chunk. A scan has two levels:

1. a window within ``(key, chunk)``, at most one partition's rows;
2. one summary row per ``(key, chunk)``; a window over those of a key (at most one per
   partition, independent of the row count) gives the carry-in of every chunk, which joins
   back on ``(key, chunk)``.

Range bounds are sampled, so the chunked frame is written once to the shared folder: both
levels then see the same cut, and a lost executor's part is read again. That write is the one
job of a scan that runs before the caller's own action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gradmesh.session import shared_path

CHUNK = "_chunk"


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` is ``sum``, ``max`` or ``min`` of ``expr`` over rows
    before the current one (``inclusive`` also counts the current row)."""

    name: str
    kind: str
    expr: Column
    inclusive: bool = True


def chunked(df: DataFrame, key: str, order: str, chunks: int | None = None) -> DataFrame:
    """``df`` with its chunk, written once; as is if it has one already.

    Without ``chunks`` there are as many ranges as shuffle partitions, of which Spark merges small
    ones by bytes: for a large log set ``spark.sql.shuffle.partitions`` or ``chunks`` to its size.
    """
    if CHUNK in df.columns:
        return df
    by = (F.col(key), F.col(order))
    ranged = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    path = shared_path(df.sparkSession, "chunks")
    out = ranged.withColumn(CHUNK, F.spark_partition_id())
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, for what several actions read."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def within(key: str, order: str) -> WindowSpec:
    """Rows of a chunk, in order."""
    return Window.partitionBy(key, CHUNK).orderBy(order)


def across(key: str) -> WindowSpec:
    """Chunk summaries of a key, in order."""
    return Window.partitionBy(key).orderBy(CHUNK)


def before(w: WindowSpec, inclusive: bool = False) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def running(df: DataFrame, key: str, order: str, specs: list[Running]) -> DataFrame:
    """Adds one column per spec to a chunked frame; ``order`` is unique within a key."""
    agg = {"sum": F.sum, "max": F.max, "min": F.min}
    base = chunked(df, key, order).withColumns({f"_in{i}": s.expr for i, s in enumerate(specs)})
    local = base.withColumns({f"_loc{i}": agg[s.kind](f"_in{i}").over(before(within(key, order), s.inclusive)) for i, s in enumerate(specs)})
    totals = base.groupBy(key, CHUNK).agg(*[agg[s.kind](f"_in{i}").alias(f"_tot{i}") for i, s in enumerate(specs)])
    carry = totals.select(key, CHUNK, *[agg[s.kind](f"_tot{i}").over(before(across(key))).alias(f"_car{i}") for i, s in enumerate(specs)])
    out = local.join(carry, [key, CHUNK], "left")
    for i, s in enumerate(specs):
        loc, car = F.col(f"_loc{i}"), F.col(f"_car{i}")
        if s.kind == "sum":
            value = F.coalesce(car, F.lit(0)) + F.coalesce(loc, F.lit(0))
        else:  # both skip nulls
            value = (F.greatest if s.kind == "max" else F.least)(car, loc)
        out = out.withColumn(s.name, value)
    return out.drop(*[f"_{p}{i}" for i in range(len(specs)) for p in ("in", "loc", "car")])
