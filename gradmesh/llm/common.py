"""Helpers shared by the corpus operators: table access, written intermediates, words."""

from __future__ import annotations

import os

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmesh.session import shared_path

#: White space of all operators: space and \t \n \v \f \r. Words are the runs between.
WS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only, null texts empty: no other column of ``docs`` can clash."""
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none is a column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    Cuts lineage and recomputation; a lost executor loses nothing of it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of ``text`` (native)."""
    return F.array_remove(F.split(F.translate(text, WS, " " * len(WS)), " "), "")


class WordHash(dict):
    """64-bit hash of a word (bytes), cached; emptied when it grows past ``limit`` words."""

    def __init__(self, limit: int = 500_000) -> None:
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, text: str | None) -> np.ndarray:
        """The hash of each word of ``text``, in order. ``bytes.split`` splits at WS only."""
        ws = (text or "").encode("utf-8", "surrogatepass").split()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
