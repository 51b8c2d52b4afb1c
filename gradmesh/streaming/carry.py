"""What a stream carries per key from micro-batch to micro-batch, as a log of small segments.

A batch writes the rows of the keys that it touched and nothing of the others. Segments are merged
while the one before isn't more than twice as long as the newest, so that a row is rewritten a
logarithm of times at most, the bytes of a batch follow the batch, and few segments are ever read.
The list of live segments is written per batch; a batch that is repeated starts from the list of
the batch before it and overwrites its own. Segments that neither list names are removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A segment is merged into its predecessor unless that has more than so many times its rows.
GROWTH = 2


class Carry:
    """Rows of ``schema`` by ``key`` under the folder ``base`` (shared by all executors)."""

    def __init__(self, spark: SparkSession, base: str, schema: str, key: str = "run_id") -> None:
        self.spark, self.base, self.schema, self.key = spark, base, schema, key

    def segments(self, batch_id: int) -> list[tuple[str, int]]:
        """``(folder name, rows)`` of the live segments after a batch, the oldest first."""
        if batch_id < 0:
            return []
        rows = self.spark.read.schema("at INT, name STRING, n BIGINT").parquet(f"{self.base}/live/{batch_id}").collect()
        return [(r["name"], r["n"]) for r in sorted(rows, key=lambda r: r["at"])]

    def _read(self, names: list[str]) -> DataFrame:
        """The newest row of each key in the segments, which are given the oldest first."""
        cols = [c.split()[0] for c in self.schema.split(", ")]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        each = [self.spark.read.schema(self.schema).parquet(f"{self.base}/{name}").withColumn("_age", F.lit(k)) for k, name in enumerate(names)]
        if len(each) == 1:
            return each[0].select(*cols)
        both = reduce(DataFrame.unionByName, each).groupBy(self.key).agg(F.max_by(F.struct(*cols), "_age").alias("row"))
        return both.select("row.*")

    def before(self, batch_id: int, touched: DataFrame) -> DataFrame:
        """The rows, as of the batch before, of the keys of ``touched``."""
        names = [name for name, _ in self.segments(batch_id - 1)]
        return self._read(names).join(touched.select(self.key).distinct(), self.key, "left_semi")

    def all(self, batch_id: int) -> DataFrame:
        """Every key's row after a batch."""
        return self._read([name for name, _ in self.segments(batch_id)])

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Makes ``rows`` the batch's segment and merges where that is due."""
        earlier = self.segments(batch_id - 1)
        live = [*earlier, self._write(f"batch-{batch_id}", rows)]
        merges = 0
        while len(live) > 1 and live[-2][1] <= GROWTH * live[-1][1]:
            names = [name for name, _ in live[-2:]]
            live[-2:] = [self._write(f"batch-{batch_id}-merge-{merges}", self._read(names))]
            merges += 1
        listed = [(k, name, n) for k, (name, n) in enumerate(live)]
        self.spark.createDataFrame(listed, "at INT, name STRING, n BIGINT").coalesce(1).write.mode("overwrite").parquet(f"{self.base}/live/{batch_id}")
        # the list before last can't be asked for again: what only it named may go
        needed = {name for name, _ in [*live, *earlier]}
        made = [f"batch-{batch_id}", *(f"batch-{batch_id}-merge-{k}" for k in range(merges))]
        last = f"live/{batch_id - 2}"
        gone = {name for name, _ in self.segments(batch_id - 2)} if batch_id >= 2 and self._folder(last)[0].exists(self._folder(last)[1]) else set()
        for name in (gone | set(made)) - needed | ({last} if gone else set()):
            files, path = self._folder(name)
            files.delete(path, True)

    def _write(self, name: str, rows: DataFrame) -> tuple[str, int]:
        rows.write.mode("overwrite").parquet(f"{self.base}/{name}")
        return name, self.spark.read.schema(self.schema).parquet(f"{self.base}/{name}").count()

    def _folder(self, name: str) -> tuple:
        """File system and path of a folder of the carry."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path
