"""Text shards -> samples.

A shard is a grouping key, not a Spark partition: lines of one shard may sit in many
files and splits, and every per-shard fact (width, row count) is a grouped aggregate.

Lines schema: ``shard_id INT, pos STRUCT<file STRING, file_block_start BIGINT, id BIGINT>,
value STRING``; ``pos`` orders lines within a shard as they were read (file name, split
start, then read order within the split).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmesh.functions.numeric import SEPARATORS, lenient_double, tokens
from gradmesh.session import shared_path

# Shard file naming (``shard_<id>.txt``, a file or a folder of part files) and
# the partition-folder form.
SHARD_FILE_ID = r"shard_(\d+)\.txt(?:/[^/]*)?$"
SHARD_DIR_ID = r"shard_id=(\d+)/[^/]*$"
#: A line's ``id`` times this, plus its token count, is one number.
PLACE = 10**10


def read_shards(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1 + S2: read newline-delimited shard files; derive ``shard_id`` from the file name
    (``shard_<id>.txt``) or from a ``shard_id=<id>`` folder (as ``partitionBy`` writes).

    Only ``\\n`` ends a line, so a ``\\r`` stays part of the line as in the reference.
    Lines of files whose path carries no shard id are kept with a NULL id; they come out as
    rejects (``no_shard_id``), never as samples.
    """
    df = spark.read.option("lineSep", "\n").text(path)
    fpath = F.col("_metadata.file_path")
    by_name = F.nullif(F.regexp_extract(fpath, SHARD_FILE_ID, 1), F.lit("")).cast("int")
    if "shard_id" in df.columns:  # partition discovery already gave the folder id
        by_dir = F.col("shard_id").cast("int")
    else:
        by_dir = F.nullif(F.regexp_extract(fpath, SHARD_DIR_ID, 1), F.lit("")).cast("int")
    pos = F.struct(
        fpath.alias("file"),
        F.col("_metadata.file_block_start").cast("bigint").alias("file_block_start"),
        F.monotonically_increasing_id().alias("id"),
    )
    return df.select(F.coalesce(by_name, by_dir).alias("shard_id"), pos.alias("pos"), F.col("value"))


class ShardFiles:
    """The files of the shards as they were when a run began, and which shards have lost any since.

    Listing is Spark's (names and lengths, no content); the first listing is written to the shared
    folder, and only the ids of lost shards come to the driver.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        kept = shared_path(spark, "shard-files")
        self._listed().write.parquet(kept)
        self.first = spark.read.schema("file STRING, length BIGINT, shard_id INT").parquet(kept)

    def _listed(self) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
        ids = [F.nullif(F.regexp_extract("path", p, 1), F.lit("")).cast("int") for p in (SHARD_FILE_ID, SHARD_DIR_ID)]
        return files.select(F.col("path").alias("file"), "length", F.coalesce(*ids).alias("shard_id")).where("shard_id IS NOT NULL")

    def lost(self) -> list[int]:
        """Shards of which a file is gone or shorter than it was."""
        try:
            now = self._listed().select("file", F.col("length").alias("now"))
        except AnalysisException:  # nothing is left under the path
            now = self.spark.createDataFrame([], "file STRING, now BIGINT")
        bad = self.first.join(now, "file", "left").where("now IS NULL OR now < length")
        return [r["shard_id"] for r in bad.select("shard_id").distinct().collect()]


def data_lines(lines: DataFrame) -> DataFrame:
    """S3: drop comment lines (first char ``#``) and empty lines. No trimming: lines of
    blanks or a lone ``\\r`` are data lines, as in the reference."""
    v = F.col("value")
    return lines.where((v != F.lit("")) & ~v.startswith("#"))


def tokenize(lines: DataFrame) -> DataFrame:
    """Add ``tok ARRAY<STRING>`` (split on runs of space / tab) and ``n_tok``."""
    return lines.withColumn("tok", tokens("value")).withColumn("n_tok", F.size("tok"))


def shard_schema(lines: DataFrame) -> DataFrame:
    """Per shard, ``width`` = token count of the first data line that has a token,
    ``n_lines`` = data lines; ``accepted`` when there is a line and ``width >= 2``.

    Lines are hash-aggregated by split: the least ``id`` with its token count, as one decimal (a
    line's text in the aggregate would have each task sort its lines). The splits of a shard, a few
    rows, are then aggregated by their place, so a huge shard is not one task.
    """
    has_token = F.btrim("value", F.lit(SEPARATORS)) != ""
    first = F.when(has_token, F.col("pos.id").cast("decimal(19,0)") * F.lit(PLACE).cast("decimal(11,0)") + F.size(tokens("value")).cast("decimal(10,0)"))
    split = (F.col("pos.file").alias("file"), F.col("pos.file_block_start").alias("block"))
    splits = lines.where(F.col("shard_id").isNotNull()).groupBy("shard_id", *split).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n_lines"))
    agg = splits.groupBy("shard_id").agg(
        F.min_by("first", F.when(F.col("first").isNotNull(), F.struct("file", "block", "first"))).alias("first"),
        F.sum("n_lines").alias("n_lines"),
    )
    width = F.coalesce(F.pmod("first", F.lit(PLACE).cast("decimal(11,0)")), F.lit(0)).cast("int")
    return agg.select("shard_id", width.alias("width"), "n_lines").withColumn("accepted", (F.col("n_lines") > 0) & (F.col("width") >= 2))


def _with_schema(lines: DataFrame, schema: DataFrame) -> DataFrame:
    """Tokens and the shard's width on every line. The per-shard side is planned by its size."""
    return tokenize(lines.join(schema.select("shard_id", "width", "accepted"), "shard_id", "left"))


def parse_samples(lines: DataFrame, schema: DataFrame, max_features: int | None = None) -> DataFrame:
    """S6 for the data lines of accepted shards: ``x`` = first ``width-1`` tokens read leniently,
    ``y`` = token ``width``; extra tokens are ignored. Rows with fewer than ``width`` tokens
    are rejects (see ``rejected_lines``). S8: ``max_features``, if given, clamps ``x``."""
    j = _with_schema(lines, schema).where(F.col("accepted") & (F.col("n_tok") >= F.col("width")))
    n = F.col("width") - 1 if max_features is None else F.least(F.col("width") - 1, F.lit(int(max_features)))
    return j.select(
        "shard_id", "pos",
        F.transform(F.slice("tok", F.lit(1), n), lenient_double).alias("x"),
        lenient_double(F.element_at("tok", F.col("width"))).alias("y"),
    )


def rejected_lines(lines: DataFrame, schema: DataFrame) -> DataFrame:
    """Data lines that do not become samples, with a reason: ``no_shard_id`` (the file's
    name carries none), ``shard_rejected`` (no usable width) or ``short_row`` (fewer tokens
    than the width)."""
    j = _with_schema(lines, schema)
    reason = F.when(F.col("shard_id").isNull(), F.lit("no_shard_id")).when(~F.col("accepted"), F.lit("shard_rejected")).when(
        F.col("n_tok") < F.col("width"), F.lit("short_row")
    )
    return j.select("shard_id", "pos", "value", "n_tok", reason.alias("reason")).where(F.col("reason").isNotNull())


def load_shards(
    spark: SparkSession, path: str | list[str], max_features: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1-S8 end to end: ``(samples, rejects, schema)`` from shard files."""
    return lines_to_samples(read_shards(spark, path), max_features)


def lines_to_samples(lines: DataFrame, max_features: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3-S8 over any lines frame: ``(samples, rejects, schema)``.

    The schema, one row a shard, is written once to the shared folder, so that joins with it are
    planned by its real size: lines aren't dealt by shard, of which there may be a handful.
    """
    kept = data_lines(lines)
    path = shared_path(lines.sparkSession, "shard-schema")
    found = shard_schema(kept)
    found.write.parquet(path)
    schema = lines.sparkSession.read.schema(found.schema).parquet(path)
    return parse_samples(kept, schema, max_features), rejected_lines(kept, schema), schema
