"""Raw console lines as text: one console per run, its lines in files that keep arriving.

A file belongs to the run of its folder (``run_id=<id>``, as ``partitionBy`` writes) or of its name
(``run_<id>.txt``, ``run_<id>-<part>.txt``). Where there are more consoles than a store bears files,
consoles share files: those in a folder ``runs=many`` have lines ``<run id>\\t<text>`` of any runs.
Files of a run that come in one micro-batch are read in the order of their names, later ones after them; a file is written once and not appended to. Lines
get ``seq`` 0, 1, 2, ... per run in that order: :func:`numbered` counts on from what the stream
carries of the run, by a scan that cuts a hot run into chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmesh.operators.scan import CHUNK, Running, chunked, running

# Where a console file has its run.
RUN_DIR = r"run_id=(-?\d+)/[^/]*$"
RUN_FILE = r"run_(-?\d+)(?:-[^/]*)?\.txt$"
SHARED_DIR = r"runs=many/[^/]*$"
#: Of a line in a shared file.
RUN_LEAD = r"^(-?\d+)\t"
#: Consoles with files of their own, of those that :func:`write_consoles` writes.
OWN_FILES = 16

SCHEMA = "value STRING"
CARRY = "run_id BIGINT, lines BIGINT"


def console_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``value, file, block`` of the lines of all files under ``path`` as they come; only ``\\n``
    ends a line. ``maxFilesPerTrigger`` and the like are options."""
    raw = spark.readStream.schema(SCHEMA).option("lineSep", "\n").option("recursiveFileLookup", "true").options(**options).text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("bigint").alias("block"))


def numbered(batch: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(run_id, seq, value)`` of a micro-batch of :func:`console_stream`, and the new carry.

    ``carry(run_id, lines)`` has how many lines of a run have come before. Files and lines without
    a run are left out.
    """
    found = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    shared = F.col("file").rlike(SHARED_DIR)
    run = F.when(shared, found("value", RUN_LEAD).try_cast("bigint")).otherwise(F.coalesce(*[found("file", p) for p in (RUN_DIR, RUN_FILE)]).cast("bigint"))
    value = F.when(shared, F.expr("substring(value, instr(value, '\\t') + 1)")).otherwise(F.col("value"))
    # the batch is a static frame: a line's place in its split is its row's place in its partition
    lines = batch.select(run.alias("run_id"), F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias("pos"), value.alias("value")).where("run_id IS NOT NULL")
    counted = running(chunked(lines, "run_id", "pos"), "run_id", "pos", [Running("at", "sum", F.lit(1))])
    out = counted.join(carry, "run_id", "left").select("run_id", (F.coalesce("lines", F.lit(0)) + F.col("at") - 1).cast("bigint").alias("seq"), "value", CHUNK)
    now = counted.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).join(carry, "run_id", "left")
    return out.drop(CHUNK), now.select("run_id", (F.coalesce("lines", F.lit(0)) + F.col("n")).alias("lines"))


def write_consoles(lines: DataFrame, path: str) -> None:
    """Appends ``lines(run_id, seq, value)`` to the consoles under ``path``, each run's in order.

    The ``OWN_FILES`` runs with most lines write files of their own (``run_id=<id>`` folders), the
    others share files: their number follows the bytes, not the runs. Rows are dealt by ranges
    of run and place, so a hot run is written by several tasks, whose files are read in their order.
    """
    busy = lines.where("run_id IS NOT NULL").groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "run_id").limit(OWN_FILES)
    own = F.col("run_id").isin([r["run_id"] for r in busy.collect()])
    dealt = lambda df: df.repartitionByRange("run_id", "seq").sortWithinPartitions("run_id", "seq")
    dealt(lines.where(own)).select("run_id", "value").write.mode("append").partitionBy("run_id").text(path)
    shared = dealt(lines.where(~own)).select(F.concat(F.col("run_id").cast("string"), F.lit("\t"), F.coalesce("value", F.lit(""))))
    shared.write.mode("append").text(f"{path}/runs=many")
