"""Synthetic samples and the shard text writer.

Features are standard normal (Box-Muller over a hash of seed, row and slot), the label is ``score > 0`` with the reference's
score ``0.5*x0 + 0.3*x1 - 0.2*x2 + 0.1*x3`` (slots past the fourth weigh 0), and lines are
``%.4f`` features then a ``%.1f`` label, space separated. Spark's generator is not
Python's ``random``, so values differ from the reference's files; the rule is the same.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference generator.
SCORE_COEFS = (0.5, 0.3, -0.2, 0.1)
N_SHARDS = 3
PER_SHARD = 50
N_FEATURES = 4
SEED = 42


def score(x: Column | str) -> Column:
    """The generator's linear score over the first four slots."""
    x = F.col(x) if isinstance(x, str) else x
    terms = [F.lit(c) * F.coalesce(F.get(x, j), F.lit(0.0)) for j, c in enumerate(SCORE_COEFS)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def label_by_score(samples: DataFrame) -> DataFrame:
    """Replace ``y`` by the generator's rule ``1.0 if score(x) > 0 else 0.0``."""
    return samples.withColumn("y", F.when(score("x") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


#: Draws of one seed, row and slot: 13 hex digits of a digest are 52 bits of a uniform.
DIGITS = 13


def _uniform(key: Column, part: int) -> Column:
    """In (0, 1), from one half of the digest of ``key``."""
    bits = F.conv(F.substring(F.md5(key), 1 + part * DIGITS, DIGITS), 16, 10).cast("double")
    return (bits + 0.5) / float(16**DIGITS)


def gaussian(row_key: Column, slot: int, seed: int = SEED) -> Column:
    """A standard normal draw by Box-Muller from a hash of (seed, row key, slot): the same for
    the same seed, whatever the partitioning or the engine."""
    key = F.concat_ws(":", F.lit(str(int(seed))), row_key.cast("string"), F.lit(str(int(slot))))
    return F.sqrt(F.log(_uniform(key, 0)) * -2.0) * F.cos(_uniform(key, 1) * (2 * math.pi))


def with_gaussian_features(rows: DataFrame, k: int = N_FEATURES, seed: int = SEED, row_key: str = "row_id") -> DataFrame:
    """Add ``x``: k independent standard normal draws per row, keyed by ``row_key``."""
    return rows.withColumn("x", F.array(*[gaussian(F.col(row_key), j, seed) for j in range(int(k))]))


def generate_samples(
    spark: SparkSession,
    n_shards: int = N_SHARDS,
    per_shard: int = PER_SHARD,
    k: int = N_FEATURES,
    seed: int = SEED,
) -> DataFrame:
    """``(shard_id, x, y)``: ``per_shard`` rows for each shard 1..n_shards, labelled by score."""
    rows = spark.range(int(n_shards) * int(per_shard)).select(
        (F.col("id") % int(n_shards) + 1).cast("int").alias("shard_id"), F.col("id").alias("row_id")
    )
    return label_by_score(with_gaussian_features(rows, k, seed))


def format_lines(samples: DataFrame) -> DataFrame:
    """``(shard_id, value)``: features as ``%.4f`` then the label as ``%.1f``."""
    feats = F.transform("x", lambda v: F.format_string("%.4f", v))
    value = F.concat_ws(" ", F.array_join(feats, " "), F.format_string("%.1f", F.col("y")))
    return samples.select("shard_id", value.alias("value"))


def write_shards(lines: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write ``(shard_id, value)`` lines as text under ``path/shard_id=<id>/``.

    Each task writes its own file per shard, so no shard is funnelled through one task;
    ``read_shards`` takes the id from the folder. (The reference writes one file per shard
    with a comment header, which the reader drops anyway.)
    """
    lines.select("shard_id", "value").write.mode(mode).partitionBy("shard_id").text(path)
    return path


def write_named_shards(lines: DataFrame, path: str, order: str = "pos") -> list[str]:
    """Write the lines of each shard, in ``order``, as ``path/shard_<id>.txt``, a folder of part
    files; returns those folders, by id.

    One scan and one sort for all shards: rows are dealt by ranges of ``(shard_id, order)``, so
    that a large shard is written by several tasks, into one folder per shard, which then gets its
    name by the Hadoop file system. A shard without lines has no folder.
    """
    spark = lines.sparkSession
    made = f"{path}/by-shard"
    by = lines.select("shard_id", order, "value").repartitionByRange("shard_id", order).sortWithinPartitions("shard_id", order)
    by.select("shard_id", "value").write.partitionBy("shard_id").text(made)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(made)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(top):
        kind, _, value = status.getPath().getName().partition("=")
        if kind == "shard_id" and value.lstrip("-").isdigit():
            found[int(value)] = f"{path}/shard_{int(value)}.txt"
            if not files.rename(status.getPath(), hadoop.Path(found[int(value)])):
                raise OSError(f"can't rename {status.getPath()} to {found[int(value)]}")
    files.delete(top, True)
    return [found[i] for i in sorted(found)]
