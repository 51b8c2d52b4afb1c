"""Best-fit packing by the sum-of-squares rule.

Each document is tokenised, ended with token 0 and, where longer than a sequence, cut into
full pieces behind a first piece with the rest. A piece goes into the bin that makes the sum
over all residual gaps of (open bins with that gap)^2 smallest; a new bin is one of the
choices. That keeps the gaps diverse and closes nearly all bins exactly. The bins still open
at the end are packed anew, longest piece first into the smallest gap that takes it.

Full pieces are sequences of their own. The others are dealt by a hash into groups of about
``GROUP`` pieces, each packed in one task: memory is bounded by twice ``GROUP`` and a group wastes
a few bins at most, so that the loss is a fixed small share at any size. The table of pieces
is written before packing; tokenising is done once and survives lost executors.

Token ids equal those of ``tokenizers`` on byte_bpe_50k.json, made by the faster ``tiktoken``
from the same vocabulary as ranks (the special token's text included); texts that it cannot
take go through ``tokenizers`` itself.

Defined cases: a null or empty text is one piece with token 0; repeated rows and null ids are
packed row by row; ties go to the smallest gap; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradmesh.llm.common import texts, written

CAPACITY = 2048
GROUP = 65_536
END = 0
SPECIAL = {"<|endoftext|>": 50256}  # fixed value of the vocabulary


@cache
def encoder(ranks_path: str, json_path: str) -> Callable[[str], list[int]]:
    """Text to ids."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except (ValueError, UnicodeError, RuntimeError):
            return Tokenizer.from_file(json_path).encode(text, add_special_tokens=False).ids

    return encode


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, ranks_path: str, json_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, json_path)
        for b in batches:
            rows = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.array([*encode(t.as_py()), END], "<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                rows += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [c.split()[0] for c in PIECES.split(", ")])

    return texts(docs, id_col, text_col).mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (0 < length <= capacity), placed in the given order."""
    lengths = np.asarray(lengths, np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    members: list[list[int]] = []
    for k, s in enumerate(lengths.tolist()):
        here = count[s:capacity]
        # what filling a bin with gap s + i changes: one bin less there, one more at gap i
        change = 2 * (count[: capacity - s] - here) + 2
        if s < capacity:
            change[0] -= 1  # a bin filled to the brim isn't open any more
            change[here == 0] = np.iinfo(np.int64).max
            gap = int(change.argmin())
        if s < capacity and change[gap] < 2 * count[capacity - s] + 1:
            b = by_gap[s + gap].pop()
            count[s + gap] -= 1
            members[b].append(k)
        else:
            b, gap = len(members), capacity - s
            members.append([k])
        if gap:
            by_gap[gap].append(b)
            count[gap] += 1
    still_open = {b for bins in by_gap for b in bins}
    closed = [m for b, m in enumerate(members) if b not in still_open]
    rest = sorted((k for b in still_open for k in members[b]), key=lambda k: (-lengths[k], k))
    closed += _best_fit(lengths, rest, capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, m in enumerate(closed):
        bins[m] = b
        offsets[m] = np.cumsum(lengths[m]) - lengths[m]
    return bins, offsets


def _best_fit(lengths: np.ndarray, order: list[int], capacity: int) -> list[list[int]]:
    count = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    for k in order:
        s = int(lengths[k])
        fits = np.flatnonzero(count[s:])
        if len(fits):
            gap = s + int(fits[0])
            m = by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, m = capacity, []
            bins.append(m)
        m.append(k)
        by_gap[gap - s].append(m)
        count[gap - s] += gap > s
    return bins


def pack(found: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that :func:`pieces` made and that are written."""
    full = found.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = found.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))

    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        # Arrow all the way: an id beside a null one stays a whole number
        return rows.select(names).append_column("sequence_id", pa.array(bins + (key[0].as_py() << 32), pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = short.withColumn("order", order).withColumn("lot", F.pmod("order", F.lit(groups)))
    # repeated rows fall into one lot: lots far beyond ``group`` are split by the place of the row
    large = dealt.groupBy("lot").agg(F.count("*").alias("n")).where(F.col("n") > 2 * group).select("lot", F.ceil(F.col("n") / group).alias("parts"))
    large = written(large, "large-lots")
    if not large.isEmpty():
        dealt = dealt.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(large), "lot", "left")
        dealt = dealt.withColumn("lot", F.col("lot") + groups * F.pmod("row", F.coalesce("parts", F.lit(1)))).drop("row", "parts")
    return dealt.groupBy("lot").applyInArrow(run, f"{PIECES}, sequence_id bigint, offset bigint").unionByName(full)


def pack_documents(docs: DataFrame, ranks_path: str, json_path: str, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return pack(written(pieces(docs, ranks_path, json_path, capacity, id_col, text_col), "pieces"), capacity, group)
