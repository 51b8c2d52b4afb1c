"""Near-duplicates by Order MinHash.

A text's k-mers are its five-word shingles, each labelled with how often it has occurred
before, so that all are distinct. A sketch takes, under one hash function, the ``PICK``
smallest labelled k-mers and hashes them in the order of the text: texts share a sketch if
they share those k-mers and their order, which follows edit similarity. ``SKETCHES`` of them
place a text in as many buckets. At similarity 0.8 a pair shares a sketch with probability
about 0.8**3; the chance to share none of 16 is about 1e-5.

Candidates are verified by a banded alignment of the labelled k-mer sequences: the longest
common subsequence within the band of diagonals that the threshold leaves possible. It is
worked out exactly, as the longest increasing run of common positions, since labelled k-mers
are distinct. With m aligned k-mers the similarity is ``m / (n_a + n_b - m)``, 0.8 or more.

Copies first: texts with equal words are one node, found by an aggregate, so copies are never
paired. Within a bucket all are compared with one hub in each round (``HUBS``): the open member that
shares most buckets overall (in a family of edited copies that is the least edited one). Members
that stay outside the hub's component are open. That is linear in the rows and collapses a family
before any of its pairs form. What two similar texts are then left in different components is found
by an exact join of the members of a bucket (:func:`_left_pairs`), whose condition holds the length
bound and a bound by parity bits: texts have one bit of ``PARITY`` for every hash of a k-mer, set if
an odd number of them falls there, so that two texts have at least as many k-mers of their own as
bits that differ. A pair below the threshold hardly ever comes out of the join, a pair above always.
So every two similar texts that share a bucket end in one class. Classes are connected components
of the verified links, carried from round to round by components, not texts.

Defined cases: null text is empty; empty texts are copies of one another; a text of one to
four words is one k-mer; rows without an id are classes of their own and always stay; repeated
rows of one id are one document; an id with different texts belongs to the classes of all of them,
which are then one (:func:`near_duplicates`); an empty table gives an empty result. Where one text
of each class stays (:func:`one_of_each`) classes are those of texts, whatever ids they share, so
that no text goes without a similar one that stays; other columns, whatever their names, are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradmesh.llm.common import WordHash, fresh, mix, texts, written
from gradmesh.llm.components import components

SHINGLE = 5
PICK = 3
SKETCHES = 16
SIMILARITY = 0.8
HUBS = (1, 1)  # of a bucket, round by round
PARITY = 1024  # bits

#: Odd multipliers, one per sketch: h -> h * m orders the k-mers anew each time.
_MULTIPLIERS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BLOCK = 1 << 20  # cells of one hash matrix


def labelled_kmers(word_hashes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hash of each k-mer with its number of earlier occurrences, in text order."""
    if not len(word_hashes):
        return word_hashes
    n = max(1, len(word_hashes) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(word_hashes))):
        h = mix(h + word_hashes[j : j + n])
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if same.any():
        at = np.arange(n)
        first = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), at, 0))
        seen = np.empty(n, np.uint64)
        seen[order] = at - first
        h = np.where(seen > 0, mix(h + seen * np.uint64(0x9E3779B97F4A7C15)), h)
    return h


def sketches(kmers: np.ndarray, pick: int = PICK) -> np.ndarray:
    """One order-preserving sketch per multiplier, as int64."""
    n = len(kmers)
    if not n:
        return np.zeros(0, np.int64)
    rows = max(1, _BLOCK // n)
    picked = []
    for s in range(0, SKETCHES, rows):
        keys = kmers[None, :] * _MULTIPLIERS[s : s + rows, None]
        picked.append(np.sort(np.argpartition(keys, pick - 1, axis=1)[:, :pick], axis=1) if n > pick else np.tile(np.arange(n), (len(keys), 1)))
    chosen = kmers[np.concatenate(picked)]
    h = np.arange(SKETCHES, dtype=np.uint64)  # a sketch only meets its own kind
    for j in range(chosen.shape[1]):
        h = mix(h + chosen[:, j])
    return h.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of two labelled k-mer sequences; 0 once it can't reach ``least``."""
    both = len(a) + len(b)
    needed = least * both / (1 + least) - 1e-9  # m / (both - m) >= least
    if not len(a) or not len(b) or min(len(a), len(b)) < needed:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    band = both - 2 * needed  # each step off the diagonal leaves a k-mer unaligned
    near = np.abs(at_a - at_b) <= band
    if near.sum() < needed:
        return 0.0
    at_b = at_b[near]
    m = len(at_b) if (np.diff(at_b) > 0).all() else _increasing(at_b.tolist())
    return m / (both - m)


def _increasing(values: list[int]) -> int:
    """Length of the longest increasing subsequence."""
    tails: list[int] = []
    for v in values:
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
    return len(tails)


def parity(kmers: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """Of each of ``bits`` classes of k-mers, is their number odd; as 64-bit words. Two texts'
    words differ in as many bits at most as k-mers occur in one of them only."""
    odd = np.bincount((mix(kmers) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def differing(a: str, b: str, bits: int = PARITY) -> Column:
    """Bits in which two arrays of parity words differ."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.get(a, k).bitwiseXOR(F.get(b, k))) for k in range(bits // 64)])


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, digest, n, sketches`` of every row that has an id; ``row_key`` tells an
    id's texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = WordHash()
        for b in batches:
            digests, sizes, found = [], [], []
            for t in b.column("text"):
                hashes = word.of(t.as_py())
                kmers = labelled_kmers(hashes)
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(kmers))
                found.append(sketches(kmers))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "row_key": b.column("row_key"), "digest": pa.array(digests, pa.binary()),
                "n": pa.array(sizes, pa.int64()), "sketches": pa.array(found, pa.list_(pa.int64())),
            })

    return _keyed(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, row_key bigint, digest binary, n bigint, sketches array<bigint>")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).where("doc_id IS NOT NULL").withColumn("row_key", F.xxhash64("text"))


def with_kmers(found: DataFrame) -> DataFrame:
    """``rep, kmers, parity`` of ``rep, text``: the labelled k-mers in text order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = WordHash()
        for b in batches:
            kmers = [labelled_kmers(word.of(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_pydict({
                "rep": b.column("rep"), "kmers": pa.array([k.view(np.int64) for k in kmers], pa.list_(pa.int64())),
                "parity": pa.array([parity(k) for k in kmers], pa.list_(pa.int64())),
            })

    return found.select("rep", "text").mapInArrow(run, "rep bigint, kmers array<bigint>, parity array<bigint>")


def verified(pairs: DataFrame, kmers: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs ``(a, b, ...)`` whose texts are similar.

    The k-mers that two texts have in common, aligned or not, bound the similarity from above;
    only pairs that pass this bound are aligned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a_kmers"), batch.column("b_kmers"), strict=True)
            keep = [similarity(np.asarray(a.values), np.asarray(b.values), least) >= least for a, b in both]
            yield batch.drop_columns(["a_kmers", "b_kmers"]).filter(pa.array(keep, pa.bool_()))

    left = kmers.select(F.col("rep").alias("a"), F.col("kmers").alias("a_kmers"))
    right = kmers.select(F.col("rep").alias("b"), F.col("kmers").alias("b_kmers"))
    total, common = F.size("a_kmers") + F.size("b_kmers"), F.size(F.array_intersect("a_kmers", "b_kmers"))
    both = pairs.join(left, "a").join(right, "b").where(common >= total * (least / (1 + least)) - 1e-9)
    return both.select(*pairs.columns, "a_kmers", "b_kmers").mapInArrow(run, pairs.schema)


def _round(places: DataFrame, kmers: DataFrame, n_hubs: int, least: float) -> tuple[DataFrame, DataFrame]:
    """The hubs of the buckets that have open members, and the new links to them.

    Hubs are the open members with the highest scores, ties to the smallest id. They meet all
    members outside their component but earlier hubs, which have met them in their round.
    """
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("score"), "rep"))
    hubs = places.where("open").withColumn("rank", rank).where(F.col("rank") <= n_hubs)
    hubs = written(hubs.select("bucket", F.struct("rep", "n", "component").alias("hub")), "omh-hubs")
    met = places.where("NOT was_hub").join(hubs, "bucket").where("component != hub.component")
    fits = (F.col("n") >= least * F.col("hub.n")) & (F.col("hub.n") >= least * F.col("n"))
    pairs = met.where(fits).select(F.col("rep").alias("a"), F.col("hub.rep").alias("b"), F.col("component").alias("a_component"), F.col("hub.component").alias("b_component"))
    return hubs, written(verified(pairs.distinct(), kmers, least), "omh-links")


def _up(rows: DataFrame, step: DataFrame | None) -> DataFrame:
    """``rows`` with the components that a step of :func:`components` gives theirs."""
    if step is None:
        return rows
    to = step.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return rows.join(to, "component", "left").withColumn("component", F.coalesce("merged", "component")).drop("merged")


def _settled(places: DataFrame, hubs: DataFrame, step: DataFrame | None) -> DataFrame:
    """``places`` with new components; members in a component of a hub of theirs are closed."""
    now = _up(places, step)
    hub_now = _up(hubs.select("bucket", "hub.rep", "hub.component"), step)
    closed = hub_now.select("bucket", "component").distinct().withColumn("closed", F.lit(True))
    were = hub_now.select("bucket", "rep").withColumn("now_hub", F.lit(True))
    both = now.join(closed, ["bucket", "component"], "left").join(were, ["bucket", "rep"], "left")
    return both.select("bucket", "rep", "n", "score", "component", (F.col("open") & F.col("closed").isNull()).alias("open"), (F.col("was_hub") | F.col("now_hub").isNotNull()).alias("was_hub"))


def _left_pairs(places: DataFrame, kmers: DataFrame, least: float) -> DataFrame:
    """Pairs from different components that share a bucket and may be similar, with both components.

    With m aligned k-mers, ``n_a + n_b - 2 m`` are of one text only; at ``least`` or more that is
    ``(n_a + n_b) * (1 - least) / (1 + least)`` at most, and the parity words differ in no more
    bits. Each pair has an end outside the component that has most of the bucket's members; only
    such ends are joined with all members.
    """
    held = places.groupBy("bucket", "component").agg(F.count("*").alias("texts")).groupBy("bucket")
    held = held.agg(F.count("*").alias("components"), F.max(F.struct("texts", "component"))["component"].alias("main")).where("components > 1")
    met = places.join(held.select("bucket", "main"), "bucket").join(kmers.select("rep", "parity"), "rep").select("bucket", "rep", "n", "component", "main", "parity")
    met = written(met, "omh-left")
    ends = met.where("component != main").select("bucket", F.col("rep").alias("b"), F.col("n").alias("b_n"), F.col("component").alias("b_component"), F.col("parity").alias("b_parity"))
    fits = (F.col("n") >= least * F.col("b_n")) & (F.col("b_n") >= least * F.col("n"))
    once = (F.col("component") == F.col("main")) | (F.col("rep") < F.col("b"))
    near = differing("parity", "b_parity") <= (F.col("n") + F.col("b_n")) * ((1 - least) / (1 + least)) + 1e-9
    # the members grow with the texts: the same merge join at every size, never a broadcast
    pairs = met.hint("merge").join(ends, (met["bucket"] == ends["bucket"]) & (F.col("component") != F.col("b_component")) & fits & once & near)
    return pairs.select(F.col("rep").alias("a"), "b", F.col("component").alias("a_component"), "b_component").distinct()


def text_classes(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, class_id`` of every row that has an id: the smallest id of the class of
    its text."""
    made = written(sketched(docs, id_col, text_col), "omh-sketches")
    reps = made.groupBy("digest").agg(F.min(F.struct("doc_id", "row_key")).alias("at"), F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    # a node is a text: ids can't stand for it, as one may have several
    reps = written(reps.select("digest", "at.*", "n", "sketches", F.monotonically_increasing_id().alias("rep")), "omh-reps")
    all_places = reps.select("rep", "n", F.explode("sketches").alias("bucket"))
    shared = all_places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    places = written(all_places.join(shared, "bucket"), "omh-shared")
    score = places.groupBy("rep").agg(F.sum("size").alias("score"))
    # the ids grow with the texts: the same merge join at every size, never a broadcast
    needed = reps.join(score, "rep").select("doc_id", "row_key", "rep").hint("merge")
    chosen = _keyed(docs, id_col, text_col).join(needed, ["doc_id", "row_key"]).dropDuplicates(["doc_id", "row_key"])
    kmers = written(with_kmers(chosen), "omh-kmers")
    places = places.join(score, "rep").select("bucket", "rep", "n", "score", F.col("rep").alias("component"), F.lit(True).alias("open"), F.lit(False).alias("was_hub"))
    places = written(places, "omh-places")

    classes = reps.select("digest", "doc_id", F.col("rep").alias("component"))
    for n_hubs in HUBS:
        if places.where("open").isEmpty():
            break
        hubs, links = _round(places, kmers, n_hubs, least)
        step = _step(links)
        classes = _up(classes, step)
        places = written(_settled(places, hubs, step), "omh-places")
    links = written(verified(_left_pairs(places, kmers, least), kmers, least), "omh-links")
    classes = _up(classes, _step(links))
    lowest = classes.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return made.select("doc_id", "row_key", "digest").join(classes.select("digest", "component").join(lowest, "component"), "digest").select("doc_id", "row_key", "class_id")


def _step(links: DataFrame) -> DataFrame | None:
    if links.isEmpty():
        return None
    return components(links.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id`` of every distinct id: the smallest id of its class. Classes that share
    an id, through texts of its own, are one."""
    of = text_classes(docs, least, id_col, text_col).select("doc_id", "class_id").distinct()
    of = written(of, "omh-classes")
    lowest = of.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("classes"))
    more = lowest.where("classes > 1").select("doc_id", F.col("class_id").alias("low"))
    if more.isEmpty():
        return lowest.select("doc_id", "class_id")
    links = of.join(more, "doc_id").where("class_id != low").select(F.col("low").alias("a"), F.col("class_id").alias("b"))
    to = components(links).select(F.col("node").alias("class_id"), F.col("component").alias("merged"))
    return lowest.select("doc_id", "class_id").join(to, "class_id", "left").select("doc_id", F.coalesce("merged", "class_id").alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for the classes of their texts: of each class the row with
    the smallest id (of several texts of that id the one with the smallest hash; of repeated rows
    the first by all their columns), and all rows without an id."""
    of = written(text_classes(docs, id_col=id_col, text_col=text_col, **options), "omh-classes")
    each = of.groupBy("class_id", "doc_id", "row_key").agg(F.count("*").alias("rows"))
    least_one = each.groupBy("class_id").agg(F.min(F.struct("doc_id", "row_key")).alias("at"))
    first = each.join(least_one, "class_id").withColumn("first", F.struct("doc_id", "row_key") == F.col("at"))
    first = written(first.select("doc_id", "row_key", "first", "rows"), "omh-first")
    ident, key, key_of = fresh(docs, "_id", "_key", "_key_of")
    named = [F.col("doc_id").alias(ident), F.col("row_key").alias(key_of)]
    given = docs.withColumn(key, F.xxhash64(F.coalesce(docs[text_col], F.lit(""))))
    this = (given[id_col].cast("bigint") == F.col(ident)) & (given[key] == F.col(key_of))
    kept = given.join(first.where("NOT first").select(*named), this, "left_anti")
    again = first.where("first AND rows > 1").select(*named)
    if again.isEmpty():
        return kept.select(*docs.columns)
    order = Window.partitionBy(id_col, key).orderBy(F.to_json(F.struct(*docs.columns)))
    once = kept.join(again, this, "left_semi").withColumn(ident, F.row_number().over(order)).where(F.col(ident) == 1)
    return kept.join(again, this, "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))
