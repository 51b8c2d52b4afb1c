"""Line windows and packing against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gradmesh.llm import line_windows as W
from gradmesh.llm import packing as P

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
WS = " \t\n\x0b\x0c\r"


def brute_lines(rows):
    """rows: (id, text), ids distinct; reads the documents in order of id."""
    places = defaultdict(list)
    for i, t in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        ls = [(k, x.strip(WS)) for k, x in enumerate(t.split("\n")) if x.strip(WS)]
        for a, b, c in zip(ls, ls[1:], ls[2:]):
            places[a[1], b[1], c[1]].append((i, a[0], c[0]))
    gone = {(i, k) for p in places.values() for i, a, c in p[1:] for k in range(a, c + 1)}
    return [(i, t if t is None or i is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in rows]


def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, "\n".join(rng.choice(["a", " b ", "c", "", " ", "d\r", f"u{rng.randrange(40)}"]) for _ in range(rng.randrange(25)))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "x\n" * 4000), (203, "x\nx\nx"), (None, "a\nc\na\nc\na")]
    df = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], "doc_id long, text string, n_chars int, spans string, Row_Hash string")
    got = W.dedup_lines(df, length_col="n_chars")
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(brute_lines(rows), key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.Row_Hash == "y" for r in got.collect())
    before, after = ({x.strip(WS) for _, t in rs if t for x in t.split("\n")} for rs in (rows, [(r.doc_id, r.text) for r in got.collect()]))
    assert before - {""} == after - {""}  # each distinct line survives


def test_lines_repeated_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "z\na\nb\nc")], "doc_id long, text string")
    assert sorted(map(tuple, W.dedup_lines(df).collect())) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "z")]


def test_lines_empty_table(spark):
    assert W.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


TEXTS = [None, "", "short text", "<|endoftext|> in a text", "é ü 漢字    '\x00 s's", "word " * 2047, "word " * 2048, "longer piece " * 9000, "a" * 30_000, " " * 9000 + "\n" * 500]


def test_pieces_equal_tokenizers_and_packing_is_exact(spark):
    rng = random.Random(1)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, "lorem ipsum " * rng.randrange(1, 900)) for k in range(300)] + [(None, "no id"), (2, "short text")]
    got = P.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, JSON, group=100).collect()
    tok = Tokenizer.from_file(JSON)
    want = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        at, k = 0, 0
        while at < len(ids):
            n = first if k == 0 else 2048
            want.append((i, k, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at, k = at + n, k + 1
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048


def test_sum_of_squares_wastes_little():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2048)
    bins, offsets = P.sum_of_squares(lengths)
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 2048 and (offsets >= 0).all()
    assert bins.max() + 1 <= lengths.sum() / 2048 * 1.005 + 1


def test_sum_of_squares_follows_its_rule():
    """Capacity 10. Two bins of gap 6 from 4, 4: 6 closes one; then 3 joins the other rather than opening a third kind."""
    bins, _ = P.sum_of_squares([4, 4, 6, 6], 10)
    assert len(set(bins.tolist())) == 2
    assert P.sum_of_squares([], 10)[0].size == 0
    assert P.sum_of_squares([10, 10, 1], 10)[0].max() == 2


def test_sum_of_squares_equals_the_plain_rule():
    """Every choice worked out by the whole sum, then the bins left open packed by best fit."""

    def squares(gaps):
        return sum(c * c for c in Counter(g for g in gaps if g).values())

    def plain(lengths, capacity):
        bins = []  # [gap, members], bins of one gap taken youngest change first
        for k, s in enumerate(lengths):
            best = None, squares([b[0] for b in bins] + [capacity - s])
            for gap in sorted({b[0] for b in bins if b[0] >= s}):
                at = max(i for i, b in enumerate(bins) if b[0] == gap)
                total = squares([b[0] - s * (i == at) for i, b in enumerate(bins)])
                if total < best[1]:
                    best = at, total
            b = [capacity, []] if best[0] is None else bins.pop(best[0])
            bins.append([b[0] - s, [*b[1], k]])
        out = [m for g, m in bins if not g]
        rest = []
        for k in sorted((k for g, m in bins if g for k in m), key=lambda k: (-lengths[k], k)):
            fits = [b for b in rest if b[0] >= lengths[k]]
            b = min(fits, key=lambda b: b[0]) if fits else [capacity, []]
            if not fits:
                rest.append(b)
            b[0] -= lengths[k]
            b[1].append(k)
        return len(out), len(out) + len(rest), {tuple(m) for m in out}

    rng = np.random.default_rng(4)
    for capacity in (7, 12, 30):
        lengths = rng.integers(1, capacity + 1, 120).tolist()
        bins, _ = P.sum_of_squares(lengths, capacity)
        closed, total, members = plain(lengths, capacity)
        got = defaultdict(list)
        for k, b in enumerate(bins.tolist()):
            got[b].append(k)
        assert len(got) == total and members <= {tuple(m) for m in got.values()}


def test_ids_beside_null_ones_stay_whole(spark):
    ids = [None, 2**60 + 1, -(2**62) - 3, 5]
    got = P.pack_documents(spark.createDataFrame([(i, "short", 1.5) for i in ids], "doc_id long, text string, lot double").coalesce(1), RANKS, JSON).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(ids, key=str)


def test_packing_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), RANKS, JSON).count() == 0


def test_repeated_rows_do_not_fill_one_lot(spark):
    rows = [(7, "the same text")] * 300 + [(k, f"text {k}") for k in range(100, 300)]
    got = P.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, JSON, group=20).collect()
    assert len(got) == len(rows)
    lots, at = defaultdict(int), defaultdict(list)
    for r in got:
        lots[r.sequence_id >> 32] += 1
        at[r.sequence_id].append((r.offset, r.length))
    assert max(lots.values()) <= 60
    assert all(a + n <= b for places in at.values() for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:]))
