"""BPE encoding and decoding with a vocabulary file of the ``tokenizers`` library.

A text is cut at the vocabulary's special strings; each part is normalised (NFC, lower case) and
split into words, numerals and runs of signs. A word's UTF-8 bytes are the first symbols, the last
of them marked as a word's end. The symbols stand in a doubly linked list and every neighbouring
pair that can merge in a priority queue by ``(rank, place)``. The lowest is taken and merged, which
puts the new pairs left and right into the queue; entries whose pair has changed meanwhile are
stale and are skipped. A word of n bytes takes O(n log n). Decoding joins the vocabulary's strings,
with the space that the library puts between tokens of a vocabulary without a decoder.

Encoding is local to a row: no shuffle, and nothing is kept but a bounded cache of words per
Python worker. The vocabulary file's path is a parameter; each worker reads it once.

Characters that this Python's Unicode tables don't know yet may have a class or a lower case in
newer ones: the library itself normalises and splits parts that hold one.

Defined cases: a null or empty text has no ids and decodes to an empty text; rows keep their ids,
null and repeated ones included; an empty table gives an empty result; other columns of the input
are ignored. Ids that the vocabulary doesn't have decode to nothing, as the library does.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache, cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gradmesh.llm.common import texts

#: Fixed value of the vocabulary: words, single numerals, runs of other signs.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: The same for texts whose characters are all of kind 0, in the classes of ``re``, which is faster.
PLAIN = re.compile(r"[^\W\d_]+|'(?:[stmd]|re|ve|ll)|\d|(?:[^\w\s]|_)+")
WORD_END = "</w>"
CACHED = 400_000  # words of each of the two generations of a worker's cache
_BATCH = 1 << 22  # characters of an output batch, at least one text


class Kinds(dict):
    """Of a character: 2 where ``unicodedata`` doesn't know it, 1 where its class in ``re`` is
    another than that of ``SPLIT``, else 0. There are as many entries as different characters."""

    def __missing__(self, sign: str) -> int:
        category = unicodedata.category(sign)
        kind = self[sign] = 2 if category == "Cn" else int(category in ("Nl", "No") or "\x1c" <= sign <= "\x1f")
        return kind


def byte_signs() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: the byte's
    own where that is printable, else the next one from code point 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


#: ``follow[a](b)`` is the rank of the pair ``(a, b)``, or None.
Follow = list[Callable[[int], int | None]]


def merged(symbols: list[int], follow: Follow, results: list[int]) -> list[int]:
    """The symbols left when no pair can merge; ``results`` has the merged symbol of each rank."""
    n = len(symbols)
    queue = []
    rank_with = follow[symbols[0]]
    for i in range(1, n):
        right = symbols[i]
        rank = rank_with(right)
        if rank is not None:
            queue.append((rank, i - 1))
        rank_with = follow[right]
    if not queue:
        return symbols
    heapify(queue)
    before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
    while queue:
        rank, i = heappop(queue)
        left, j = symbols[i], after[i]
        if left < 0 or j == n or follow[left](symbols[j]) != rank:
            continue  # stale
        symbols[i] = new = results[rank]
        symbols[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = follow[new](symbols[k])
            if rank is not None:
                heappush(queue, (rank, i))
        h = before[i]
        if h >= 0:
            rank = follow[symbols[h]](new)
            if rank is not None:
                heappush(queue, (rank, h))
    return [s for s in symbols if s >= 0]


class WordBPE(dict):
    """Text to ids and back. As a dict: the ids of a word, kept in two generations."""

    def __init__(self, path: str, cached: int = CACHED) -> None:
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        vocab: dict[str, int] = read["model"]["vocab"]
        self.path, self.cached, self.older, self.kinds = path, cached, {}, Kinds()
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.strings: dict[int, str] = {i: s for s, i in (vocab | self.specials).items()}
        pairs: dict[int, dict[int, int]] = {}
        self.results: list[int] = []
        for a, b in read["model"]["merges"]:
            pairs.setdefault(vocab[a], {}).setdefault(vocab[b], len(self.results))
            self.results.append(vocab[a + b])
        self.follow: Follow = [pairs.get(i, {}).get for i in range(max(self.strings) + 1)]
        signs = byte_signs()
        self.inner, self.last = [vocab[s] for s in signs], [vocab[s + WORD_END] for s in signs]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.older.get(word)
        if found is None:
            b = word.encode()
            symbols = [self.inner[x] for x in b]
            symbols[-1] = self.last[b[-1]]
            found = tuple(merged(symbols, self.follow, self.results))
        if len(self) >= self.cached:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def words(self, part: str) -> list[str]:
        """The normalised words of a part without special strings."""
        kind = max(map(self.kinds.__getitem__, {*part}), default=0)
        if kind == 2:
            t = self.library
            part = t.normalizer.normalize_str(part)
            return [part[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(part)]
        if not part.isascii():
            # a capital sigma is lowered by itself, whatever stands around it
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        return (SPLIT if kind else PLAIN).findall(part.lower())

    def encode(self, text: str) -> list[int]:
        if self.special is None or not self.special.search(text):
            return [*chain.from_iterable(map(self.__getitem__, self.words(text)))]
        ids: list[int] = []
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                ids.append(self.specials[part])
            elif part:
                ids += chain.from_iterable(map(self.__getitem__, self.words(part)))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        found = map(self.strings.get, ids)
        return " ".join(s for s in found if s is not None)


@cache
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


def _batches(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows ``(size, value, ...)`` gathered into record batches of about ``_BATCH``."""
    held, size = [], 0
    for n, *row in rows:
        held.append(row)
        size += n
        if size >= _BATCH:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_ID, _IDS, _TEXT = pa.field("doc_id", pa.int64()), pa.field("ids", pa.list_(pa.int32())), pa.field("text", pa.string())


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row; ``with_decoded`` adds ``text``, what the ids decode to."""
    schema = pa.schema([_ID, _IDS, *([_TEXT] if with_decoded else [])])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = word_bpe(path)
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = t.as_py()
                ids = bpe.encode(text)
                yield (len(text), i, np.array(ids, np.int32), *([bpe.decode(ids)] if with_decoded else []))

    out = "doc_id bigint, ids array<int>" + (", text string" if with_decoded else "")
    return texts(docs, id_col, text_col).mapInArrow(lambda batches: _batches(schema, rows(batches)), out)


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of every row of ids; null ids decode to an empty text."""
    schema = pa.schema([_ID, _TEXT])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = word_bpe(path)
        for b in batches:
            for i, ids in zip(b.column("doc_id").to_pylist(), b.column("ids"), strict=True):
                ids = ids.as_py() or []
                yield len(ids), i, bpe.decode(ids)

    given = tokens.select(tokens[id_col].cast("bigint").alias("doc_id"), tokens[ids_col].cast("array<int>").alias("ids"))
    return given.mapInArrow(lambda batches: _batches(schema, rows(batches)), "doc_id bigint, text string")
