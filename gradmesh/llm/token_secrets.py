"""Secrets by token efficiency.

A byte-pair vocabulary packs natural words into few tokens and random strings into many.
Candidate strings (16 or more of ``A-Za-z0-9+/_=-`` with a letter) whose characters per token
fall below ``max_ratio`` are reported as ``random``, unless they are known non-secrets: bare
md5/sha1/sha256/sha512 digests, UUIDs, dates with or without a time and identifiers made of words.

A candidate that passes as a whole can hide a secret behind a path or a name. So its parts
between ``/ = _ -`` of 16 or more characters are judged alone, and so is every window of tokens
that is just 16 or more characters long; parts and joined windows below ``max_ratio`` are reported.
Digests, UUIDs and dates that stand between other parts are left out of the windows.

Base kinds assign, access and hex follow the stated patterns, leftmost and not overlapping
within a kind, failing matches dropped without a retry.

Defined cases: null text is empty and has no span; offsets are code points; equal rows give
equal results; candidates longer than ``PIECE`` are tokenised piece by piece, so cost stays linear; a
window of letter-only words and short numbers is an identifier; kinds may overlap.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from gradmesh.llm.common import texts

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
MAX_RATIO = 2.2  # characters per token; words of natural languages have 3 and more
WORD_RATIO = 1.85  # of letters in the case of a word, among which rare and made-up words get down to 2
PIECE = 512
LEAST = 16  # characters of a candidate, a part or a window

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_FIXED = r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_TIME = r"(?:[Tt_-]?[0-9]{2}(?:-?[0-9]{2}){0,2}(?:[0-9]{3}){0,3}(?:[Zz]|[+-][0-9]{2}-?[0-9]{2})?)?"
_KNOWN = re.compile(rf"(?:{_FIXED}|[0-9+=/_-]+|(?:[0-9]{{4}}-)?[0-9]{{2}}-[0-9]{{2}}{_TIME})")
_KNOWN_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{_FIXED}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_TIME})(?![A-Za-z0-9])")
_PART = re.compile(rf"[A-Za-z0-9+]{{{LEAST},}}")
_IDENTIFIER = re.compile(r"(?:[A-Za-z]+|[0-9]{1,4})(?:[_/=+-](?:[A-Za-z]+|[0-9]{1,4}))+")


@cache
def encoder(path: str) -> tiktoken.Encoding:
    import public_tokenizers

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(text: str, enc: tiktoken.Encoding) -> list[int]:
    """Characters of each token (of an ASCII text)."""
    return [len(x) for i in range(0, len(text), PIECE) for x in enc.decode_tokens_bytes(enc.encode_ordinary(text[i : i + PIECE]))]


def ratio(text: str, enc: tiktoken.Encoding) -> float:
    """Characters per token."""
    return len(text) / max(len(token_sizes(text, enc)), 1)


def least_ratio(s: str, max_ratio: float) -> float:
    """What a string must stay below, by its class of characters: letters that are all lower or
    upper case, or have one capital in front, may be a word."""
    return min(max_ratio, WORD_RATIO) if s.isalpha() and (s[1:].islower() or s.isupper()) else max_ratio


def is_random(s: str, enc: tiktoken.Encoding, max_ratio: float) -> bool:
    if _KNOWN.fullmatch(s) or _IDENTIFIER.fullmatch(s):
        return False
    return ratio(s, enc) < least_ratio(s, max_ratio)


def random_windows(s: str, enc: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int]]:
    """The windows of tokens, just ``LEAST`` or more characters long, that are random."""
    ends = list(accumulate(token_sizes(s, enc), initial=0))
    out, j = [], 0
    for i, start in enumerate(ends):
        while j < len(ends) and ends[j] - start < LEAST:
            j += 1
        if j == len(ends):
            break
        window = s[start : ends[j]].strip("/=_-")
        if ends[j] - start < least_ratio(window, max_ratio) * (j - i) and not _KNOWN.fullmatch(window) and not _IDENTIFIER.fullmatch(window):
            out.append((start, ends[j]))
    return out


def random_parts(s: str, enc: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int]]:
    """The random spans of a candidate: all of it, or else its parts and windows, joined."""
    if is_random(s, enc, max_ratio):
        return [(0, len(s))]
    if _KNOWN.fullmatch(s):
        return []
    spans = [m.span() for m in _PART.finditer(s) if is_random(m[0], enc, max_ratio)]
    cuts = [0, *(x for m in _KNOWN_PART.finditer(s) for x in m.span()), len(s)]
    for a, b in zip(cuts[::2], cuts[1::2], strict=True):
        spans += [(a + x, a + y) for x, y in random_windows(s[a:b], enc, max_ratio)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(text: str, enc: tiktoken.Encoding, max_ratio: float = MAX_RATIO) -> dict[str, list[tuple[int, int]]]:
    return {
        "assign": [m.span() for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6],
        "access": [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20] if "AKIA" in text else [],
        "hex": [m.span() for m in _LONG_HEX.finditer(text)],
        "random": [(m.start() + a, m.start() + b) for m in _CANDIDATE.finditer(text) for a, b in random_parts(m[0], enc, max_ratio)],
    }


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    """By start, then kind as listed."""
    spans = sorted((a, n, b) for n, k in enumerate(kinds) for a, b in found[k])
    return ",".join(f"{kinds[n]}:{a}:{b}" for a, n, b in spans)


SPANS = "doc_id bigint, kind string, start bigint, end bigint, value string"
_SPANS = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
DIGEST = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string"


def secret_spans(docs: DataFrame, vocabulary: str, max_ratio: float = MAX_RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: ``doc_id, kind, start, end, value``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            rows = [(i, k, s, e, t.as_py()[s:e]) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) for k, spans in find(t.as_py(), enc, max_ratio).items() for s, e in spans]
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True) if rows else [[]] * 5, _SPANS, strict=True)], schema=_SPANS)

    return texts(docs, id_col, text_col).mapInArrow(run, SPANS)


def secret_digest(docs: DataFrame, vocabulary: str, max_ratio: float = MAX_RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind, the digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("base_sha256", "spans")} | {f"n_{k}": [] for k in KINDS}
            for t in b.column("text"):
                found = find(t.as_py(), enc, max_ratio)
                for k in KINDS:
                    out[f"n_{k}"].append(len(found[k]))
                out["base_sha256"].append(hashlib.sha256(joined(found, BASE).encode()).hexdigest())
                out["spans"].append(joined(found, KINDS))
            cols = {"doc_id": b.column("doc_id")} | {f"n_{k}": pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS} | {c: pa.array(out[c], pa.string()) for c in ("base_sha256", "spans")}
            yield pa.RecordBatch.from_pydict(cols)

    return texts(docs, id_col, text_col).mapInArrow(run, DIGEST)
