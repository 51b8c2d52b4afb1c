"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: ``@``, ``://``, ``+``, dots and separators
between digits are reached from the first digit of a number, and cue words ("iban", "account",
"ssn", ...) announce identifiers. From each anchor a deterministic local parser expands to the
left and right, fixes the boundaries and validates (octets, Luhn, digit counts, mod 97).

Base kinds email, ip, card and phone follow the stated patterns, leftmost and not overlapping
within a kind, failing matches dropped without a retry. The method adds two kinds beside them:
``login`` (user and password of a URL) and ``account`` (an IBAN that passes mod 97, or the
identifier that follows an account cue).

Defined cases: null text is empty and has no span; offsets are code points; equal rows give
equal results; kinds may overlap one another; a text of any length is scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from gradmesh.llm.common import texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "account")
#: Cues of an account or identity number, lower case; found in any case.
CUES = ("iban", "account no", "account number", "acct", "konto", "kontonummer", "ssn", "passport", "tax id", "customer id")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OCTETS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+(?=@)")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_AFTER_CUE = re.compile(r"[\x20:#=.]{1,4}((?=[A-Z0-9-]*[0-9])[A-Z0-9][A-Z0-9-]{4,33}[A-Z0-9])\b")
_WORD = re.compile(r"\w")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and _LOCAL.match(text, start - 1):
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def lowered(text: str) -> str:
    """Lower case, every character at its place: one whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


class Finder:
    """The automaton, built once per task, and the parsers of each anchor."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for anchor in ("@", "://", "+", *"0123456789"):
            self.automaton.add_word(anchor, (anchor if len(anchor) > 1 or not anchor.isdigit() else "0", len(anchor)))
        for cue in CUES:
            self.automaton.add_word(cue, ("cue", len(cue)))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[str, list[tuple[int, int]]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        end = dict.fromkeys((*KINDS, "digits"), 0)  # where the last match of a kind ended, kept or not
        for last, (anchor, size) in self.automaton.iter(lowered(text)):
            if anchor == "0":
                if last >= end["digits"]:
                    self._digits(text, last, end, found)
            elif anchor == "@":
                if span := _email(text, last, end["email"]):
                    found["email"].append(span)
                    end["email"] = span[1]
            elif anchor == "+":
                if (m := _PHONE.match(text, last)) and 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found["phone"].append(m.span())
            elif anchor == "://":
                if m := _LOGIN.match(text, last + 1):
                    found["login"].append(m.span())
            elif last + 1 >= end["account"]:
                self._after_cue(text, last - size + 1, last + 1, end, found)
        return found

    @staticmethod
    def _digits(text: str, at: int, end: dict[str, int], found: dict[str, list[tuple[int, int]]]) -> None:
        """The anchor is the first digit of a run; numbers and dotted quads expand from it."""
        end["digits"] = _DIGITS.match(text, at).end()
        if at >= end["card"] and (m := _NUMBER.match(text, at)):
            end["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        if at >= end["ip"] and (m := _OCTETS.match(text, at)):
            end["ip"] = m.end()
            if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
                found["ip"].append(m.span())

    @staticmethod
    def _after_cue(text: str, start: int, at: int, end: dict[str, int], found: dict[str, list[tuple[int, int]]]) -> None:
        if start and _WORD.match(text, start - 1):
            return  # inside a word
        rest = re.compile(r"[\x20:#=.]{1,4}").match(text, at)
        if rest and (m := _IBAN.match(text, rest.end())):
            s = m[0]
            while s and not iban_valid(s):  # blanks let it run into the next word
                s = s[: s.rfind(" ")] if " " in s else ""
            if s:
                found["account"].append((m.start(), m.start() + len(s)))
                end["account"] = m.start() + len(s)
                return
        if m := _AFTER_CUE.match(text, at):
            found["account"].append(m.span(1))
            end["account"] = m.end(1)


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


SPANS = "doc_id bigint, kind string, start bigint, end bigint, value string"
_SPANS = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
DIGEST = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_login bigint, n_account bigint, base_sha256 string, spans string"


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: ``doc_id, kind, start, end, value``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder()
        for b in batches:
            rows = [(i, k, s, e, t.as_py()[s:e]) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) for k, spans in find(t.as_py()).items() for s, e in spans]
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True) if rows else [[]] * 5, _SPANS, strict=True)], schema=_SPANS)

    return texts(docs, id_col, text_col).mapInArrow(run, SPANS)


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind, the digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder()
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("base_sha256", "spans")} | {f"n_{k}": [] for k in KINDS}
            for t in b.column("text"):
                found = find(t.as_py())
                for k in KINDS:
                    out[f"n_{k}"].append(len(found[k]))
                out["base_sha256"].append(hashlib.sha256(joined(found, BASE).encode()).hexdigest())
                out["spans"].append(joined(found, KINDS))
            cols = {"doc_id": b.column("doc_id")} | {f"n_{k}": pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS} | {c: pa.array(out[c], pa.string()) for c in ("base_sha256", "spans")}
            yield pa.RecordBatch.from_pydict(cols)

    return texts(docs, id_col, text_col).mapInArrow(run, DIGEST)
