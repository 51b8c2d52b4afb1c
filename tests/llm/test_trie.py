"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from gradmesh.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = [c.split()[0] for c in P.NODE.split(", ")]


def brute(rows):
    """Rows of the trie of ``(conv_id, turn, role, text)``."""
    conv = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            conv[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    conv = {c: [x[3:] for x in sorted(turns)] for c, turns in conv.items()}
    paths = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        paths[c] = tuple(conv.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * n
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), up, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def some_rows():
    """Shared prefixes, a hot conversation, gaps, nulls, ties, repeated rows, a long one."""
    random.seed(5)
    rows = []
    for c in [*range(0, 90), -5, -20, -21, 10**12]:
        if c in (40, 60):
            continue  # bases that are missing
        hot = c % 3 == 0
        for t in range(2 if hot else random.choice([0, 1, 1, 2, 3, 5])):
            turn = None if c % 7 == 0 and t == 1 else t // 2 if c % 11 == 0 else t
            rows.append((c, turn, "user" if hot else random.choice(["user", "assistant", None]), "the hot text" if hot else random.choice(["a b", "c", "", None, "d e\tf"])))
    rows += [(77, t, "user", f"turn {t}") for t in range(400)] + [(78, t, "user", f"turn {t}") for t in range(300)]
    return rows + rows[:20] + [(None, 1, "user", "x")]


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_equals_brute_force(spark, shards):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, n_convs int").repartition(5)
    assert made(P.conversation_trie(df, shards)) == brute(rows)


def test_one_conversation_everywhere(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(5)]
    assert made(P.conversation_trie(spark.createDataFrame(rows, SCHEMA), 12)) == brute(rows)


def test_hot_path_is_cut_by_its_conversations(spark):
    rows = [(c, 0, "user", "same") for c in range(400)]
    paths = P.as_paths(P.conversations_of(spark.createDataFrame(rows, SCHEMA)))
    frame = P.skeleton(paths, 8)
    assert len({p for p, _ in frame.splitters}) == 1 and len(frame.splitters) == 7 and len(frame.parents) == 2
    found = P.walked(paths, frame).where("part_of = 1").collect()
    assert sum(r["n_convs"] for r in found) == 400 and len(found) == 8 and max(r["n_convs"] for r in found) < 150


def test_nothing_and_turnless(spark):
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert P.conversation_trie(none).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    turnless = next(c for c in h if h[c] > 0)  # its own turn is replaced by the first of a base that is absent
    rows = [(turnless, 0, "user", "gone")]
    assert made(P.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(brute(rows)) == 1
