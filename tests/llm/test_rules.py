"""The rules cascade against plain Python."""

import re

from gradmesh.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, kept int, words string"
TEXTS = [
    None, "", " \n\t", "one two", "a b c d e f g h i j k", "A B C D E F G H I J K l", "x\n" * 30, "a b c d e a b c d e a b c d e", "# " * 20 + "word " * 12,
    "é à ü ö " * 15, "ends\nwith\nlines\n\n \nlines\nlines " + "w1 w2 w3 w4 w5 w6 w7 w8 w9 " + "u1 u2 u3 u4 u5 u6 u7", " ".join(f"w{k % 997}" for k in range(30_000)), "w " * 5 + " ".join(f"v{k}" for k in range(100)),
]


def brute(t):
    t = t or ""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(ws) - 4):
        seen.setdefault(tuple(ws[i : i + 5]), []).append(i)
    covered = {i + k for s in seen.values() if len(s) > 1 for i in s for k in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
    dup = len(lines) - len(set(lines))
    kept = not (failed or symbols * 10 > len(ws) or len(re.findall("[A-Z]", t)) > len(re.findall("[a-z]", t)) or dup * 10 > len(lines) * 3)
    return len(ws), sum(map(len, ws)), symbols, dup, len(covered), failed, kept


def test_report_equals_brute_force(spark):
    rows = [(k, t, 0, "") for k, t in enumerate(TEXTS)] + [(None, "one two", 1, None), (4, TEXTS[4], 1, None)]
    got = Q.rules_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = "one two" if r.doc_id is None else TEXTS[r.doc_id]
        assert tuple(r)[1:] == brute(t), r.doc_id


def test_cascade_verdicts_do_not_depend_on_order(spark):
    feats = Q.features(spark.createDataFrame([(k, t, 0, "") for k, t in enumerate(TEXTS)], SCHEMA))
    rules = Q.default_rules()
    kept = [sorted(map(tuple, Q.apply_cascade(feats, o).select("doc_id", "kept").collect())) for o in (rules, rules[::-1])]
    assert kept[0] == kept[1]
    assert kept[0] == sorted((k, brute(t)[-1]) for k, t in enumerate(TEXTS))


def test_order_is_by_rejection_per_cost():
    a, b, c = (Q.Rule(n, None) for n in "abc")
    assert [r.name for r in Q.order_rules([Q.Measured(a, 2.0, 0.2), Q.Measured(b, 0.1, 0.1), Q.Measured(c, 1.0, 0.0)])] == ["b", "a", "c"]


def test_measured_order_is_stable(spark):
    """The costly rule is told from the cheap ones, whose order follows what they reject."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    feats = Q.features(docs)
    found = [Q.measure(feats, Q.default_rules(), sample_rows=400, repeats=12) for _ in range(2)]
    for m in found:
        by = {x.rule.name: x for x in m}
        assert by["repeated_windows"].cost == max(x.cost for x in m) > 3 * by["too_short"].cost > 0
        assert Q.order_rules(m)[-1].name != "too_short" or by["too_short"].rejected == 0
    assert [r.name for r in Q.order_rules(found[0])][:2] == [r.name for r in Q.order_rules(found[1])][:2]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.rules_report(empty).count() == 0
    assert Q.quality_cascade(empty).count() == 0
