"""DuckDB SQL for the correctness check: the same results as the Spark queries, written
independently as plain SQL over the registered parquet views.

Training is unrolled: one block of CTEs per round (score, per-shard mean, cross-shard
mean, step). Every floating output is ``round(v, 8) + 0.0`` and arrays are exploded to
``(j, value)`` rows, matching the Spark side.
"""

from __future__ import annotations

from collections.abc import Sequence

WEIGHT_SLOTS = 64


def r8(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 8) + 0.0)"


def r8_odd(expr: str) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * 1e8 + 0.4937) / 1e8)"


# ---- sample adapters (FIXTURES.md §2) ------------------------------------------------

LI_K = 4


def li_samples_sql() -> str:
    return (
        "SELECT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, "
        "CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS row_id, "
        "CAST(l_quantity / 50.0 AS DOUBLE) AS x0, CAST(l_extendedprice / 100000.0 AS DOUBLE) AS x1, "
        "CAST(l_discount * 10.0 AS DOUBLE) AS x2, CAST(l_tax * 10.0 AS DOUBLE) AS x3, "
        "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM lineitem"
    )


def emb_samples_sql(k: int = 64, ragged: bool = False) -> str:
    cols = []
    for j in range(k):
        v = f"CAST(embedding[{j + 1}] AS DOUBLE)"
        if ragged:
            v = f"CASE WHEN {j} < 16 * (vec_id % 3 + 1) THEN {v} ELSE 0.0 END"
        cols.append(f"coalesce({v}, 0.0) AS x{j}")
    return (
        "SELECT CAST(vec_id % 3 + 1 AS INTEGER) AS shard_id, CAST(vec_id AS BIGINT) AS row_id, "
        + ", ".join(cols)
        + ", CAST(label % 2 AS DOUBLE) AS y FROM embeddings"
    )


def li_raw_samples_sql() -> str:
    """The unscaled columns, as the text lines have them."""
    return (
        "SELECT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_extendedprice AS DOUBLE) AS x1, "
        "CAST(l_discount AS DOUBLE) AS x2, CAST(l_tax AS DOUBLE) AS x3, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM lineitem"
    )


def customer_samples_sql() -> str:
    return (
        f"SELECT CAST(o_custkey AS BIGINT) AS run_id, q.* FROM ({li_samples_sql()}) q JOIN orders ON o_orderkey = q.row_id // 8"
    )


def wide_samples_sql() -> str:
    cols = [f"CAST(embedding[{j + 1}] AS DOUBLE)" for j in range(64)]
    both = cols + [f"{c} * {c}" for c in cols]
    return (
        "SELECT CAST(vec_id % 3 + 1 AS INTEGER) AS shard_id, "
        + ", ".join(f"{c} AS x{j}" for j, c in enumerate(both))
        + ", CAST(label % 2 AS DOUBLE) AS y FROM embeddings"
    )


def gaussian_sql(row_key: str, slot: int, seed: int = 42) -> str:
    """Box-Muller over the halves of a digest's first 26 hex digits."""
    digest = f"md5('{seed}:' || {row_key} || ':{slot}')"
    u = [f"((CAST('0x' || substr({digest}, {1 + 13 * h}, 13) AS BIGINT) + 0.5) / {float(16**13)!r})" for h in (0, 1)]
    return f"sqrt(ln({u[0]}) * -2.0) * cos({u[1]} * (2 * pi()))"


# ---- training ------------------------------------------------------------------------

def training_ctes(
    samples_sql: str,
    k: int,
    rounds: int = 10,
    threshold: float = 1e-4,
    runs_sql: str | None = None,
    sched_sql: str | None = None,
    lr: float = 0.01,
    failures_sql: str | None = None,
    norm_slots: int = WEIGHT_SLOTS,
    own_samples: bool = False,
) -> list[str]:
    """CTE list ending in ``hist(run_id, round_id, lr, grad_norm, responses, alive_shards,
    status, w0..w{k-1})``. ``runs_sql`` gives (run_id, stop_round); ``sched_sql`` gives
    (run_id, round_id, lr) and defaults to ``lr`` for every round. With ``own_samples`` each
    run trains on the samples of its ``run_id`` only."""
    xs = [f"x{j}" for j in range(k)]
    ws = [f"w{j}" for j in range(k)]
    runs_sql = runs_sql or f"SELECT CAST(0 AS BIGINT) AS run_id, {int(rounds)} AS stop_round"
    ctes = [
        f"s AS MATERIALIZED (SELECT {'run_id, ' if own_samples else ''}shard_id, {', '.join(xs)}, y FROM ({samples_sql}) q)",
        f"runs AS MATERIALIZED ({runs_sql})",
        "f AS MATERIALIZED ("
        + (failures_sql or "SELECT CAST(NULL AS INTEGER) AS shard_id, CAST(NULL AS INTEGER) AS failed_from_round WHERE false")
        + ")",
        "sched AS MATERIALIZED ("
        + (sched_sql or f"SELECT run_id, CAST(r.range AS INTEGER) AS round_id, CAST({lr!r} AS DOUBLE) AS lr "
           f"FROM runs, range({rounds}) r")
        + ")",
        "h_0 AS MATERIALIZED (SELECT run_id, 0 AS status, " + ", ".join(f"0.0::DOUBLE AS {w}" for w in ws) + " FROM runs)",
    ]
    for r in range(rounds):
        prev = f"h_{r}"
        z = " + ".join(f"a.{w} * s.{x}" for w, x in zip(ws, xs))
        ctes.append(
            f"a_{r} AS MATERIALIZED (SELECT p.run_id, {', '.join('p.' + w for w in ws)} FROM {prev} p "
            f"JOIN runs USING (run_id) WHERE p.status = 0 AND {r} < runs.stop_round)"
        )
        ctes.append(
            f"e_{r} AS MATERIALIZED (SELECT a.run_id, s.shard_id, 1.0 / (1.0 + exp(-({z}))) - s.y AS e, "
            f"{', '.join('s.' + x for x in xs)} FROM s JOIN a_{r} a ON {'s.run_id = a.run_id' if own_samples else 'true'} WHERE NOT EXISTS "
            f"(SELECT 1 FROM f WHERE f.shard_id = s.shard_id AND f.failed_from_round <= {r}))"
        )
        ctes.append(
            f"g_{r} AS MATERIALIZED (SELECT run_id, shard_id, "
            + ", ".join(f"avg(e * {x}) AS g{j}" for j, x in enumerate(xs))
            + f" FROM e_{r} GROUP BY run_id, shard_id)"
        )
        ctes.append(
            f"c_{r} AS MATERIALIZED (SELECT run_id, count(*) AS responses, "
            + ", ".join(f"sum(coalesce(g{j}, 0.0)) / count(*) AS c{j}" for j in range(k))
            + f" FROM g_{r} GROUP BY run_id)"
        )
        norm = f"sqrt(({' + '.join(f'c.c{j} * c.c{j}' for j in range(k))}) / {float(norm_slots)!r})"
        step = ", ".join(
            f"a.w{j} - CASE WHEN coalesce(c.responses, 0) > 0 THEN sc.lr * c.c{j} ELSE 0.0 END AS w{j}"
            for j in range(k)
        )
        alive = (
            f"(SELECT count(DISTINCT s.shard_id) FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE "
            f"f.shard_id = s.shard_id AND f.failed_from_round <= {r}){' AND s.run_id = a.run_id' if own_samples else ''})"
        )
        ctes.append(
            f"n_{r} AS MATERIALIZED (SELECT a.run_id, {r} AS round_id, sc.lr, "
            f"CASE WHEN coalesce(c.responses, 0) > 0 THEN {norm} END AS grad_norm, "
            f"CAST(coalesce(c.responses, 0) AS BIGINT) AS responses, CAST({alive} AS BIGINT) AS alive_shards, "
            f"{step} FROM a_{r} a LEFT JOIN c_{r} c USING (run_id) "
            f"JOIN sched sc ON sc.run_id = a.run_id AND sc.round_id = {r})"
        )
        ctes.append(
            f"h_{r + 1} AS MATERIALIZED (SELECT run_id, round_id, lr, grad_norm, responses, alive_shards, "
            f"CASE WHEN grad_norm < {threshold!r} THEN 1 ELSE 0 END AS status, {', '.join(ws)} FROM n_{r})"
        )
    ctes.append(
        "hist AS (" + " UNION ALL ".join(
            f"SELECT run_id, round_id, lr, grad_norm, responses, alive_shards, status, {', '.join(ws)} FROM h_{r + 1}"
            for r in range(rounds)
        ) + ")"
    )
    return ctes


def crossed_samples_sql() -> str:
    """One row per sample and slot: ``row_id, shard_id, y, j, x``."""
    cols = [f"list_transform(e, lambda v, i: v * e[(i - 1 + {s}) % 64 + 1])" for s in range(16)]
    return (
        "SELECT vec_id AS row_id, CAST(vec_id % 3 + 1 AS INTEGER) AS shard_id, CAST(label % 2 AS DOUBLE) AS y, unnest(range(1024)) AS j, "
        f"unnest({' || '.join(cols)}) AS x FROM (SELECT *, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) q"
    )


def long_training_sql(samples_long: str, k: int, rounds: int = 10, lr: float = 0.01, norm_slots: int = WEIGHT_SLOTS) -> str:
    """Training over samples with a row per slot: ``round_id, grad_norm, j, w``."""
    ctes = [f"s AS MATERIALIZED ({samples_long})", f"w_0 AS MATERIALIZED (SELECT range AS j, 0.0::DOUBLE AS w FROM range({k}))"]
    for r in range(rounds):
        ctes += [
            f"e_{r} AS MATERIALIZED (SELECT row_id, shard_id, 1.0 / (1.0 + exp(-sum(x * w))) - any_value(y) AS e FROM s JOIN w_{r} USING (j) GROUP BY row_id, shard_id)",
            f"g_{r} AS MATERIALIZED (SELECT j, avg(g) AS g FROM (SELECT s.shard_id, j, avg(e * x) AS g FROM s JOIN e_{r} USING (row_id) GROUP BY s.shard_id, j) q GROUP BY j)",
            f"w_{r + 1} AS MATERIALIZED (SELECT j, w - {lr!r} * g AS w FROM w_{r} JOIN g_{r} USING (j))",
        ]
    body = " UNION ALL ".join(
        f"SELECT CAST({r} AS INTEGER) AS round_id, {r8(f'(SELECT sqrt(sum(g * g) / {float(norm_slots)!r}) FROM g_{r})')} AS grad_norm, CAST(j AS INTEGER) AS j, {r8('w')} AS w FROM w_{r + 1}"
        for r in range(rounds)
    )
    return with_ctes(ctes, body)


def with_ctes(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def history_exploded_body(k: int, with_run: bool = False) -> str:
    ws = ", ".join(f"w{j}" for j in range(k))
    run, cut = ("run_id, ", r8_odd) if with_run else ("", r8)
    inner = (
        f"SELECT {run}round_id, lr, grad_norm, responses, alive_shards, status, "
        f"unnest(range({k})) AS j, unnest([{ws}]) AS w FROM hist"
    )
    return (
        f"SELECT {run}CAST(round_id AS INTEGER) AS round_id, {r8('lr')} AS lr, {cut('grad_norm')} AS grad_norm, "
        "CAST(responses AS BIGINT) AS responses, CAST(alive_shards AS BIGINT) AS alive_shards, "
        f"CAST(status AS INTEGER) AS status, CAST(j AS INTEGER) AS j, {cut('w')} AS w FROM ({inner}) t"
    )


# ---- text shards -----------------------------------------------------------------------

# Same patterns as gradmesh.functions.numeric (RE2 and Java regex agree on them).
FLOAT_PREFIX = (
    r"^[ \t\n\r\f\x0B]*([+-]?(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|(?i:inf(?:inity)?|nan)))"
)
INT_PREFIX = r"^[ \t\n\r\f\x0B]*([+-]?[0-9]+)"


def strtof(expr: str) -> str:
    prefix = f"regexp_extract({expr}, '{FLOAT_PREFIX}', 1)"
    return f"CASE WHEN suffix(lower({prefix}), 'nan') THEN 'nan'::DOUBLE ELSE coalesce(TRY_CAST({prefix} AS DOUBLE), 0.0) END"


def atoi(expr: str) -> str:
    return f"coalesce(TRY_CAST(regexp_extract({expr}, '{INT_PREFIX}', 1) AS BIGINT), 0)"


def _li_text_cols() -> str:
    return (
        "CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, CAST(l_orderkey AS BIGINT) AS pos_block, "
        "CAST(l_linenumber AS BIGINT) AS pos_id, l_linenumber, l_returnflag, "
        "printf('%.4f', l_quantity) AS q, printf('%.4f', l_extendedprice) AS p, "
        "printf('%.4f', l_discount) AS d, printf('%.4f', l_tax) AS t, "
        "printf('%.1f', CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS lab"
    )


def li_lines_sql() -> str:
    return f"SELECT shard_id, pos_block, pos_id, q || ' ' || p || ' ' || d || ' ' || t || ' ' || lab AS value FROM (SELECT {_li_text_cols()} FROM lineitem) a"


def li_dirty_lines_sql() -> str:
    clean = "q || ' ' || p || ' ' || d || ' ' || t || ' ' || lab"
    value = (
        f"CASE l_linenumber WHEN 2 THEN {clean} || chr(13) "
        "WHEN 3 THEN q || chr(9) || p || '  ' || d || chr(9) || chr(9) || t || ' ' || lab "
        "WHEN 4 THEN q || ' ' || p || ' ' || d || 'abc ' || t || 'e ' || lab || ' extra 99' "
        f"WHEN 5 THEN '# ' || {clean} "
        "WHEN 6 THEN q || ' ' || p "
        "WHEN 7 THEN CASE WHEN l_returnflag = 'A' THEN '   ' ELSE '' END "
        f"ELSE {clean} END"
    )
    return f"SELECT shard_id, pos_block, pos_id, {value} AS value FROM (SELECT {_li_text_cols()} FROM lineitem) a"


def tok_lines_sql(lines_sql: str) -> str:
    """S3 + S4 over a lines query with (shard_id, pos_block, pos_id, value)."""
    return (
        "SELECT *, len(tok) AS n_tok FROM (SELECT shard_id, pos_block, pos_id, value, "
        "list_filter(regexp_split_to_array(value, '[ \\t\\n]+'), lambda x: x <> '') AS tok "
        f"FROM ({lines_sql}) l WHERE value <> '' AND NOT starts_with(value, '#')) a"
    )


def shard_schema_sql(tok_sql: str) -> str:
    return (
        "SELECT shard_id, CAST(coalesce(arg_min(n_tok, pos_block * 8 + pos_id) FILTER (WHERE n_tok > 0), 0) AS INTEGER) AS width, "
        f"count(*) AS n_lines FROM ({tok_sql}) t GROUP BY shard_id"
    )


# ---- control log ------------------------------------------------------------------------

def ctl_sql() -> str:
    """F-CTL over events, invalid ops dropped."""
    return (
        "SELECT * FROM (SELECT CAST(user_id AS BIGINT) AS run_id, CAST(event_id AS BIGINT) AS seq, "
        "CASE event_type WHEN 'error' THEN 'PAUSE' WHEN 'view' THEN 'RESUME' WHEN 'click' THEN 'ADJUST_LR' "
        "WHEN 'purchase' THEN 'QUERY_PROGRESS' WHEN 'signup' THEN CASE WHEN event_id % 10 = 0 THEN 'TERMINATE' END END AS op, "
        "CASE WHEN event_type = 'click' THEN CAST(value / 10000.0 AS DOUBLE) END AS new_lr FROM events) e WHERE op IS NOT NULL"
    )


def cmd_lines_sql() -> str:
    """F-CMD over events."""
    return (
        "SELECT CAST(user_id AS BIGINT) AS run_id, CAST(event_id AS BIGINT) AS seq, "
        "CASE event_type WHEN 'purchase' THEN '1' WHEN 'click' THEN '2' WHEN 'error' THEN '3' WHEN 'view' THEN '4' "
        "ELSE CAST(value AS VARCHAR) END AS value FROM events"
    )


def decode_sql(lines_sql: str) -> str:
    b = (
        f"SELECT run_id, seq, value, {atoi('value')} AS code, "
        "row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1 AS idx, "
        "lead(value) OVER (PARTITION BY run_id ORDER BY seq) AS next_value "
        f"FROM ({lines_sql}) l"
    )
    c = (
        "SELECT *, idx - coalesce(max(CASE WHEN code <> 2 THEN idx END) OVER (PARTITION BY run_id ORDER BY seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) - 1 AS span FROM (" + b + ") b"
    )
    cmds = "SELECT * FROM (" + c + ") c WHERE span % 2 = 0"
    ends = "SELECT run_id, arg_min(seq, seq) AS end_seq, arg_min(code, seq) AS end_code FROM (" + cmds + ") x WHERE code < 0 OR code = 5 GROUP BY run_id"
    return (
        "SELECT m.run_id, m.seq, CASE m.code WHEN 1 THEN 'QUERY_PROGRESS' WHEN 2 THEN 'ADJUST_LR' WHEN 3 THEN 'PAUSE' "
        "WHEN 4 THEN 'RESUME' WHEN 5 THEN 'TERMINATE' END AS op, "
        f"CASE WHEN m.code = 2 THEN {strtof('m.next_value')} END AS new_lr "
        f"FROM ({cmds}) m LEFT JOIN ({ends}) e USING (run_id) "
        "WHERE (e.end_seq IS NULL OR m.seq < e.end_seq OR (m.seq = e.end_seq AND e.end_code = 5)) "
        "AND NOT (m.code = 2 AND m.next_value IS NULL)"
    )


def cut_sql(ctl: str) -> str:
    return (
        f"SELECT c.* FROM ({ctl}) c LEFT JOIN (SELECT run_id, min(seq) AS t FROM ({ctl}) x WHERE op = 'TERMINATE' "
        "GROUP BY run_id) t USING (run_id) WHERE t.t IS NULL OR c.seq <= t.t"
    )


def rounds_sql(ctl: str) -> str:
    """C2 + C3: (run_id, seq, op, new_lr, paused_before, effective, round_id)."""
    e = (
        "SELECT *, coalesce(max(CASE op WHEN 'PAUSE' THEN seq * 2 + 1 WHEN 'RESUME' THEN seq * 2 END) OVER ("
        "PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) % 2 = 1, false) AS paused_before "
        f"FROM ({cut_sql(ctl)}) c"
    )
    return (
        "SELECT *, (NOT paused_before OR op IN ('RESUME', 'TERMINATE')) AS effective, "
        "CAST(sum(CASE WHEN paused_before THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS INTEGER) AS round_id FROM (" + e + ") e"
    )


def gate_sql(ctl: str) -> tuple[str, str]:
    """(commands after the gate, gates(run_id, gate_op))."""
    gates = (
        f"SELECT r.run_id, g.gate_seq, g.gate_op FROM (SELECT DISTINCT run_id FROM ({ctl}) a) r LEFT JOIN "
        f"(SELECT run_id, min(seq) AS gate_seq, arg_min(op, seq) AS gate_op FROM ({ctl}) b "
        "WHERE op IN ('RESUME', 'TERMINATE') GROUP BY run_id) g USING (run_id)"
    )
    rest = (
        f"SELECT c.run_id, c.seq, c.op, c.new_lr FROM ({ctl}) c JOIN ({gates}) g USING (run_id) "
        "WHERE g.gate_op = 'RESUME' AND c.seq > g.gate_seq"
    )
    return rest, gates


def terminations_sql(ctl: str, rounds: int = 10, gate: bool = False) -> str:
    src = gate_sql(ctl)[0] if gate else ctl
    per = (
        "SELECT run_id, min(CASE WHEN op = 'TERMINATE' THEN round_id END) AS term_round, "
        "max(CASE op WHEN 'PAUSE' THEN seq * 2 + 1 WHEN 'RESUME' THEN seq * 2 END) % 2 = 1 AS stalled, "
        f"max(round_id) AS last_round FROM ({rounds_sql(src)}) r GROUP BY run_id"
    )
    base = (
        "SELECT run_id, CASE WHEN term_round IS NOT NULL THEN term_round WHEN stalled THEN last_round END AS stop_round, "
        "CASE WHEN term_round IS NOT NULL THEN 'terminated' WHEN stalled THEN 'stalled' END AS outcome "
        f"FROM (SELECT DISTINCT run_id FROM ({ctl}) a) r LEFT JOIN ({per}) p USING (run_id)"
    )
    if gate:
        gates = gate_sql(ctl)[1]
        base = (
            "SELECT b.run_id, CASE WHEN g.gate_op = 'RESUME' THEN b.stop_round ELSE 0 END AS stop_round, "
            "CASE WHEN g.gate_op = 'TERMINATE' THEN 'terminated' WHEN g.gate_op IS NULL THEN 'waiting' ELSE b.outcome END AS outcome "
            f"FROM ({base}) b JOIN ({gates}) g USING (run_id)"
        )
    return (
        f"SELECT run_id, CAST(CASE WHEN stop_round IS NULL OR stop_round >= {rounds} THEN {rounds} ELSE stop_round END AS INTEGER) AS stop_round, "
        f"CASE WHEN stop_round IS NULL OR stop_round >= {rounds} THEN 'running' ELSE outcome END AS outcome FROM ({base}) t"
    )


def lr_schedule_sql(ctl: str, rounds: int = 10, lr: float = 0.01, gate: bool = False) -> str:
    src = gate_sql(ctl)[0] if gate else ctl
    adj = (
        f"SELECT run_id, round_id, new_lr FROM ({rounds_sql(src)}) r WHERE op = 'ADJUST_LR' AND effective "
        f"AND round_id < {rounds}"
    )
    return (
        "SELECT g.run_id, CAST(g.round_id AS INTEGER) AS round_id, "
        f"coalesce((SELECT arg_max(a.new_lr, a.round_id) FROM ({adj}) a WHERE a.run_id = g.run_id AND a.round_id <= g.round_id), "
        f"CAST({lr!r} AS DOUBLE)) AS lr FROM (SELECT t.run_id, r.range AS round_id FROM ({terminations_sql(ctl, rounds, gate)}) t, "
        f"range({rounds}) r WHERE r.range < t.stop_round) g"
    )
