"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``,
with the matching DuckDB SQL where the operator is expressible in SQL.

Outputs are hash-friendly: floats are ``round(v, 8) + 0.0``, arrays are exploded to
``(j, value)`` rows, and integer widths are cast explicitly on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmesh import oracle as O
from gradmesh.functions.model import linear_score, sigmoid
from gradmesh.operators import control as C
from gradmesh.operators import gradients as G
from gradmesh.plans import live as LV
from gradmesh.plans import runs as RN
from gradmesh.plans import training as TR
from gradmesh.session import shared_path
from gradmesh.sources import console as CON
from gradmesh.sources import generator as GEN
from gradmesh.sources import tables as TB
from gradmesh.sources import text as TX
from gradmesh.streaming.control_stream import CONTROL_SCHEMA, Arrivals, run_to_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def r8(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 8) + F.lit(0.0)


def r8_odd(c: Column | str) -> Column:
    """Eight decimals cut at an odd place: runs of a few rows have exact decimal ties, which
    ``round`` would settle by the order of summation."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * 1e8 + 0.4937).cast("double") / 1e8


# Fixed parameters of the demonstration queries.
W_PROBE = [0.3, -0.2, 0.1, 0.4]  # probe weights for the per-row and per-shard operators
LR = 0.01
CONVERGE_THRESHOLD = 0.0199  # reached mid-run on F-LI, to show the early stop
FAILURES = [(2, 3), (3, 6)]  # shard 2 fails from round 3, shard 3 from round 6
RAW_LR = 1e-8  # for the unscaled columns of the text lines
CLAMP = 8  # feature clamp shown on the 64-d embeddings


def _w_sql(w) -> list[str]:
    return [repr(float(v)) for v in w]


def _score_sql(w, k: int = 4) -> str:
    return " + ".join(f"{wv} * x{j}" for j, wv in enumerate(_w_sql(w)[:k]))


def _residual_rows_sql(w) -> str:
    return (
        f"SELECT shard_id, row_id, x0, x1, x2, x3, y, {_score_sql(w)} AS z FROM ({O.li_samples_sql()}) s"
    )


# ---- P1-P5 per row ------------------------------------------------------------------

@register("linear_score", lambda: f"SELECT row_id, shard_id, {O.r8('z')} AS z FROM ({_residual_rows_sql(W_PROBE)}) t")
def q_linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TB.lineitem_samples(spark, sf_dir)
    return s.select("row_id", "shard_id", r8(linear_score("x", G.weights_literal(W_PROBE))).alias("z"))


@register(
    "predict",
    lambda: f"SELECT row_id, shard_id, {O.r8('1.0 / (1.0 + exp(-z))')} AS p FROM ({_residual_rows_sql(W_PROBE)}) t",
)
def q_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TB.lineitem_samples(spark, sf_dir)
    z = linear_score("x", G.weights_literal(W_PROBE))
    return s.select("row_id", "shard_id", r8(sigmoid(z)).alias("p"))


@register(
    "residuals",
    lambda: f"SELECT row_id, shard_id, {O.r8('1.0 / (1.0 + exp(-z)) - y')} AS err FROM ({_residual_rows_sql(W_PROBE)}) t",
)
def q_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = G.residuals(TB.lineitem_samples(spark, sf_dir), W_PROBE)
    return r.select("row_id", "shard_id", r8("err").alias("err"))


@register(
    "sample_gradient",
    lambda: (
        "SELECT row_id, shard_id, CAST(j AS INTEGER) AS j, " + O.r8("g") + " AS g FROM ("
        "SELECT row_id, shard_id, unnest(range(4)) AS j, unnest([e * x0, e * x1, e * x2, e * x3]) AS g FROM ("
        f"SELECT *, 1.0 / (1.0 + exp(-z)) - y AS e FROM ({_residual_rows_sql(W_PROBE)}) a) b) c"
    ),
)
def q_sample_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = G.sample_gradients(TB.lineitem_samples(spark, sf_dir), W_PROBE)
    return g.select("row_id", "shard_id", F.posexplode("g").alias("j", "g")).select(
        "row_id", "shard_id", "j", r8("g").alias("g")
    )


def _shard_grad_sql(w) -> str:
    return (
        "SELECT shard_id, count(*) AS n, avg(e * x0) AS g0, avg(e * x1) AS g1, avg(e * x2) AS g2, avg(e * x3) AS g3 "
        f"FROM (SELECT *, 1.0 / (1.0 + exp(-z)) - y AS e FROM ({_residual_rows_sql(w)}) a) b GROUP BY shard_id"
    )


@register(
    "shard_gradient",
    lambda: (
        "SELECT shard_id, n, CAST(j AS INTEGER) AS j, " + O.r8("g") + " AS g FROM ("
        f"SELECT shard_id, n, unnest(range(4)) AS j, unnest([g0, g1, g2, g3]) AS g FROM ({_shard_grad_sql(W_PROBE)}) a) b"
    ),
)
def q_shard_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    sg = G.shard_gradient(TB.lineitem_samples(spark, sf_dir), W_PROBE)
    return sg.select("shard_id", "n", F.posexplode("g").alias("j", "g")).select(
        "shard_id", "n", "j", r8("g").alias("g")
    )


def _combined_sql(w) -> str:
    return (
        "SELECT count(*) AS responses, "
        + ", ".join(f"sum(coalesce(g{j}, 0.0)) / count(*) AS c{j}" for j in range(4))
        + f" FROM ({_shard_grad_sql(w)}) s"
    )


@register(
    "combined_gradient",
    lambda: (
        "SELECT responses, CAST(j AS INTEGER) AS j, " + O.r8("g") + " AS g FROM ("
        f"SELECT responses, unnest(range(4)) AS j, unnest([c0, c1, c2, c3]) AS g FROM ({_combined_sql(W_PROBE)}) a) b"
    ),
)
def q_combined_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    sg = G.shard_gradient(TB.lineitem_samples(spark, sf_dir), W_PROBE)
    cg = G.combined_gradient(sg, len(W_PROBE))
    return cg.select("responses", F.posexplode("g").alias("j", "g")).select("responses", "j", r8("g").alias("g"))


@register(
    "gradient_norm",
    lambda: (
        f"SELECT responses, {O.r8('sqrt((c0 * c0 + c1 * c1 + c2 * c2 + c3 * c3) / 64.0)')} AS grad_norm "
        f"FROM ({_combined_sql(W_PROBE)}) a"
    ),
)
def q_gradient_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    sg = G.shard_gradient(TB.lineitem_samples(spark, sf_dir), W_PROBE)
    cg = G.combined_gradient(sg, len(W_PROBE))
    return cg.select("responses", r8("grad_norm").alias("grad_norm"))


@register(
    "weight_step",
    lambda: (
        "SELECT CAST(j AS INTEGER) AS j, " + O.r8("w") + " AS w FROM (SELECT unnest(range(4)) AS j, unnest(["
        + ", ".join(f"{wv} - {LR!r} * c{j}" for j, wv in enumerate(_w_sql(W_PROBE)))
        + f"]) AS w FROM ({_combined_sql(W_PROBE)}) a) b"
    ),
)
def q_weight_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = TR.train_one_round(TB.lineitem_samples(spark, sf_dir), W_PROBE, LR)
    return one.select(F.posexplode("w").alias("j", "w")).select("j", r8("w").alias("w"))


@register(
    "train_one_round",
    lambda: (
        "SELECT responses, " + O.r8("grad_norm") + " AS grad_norm, CAST(j AS INTEGER) AS j, "
        + O.r8("g") + " AS g, " + O.r8("w") + " AS w FROM (SELECT responses, "
        "sqrt((c0 * c0 + c1 * c1 + c2 * c2 + c3 * c3) / 64.0) AS grad_norm, unnest(range(4)) AS j, "
        f"unnest([c0, c1, c2, c3]) AS g, unnest([-{LR!r} * c0, -{LR!r} * c1, -{LR!r} * c2, -{LR!r} * c3]) AS w "
        f"FROM ({_combined_sql([0.0] * 4)}) a) b"
    ),
)
def q_train_one_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = TR.train_one_round(TB.lineitem_samples(spark, sf_dir), [0.0] * 4, LR)
    return one.select(
        "responses", r8("grad_norm").alias("grad_norm"),
        F.posexplode(F.arrays_zip("g", "w")).alias("j", "gw"),
    ).select("responses", "grad_norm", "j", r8("gw.g").alias("g"), r8("gw.w").alias("w"))


# ---- A2, S8 ---------------------------------------------------------------------------

@register(
    "shard_stats",
    lambda: (
        "SELECT CAST(vec_id % 3 + 1 AS INTEGER) AS shard_id, count(*) AS n_samples, "
        "CAST(max(len(embedding[1:16 * (vec_id % 3 + 1)])) AS INTEGER) AS n_features FROM embeddings GROUP BY 1"
    ),
)
def q_shard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.shard_stats(TB.ragged_embedding_samples(spark, sf_dir))


@register(
    "feature_clamp",
    lambda: (
        "SELECT shard_id, CAST(j AS INTEGER) AS j, count(*) AS n, " + O.r8("sum(v)") + " AS sum_v FROM ("
        "SELECT CAST(vec_id % 3 + 1 AS INTEGER) AS shard_id, unnest(range(len(embedding[1:" + str(CLAMP) + "]))) AS j, "
        "unnest(CAST(embedding[1:" + str(CLAMP) + "] AS DOUBLE[])) AS v FROM embeddings) a GROUP BY shard_id, j"
    ),
)
def q_feature_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TB.embedding_samples(spark, sf_dir).withColumn("x", TR.clamped("x", CLAMP))
    e = s.select("shard_id", F.posexplode("x").alias("j", "v"))
    return e.groupBy("shard_id", "j").agg(F.count(F.lit(1)).alias("n"), r8(F.sum("v")).alias("sum_v"))


# ---- T1-T6, J2, A6 ----------------------------------------------------------------------

def _hist_exploded(h: DataFrame, with_run: bool = False) -> DataFrame:
    lead, cut = (["run_id"], r8_odd) if with_run else ([], r8)
    return h.select(
        *lead, "round_id", r8("lr").alias("lr"), cut("grad_norm").alias("grad_norm"),
        "responses", "alive_shards", "status", F.posexplode("w").alias("j", "w"),
    ).select(*lead, "round_id", "lr", "grad_norm", "responses", "alive_shards", "status", "j", cut("w").alias("w"))


def _cores(spark: SparkSession) -> int:
    """Even parts for the rounds' scans: the test tables are files of one row group."""
    return spark.sparkContext.defaultParallelism


def _failures_df(spark: SparkSession):
    return spark.createDataFrame(FAILURES, "shard_id INT, failed_from_round INT")


def _failures_sql() -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({a}, {b})" for a, b in FAILURES) + ") v(shard_id, failed_from_round)"


def _all_failed(samples: DataFrame) -> DataFrame:
    return samples.select("shard_id").distinct().select("shard_id", F.lit(0).alias("failed_from_round"))


@register("train", lambda: O.with_ctes(O.training_ctes(O.li_samples_sql(), 4), O.history_exploded_body(4)))
def q_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hist_exploded(TR.train(TB.lineitem_samples(spark, sf_dir), partitions=_cores(spark)).history)


@register(
    "train_embeddings",
    lambda: O.with_ctes(O.training_ctes(O.emb_samples_sql(64), 64), O.history_exploded_body(64)),
)
def q_train_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hist_exploded(TR.train(TB.embedding_samples(spark, sf_dir), partitions=_cores(spark)).history)


@register(
    "train_ragged",
    lambda: O.with_ctes(O.training_ctes(O.emb_samples_sql(48, ragged=True), 48), O.history_exploded_body(48)),
)
def q_train_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hist_exploded(TR.train(TB.ragged_embedding_samples(spark, sf_dir), partitions=_cores(spark)).history)


@register("train_wide", lambda: O.with_ctes(O.training_ctes(O.wide_samples_sql(), 128), O.history_exploded_body(128)))
def q_train_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """128 features: nothing is clamped unless asked for."""
    return _hist_exploded(TR.train(TB.wide_samples(spark, sf_dir), partitions=_cores(spark)).history)


@register("train_1024", lambda: O.long_training_sql(O.crossed_samples_sql(), 1024))
def q_train_1024(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1,024 features, as blocks and matrix products."""
    res = TR.train(TB.crossed_samples(spark, sf_dir), partitions=_cores(spark))
    return _hist_exploded(res.history).select("round_id", "grad_norm", "j", "w")


@register(
    "train_with_failures",
    lambda: O.with_ctes(O.training_ctes(O.li_samples_sql(), 4, failures_sql=_failures_sql()),
                        O.history_exploded_body(4)),
)
def q_train_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = TR.train(TB.lineitem_samples(spark, sf_dir), failures=_failures_df(spark), partitions=_cores(spark))
    return _hist_exploded(res.history)


@register(
    "round_participation",
    lambda: (
        "WITH s AS (SELECT DISTINCT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id FROM lineitem), "
        f"f AS ({_failures_sql()}) "
        "SELECT CAST(r.range AS INTEGER) AS round_id, CAST(count(s.shard_id) AS BIGINT) AS alive_shards "
        "FROM range(10) r LEFT JOIN s ON NOT EXISTS (SELECT 1 FROM f WHERE f.shard_id = s.shard_id "
        "AND f.failed_from_round <= r.range) GROUP BY r.range"
    ),
)
def q_round_participation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.alive_shards(TB.lineitem_samples(spark, sf_dir), _failures_df(spark), 10)


@register(
    "train_converged",
    lambda: O.with_ctes(
        O.training_ctes(O.li_samples_sql(), 4, threshold=CONVERGE_THRESHOLD), O.history_exploded_body(4)
    ),
)
def q_train_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = TR.train(TB.lineitem_samples(spark, sf_dir), threshold=CONVERGE_THRESHOLD, partitions=_cores(spark))
    return _hist_exploded(res.history)


@register(
    "train_all_failed",
    lambda: O.with_ctes(
        O.training_ctes(
            O.li_samples_sql(), 4,
            failures_sql="SELECT DISTINCT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, 0 AS failed_from_round FROM lineitem",
        ),
        O.history_exploded_body(4),
    ),
)
def q_train_all_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TB.lineitem_samples(spark, sf_dir)
    return _hist_exploded(TR.train(s, failures=_all_failed(s), partitions=_cores(spark)).history)


def _summary_sql() -> str:
    ctes = O.training_ctes(O.li_samples_sql(), 4, threshold=CONVERGE_THRESHOLD, failures_sql=_failures_sql())
    body = (
        "SELECT run_id, CAST(CASE WHEN max(status) = 1 THEN max(round_id) ELSE 10 END AS INTEGER) AS final_round, "
        "CAST(count(*) AS INTEGER) AS rounds_run, CAST(arg_max(alive_shards, round_id) AS BIGINT) AS alive_shards, "
        "CASE WHEN max(status) = 1 THEN 'converged' ELSE 'completed' END AS outcome, "
        + O.r8("arg_max(grad_norm, round_id) FILTER (WHERE grad_norm IS NOT NULL)")
        + " AS final_norm FROM hist GROUP BY run_id"
    )
    return O.with_ctes(ctes, body)


@register("run_summary", _summary_sql)
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = TR.train(TB.lineitem_samples(spark, sf_dir), threshold=CONVERGE_THRESHOLD, failures=_failures_df(spark), partitions=_cores(spark))
    sm = res.summary
    return sm.select("run_id", "final_round", "rounds_run", "alive_shards", "outcome", r8("final_norm").alias("final_norm"))


# ---- S1-S9 text shards ---------------------------------------------------------------------

def _on_disk(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The lines written as ``shard_<id>.txt`` in the shared folder, in order, and read back."""
    paths = GEN.write_named_shards(lines, shared_path(spark, "shards"))
    return TX.read_shards(spark, paths)


@register("shard_scan", lambda: f"SELECT shard_id, value FROM ({O.li_lines_sql()}) a")
def q_shard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 over files named ``shard_<id>.txt``."""
    return _on_disk(spark, TB.lineitem_lines(spark, sf_dir)).select("shard_id", "value")


@register("shard_folder_scan", lambda: f"SELECT shard_id, value FROM ({O.li_lines_sql()}) a")
def q_shard_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9's writer and S1 + S2 over ``shard_id=<id>`` folders."""
    path = GEN.write_shards(TB.lineitem_lines(spark, sf_dir), shared_path(spark, "shard_scan"))
    return TX.read_shards(spark, path).select("shard_id", "value")


@register("shard_filter", lambda: f"SELECT shard_id, value FROM ({O.li_dirty_lines_sql()}) l WHERE value <> '' AND NOT starts_with(value, '#')")
def q_shard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.data_lines(_on_disk(spark, TB.lineitem_dirty_lines(spark, sf_dir))).select("shard_id", "value")


def _schema_sql() -> str:
    return O.shard_schema_sql(O.tok_lines_sql(O.li_dirty_lines_sql()))


@register(
    "shard_schema",
    lambda: f"SELECT shard_id, width, n_lines, CAST(n_lines > 0 AND width >= 2 AS INTEGER) AS accepted FROM ({_schema_sql()}) s",
)
def q_shard_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    sch = TX.shard_schema(TX.data_lines(_on_disk(spark, TB.lineitem_dirty_lines(spark, sf_dir))))
    return sch.select("shard_id", "width", "n_lines", F.col("accepted").cast("int").alias("accepted"))


@register(
    "shard_parse",
    lambda: (
        "SELECT t.shard_id, " + O.r8(O.strtof("t.tok[s.width]")) + " AS y, "
        + ", ".join(f"{O.r8(O.strtof(f't.tok[{j + 1}]'))} AS x{j}" for j in range(4))
        + f" FROM ({O.tok_lines_sql(O.li_dirty_lines_sql())}) t JOIN ({_schema_sql()}) s USING (shard_id) WHERE s.width = 5 AND t.n_tok >= s.width"
    ),
)
def q_shard_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, _, _ = TX.lines_to_samples(_on_disk(spark, TB.lineitem_dirty_lines(spark, sf_dir)))
    return samples.select("shard_id", r8("y").alias("y"), *[r8(F.get("x", j)).alias(f"x{j}") for j in range(4)])


@register(
    "shard_rejects",
    lambda: (
        "SELECT t.shard_id, t.value, CAST(t.n_tok AS INTEGER) AS n_tok, "
        "CASE WHEN NOT (s.n_lines > 0 AND s.width >= 2) THEN 'shard_rejected' ELSE 'short_row' END AS reason "
        f"FROM ({O.tok_lines_sql(O.li_dirty_lines_sql())}) t JOIN ({_schema_sql()}) s USING (shard_id) "
        "WHERE NOT (s.n_lines > 0 AND s.width >= 2) OR t.n_tok < s.width"
    ),
)
def q_shard_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects, _ = TX.lines_to_samples(_on_disk(spark, TB.lineitem_dirty_lines(spark, sf_dir)))
    return rejects.select("shard_id", "value", "n_tok", "reason")


@register(
    "train_from_shards",
    lambda: O.with_ctes(
        O.training_ctes(f"SELECT * FROM ({O.li_raw_samples_sql()}) a WHERE shard_id <> {TB.N_SHARDS}", 4, lr=RAW_LR), O.history_exploded_body(4)
    ),
)
def q_train_from_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main path: text shards, load, train. The last shard has one column only, so its
    load fails and the mean is over the others."""
    lines = TB.lineitem_lines(spark, sf_dir)
    narrow = F.when(F.col("shard_id") == TB.N_SHARDS, F.substring_index("value", " ", -1)).otherwise(F.col("value"))
    samples, _, _ = TX.lines_to_samples(_on_disk(spark, lines.withColumn("value", narrow)))
    return _hist_exploded(TR.train(samples, lr=RAW_LR, partitions=_cores(spark)).history)


@register(
    "generate_lines",
    lambda: (
        "SELECT shard_id, printf('%.4f', x0) || ' ' || printf('%.4f', x1) || ' ' || printf('%.4f', x2) || ' ' || "
        "printf('%.4f', x3) || ' ' || printf('%.1f', CASE WHEN 0.5 * x0 + 0.3 * x1 + -0.2 * x2 + 0.1 * x3 > 0 "
        "THEN 1.0 ELSE 0.0 END) AS value FROM (SELECT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, "
        "l_quantity AS x0, l_extendedprice AS x1, -l_discount AS x2, l_tax AS x3 FROM lineitem) a"
    ),
)
def q_generate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9's label rule and line format over lineitem's raw two-decimal columns
    (discount negated so both labels occur)."""
    li = TB.read_table(spark, sf_dir, "lineitem")
    s = li.select(
        (F.col("l_orderkey") % 3 + 1).cast("int").alias("shard_id"),
        F.array("l_quantity", "l_extendedprice", -F.col("l_discount"), "l_tax").cast("array<double>").alias("x"),
    )
    return GEN.format_lines(GEN.label_by_score(s))


def _generated_sql() -> str:
    key = "CAST(l_orderkey * 8 + l_linenumber AS VARCHAR)"
    xs = ", ".join(f"{O.gaussian_sql(key, j)} AS x{j}" for j in range(4))
    label = "CASE WHEN 0.5 * x0 + 0.3 * x1 + -0.2 * x2 + 0.1 * x3 > 0 THEN '1.0' ELSE '0.0' END"
    line = " || ' ' || ".join([f"printf('%.4f', x{j})" for j in range(4)] + [label])
    return f"SELECT shard_id, {line} AS value FROM (SELECT CAST(l_orderkey % 3 + 1 AS INTEGER) AS shard_id, {xs} FROM lineitem) a"


@register("generate_samples", _generated_sql)
def q_generate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 proper: one gaussian sample per lineitem row, drawn by the row's key."""
    li = TB.lineitem_samples(spark, sf_dir).select("shard_id", "row_id")
    return GEN.format_lines(GEN.label_by_score(GEN.with_gaussian_features(li)))


# ---- C1-C7, J3 control log ----------------------------------------------------------------

def _ctl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.events_control(spark, sf_dir)


@register(
    "decode_commands",
    lambda: f"SELECT run_id, seq, op, {O.r8('new_lr')} AS new_lr FROM ({O.decode_sql(O.cmd_lines_sql())}) d",
)
def q_decode_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.decode_commands(TB.events_commands(spark, sf_dir))
    return d.select("run_id", "seq", "op", r8("new_lr").alias("new_lr"))


@register(
    "effective_commands",
    lambda: (
        "SELECT run_id, seq, op, CAST(paused_before AS INTEGER) AS paused_before, "
        f"CAST(effective AS INTEGER) AS effective FROM ({O.rounds_sql(O.ctl_sql())}) r"
    ),
)
def q_effective_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = C.effective_commands(_ctl(spark, sf_dir))
    return e.select(
        "run_id", "seq", "op", F.col("paused_before").cast("int").alias("paused_before"),
        F.col("effective").cast("int").alias("effective"),
    )


@register("command_rounds", lambda: f"SELECT run_id, seq, op, round_id FROM ({O.rounds_sql(O.ctl_sql())}) r")
def q_command_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.command_rounds(_ctl(spark, sf_dir)).select("run_id", "seq", "op", "round_id")


@register(
    "command_log_rounds",
    lambda: (
        f"SELECT run_id, seq, op, round_id FROM ({O.rounds_sql('SELECT * FROM (' + O.decode_sql(O.cmd_lines_sql()) + ') d WHERE op IS NOT NULL')}) r"
    ),
)
def q_command_log_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 then C2/C3: raw console lines all the way to round numbers."""
    d = C.decode_commands(TB.events_commands(spark, sf_dir))
    return C.command_rounds(d).select("run_id", "seq", "op", "round_id")


@register("terminations", lambda: O.terminations_sql(O.ctl_sql()))
def q_terminations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.terminations(_ctl(spark, sf_dir))


@register("start_gate", lambda: O.terminations_sql(O.ctl_sql(), gate=True))
def q_start_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.terminations(_ctl(spark, sf_dir), wait_for_start=True)


@register(
    "lr_schedule",
    lambda: f"SELECT run_id, round_id, {O.r8('lr')} AS lr FROM ({O.lr_schedule_sql(O.ctl_sql())}) s",
)
def q_lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = C.lr_schedule(_ctl(spark, sf_dir))
    return s.select("run_id", "round_id", r8("lr").alias("lr"))


def _controlled_ctes(gate: bool = False) -> list[str]:
    """Every customer is a run; those without a log keep the default plan."""
    ctl = O.ctl_sql()
    all_runs = f"SELECT DISTINCT run_id FROM ({O.customer_samples_sql()}) c"
    runs = f"SELECT c.run_id, coalesce(t.stop_round, 10) AS stop_round FROM ({all_runs}) c LEFT JOIN ({O.terminations_sql(ctl, 10, gate)}) t USING (run_id)"
    sched = (
        f"SELECT c.run_id, CAST(r.range AS INTEGER) AS round_id, coalesce(l.lr, CAST({LR!r} AS DOUBLE)) AS lr FROM ({all_runs}) c CROSS JOIN range(10) r "
        f"LEFT JOIN ({O.lr_schedule_sql(ctl, 10, LR, gate)}) l ON l.run_id = c.run_id AND l.round_id = r.range"
    )
    return O.training_ctes(O.customer_samples_sql(), 4, runs_sql=runs, sched_sql=sched, own_samples=True)


@register("train_controlled", lambda: O.with_ctes(_controlled_ctes(), O.history_exploded_body(4, with_run=True)))
def q_train_controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 for many runs: one per customer, on its own samples, controlled by the user's log."""
    with C.fold_control(_ctl(spark, sf_dir)) as (_, stops, schedule):
        res = RN.train_runs(TB.customer_samples(spark, sf_dir), stops, schedule)
    return _hist_exploded(res.history, with_run=True)


def _progress_sql() -> str:
    ctes = _controlled_ctes()
    ctes.append(
        "fin AS (SELECT r.run_id, coalesce((SELECT min(h.round_id) FROM hist h WHERE h.run_id = r.run_id "
        "AND h.status = 1), r.stop_round) AS final_round FROM runs r)"
    )
    ctes.append("nsh AS (SELECT run_id, count(DISTINCT shard_id) AS n FROM s GROUP BY run_id)")
    ctes.append(
        f"q AS (SELECT r.run_id, r.seq, r.round_id FROM ({O.rounds_sql(O.ctl_sql())}) r JOIN fin USING (run_id) "
        "WHERE r.op = 'QUERY_PROGRESS' AND r.effective AND r.round_id < 10 AND r.round_id <= fin.final_round)"
    )
    body = (
        "SELECT q.run_id, q.seq, CAST(10 AS INTEGER) AS total_rounds, CAST(greatest(q.round_id - 1, 0) AS INTEGER) AS current_round, "
        "CAST(coalesce(h.alive_shards, nsh.n) AS INTEGER) AS active_workers, "
        "CAST(nsh.n - coalesce(h.alive_shards, nsh.n) AS INTEGER) AS failed_workers, "
        + O.r8(f"coalesce(sc.lr, {LR!r})") + " AS current_lr, "
        + O.r8_odd("coalesce((SELECT arg_max(h2.grad_norm, h2.round_id) FROM hist h2 WHERE h2.run_id = q.run_id "
               "AND h2.round_id < q.round_id AND h2.grad_norm IS NOT NULL), 0.0)")
        + " AS current_loss FROM q JOIN nsh ON nsh.run_id = q.run_id LEFT JOIN hist h ON h.run_id = q.run_id AND h.round_id = q.round_id - 1 "
        "LEFT JOIN sched sc ON sc.run_id = q.run_id AND sc.round_id = q.round_id"
    )
    return O.with_ctes(ctes, body)


@register("progress", _progress_sql)
def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    with C.fold_control(_ctl(spark, sf_dir)) as (folded, stops, schedule):
        res = RN.train_runs(TB.customer_samples(spark, sf_dir), stops, schedule)
        p = C.progress(folded, schedule, res.history, res.summary)
        path = shared_path(spark, "progress")
        p.write.parquet(path)
    return spark.read.parquet(path).select(
        "run_id", "seq", "total_rounds", "current_round", "active_workers", "failed_workers",
        r8("current_lr").alias("current_lr"), r8_odd("current_loss").alias("current_loss"),
    )


# ---- live control and C8 -----------------------------------------------------------------

LIVE = [(3, 10, "ADJUST_LR", 0.05), (4, 11, "PAUSE", None), (4, 12, "ADJUST_LR", 0.9), (4, 13, "RESUME", None), (7, 14, "TERMINATE", None)]


@register(
    "train_live",
    lambda: O.with_ctes(
        O.training_ctes(
            O.li_samples_sql(), 4, runs_sql="SELECT CAST(0 AS BIGINT) AS run_id, 8 AS stop_round",
            sched_sql="SELECT CAST(0 AS BIGINT) AS run_id, CAST(range AS INTEGER) AS round_id, CASE WHEN range >= 4 THEN 0.05 ELSE 0.01 END::DOUBLE AS lr FROM range(10)",
        ),
        O.history_exploded_body(4),
    ),
)
def q_train_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands that arrive while the run trains: the table is read again at each boundary.
    After round 3 a rate is set, after 4 a pause swallows another, after 7 the run ends."""
    path = shared_path(spark, "live-control")
    schema = "seq BIGINT, op STRING, new_lr DOUBLE"
    spark.createDataFrame([], schema).write.parquet(path)

    def arrive(round_id: int, _: float | None) -> None:
        if new := [c[1:] for c in LIVE if c[0] == round_id]:
            spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(path)

    live = TR.LiveControl(lambda: spark.read.schema(schema).parquet(path))
    return _hist_exploded(TR.train(TB.lineitem_samples(spark, sf_dir), live=live, on_round=arrive, partitions=_cores(spark)).history)


# Commands of a gated run, by the round after which they come (-1: before the start).
LIVE_QUERIES = [
    (-1, 5, "ADJUST_LR", 0.9), (-1, 6, "RESUME", None), (1, 10, "QUERY_PROGRESS", None), (2, 11, "ADJUST_LR", 0.05), (3, 12, "ADJUST_LR", None),
    (5, 13, "QUERY_PROGRESS", None), (7, 14, "PAUSE", None), (7, 15, "QUERY_PROGRESS", None), (7, 16, "RESUME", None), (8, 17, "QUERY_PROGRESS", None),
]


def _live_answers_sql() -> str:
    """The queries are taken at boundaries 2, 6 and 9; the one inside the pause is swallowed."""
    ctes = O.training_ctes(
        O.li_samples_sql(), 4, failures_sql=_failures_sql(),
        sched_sql="SELECT CAST(0 AS BIGINT) AS run_id, CAST(range AS INTEGER) AS round_id, CASE WHEN range >= 3 THEN 0.05 ELSE 0.01 END::DOUBLE AS lr FROM range(10)",
    )
    body = (
        "SELECT CAST(q.seq AS BIGINT) AS seq, CAST(10 AS INTEGER) AS total_rounds, h.round_id AS current_round, CAST(h.alive_shards AS INTEGER) AS active_workers, "
        f"CAST({TB.N_SHARDS} - h.alive_shards AS INTEGER) AS failed_workers, {O.r8('sc.lr')} AS current_lr, {O.r8('h.grad_norm')} AS current_loss "
        "FROM (VALUES (10, 2), (13, 6), (17, 9)) q(seq, due) JOIN hist h ON h.round_id = q.due - 1 JOIN sched sc ON sc.round_id = q.due"
    )
    return O.with_ctes(ctes, body)


@register("progress_live", _live_answers_sql)
def q_progress_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 + C7 live: progress queries that come while a gated run trains and loses shards."""
    path = shared_path(spark, "live-queries")
    schema = "seq BIGINT, op STRING, new_lr DOUBLE"

    def arrive(round_id: int, _: float | None = None) -> None:
        if new := [c[1:] for c in LIVE_QUERIES if c[0] == round_id]:
            spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(path)

    arrive(-1)
    live = TR.LiveControl(lambda: spark.read.schema(schema).parquet(path), wait_for_start=True)
    res = TR.train(TB.lineitem_samples(spark, sf_dir), live=live, on_round=arrive, failures=_failures_df(spark), partitions=_cores(spark))
    return res.answers.select("seq", "total_rounds", "current_round", "active_workers", "failed_workers", r8("current_lr").alias("current_lr"), r8("current_loss").alias("current_loss"))


def _due_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's commands, with the boundary before which they come: the one they are due at."""
    path = shared_path(spark, "due")
    C.command_rounds(_ctl(spark, sf_dir)).select("run_id", "seq", "op", "new_lr", F.least("round_id", F.lit(9)).alias("due")).write.partitionBy("due").parquet(path)
    return spark.read.schema(f"{CONTROL_SCHEMA}, due INT").parquet(path)


@register("train_runs_live", lambda: O.with_ctes(_controlled_ctes(), O.history_exploded_body(4, with_run=True)))
def q_train_runs_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + C8: a run per customer, whose commands come as a stream between the rounds."""
    due, path = _due_commands(spark, sf_dir), shared_path(spark, "live-commands")
    came = Arrivals(spark, lambda: spark.readStream.schema(CONTROL_SCHEMA).parquet(path))

    def poll(at: int) -> DataFrame | None:
        due.where(F.col("due") == at).drop("due").write.mode("append").parquet(path)
        return came(at)

    return _hist_exploded(LV.train_live_runs(TB.customer_samples(spark, sf_dir), LV.LiveRuns(poll)).history, with_run=True)


@register("progress_runs_live", lambda: _progress_sql())
def q_progress_runs_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 for many runs: queries that come between the rounds, answered at their boundary."""
    due = _due_commands(spark, sf_dir)
    res = LV.train_live_runs(TB.customer_samples(spark, sf_dir), LV.LiveRuns(lambda at: due.where(F.col("due") == at).drop("due")))
    return res.answers.select(
        "run_id", "seq", "total_rounds", "current_round", "active_workers", "failed_workers",
        r8("current_lr").alias("current_lr"), r8_odd("current_loss").alias("current_loss"),
    )


def _stream_sql(gate: bool, ctl: str | None = None) -> str:
    ctl = ctl or (O.gate_sql(O.ctl_sql())[0] if gate else O.ctl_sql())
    return (
        "SELECT run_id, seq, op, round_id, CAST(paused_before AS INTEGER) AS paused_before, " + O.r8(
            "coalesce(last_value(CASE WHEN op = 'ADJUST_LR' AND effective THEN new_lr END IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY seq), 0.01)"
        ) + f" AS lr FROM ({O.rounds_sql(ctl)}) r"
    )


def _stream_rows(spark: SparkSession, sf_dir: str, wait_for_start: bool, mapped: Callable[[DataFrame], DataFrame] = TB.control_from_events) -> DataFrame:
    """The events table arrives in four parts, in order; the stream is drained after each."""
    events = TB.read_table(spark, sf_dir, "events")
    path, base = shared_path(spark, "events"), shared_path(spark, "control_stream")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - low) * 4 / (high - low + 1))
    out = None
    for i in range(4):
        events.where(part == i).write.mode("append").parquet(path)
        raw = spark.readStream.schema(events.schema).parquet(path)
        out = run_to_table(mapped(raw), spark, base, wait_for_start=wait_for_start)
    return out.select("run_id", "seq", "op", "round_id", F.col("paused_before").cast("int").alias("paused_before"), r8("lr").alias("lr"))


@register("control_stream", lambda: _stream_sql(False))
def q_control_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control events read as a stream, folded with a carry per run."""
    return _stream_rows(spark, sf_dir, False)


@register("control_stream_gated", lambda: _stream_sql(True))
def q_control_stream_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 with the start gate."""
    return _stream_rows(spark, sf_dir, True)


@register("command_stream", lambda: _stream_sql(False, "SELECT * FROM (" + O.decode_sql(O.cmd_lines_sql()) + ") d WHERE op IS NOT NULL"))
def q_command_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C8: raw console lines read as a stream."""
    return _stream_rows(spark, sf_dir, False, TB.commands_from_events)


def _console_sql() -> str:
    """Lines numbered per run by their place."""
    lines = f"SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1 AS BIGINT) AS seq, value FROM ({O.cmd_lines_sql()}) c"
    return _stream_sql(False, "SELECT * FROM (" + O.decode_sql(lines) + ") d WHERE op IS NOT NULL")


@register("console_stream", _console_sql)
def q_console_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C8 from raw text: a console per user, its lines in files that come in three goes. Busy
    consoles have files of their own, the others share files."""
    lines = TB.events_commands(spark, sf_dir)
    path, base = shared_path(spark, "consoles"), shared_path(spark, "console_stream")
    low, high = lines.agg(F.min("seq"), F.max("seq")).first()
    part = F.floor((F.col("seq") - low) * 3 / (high - low + 1))
    out = None
    for i in range(3):
        CON.write_consoles(lines.where(part == i), path)
        out = run_to_table(CON.console_stream(spark, path), spark, base)
    return out.select("run_id", "seq", "op", "round_id", F.col("paused_before").cast("int").alias("paused_before"), r8("lr").alias("lr"))
