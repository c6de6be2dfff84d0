"""Queries over tree ensembles; their SQL learns the same trees from the tables.

The features take at most 32 values each, so the learner tries every midpoint
between neighbouring values and SQL can do the same: sums per node, feature and
value, running totals, and the split of the largest gain.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.functions.hashing import arithmetic_uniform, arithmetic_uniform_sql
from oreline.operators import classify as cf
from oreline.operators import sampling as sm
from oreline.operators import trees as tr
from oreline.plans.tables import rounded, table
from oreline.session import scratch_path
from oreline.sources import readers

NAMES = ["size", "line", "discount", "tax"]
ROUNDS, RATE = 3, 0.1
_LABEL = "l_quantity + 3 * l_linenumber + l_orderkey % 13 > 40"
_CELLS = ["ceil(l_quantity / 2)", "l_linenumber", "l_discount", "l_tax"]


def _examples(spark, sf):
    """Lines with four features and a label that two of them tell in part."""
    rows = table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber").alias("line_key"), F.expr(f"CAST({_LABEL} AS DOUBLE)").alias("label"),
        *[F.expr(f"CAST({c} AS DOUBLE)").alias(n) for c, n in zip(_CELLS, NAMES)])
    data = cf.assemble(rows, NAMES, keep=["line_key"])
    return sm.with_split(data, arithmetic_uniform("line_key.l_orderkey"), 0.7)


def _saved(spark, estimator, data):
    path = scratch_path(spark, "model")
    cf.save_model(estimator.fit(data.where("split = 'train'").select("label", "features")), path)
    return tr.node_table(spark, path)


def _table(nodes, depth):
    told = tr.with_paths(nodes, depth)
    return told.select("tree", "path", "feature", rounded("threshold").alias("threshold"), rounded("value").alias("value"))


def boosted_nodes(spark, sf):
    """The node table of boosted trees of depth 2."""
    return _table(_saved(spark, cf.boosting(2, ROUNDS, seed=255), _examples(spark, sf)), 2)


def boosted_scores(spark, sf):
    """Margin and class of every line, scored by walking the node table."""
    from pyspark.ml.functions import vector_to_array
    data = _examples(spark, sf)
    nodes = _saved(spark, cf.boosting(2, ROUNDS, seed=255), data)
    rows = data.select("line_key", vector_to_array("features").alias("features"))
    return tr.score(rows, nodes, 2, ["line_key"]).select(
        "line_key.l_orderkey", "line_key.l_linenumber", rounded("raw").alias("raw"), tr.predicted("gbt").alias("prediction"))


def grown_tree_nodes(spark, sf):
    """The node table of one classification tree of depth 3, with equal leaves merged."""
    return _table(_saved(spark, cf.forest(3, 1, seed=255).setBootstrap(False), _examples(spark, sf)), 3)


def tree_job_from_text(spark, sf):
    """Lines of text: sampled, parsed, made binary, split 70/30, and a sweep over the depth of boosted trees."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat_ws(", ", *[F.expr(f"CAST(CAST({c} AS DOUBLE) AS STRING)") for c in _CELLS],
                                  F.expr(f"CASE WHEN {_LABEL} THEN '2.0' ELSE '7.0' END"), F.col("l_orderkey").cast("string")).alias("value"))
    kept = lines.where(arithmetic_uniform("l_orderkey", seed=77) < 0.8)
    parsed = readers.parse_numeric_lines(kept, [*NAMES, "class", "key"], "class")
    data = cf.assemble(cf.binarise(parsed, "label", 2.0), NAMES, keep=["key"])
    out = cf.depth_sweep(sm.with_split(data, arithmetic_uniform("key"), 0.7).drop("key"), "gbt", [1, 2], size=ROUNDS, seed=255)
    return out.select("algo", "depth", "split", "n", rounded("err", 8).alias("err"))


# --- the same trees by SQL --------------------------------------------------------


def _base(where: str = "true") -> str:
    cells = ", ".join(f"({c})::DOUBLE" for c in _CELLS)
    return f"""
b AS MATERIALIZED (
  SELECT l_orderkey, l_linenumber, ({_LABEL})::INT AS y, [{cells}] AS x,
         {arithmetic_uniform_sql('l_orderkey')} < 0.7 AS train FROM lineitem WHERE {where})"""


def _impurity(kind: str, n: str, s: str, q: str) -> str:
    return f"({q} - {s} * {s} / {n}) / {n}" if kind == "variance" else f"(1 - ({s} / {n}) ** 2 - (1 - {s} / {n}) ** 2)"


def _grow(name: str, start: str, depth: int, kind: str) -> list[str]:
    """Levels of one tree: ``{name}_0`` .. ``{name}_{depth}`` hold every row with its path, ``{name}_s0`` .. the splits."""
    out = [f"{name}_0 AS MATERIALIZED (SELECT *, '' AS path FROM ({start}))"]
    for level in range(depth):
        rest = [f"({a} - l{a})" for a in ("n", "s", "q")]
        gain = (f"{_impurity(kind, 'n', 's', 'q')} - ln / n * {_impurity(kind, 'ln', 'ls', 'lq')}"
                f" - {rest[0]} / n * {_impurity(kind, *rest)}")
        out += [f"""{name}_c{level} AS (
  SELECT path, f, v, lead(v) OVER w AS next, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq,
         sum(n) OVER p AS n, sum(s) OVER p AS s, sum(q) OVER p AS q
  FROM (SELECT path, f, v, count(*)::DOUBLE AS n, sum(t) AS s, sum(t * t) AS q
        FROM (SELECT path, t, unnest(range(4)) AS f, unnest(x) AS v FROM {name}_{level} WHERE train AND length(path) = {level}) GROUP BY ALL)
  WINDOW w AS (PARTITION BY path, f ORDER BY v), p AS (PARTITION BY path, f))""",
                f"""{name}_s{level} AS MATERIALIZED (
  SELECT path, f, (v + next) / 2 AS cut FROM (SELECT *, {gain} AS gain FROM {name}_c{level} WHERE next IS NOT NULL) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, v) = 1)""",
                f"""{name}_{level + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (path), r.path || CASE WHEN s.path IS NULL THEN '' WHEN r.x[s.f + 1] <= s.cut THEN 'L' ELSE 'R' END AS path
  FROM {name}_{level} r LEFT JOIN {name}_s{level} s ON s.path = r.path)"""]
    out.append(f"""{name}_v AS MATERIALIZED (
  SELECT path[1:k] AS path, avg(t) AS value, sum(t) AS s, count(*) AS n
  FROM {name}_{depth}, range({depth + 1}) d(k) WHERE train AND k <= length(path) GROUP BY 1)""")
    return out


def _nodes(name: str, tree: int, depth: int) -> str:
    splits = " UNION ALL ".join(f"SELECT * FROM {name}_s{level}" for level in range(depth))
    return (f"SELECT {tree} AS tree, v.path, s.f::INTEGER AS feature, round(s.cut, 6) AS threshold, round(v.value, 6) AS value "
            f"FROM {name}_v v LEFT JOIN ({splits}) s ON s.path = v.path")


def _boost(depth: int, prefix: str = "t", rounds: int = ROUNDS) -> list[str]:
    """Boosting with logistic loss: each tree fits four times the label over one plus the exponential of twice the margin."""
    out, start = [], "SELECT *, (2 * y - 1)::DOUBLE AS t, 0.0::DOUBLE AS margin FROM b"
    for k in range(rounds):
        name, weight = f"{prefix}{k}", 1.0 if k == 0 else RATE
        out += _grow(name, start, depth, "variance")
        margin = f"margin + {weight}::DOUBLE * value"
        start = (f"SELECT * EXCLUDE (t, margin, path, value, s, n, path_1), {margin} AS margin, "
                 f"4.0::DOUBLE * (2 * y - 1) / (1.0::DOUBLE + exp(2.0::DOUBLE * (2 * y - 1) * ({margin}))) AS t "
                 f"FROM (SELECT r.*, v.path AS path_1, v.value, v.s, v.n FROM {name}_{depth} r JOIN {name}_v v ON v.path = r.path)")
    out.append(f"{prefix}_end AS (SELECT * FROM ({start}))")
    return out


BOOSTED_NODES_SQL = f"WITH {_base()}, {', '.join(_boost(2))} " + " UNION ALL ".join(_nodes(f"t{k}", k, 2) for k in range(ROUNDS))

BOOSTED_SCORES_SQL = f"""WITH {_base()}, {', '.join(_boost(2))}
SELECT l_orderkey, l_linenumber, round(margin, 6) AS raw, (margin > 0)::INT::DOUBLE AS prediction FROM t_end"""


def _merged(name: str, depth: int) -> str:
    """Inner nodes whose two children are leaves of one class become leaves, from the bottom up."""
    label = f"SELECT path, 2 * s > n AS one FROM {name}_v"
    out = [f"{name}_k{depth} AS (SELECT '' AS path WHERE false)"]
    for level in reversed(range(depth)):
        out.append(f"""{name}_k{level} AS (
  SELECT s.path FROM {name}_s{level} s JOIN ({label}) a ON a.path = s.path || 'L' JOIN ({label}) c ON c.path = s.path || 'R'
  WHERE a.one <> c.one OR a.path IN (FROM {name}_k{level + 1}) OR c.path IN (FROM {name}_k{level + 1}))""")
    kept = " UNION ALL ".join(f"FROM {name}_k{level}" for level in range(depth))
    return ", ".join(out) + f", {name}_k AS ({kept})"


GROWN_TREE_NODES_SQL = f"""WITH {_base()}, {', '.join(_grow('g', 'SELECT *, y::DOUBLE AS t FROM b', 3, 'gini'))}, {_merged('g', 3)}
SELECT tree, path, CASE WHEN path IN (FROM g_k) THEN feature END AS feature, CASE WHEN path IN (FROM g_k) THEN threshold END AS threshold, value
FROM ({_nodes('g', 0, 3)}) WHERE path = '' OR path[1:length(path) - 1] IN (FROM g_k)"""

TREE_JOB_FROM_TEXT_SQL = f"""WITH {_base(arithmetic_uniform_sql('l_orderkey', 77) + ' < 0.8')},
{', '.join(_boost(1, 'a'))}, {', '.join(_boost(2, 'c'))}
SELECT 'gbt' AS algo, depth, CASE WHEN train THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       round(avg(((margin > 0)::INT <> y)::INT), 8) AS err
FROM (SELECT 1 AS depth, train, margin, y FROM a_end UNION ALL SELECT 2, train, margin, y FROM c_end) GROUP BY ALL"""

QUERIES = {
    "boosted_nodes": (boosted_nodes, BOOSTED_NODES_SQL),
    "boosted_scores": (boosted_scores, BOOSTED_SCORES_SQL),
    "grown_tree_nodes": (grown_tree_nodes, GROWN_TREE_NODES_SQL),
    "tree_job_from_text": (tree_job_from_text, TREE_JOB_FROM_TEXT_SQL),
}
