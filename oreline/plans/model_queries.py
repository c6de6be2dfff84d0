"""Queries over points and labelled rows: clustering, sampling, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.functions.hashing import arithmetic_uniform, arithmetic_uniform_sql
from oreline.operators import classify as cf
from oreline.operators import cluster as cl
from oreline.operators import sampling as sm
from oreline.operators.regress import number_columns
from oreline.plans.tables import rounded, table
from oreline.session import scratch_path
from oreline.sources import readers, schemas, sinks

# --- clustering: embeddings as points ---------------------------------------------

K, RUNS = 5, 3


def _points(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")


def _first_centers(points):
    """Starting centres of three runs: means of K groups of the points per run."""
    marked = points.select(
        "v", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(RUNS - 1)),
            lambda r: F.pmod(F.col("label") + r * F.col("id"), F.lit(K)))).alias("run", "j"))
    cells = (marked.select("run", F.col("j").cast("int").alias("j"), F.posexplode("v").alias("i", "x"))
             .groupBy("run", "j", "i").agg(F.avg("x").alias("x")))
    return cells.groupBy("run", "j").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))


_POINTS_SQL = f"""
WITH p AS (SELECT vec_id AS id, label, unnest(range(1, 65)) AS i, unnest(embedding)::DOUBLE AS x
           FROM embeddings),
c0 AS (SELECT run, (label + run * id) % {K} AS j, i, avg(x) AS c
       FROM p, range(0, {RUNS}) t(run) GROUP BY ALL),
d0 AS (SELECT id, run, j, sum((x - c) ** 2) AS d FROM p JOIN c0 USING (i) GROUP BY ALL),
a0 AS (SELECT id, run, j, d FROM d0 QUALIFY row_number() OVER (PARTITION BY id, run ORDER BY d, j) = 1),
c1 AS (SELECT run, j, i, avg(x) AS c FROM p JOIN a0 USING (id) GROUP BY ALL),
d1 AS (SELECT id, run, j, sum((x - c) ** 2) AS d FROM p JOIN c1 USING (i) GROUP BY ALL),
a1 AS (SELECT id, run, j, d FROM d1 QUALIFY row_number() OVER (PARTITION BY id, run ORDER BY d, j) = 1),
cost AS (SELECT run, sum(d) AS cost FROM a0 GROUP BY run)"""


def kmeans_assign(spark, sf):
    """Nearest centre of every point in every run."""
    points = _points(spark, sf)
    out = cl.assign(points, cl.center_array(_first_centers(points)))
    return (out.select("id", F.posexplode(F.arrays_zip("labels", "d2")).alias("run", "z"))
            .select("id", "run", F.col("z.labels").alias("j"), rounded("z.d2").alias("d2")))


KMEANS_ASSIGN_SQL = _POINTS_SQL + """
SELECT id, CAST(run AS INTEGER) AS run, CAST(j AS INTEGER) AS j, round(d, 6) AS d2 FROM a0"""


def kmeans_assign_cost(spark, sf):
    points = _points(spark, sf)
    costs = cl.run_costs(points, cl.center_array(_first_centers(points)))
    return costs.select("run", rounded("cost").alias("cost"))


KMEANS_ASSIGN_COST_SQL = _POINTS_SQL + """
SELECT CAST(run AS INTEGER) AS run, round(cost, 6) AS cost FROM cost"""


def kmeans_two_steps(spark, sf):
    """Members and cost per cluster after one move of the centres."""
    points = _points(spark, sf)
    start = cl.center_array(_first_centers(points))
    moved = cl.cluster_sums(points, start)
    out = cl.cluster_sums(points, cl.center_array(moved, previous=start))
    return out.select("run", "j", "n", rounded("cost").alias("cost"))


KMEANS_TWO_STEPS_SQL = _POINTS_SQL + """
SELECT CAST(run AS INTEGER) AS run, CAST(j AS INTEGER) AS j, count(*) AS n, round(sum(d), 6) AS cost
FROM a1 GROUP BY ALL"""


def kmeans_shift(spark, sf):
    """Largest summed move of a run's centres in the first step."""
    points = _points(spark, sf)
    start = _first_centers(points)
    moved = cl.cluster_sums(points, cl.center_array(start))
    return cl.max_shift(start, moved).select(rounded("max_shift").alias("max_shift"))


KMEANS_SHIFT_SQL = _POINTS_SQL + """,
s AS (SELECT run, j, sqrt(sum((c0.c - c1.c) ** 2)) AS move FROM c0 JOIN c1 USING (run, j, i) GROUP BY ALL),
r AS (SELECT run, sum(move) AS shift FROM s GROUP BY run)
SELECT round(max(shift), 6) AS max_shift FROM r"""


def cost_summary(spark, sf):
    points = _points(spark, sf)
    costs = cl.run_costs(points, cl.center_array(_first_centers(points)))
    out = cl.cost_summary(costs)
    return out.select(*[rounded(c).alias(c) for c in out.columns])


COST_SUMMARY_SQL = _POINTS_SQL + """
SELECT round(log2(max(cost)), 6) AS log2_max, round(log2(min(cost)), 6) AS log2_min,
       round(log2(avg(cost)), 6) AS log2_mean FROM cost"""


def best_run(spark, sf):
    points = _points(spark, sf)
    out = cl.best_run(cl.run_costs(points, cl.center_array(_first_centers(points))))
    return out.select("run", rounded("cost").alias("cost"))


BEST_RUN_SQL = _POINTS_SQL + """
SELECT CAST(run AS INTEGER) AS run, round(cost, 6) AS cost FROM cost ORDER BY cost, run LIMIT 1"""


def label_prefix_entropy(spark, sf):
    points = _points(spark, sf)
    labelled = cl.assign(points, cl.center_array(_first_centers(points)))
    return cl.prefix_entropy(labelled).select("runs", rounded("entropy").alias("entropy"))


LABEL_PREFIX_ENTROPY_SQL = _POINTS_SQL + f""",
l AS (SELECT id, list(j ORDER BY run) AS labels FROM a0 GROUP BY id),
n AS (SELECT runs, labels[1:runs] AS sig, count(*) AS n FROM l, range(1, {RUNS + 1}) t(runs) GROUP BY ALL),
f AS (SELECT runs, n / sum(n) OVER (PARTITION BY runs) AS p FROM n)
SELECT CAST(runs AS INTEGER) AS runs, round(-sum(p * log2(p)), 6) AS entropy FROM f GROUP BY runs"""


def event_type_entropy(spark, sf):
    """Entropy of the event types of each user."""
    counts = (table(spark, sf, "events").groupBy("user_id", "event_type")
              .agg(F.count(F.lit(1)).alias("n")))
    return cl.entropy_of(counts, ["user_id"]).select("user_id", rounded("entropy").alias("entropy"))


EVENT_TYPE_ENTROPY_SQL = """
WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
f AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM n)
SELECT user_id, round(-sum(p * log2(p)), 6) + 0 AS entropy FROM f GROUP BY user_id"""


def kmeans_pp_multi_run(spark, sf):
    """Cost of every run after k-means++ and Lloyd steps, and the entropy of its labels' prefix."""
    points = _points(spark, sf).select("id", "v")
    found = cl.kmeans(points, k=5, runs=25, seed=17)
    costs = cl.run_costs(points, found.centers)
    entropy = cl.prefix_entropy(cl.assign(points, found.centers))
    return (costs.join(entropy, costs["run"] + 1 == entropy["runs"])
            .select("run", rounded("cost").alias("cost"), rounded("entropy").alias("entropy")))


SEED = 17


def kmeans_pp_seeds(spark, sf):
    """The points that 25 runs draw as their five starting centres."""
    points = _points(spark, sf).select("id", "v").persist()
    _, drawn = cl.seeds(points, k=5, runs=25, seed=SEED)
    points.unpersist()
    rows = [(r, j, int(drawn[r, j])) for r in range(25) for j in range(5)]
    return spark.createDataFrame(rows, "run int, j int, id bigint")


def _mixed_sql(x: str) -> str:
    """Finaliser of the public SplitMix64 generator on an unsigned 64-bit number."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = f"((xor({x}, {x} >> {shift})::UHUGEINT * {factor}::UHUGEINT) % {2 ** 64}::UHUGEINT)::UBIGINT"
    return f"xor({x}, {x} >> 31)"


def _seeds_sql(k: int, runs: int, seed: int) -> str:
    """Every round draws the least waiting time: the logarithm of a uniform over the squared distance to the centres so far."""
    parts = [f"""
p AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
s AS MATERIALIZED (SELECT run, round, {_mixed_sql('start')} AS salt FROM (
  SELECT run, round, (({seed * 1_000_003}::UBIGINT + round) * 1000003 + run)::UBIGINT AS start
  FROM range({runs}) a(run), range({k}) b(round))),
u AS MATERIALIZED (SELECT id, run, round, (({_mixed_sql('z')} >> 11)::DOUBLE + 1.0::DOUBLE) * (2.0::DOUBLE ** -53) AS u FROM (
  SELECT id, run, round, xor(id::UBIGINT, salt) AS z FROM p, s)),
n0 AS (SELECT id, run, NULL::DOUBLE AS d2 FROM p, range({runs}) a(run))"""]
    for j in range(k):
        wait = "-ln(u)" if j == 0 else "CASE WHEN d2 > 0 THEN -ln(u) / d2 ELSE 'inf'::DOUBLE END"
        parts.append(f"""c{j} AS MATERIALIZED (
  SELECT run, id, v FROM (SELECT run, id, {wait} AS wait, u FROM n{j} JOIN u USING (id, run) WHERE round = {j}) JOIN p USING (id)
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY wait, u, id) = 1)""")
        if j + 1 < k:
            parts.append(f"""n{j + 1} AS MATERIALIZED (
  SELECT n.id, n.run, least(n.d2, list_distance(p.v, c.v) ** 2) AS d2 FROM n{j} n JOIN p USING (id) JOIN c{j} c ON c.run = n.run)""")
    return "WITH " + ", ".join(parts) + "\n" + " UNION ALL ".join(
        f"SELECT run::INTEGER AS run, {j} AS j, id FROM c{j}" for j in range(k))


KMEANS_PP_SEEDS_SQL = _seeds_sql(5, 25, SEED)


def _rested(spark, sf):
    """Points, and three runs from fixed centres moved until none of them moves more than the limit."""
    points = _points(spark, sf).select("id", "v").persist()
    return points, cl.lloyd(points, cl.center_array(_first_centers(_points(spark, sf))))


def lloyd_to_rest(spark, sf):
    """Centres, members and cost of every cluster once all runs rest, and the number of steps."""
    points, found = _rested(spark, sf)
    sums = cl.cluster_sums(points, found.centers).select("run", "j", "n", "cost")
    rows = cl.center_rows(points, found.centers).join(sums, ["run", "j"], "left")
    wide = rows.select("run", "j", F.coalesce("n", F.lit(0)).alias("n"), rounded(F.coalesce("cost", F.lit(0.0))).alias("cost"),
                       F.lit(len(found.history)).alias("steps"), F.transform("c", lambda x: rounded(x)).alias("c"))
    return number_columns(wide, ["c"], 64)


def best_centres(spark, sf):
    """The centres of the run of least cost, as rows."""
    points, found = _rested(spark, sf)
    rows = cl.best_center_rows(points, cl.run_costs(points, found.centers), found.centers)
    return number_columns(rows.withColumn("c", F.transform("c", lambda x: rounded(x))), ["c"], 64)


def station_labels(spark, sf):
    """Three arrays of a row made one vector, clustered to rest, and the label of every row in every run."""
    e = F.col("embedding")
    parts = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.slice(e, 1, 20).alias("TAVG"), F.slice(e, 21, 20).alias("TRANGE"), F.slice(e, 41, 24).alias("SNWD"))
    points = cl.concat_features(parts, "id", ["TAVG", "TRANGE", "SNWD"]).persist()
    found = cl.lloyd(points, cl.center_array(_first_centers(_points(spark, sf))))
    return cl.assign(points, found.centers).select("id", F.posexplode("labels").alias("run", "label"))


# Steps are taken until the largest move of a run's centres is at rest; an empty cluster keeps its centre.
_LLOYD_SQL = f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
e AS MATERIALIZED (SELECT id, label, unnest(range(1, 65)) AS i, unnest(v) AS x FROM p),
c0 AS MATERIALIZED (
  SELECT run, j, list(c ORDER BY i) AS c FROM (
    SELECT run, (label + run * id) % {K} AS j, i, avg(x) AS c FROM e, range({RUNS}) t(run) GROUP BY ALL) GROUP BY ALL),
w AS (
  SELECT 0 AS steps, run, j, c, 'inf'::DOUBLE AS shift FROM c0
  UNION ALL
  (WITH s AS MATERIALIZED (SELECT * FROM w WHERE shift > {cl.MAX_SHIFT}),
   a AS MATERIALIZED (SELECT id, run, arg_min(j, list_distance(v, c) ** 2) AS j FROM p, s GROUP BY id, run),
   m AS (SELECT run, j, list(x ORDER BY i) AS c FROM (SELECT run, j, i, avg(x) AS x FROM e JOIN a USING (id) GROUP BY ALL) GROUP BY ALL),
   n AS MATERIALIZED (SELECT s.steps + 1 AS steps, s.run, s.j, coalesce(m.c, s.c) AS c, list_distance(coalesce(m.c, s.c), s.c) AS move
                      FROM s LEFT JOIN m ON m.run = s.run AND m.j = s.j)
   SELECT steps, run, j, c, (SELECT max(t) FROM (SELECT sum(move) AS t FROM n GROUP BY run) q) AS shift FROM n)),
f AS MATERIALIZED (SELECT * FROM w WHERE steps = (SELECT max(steps) FROM w)),
d AS MATERIALIZED (SELECT id, run, arg_min(j, list_distance(v, c) ** 2) AS j, min(list_distance(v, c) ** 2) AS d FROM p, f GROUP BY id, run)"""

_C_SQL = ", ".join(f"round(c[{i}], 6) AS c{i}" for i in range(1, 65))

LLOYD_TO_REST_SQL = _LLOYD_SQL + f""",
g AS (SELECT run, j, count(*) AS n, sum(d) AS cost FROM d GROUP BY run, j)
SELECT f.run::INTEGER AS run, f.j::INTEGER AS j, coalesce(n, 0) AS n, round(coalesce(cost, 0.0::DOUBLE), 6) AS cost, steps::INTEGER AS steps, {_C_SQL}
FROM f LEFT JOIN g ON g.run = f.run AND g.j = f.j"""

BEST_CENTRES_SQL = _LLOYD_SQL + f""",
r AS (SELECT run FROM d GROUP BY run ORDER BY sum(d), run LIMIT 1)
SELECT f.run::INTEGER AS run, f.j::INTEGER AS j, {_C_SQL} FROM f JOIN r USING (run)"""

STATION_LABELS_SQL = _LLOYD_SQL + """
SELECT id, run::INTEGER AS run, j::INTEGER AS label FROM d"""


def vector_concat(spark, sf):
    """Three arrays of a row as one feature vector, then as columns."""
    e = F.col("embedding")
    parts = table(spark, sf, "embeddings").select(
        "vec_id", F.slice(e, 1, 20).alias("a"), F.slice(e, 21, 20).alias("b"),
        F.slice(e, 41, 24).alias("c"))
    return number_columns(cl.concat_features(parts, "vec_id", ["a", "b", "c"]), ["v"], 64)


VECTOR_CONCAT_SQL = "SELECT vec_id, " + ", ".join(
    f"embedding[{i}]::DOUBLE AS v{i}" for i in range(1, 65)
) + " FROM embeddings"

# --- samples and splits ---------------------------------------------------------------


def hash_sample_split_sizes(spark, sf):
    """Sizes of a 10 % sample of the orders and of its 70/30 split."""
    draw = arithmetic_uniform("o_orderkey")
    sample = table(spark, sf, "orders").where(draw < 0.1)
    out = sm.with_split(sample, arithmetic_uniform("o_orderkey", seed=987654321), 0.7)
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("cnt"),
                                    F.sum("o_orderkey").alias("key_sum"))


HASH_SAMPLE_SPLIT_SIZES_SQL = f"""
SELECT CASE WHEN {arithmetic_uniform_sql('o_orderkey', 987654321)} < 0.7 THEN 'train' ELSE 'test' END
       AS split, count(*) AS cnt, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders WHERE {arithmetic_uniform_sql('o_orderkey')} < 0.1 GROUP BY 1"""


def keyed_split_is_complete(spark, sf):
    """Rows and keys over both sides of a keyed split: the whole table, once."""
    lines = table(spark, sf, "lineitem")
    out = sm.train_test(lines, ["l_orderkey", "l_linenumber"], 0.7, seed=255)
    return out.agg(F.count(F.lit(1)).alias("cnt"), F.countDistinct("split").alias("splits"),
                   F.sum("l_orderkey").alias("key_sum"))


KEYED_SPLIT_IS_COMPLETE_SQL = """
SELECT count(*) AS cnt, CAST(2 AS BIGINT) AS splits, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM lineitem"""

# --- classification ---------------------------------------------------------------------

FLAGS = {"A": "accepted", "N": "none", "R": "returned"}


def class_distribution(spark, sf):
    out = cf.class_distribution(table(spark, sf, "lineitem"), "l_returnflag", FLAGS)
    return out.select(F.col("l_returnflag").alias("label"), "name", "cnt",
                      rounded("pct").alias("pct"))


CLASS_DISTRIBUTION_SQL = """
SELECT l_returnflag AS label,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS name,
       count(*) AS cnt, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS pct
FROM lineitem GROUP BY 1"""


def binary_label_counts(spark, sf):
    out = cf.binarise(table(spark, sf, "lineitem"), "l_returnflag", "R")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))


BINARY_LABEL_COUNTS_SQL = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, count(*) AS cnt
FROM lineitem GROUP BY 1"""


def error_rate(spark, sf):
    """Error of a fixed rule on both sides of a split."""
    rows = cf.binarise(table(spark, sf, "lineitem"), "l_returnflag", "R")
    rows = sm.with_split(rows, arithmetic_uniform("l_orderkey"), 0.7)
    rule = (F.col("l_quantity") > 25).cast("double")
    out = cf.error_rate(rows.withColumn("prediction", rule), ["split"])
    return out.select("split", "n", rounded("err", 8).alias("err"))


ERROR_RATE_SQL = f"""
SELECT CASE WHEN {arithmetic_uniform_sql('l_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, round(avg(CASE WHEN (l_returnflag = 'R') <> (l_quantity > 25) THEN 1.0 ELSE 0.0 END), 8) AS err
FROM lineitem GROUP BY 1"""


def _examples(spark, sf):
    """Label 3 against the rest, on the 64 numbers of an embedding."""
    wide = number_columns(table(spark, sf, "embeddings"), ["embedding"], 64)
    rows = cf.assemble(cf.binarise(wide, "label", 3), [f"embedding{i + 1}" for i in range(64)],
                       keep=["vec_id"])
    return sm.with_split(rows, arithmetic_uniform("vec_id"), 0.7).drop("vec_id")


def gbt_depth_sweep(spark, sf):
    out = cf.depth_sweep(_examples(spark, sf), "gbt", cf.BOOSTING_DEPTHS, seed=255)
    return out.select("algo", "depth", "split", "n", "err")


def rf_depth_sweep(spark, sf):
    out = cf.depth_sweep(_examples(spark, sf), "rf", cf.FOREST_DEPTHS, seed=255)
    return out.select("algo", "depth", "split", "n", "err")


def _decided(spark, sf):
    """Lines whose label one of three features decides: more than 25 pieces."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_quantity") > 25).cast("double").alias("label"),
        *[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax")])
    data = cf.assemble(rows, ["l_quantity", "l_discount", "l_tax"], keep=["l_orderkey"])
    return sm.with_split(data, arithmetic_uniform("l_orderkey"), 0.7).drop("l_orderkey")


def tree_sweeps_decided(spark, sf):
    """Both learners at two depths on a label that one feature decides: no errors."""
    data = _decided(spark, sf)
    sweeps = [cf.depth_sweep(data, algo, [depth], size=size, seed=255)
              for algo, depth, size in (("gbt", 1, 2), ("gbt", 3, 2), ("rf", 6, 5))]
    out = sweeps[0].unionByName(sweeps[1]).unionByName(sweeps[2])
    return out.select("algo", "depth", "split", "n", rounded("err", 8).alias("err"))


TREE_SWEEPS_DECIDED_SQL = f"""
SELECT algo, depth, CASE WHEN {arithmetic_uniform_sql('l_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, 0.0::DOUBLE AS err
FROM lineitem, (VALUES ('gbt', 1), ('gbt', 3), ('rf', 6)) t(algo, depth) GROUP BY ALL"""


def saved_tree_errors(spark, sf):
    """A boosted model written, read again, and joined to the labels of its rows."""
    data = _decided(spark, sf)
    path = scratch_path(spark, "model")
    cf.save_model(cf.boosting(1, 2, seed=255).fit(data.where("split = 'train'").drop("split")), path)
    scored = cf.load_model("gbt", path).transform(data)
    out = cf.error_rate(scored, ["split"])
    return out.select("split", "n", rounded("err", 8).alias("err"))


SAVED_TREE_ERRORS_SQL = f"""
SELECT CASE WHEN {arithmetic_uniform_sql('l_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, 0.0::DOUBLE AS err FROM lineitem GROUP BY ALL"""


# --- files of numbers ---------------------------------------------------------------------


def _write_csv(spark, sf, cells, name):
    path = scratch_path(spark, name)
    sinks.write_lines(table(spark, sf, "embeddings").select(F.concat_ws(", ", *cells)), path)
    return path


def _numbers():
    return F.transform("embedding", lambda x: x.cast("double").cast("string"))


def csv_label_last(spark, sf):
    names = schemas.expand_names([("e", 64), "label"])
    path = _write_csv(spark, sf, [_numbers(), F.col("label").cast("string")], "label-last")
    out = readers.read_numeric_csv(spark, path, names, "label")
    return _column_sums(out)


def _column_sums(numbers):
    return numbers.groupBy("label").agg(F.count(F.lit(1)).alias("cnt"), *[
        rounded(F.sum(f"e_{i}")).alias(f"s{i}") for i in range(64)])


def csv_label_first(spark, sf):
    names = schemas.expand_names(["label", ("e", 64)])
    path = _write_csv(spark, sf, [F.col("label").cast("string"), _numbers()], "label-first")
    out = readers.parse_numeric_lines(spark.read.text(path), names, "label")
    return _column_sums(out)


CSV_SQL = ("SELECT label::DOUBLE AS label, count(*) AS cnt, "
           + ", ".join(f"round(sum(embedding[{i + 1}]::DOUBLE), 6) AS s{i}" for i in range(64))
           + " FROM embeddings GROUP BY 1")


def flatten_nested(spark, sf):
    """Each embedding as a station record with two measurements, then flattened."""
    e = F.col("embedding").cast("array<double>")
    nested = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("station"),
        F.array(F.struct(F.lit("TMIN").alias("measurement"), F.col("label").alias("year"),
                         F.slice(e, 1, 32).alias("vec")),
                F.struct(F.lit("TMAX").alias("measurement"), (F.col("label") + 1).alias("year"),
                         F.slice(e, 33, 32).alias("vec"))).alias("measurements"))
    flat = readers.flatten_stations(nested)
    return flat.select("station", "measurement", "year",
                       rounded(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x)).alias("total"))


FLATTEN_NESTED_SQL = """
SELECT vec_id::VARCHAR AS station, 'TMIN' AS measurement, label AS year,
       round(list_sum(list_transform(embedding[1:32], lambda x: x::DOUBLE)), 6) AS total FROM embeddings
UNION ALL
SELECT vec_id::VARCHAR, 'TMAX', label + 1,
       round(list_sum(list_transform(embedding[33:64], lambda x: x::DOUBLE)), 6) FROM embeddings"""

QUERIES = {
    "kmeans_assign": (kmeans_assign, KMEANS_ASSIGN_SQL),
    "kmeans_assign_cost": (kmeans_assign_cost, KMEANS_ASSIGN_COST_SQL),
    "kmeans_two_steps": (kmeans_two_steps, KMEANS_TWO_STEPS_SQL),
    "kmeans_shift": (kmeans_shift, KMEANS_SHIFT_SQL),
    "kmeans_pp_multi_run": (kmeans_pp_multi_run, None),
    "kmeans_pp_seeds": (kmeans_pp_seeds, KMEANS_PP_SEEDS_SQL),
    "lloyd_to_rest": (lloyd_to_rest, LLOYD_TO_REST_SQL),
    "best_centres": (best_centres, BEST_CENTRES_SQL),
    "station_labels": (station_labels, STATION_LABELS_SQL),
    "cost_summary": (cost_summary, COST_SUMMARY_SQL),
    "best_run": (best_run, BEST_RUN_SQL),
    "label_prefix_entropy": (label_prefix_entropy, LABEL_PREFIX_ENTROPY_SQL),
    "event_type_entropy": (event_type_entropy, EVENT_TYPE_ENTROPY_SQL),
    "vector_concat": (vector_concat, VECTOR_CONCAT_SQL),
    "hash_sample_split_sizes": (hash_sample_split_sizes, HASH_SAMPLE_SPLIT_SIZES_SQL),
    "keyed_split_is_complete": (keyed_split_is_complete, KEYED_SPLIT_IS_COMPLETE_SQL),
    "class_distribution": (class_distribution, CLASS_DISTRIBUTION_SQL),
    "binary_label_counts": (binary_label_counts, BINARY_LABEL_COUNTS_SQL),
    "error_rate": (error_rate, ERROR_RATE_SQL),
    "gbt_depth_sweep": (gbt_depth_sweep, None),
    "rf_depth_sweep": (rf_depth_sweep, None),
    "tree_sweeps_decided": (tree_sweeps_decided, TREE_SWEEPS_DECIDED_SQL),
    "saved_tree_errors": (saved_tree_errors, SAVED_TREE_ERRORS_SQL),
    "csv_label_last": (csv_label_last, CSV_SQL),
    "csv_label_first": (csv_label_first, CSV_SQL),
    "flatten_nested": (flatten_nested, FLATTEN_NESTED_SQL),
}
