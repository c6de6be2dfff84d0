"""Queries over panels, vectors and stations: statistics, spectra, regression."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from oreline.functions.hashing import arithmetic_uniform, arithmetic_uniform_sql
from oreline.operators import leading
from oreline.operators import lowrank as lr
from oreline.operators import panel as pn
from oreline.operators import regress as rg
from oreline.operators import sampling as sm
from oreline.plans.tables import rounded, table

# --- panels: event types as measurements, day of the year as day -------------------


def _panel(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series"), F.dayofyear("ts").alias("day"),
        F.col("value").alias("x"))


def panel_daily_stats(spark, sf):
    out = pn.daily_stats(_panel(spark, sf))
    return out.select("series", "day", "ne", *[rounded(c, 5).alias(c) for c in
                                               ("mean", "var", "band_low", "band_high")])


PANEL_DAILY_STATS_SQL = """
WITH s AS (SELECT event_type AS series, CAST(dayofyear(ts) AS INTEGER) AS day,
                  avg(value) AS mean, var_pop(value) AS var, count(value) AS ne
           FROM events GROUP BY 1, 2)
SELECT series, day, ne, round(mean, 5) + 0 AS mean, round(var, 5) + 0 AS var,
       round(mean - sqrt(var), 5) + 0 AS band_low, round(mean + sqrt(var), 5) + 0 AS band_high
FROM s"""


def panel_of_kinds(spark, sf):
    """Readings of two of the measurements only."""
    return (pn.pick_series(_panel(spark, sf), ["view", "purchase"])
            .groupBy("series").agg(F.count("x").alias("ne")))


PANEL_OF_KINDS_SQL = """
SELECT event_type AS series, count(value) AS ne FROM events
WHERE event_type IN ('view', 'purchase') GROUP BY 1"""


def scalar_summary(spark, sf):
    out = pn.scalar_summary(_panel(spark, sf))
    return out.select("series", *[rounded(c, 5).alias(c) for c in ("mean", "std", *pn.CUTS)])


SCALAR_SUMMARY_SQL = """
SELECT event_type AS series, round(avg(value), 5) AS mean, round(stddev_pop(value), 5) AS std,
       round(quantile_cont(value, 0.001), 5) AS low1000,
       round(quantile_cont(value, 0.01), 5) AS low100,
       round(quantile_cont(value, 0.99), 5) AS high100,
       round(quantile_cont(value, 0.999), 5) AS high1000
FROM events GROUP BY 1"""


def clipped_histogram(spark, sf):
    out = pn.clipped_histogram(_panel(spark, sf))
    return out.select("series", "bin", rounded("bin_start", 4).alias("bin_start"), "cnt")


CLIPPED_HISTOGRAM_SQL = """
WITH q AS (SELECT event_type AS s, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
           FROM events GROUP BY 1),
v AS (SELECT s, value FROM events JOIN q ON s = event_type WHERE value BETWEEN lo AND hi),
m AS (SELECT s, min(value) AS lo, max(value) AS hi FROM v GROUP BY s),
b AS (SELECT v.s AS series, lo, (hi - lo) / 100.0::DOUBLE AS w,
             least(floor((value - lo) / ((hi - lo) / 100.0::DOUBLE)), 99) AS bin
      FROM v JOIN m USING (s))
SELECT series, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 4) AS bin_start, count(*) AS cnt
FROM b GROUP BY ALL"""

def clipped_readings(spark, sf):
    """Readings of each day that lie between the 1 % and 99 % points of their measurement."""
    panel = _panel(spark, sf)
    return (pn.clip_range(panel, pn.scalar_summary(panel)).groupBy("series", "day")
            .agg(F.count(F.lit(1)).alias("n"), rounded(F.min("x")).alias("least"), rounded(F.max("x")).alias("most")))


CLIPPED_READINGS_SQL = """
WITH e AS (SELECT event_type AS series, dayofyear(ts) AS day, value AS x FROM events WHERE NOT isnan(value)),
q AS (SELECT series, quantile_cont(x, 0.01) AS low, quantile_cont(x, 0.99) AS high FROM e GROUP BY series)
SELECT series, CAST(day AS INTEGER) AS day, count(*) AS n, round(min(x), 6) AS least, round(max(x), 6) AS most
FROM e JOIN q USING (series) WHERE x BETWEEN low AND high GROUP BY ALL"""


# --- spectra: embeddings as day vectors, label as series -----------------------------

D = 64


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").alias("series"), F.col("embedding").alias("vec"))


def _spectrum(spark, sf):
    return lr.eigen(lr.covariance(_vectors(spark, sf)))


def covariance_invariants(spark, sf):
    """Sum and square sum of the eigenvalues: trace and Frobenius norm of the covariance."""
    return _spectrum(spark, sf).groupBy("series").agg(
        rounded(F.sum("eigval"), 8).alias("trace"),
        rounded(F.sum(F.col("eigval") * F.col("eigval")), 8).alias("frobenius2"))


COVARIANCE_INVARIANTS_SQL = """
WITH c AS (SELECT vec_id, label AS series, unnest(range(1, 65)) AS i,
                  unnest(embedding)::DOUBLE AS x FROM embeddings),
p AS (SELECT a.series, a.i, b.i AS j, covar_pop(a.x, b.x) AS cov
      FROM c a JOIN c b ON a.vec_id = b.vec_id AND a.series = b.series GROUP BY ALL)
SELECT series, round(sum(cov) FILTER (WHERE i = j), 8) AS trace,
       round(sum(cov * cov), 8) AS frobenius2
FROM p GROUP BY series"""


def covariance_entries(spark, sf):
    """Every entry of the covariance on and above the diagonal."""
    return lr.covariance(_vectors(spark, sf)).select(
        "series", "i", "j", F.col("n").cast("bigint").alias("n"), rounded("cov", 8).alias("cov"))


_ENTRIES_SQL = """
WITH c AS (SELECT vec_id, label AS series, unnest(range(0, 64)) AS i,
                  unnest(embedding)::DOUBLE AS x FROM embeddings),
p AS (SELECT a.series, a.i, b.i AS j, count(*) AS n, covar_pop(a.x, b.x) AS cov
      FROM c a JOIN c b ON a.vec_id = b.vec_id AND a.series = b.series AND a.i <= b.i GROUP BY ALL)"""

COVARIANCE_ENTRIES_SQL = _ENTRIES_SQL + """
SELECT series, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, n, round(cov, 8) AS cov FROM p"""


def eigen_rebuild(spark, sf):
    """The covariance put together again from all eigenvalues and eigenvectors."""
    pairs = _spectrum(spark, sf).select("series", "eigval", "eigvec", F.posexplode("eigvec").alias("i", "a"))
    cells = pairs.select("series", "eigval", "i", "a", F.posexplode("eigvec").alias("j", "b")).where("i <= j")
    return cells.groupBy("series", "i", "j").agg(rounded(F.sum(F.col("eigval") * F.col("a") * F.col("b")), 7).alias("cov"))


EIGEN_REBUILD_SQL = _ENTRIES_SQL + """
SELECT series, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(cov, 7) AS cov FROM p"""


def residual_trace(spark, sf):
    """Mean residual at rank r plus the share of the top r eigenvalues in the trace: the trace again, r = 1..3."""
    vectors, cov = _vectors(spark, sf), lr.covariance(_vectors(spark, sf))
    spectrum = lr.eigen(cov)
    share = lr.explained_variance(spectrum, k_max=3).where("k > 0")
    trace = spectrum.groupBy("series").agg(F.sum("eigval").alias("trace"))
    left = (lr.residuals(vectors, lr.fit_basis(vectors)).groupBy("series")
            .agg(*[F.avg(F.get("err", F.lit(r))).alias(f"err{r + 1}") for r in range(3)])
            .select("series", F.posexplode(F.array("err1", "err2", "err3")).alias("p", "err")))
    joined = share.join(trace, "series").join(left.select("series", (F.col("p") + 1).alias("k"), "err"), ["series", "k"])
    return joined.select("series", "k", rounded(F.col("err") + F.col("explained") * F.col("trace"), 7).alias("trace"))


RESIDUAL_TRACE_SQL = _ENTRIES_SQL + """
SELECT series, CAST(k AS INTEGER) AS k, round(sum(cov), 7) AS trace
FROM p, range(1, 4) t(k) WHERE i = j GROUP BY series, k"""


SQUARINGS = 14


def _eigen_sql(top: int, length: int) -> str:
    """Leading eigenpairs ``v1`` .. by repeated squaring of the covariance ``p`` (series, i <= j, cov), from 0.

    The power of a matrix tends to the outer product of its leading vector; the
    vector is taken from the row of the largest diagonal entry, its value is the
    Rayleigh quotient, and the pair is subtracted before the next.
    """
    parts = ["""f1 AS MATERIALIZED (
  SELECT series, i, list(cov ORDER BY j) AS r FROM (SELECT series, i, j, cov FROM p UNION ALL SELECT series, j, i, cov FROM p WHERE i < j) GROUP BY ALL)"""]
    for k in range(1, top + 1):
        source = f"f{k}"
        for t in range(SQUARINGS + 1):
            raw = source if t == 0 else f"q{k}_{t}"
            if t:
                parts.append(f"""{raw} AS MATERIALIZED (
  SELECT a.series, a.i, list(list_dot_product(a.r, b.r) ORDER BY b.i) AS r FROM n{k}_{t - 1} a JOIN n{k}_{t - 1} b ON a.series = b.series GROUP BY ALL)""")
            parts.append(f"""n{k}_{t} AS MATERIALIZED (
  SELECT series, i, list_transform(r, lambda x: CASE WHEN tr > 1e-12 THEN x / tr ELSE 0.0::DOUBLE END) AS r
  FROM {raw} JOIN (SELECT series, sum(r[i + 1]) AS tr FROM {raw} GROUP BY series) USING (series))""")
        parts.append(f"""u{k} AS MATERIALIZED (
  SELECT series, list_transform(r, lambda x: x * s / n) AS v FROM (
    SELECT series, r, greatest(sqrt(list_dot_product(r, r)), 1e-300::DOUBLE) AS n,
           sign(list_sum(list_filter(r, lambda x: abs(x) = list_max(list_transform(r, lambda y: abs(y)))))) AS s
    FROM n{k}_{SQUARINGS} QUALIFY row_number() OVER (PARTITION BY series ORDER BY r[i + 1] DESC, i) = 1))""")
        parts.append(f"""v{k} AS MATERIALIZED (
  SELECT series, any_value(v) AS v, greatest(sum(v[i + 1] * list_dot_product(r, v)), 0.0::DOUBLE) AS value FROM f{k} JOIN u{k} USING (series) GROUP BY series)""")
        if k < top:
            parts.append(f"""f{k + 1} AS MATERIALIZED (
  SELECT series, i, list_transform(list_zip(r, v), lambda z: z[1] - value * v[i + 1] * z[2]) AS r FROM f{k} JOIN v{k} USING (series))""")
    pairs = " UNION ALL ".join(f"SELECT series, {k} AS k, value, v FROM v{k}" for k in range(1, top + 1))
    return ",\n".join(parts) + f",\neig AS MATERIALIZED ({pairs})"


EXPLAINED_VARIANCE_SQL = _ENTRIES_SQL + ", " + _eigen_sql(9, D) + """
SELECT series, CAST(t.k AS INTEGER) AS k, round(coalesce(sum(value) FILTER (WHERE eig.k <= t.k), 0.0::DOUBLE) / any_value(trace), 8) AS explained
FROM eig JOIN (SELECT series, sum(cov) AS trace FROM p WHERE i = j GROUP BY series) USING (series), range(0, 10) t(k) GROUP BY series, t.k"""

DAILY_BASIS_SERIES_SQL = _ENTRIES_SQL + ", " + _eigen_sql(3, D) + f"""
SELECT series, CAST(k AS INTEGER) AS k, CAST(i AS INTEGER) AS day, round(v[i], 6) AS value FROM eig, range(1, {D + 1}) t(i)"""

SPECTRAL_RESIDUALS_SQL = _ENTRIES_SQL + ", " + _eigen_sql(3, D) + """,
x AS (SELECT vec_id, series, list(x - mean ORDER BY i) AS x FROM c JOIN (SELECT series, i, avg(x) AS mean FROM c GROUP BY ALL) USING (series, i) GROUP BY ALL),
w AS (SELECT vec_id, x.series, k, list_dot_product(x, x) AS whole, list_dot_product(x, v) ** 2 AS part FROM x JOIN eig ON eig.series = x.series),
e AS (SELECT vec_id, series, k, whole - sum(part) OVER (PARTITION BY vec_id ORDER BY k) AS err FROM w)
SELECT series, count(DISTINCT vec_id) AS n, round(avg(err) FILTER (WHERE k = 1), 8) AS err1,
       round(avg(err) FILTER (WHERE k = 2), 8) AS err2, round(avg(err) FILTER (WHERE k = 3), 8) AS err3
FROM e GROUP BY series"""


def explained_variance(spark, sf):
    out = lr.explained_variance(_spectrum(spark, sf))
    return out.select("series", "k", rounded("explained", 8).alias("explained"))


def daily_basis_series(spark, sf):
    out = lr.eigenvector_series(_spectrum(spark, sf))
    return out.select("series", "k", "day", rounded("value").alias("value"))


def leading_basis_series(spark, sf):
    """The leading eigenvectors by block iteration on the vectors, without pair sums."""
    out = lr.eigenvector_series(leading.leading_eigen(_vectors(spark, sf)))
    return out.select("series", "k", "day", rounded("value").alias("value"))


def leading_shares(spark, sf):
    """Value and share of the variance of each leading eigenvector, by block iteration."""
    return leading.leading_eigen(_vectors(spark, sf)).select(
        "series", "k", rounded("eigval", 8).alias("eigval"), rounded("share", 8).alias("share"))


LEADING_SHARES_SQL = _ENTRIES_SQL + ", " + _eigen_sql(3, D) + """
SELECT series, CAST(k AS INTEGER) AS k, round(value, 8) AS eigval, round(value / trace, 8) AS share
FROM eig JOIN (SELECT series, sum(cov) AS trace FROM p WHERE i = j GROUP BY series) USING (series)"""


def spectral_residuals(spark, sf):
    """Mean residual per series against the series' own leading eigenvectors."""
    vectors = _vectors(spark, sf)
    return (lr.residuals(vectors, lr.fit_basis(vectors)).groupBy("series")
            .agg(F.count(F.lit(1)).alias("n"),
                 *[rounded(F.avg(F.get("err", F.lit(r))), 8).alias(f"err{r + 1}")
                   for r in range(3)]))


def _cosine(rank: int, length: int):
    """Rows of the orthonormal cosine basis, as an array of arrays."""
    return [[math.sqrt(2.0 / length) * math.cos(math.pi * (i + 0.5) * k / length)
             for i in range(length)] for k in range(1, rank + 1)]


def _cosine_basis(vectors, length):
    rows = F.array(*[F.array(*[F.lit(v) for v in row]) for row in _cosine(3, length)])
    return lr.mean_vectors(vectors).withColumn("basis", rows)


def _basis_sql(length: int) -> str:
    return (f"(SELECT k, i, sqrt(2.0::DOUBLE / {length}) * "
            f"cos(pi() * (i - 0.5::DOUBLE) * k / {length}) AS b "
            f"FROM range(1, 4) t(k), range(1, {length + 1}) u(i))")


def reconstruct_residual(spark, sf):
    """Residuals at rank 1, 2 and 3 in a fixed basis."""
    vectors = _vectors(spark, sf)
    out = lr.residuals(vectors, _cosine_basis(vectors, D))
    return out.select("vec_id", "series", *[rounded(F.get("err", F.lit(r))).alias(f"err{r + 1}")
                                            for r in range(3)])


RECONSTRUCT_RESIDUAL_SQL = f"""
WITH c AS (SELECT vec_id, label AS series, unnest(range(1, {D + 1})) AS i,
                  unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT series, i, avg(x) AS mean FROM c GROUP BY ALL),
z AS (SELECT vec_id, series, i, x, mean FROM c JOIN m USING (series, i)),
w AS (SELECT vec_id, k, sum((x - mean) * b) AS w FROM z JOIN {_basis_sql(D)} USING (i) GROUP BY ALL),
r AS (SELECT vec_id, series, i, x, mean, k,
             sum(w * b) OVER (PARTITION BY vec_id, i ORDER BY k) AS part
      FROM z JOIN {_basis_sql(D)} USING (i) JOIN w USING (vec_id, k)),
e AS (SELECT vec_id, series, k, sum((mean + part - x) ** 2) AS err FROM r GROUP BY ALL)
SELECT vec_id, series, round(max(err) FILTER (WHERE k = 1), 6) AS err1,
       round(max(err) FILTER (WHERE k = 2), 6) AS err2,
       round(max(err) FILTER (WHERE k = 3), 6) AS err3
FROM e GROUP BY ALL"""

# --- vectors with gaps: hour-of-day profiles of users ----------------------------------


def _profiles(spark, sf):
    hours = table(spark, sf, "events").select(
        "user_id", F.lit("value").alias("series"), F.hour("ts").alias("hour"), "value")
    return lr.panel_vectors(hours, ["user_id", "series"], "hour", "value", 24)


def residual_extremes(spark, sf):
    vectors = _profiles(spark, sf)
    out = lr.residual_extremes(vectors, _cosine_basis(vectors, 24), ["user_id"])
    return out.select("user_id", "series", "end", "pos", rounded("err", 5).alias("err"))


_EXTREMES_SQL = f"""
WITH c AS (SELECT user_id, CAST(hour(ts) AS INTEGER) + 1 AS i, avg(value) AS x
           FROM events GROUP BY ALL),
m AS (SELECT i, avg(x) AS mean FROM c GROUP BY i),
whole AS (SELECT user_id FROM c GROUP BY user_id HAVING count(*) = 24),
z AS (SELECT user_id, i, x, mean FROM c JOIN m USING (i) JOIN whole USING (user_id)),
w AS (SELECT user_id, k, sum((x - mean) * b) AS w FROM z JOIN {_basis_sql(24)} USING (i) GROUP BY ALL),
r AS (SELECT user_id, i, x, mean, k,
             mean + sum(w * b) OVER (PARTITION BY user_id, i ORDER BY k) AS v
      FROM z JOIN {_basis_sql(24)} USING (i) JOIN w USING (user_id, k)),
e AS (SELECT user_id, sum((v - x) ** 2) AS err FROM r WHERE k = 3 GROUP BY ALL),
p AS (SELECT user_id, err, row_number() OVER (ORDER BY err, user_id) AS lo,
             row_number() OVER (ORDER BY err DESC, user_id) AS hi FROM e),
x AS (SELECT user_id, err, 'low' AS "end", lo AS pos FROM p WHERE lo <= 2
      UNION ALL SELECT user_id, err, 'high', hi FROM p WHERE hi <= 2)"""

RESIDUAL_EXTREMES_SQL = _EXTREMES_SQL + """
SELECT user_id, 'value' AS series, "end", CAST(pos AS INTEGER) AS pos, round(err, 5) AS err FROM x"""


def reconstruction_profiles(spark, sf):
    """Original, mean and rank 1..3 series of the extreme users, by hour."""
    vectors = _profiles(spark, sf)
    out = lr.extreme_profiles(vectors, _cosine_basis(vectors, 24), ["user_id"])
    return out.select(
        "user_id", "end", "pos", "day", rounded("original", 5).alias("original"),
        rounded("mean", 5).alias("mean"),
        *[rounded(F.get("recon", F.lit(r)), 5).alias(f"rank{r + 1}") for r in range(3)])


RECONSTRUCTION_PROFILES_SQL = _EXTREMES_SQL + """
SELECT user_id, "end", CAST(pos AS INTEGER) AS pos, i AS day, round(r.x, 5) AS original,
       round(mean, 5) AS mean, round(max(v) FILTER (WHERE k = 1), 5) AS rank1,
       round(max(v) FILTER (WHERE k = 2), 5) AS rank2, round(max(v) FILTER (WHERE k = 3), 5) AS rank3
FROM x JOIN r USING (user_id) GROUP BY user_id, "end", pos, i, r.x, mean"""

def own_extremes(spark, sf):
    """The users nearest to and farthest from their rebuilding in the panel's own eigenvectors."""
    vectors = _profiles(spark, sf)
    out = lr.residual_extremes(vectors, lr.fit_basis(vectors), ["user_id"])
    return out.select("user_id", "series", "end", "pos", rounded("err", 5).alias("err"))


def own_profiles(spark, sf):
    """Original, mean and rank 1..3 series of these users, by hour."""
    vectors = _profiles(spark, sf)
    out = lr.extreme_profiles(vectors, lr.fit_basis(vectors), ["user_id"])
    return out.select(
        "user_id", "end", "pos", "day", rounded("original", 5).alias("original"), rounded("mean", 5).alias("mean"),
        *[rounded(F.get("recon", F.lit(r)), 5).alias(f"rank{r + 1}") for r in range(3)])


_OWN_SQL = (_EXTREMES_SQL[:_EXTREMES_SQL.index("whole AS")] + """
h AS (SELECT 'value' AS series, user_id, i - 1 AS i, x FROM c),
p AS (SELECT a.series, a.i, b.i AS j, covar_pop(a.x, b.x) AS cov FROM h a JOIN h b ON a.user_id = b.user_id AND a.i <= b.i GROUP BY ALL), """
            + _eigen_sql(3, 24) + ",\nb AS (SELECT k, i, v[i] AS b FROM eig, range(1, 25) t(i)),\n"
            + _EXTREMES_SQL[_EXTREMES_SQL.index("whole AS"):].replace(_basis_sql(24), "b").replace("p AS (SELECT user_id", "g AS (SELECT user_id").replace("FROM p ", "FROM g "))

OWN_EXTREMES_SQL = _OWN_SQL + RESIDUAL_EXTREMES_SQL[len(_EXTREMES_SQL):]
OWN_PROFILES_SQL = _OWN_SQL + RECONSTRUCTION_PROFILES_SQL[len(_EXTREMES_SQL):]

# --- regression ---------------------------------------------------------------------------

INPUTS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
TARGETS = ["price", "revenue", "charge"]


def _stations(spark, sf):
    price, off = F.col("l_extendedprice"), 1 - F.col("l_discount")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", *INPUTS, price.alias("price"), (price * off).alias("revenue"),
        (price * off * (1 + F.col("l_tax"))).alias("charge"))
    return sm.with_split(lines, arithmetic_uniform("l_orderkey"), 0.5)


def ols_coefficients(spark, sf):
    out = rg.ols_coefficients(_stations(spark, sf), INPUTS, TARGETS)
    return out.select("target", "input", rounded("coef", 3).alias("coef"))


def ols_scores(spark, sf):
    out = rg.ols_scores(_stations(spark, sf), INPUTS, TARGETS)
    return out.select("target", rounded("train_r2", 8).alias("train_r2"),
                      rounded("test_r2", 8).alias("test_r2"), "overfit")


def ols_ablation(spark, sf):
    out = rg.ols_ablation(_stations(spark, sf), INPUTS, TARGETS)
    return out.select("target", "removed", rounded("train_decrease", 8).alias("train_decrease"),
                      rounded("test_decrease", 8).alias("test_decrease"))


def _elimination_sql(base: str, inputs: list[str], targets: list[str]) -> str:
    """Successive residuals on the train rows, once with each input last.

    Each step removes one input from every later column (Frisch-Waugh-Lovell);
    the last step's slope is that input's coefficient in the full model, and the
    squares before and after it give the scores without and with the input.
    """
    parts, many = [f"base AS ({base})"], len(targets)
    columns = [f"x{i}" for i in range(len(inputs))] + [f"y{t}" for t in range(many)]
    centred = ", ".join(f"{c} - avg({c}) FILTER (WHERE tr) OVER () AS {c}" for c in columns)
    parts.append(f"centred AS (SELECT tr, {centred} FROM base)")
    results = []
    for last in range(len(inputs)):
        order = [i for i in range(len(inputs)) if i != last] + [last]
        source = "centred"
        for step, pivot in enumerate(order):
            u = f"x{pivot}"
            later = [f"x{i}" for i in order[step + 1:]] + [f"y{t}" for t in range(many)]

            def slope(c, u=u):
                return (f"sum({c} * {u}) FILTER (WHERE tr) OVER () / "
                        f"sum({u} * {u}) FILTER (WHERE tr) OVER ()")

            exprs = [f"{c} - {u} * ({slope(c)}) AS {c}" for c in later]
            if pivot == last:      # keep the residual before this step, and the slope
                exprs += [f"y{t} AS p{t}" for t in range(many)]
                exprs += [f"{slope(f'y{t}')} AS b{t}" for t in range(many)]
            name = f"s{last}_{step}"
            parts.append(f"{name} AS (SELECT tr, {', '.join(exprs)} FROM {source})")
            source = name
        for t, target in enumerate(targets):
            results.append(f"""SELECT '{target}' AS target, '{inputs[last]}' AS input,
                {last} AS pos, max(b{t}) AS coef,
                sum(y{t} ** 2) FILTER (WHERE tr) AS tr_with, sum(p{t} ** 2) FILTER (WHERE tr) AS tr_without,
                sum(y{t} ** 2) FILTER (WHERE NOT tr) AS te_with,
                sum(p{t} ** 2) FILTER (WHERE NOT tr) AS te_without FROM {source}""")
    totals = " UNION ALL ".join(
        f"""SELECT '{target}' AS target, avg(y{t}) FILTER (WHERE tr) AS ybar,
            var_pop(y{t}) FILTER (WHERE tr) * count(*) FILTER (WHERE tr) AS tr_sst,
            var_pop(y{t}) FILTER (WHERE NOT tr) * count(*) FILTER (WHERE NOT tr) AS te_sst FROM base"""
        for t, target in enumerate(targets))
    parts.append(f"fits AS ({' UNION ALL '.join(results)})")
    parts.append(f"totals AS ({totals})")
    return "WITH " + ",\n".join(parts)


_OLS = _elimination_sql(f"""SELECT {arithmetic_uniform_sql('l_orderkey')} < 0.5 AS tr,
        l_quantity AS x0, l_discount AS x1, l_tax AS x2, l_linenumber::DOUBLE AS x3,
        l_extendedprice AS y0, l_extendedprice * (1 - l_discount) AS y1,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y2 FROM lineitem""", INPUTS, TARGETS)
_MEANS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS input, avg(x{i}) FILTER (WHERE tr) AS xbar FROM base"
    for i, name in enumerate(INPUTS))

OLS_COEFFICIENTS_SQL = _OLS + f""",
means AS ({_MEANS_SQL})
SELECT target, input, round(coef, 3) AS coef FROM fits
UNION ALL
SELECT target, 'intercept', round(max(ybar) - sum(coef * xbar), 3)
FROM fits JOIN means USING (input) JOIN totals USING (target) GROUP BY target"""

OLS_SCORES_SQL = _OLS + """
SELECT target, round(1 - tr_with / tr_sst, 8) AS train_r2, round(1 - te_with / te_sst, 8) AS test_r2,
       (1 - te_with / te_sst) < 0.1 * (1 - tr_with / tr_sst) AS overfit
FROM fits JOIN totals USING (target) WHERE pos = 0"""

OLS_ABLATION_SQL = _OLS + """
SELECT target, input AS removed, round((tr_without - tr_with) / tr_sst, 8) + 0.0::DOUBLE AS train_decrease,
       round((te_without - te_with) / te_sst, 8) + 0.0::DOUBLE AS test_decrease
FROM fits JOIN totals USING (target)"""


ARRAYS = {"TAVG": 1, "TRANGE": 21, "SNWD": 41}
ARRAY_INPUTS, ARRAY_TARGETS = [f"place{k}" for k in range(1, 5)], [f"{a}_coeff{k}" for a in ARRAYS for k in range(1, 4)]


def array_targets_ablation(spark, sf):
    """Three numbers of each of three arrays as targets, four inputs, and what every input adds to every fit."""
    e = F.col("embedding")
    rows = table(spark, sf, "embeddings").select(
        "vec_id", *[F.slice(e, at, 3).alias(f"{a}_coeff") for a, at in ARRAYS.items()], F.slice(e, 61, 4).alias("place"))
    wide = rows
    for a in ARRAYS:
        wide = rg.number_columns(wide, [f"{a}_coeff"], 3)
    wide = sm.with_split(rg.number_columns(wide, ["place"], 4), arithmetic_uniform("vec_id"), 0.5)
    out = rg.ols_ablation(wide, ARRAY_INPUTS, ARRAY_TARGETS)
    return out.select("target", "removed", rounded("train_decrease", 8).alias("train_decrease"), rounded("test_decrease", 8).alias("test_decrease"))


ARRAY_TARGETS_ABLATION_SQL = _elimination_sql(
    f"SELECT {arithmetic_uniform_sql('vec_id')} < 0.5 AS tr, " + ", ".join(
        [f"embedding[{60 + k}]::DOUBLE AS x{k - 1}" for k in range(1, 5)]
        + [f"embedding[{at + k}]::DOUBLE AS y{3 * n + k}" for n, at in enumerate(ARRAYS.values()) for k in range(3)]) + " FROM embeddings",
    ARRAY_INPUTS, ARRAY_TARGETS) + """
SELECT target, input AS removed, round((tr_without - tr_with) / tr_sst, 8) + 0.0::DOUBLE AS train_decrease,
       round((te_without - te_with) / te_sst, 8) + 0.0::DOUBLE AS test_decrease
FROM fits JOIN totals USING (target)"""


def array_to_columns(spark, sf):
    return rg.number_columns(table(spark, sf, "embeddings"), ["embedding"], D, drop=["label"])


ARRAY_TO_COLUMNS_SQL = "SELECT vec_id, " + ", ".join(f"embedding[{k}]::DOUBLE AS embedding{k}" for k in range(1, D + 1)) + " FROM embeddings"

QUERIES = {
    "panel_daily_stats": (panel_daily_stats, PANEL_DAILY_STATS_SQL),
    "panel_of_kinds": (panel_of_kinds, PANEL_OF_KINDS_SQL),
    "scalar_summary": (scalar_summary, SCALAR_SUMMARY_SQL),
    "clipped_readings": (clipped_readings, CLIPPED_READINGS_SQL),
    "clipped_histogram": (clipped_histogram, CLIPPED_HISTOGRAM_SQL),
    "covariance_invariants": (covariance_invariants, COVARIANCE_INVARIANTS_SQL),
    "covariance_entries": (covariance_entries, COVARIANCE_ENTRIES_SQL),
    "eigen_rebuild": (eigen_rebuild, EIGEN_REBUILD_SQL),
    "residual_trace": (residual_trace, RESIDUAL_TRACE_SQL),
    "explained_variance": (explained_variance, EXPLAINED_VARIANCE_SQL),
    "daily_basis_series": (daily_basis_series, DAILY_BASIS_SERIES_SQL),
    "leading_basis_series": (leading_basis_series, DAILY_BASIS_SERIES_SQL),
    "leading_shares": (leading_shares, LEADING_SHARES_SQL),
    "spectral_residuals": (spectral_residuals, SPECTRAL_RESIDUALS_SQL),
    "own_extremes": (own_extremes, OWN_EXTREMES_SQL),
    "own_profiles": (own_profiles, OWN_PROFILES_SQL),
    "reconstruct_residual": (reconstruct_residual, RECONSTRUCT_RESIDUAL_SQL),
    "residual_extremes": (residual_extremes, RESIDUAL_EXTREMES_SQL),
    "reconstruction_profiles": (reconstruction_profiles, RECONSTRUCTION_PROFILES_SQL),
    "ols_coefficients": (ols_coefficients, OLS_COEFFICIENTS_SQL),
    "ols_scores": (ols_scores, OLS_SCORES_SQL),
    "ols_ablation": (ols_ablation, OLS_ABLATION_SQL),
    "array_targets_ablation": (array_targets_ablation, ARRAY_TARGETS_ABLATION_SQL),
    "array_to_columns": (array_to_columns, ARRAY_TO_COLUMNS_SQL),
}
