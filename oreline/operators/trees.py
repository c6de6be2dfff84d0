"""Tree ensembles as a relational node table: (tree, weight, node, feature, threshold, left, right, value).

The table is read from the files of a saved model.  ``value`` is a regression
tree's prediction or a classification tree's share of class 1; ``weight`` is the
tree's weight in the ensemble (one over the number of trees for a forest), so a
row's raw score is the sum of weight times value over the leaves it reaches.
Leaves have no feature, threshold or children.  Any SQL engine can score it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators.lookup import enrich, fits_broadcast
from oreline.session import cut_lineage

ROOT = 0


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The node table of an ensemble written by ``classify.save_model``."""
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "_w")
    votes = F.get_json_object("metadata", "$.class").endswith("ClassificationModel")
    weights = trees.select("tree", F.when(votes, F.lit(1.0) / trees.count()).otherwise(F.col("_w")).alias("weight"), votes.alias("_votes"))
    stats = F.col("n.impurityStats")
    share = F.coalesce(F.get(stats, 1), F.lit(0.0)) / F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)
    inner = lambda c: F.when(F.col("n.leftChild") >= 0, c)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
    return nodes.join(F.broadcast(weights), "tree").select(     # one row per tree
        "tree", "weight", F.col("n.id").alias("node"), inner(F.col("n.split.featureIndex")).alias("feature"),
        inner(F.get("n.split.leftCategoriesOrThreshold", 0)).alias("threshold"), inner(F.col("n.leftChild")).alias("left"),
        inner(F.col("n.rightChild")).alias("right"), F.when(F.col("_votes"), share).otherwise(F.col("n.prediction")).alias("value"))


def with_paths(nodes: DataFrame, depth: int) -> DataFrame:
    """``nodes`` with the ``path`` from the root: one letter, L or R, per step."""
    nodes = cut_lineage(nodes)
    level = nodes.where(F.col("node") == ROOT).withColumn("path", F.lit(""))
    out = level
    for _ in range(depth):
        steps = level.where("left is not null").select(
            "tree", F.explode(F.array(F.struct(F.col("left").alias("node"), F.concat("path", F.lit("L")).alias("path")),
                                      F.struct(F.col("right").alias("node"), F.concat("path", F.lit("R")).alias("path")))).alias("s"))
        level = nodes.join(steps.select("tree", "s.node", "s.path"), ["tree", "node"]).select(*out.columns)
        out = out.unionByName(level)
    return out


def score(rows: DataFrame, nodes: DataFrame, depth: int, key: list[str], features: str = "features") -> DataFrame:
    """``(*key, raw)``: every row walks down all trees, one join per level; ``features`` is an array.

    A node table of a measured, small size is broadcast, so the walk shuffles
    nothing; a larger one is joined with the crowded nodes salted.
    """
    nodes = cut_lineage(nodes)
    small = fits_broadcast(nodes)

    def meet(state: DataFrame, columns: list[str]) -> DataFrame:
        lookup = nodes.select("tree", "node", *columns)
        if small:
            return state.join(F.broadcast(lookup), ["tree", "node"])
        return enrich(state, lookup, ["tree", "node"], spread=[F.col("_row")])

    trees = nodes.agg(F.max("tree")).first()[0]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())       # rows may be equal
    state = numbered.select("_row", *key, F.col(features).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree")).withColumn("node", F.lit(ROOT))
    for _ in range(depth):
        here = meet(state, ["feature", "threshold", "left", "right"])
        below = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        state = here.select("_row", *key, "_x", "tree", F.when(F.col("left").isNull(), F.col("node")).otherwise(below).alias("node"))
    return meet(state, ["weight", "value"]).groupBy("_row", *key).agg(F.sum(F.col("weight") * F.col("value")).alias("raw")).drop("_row")


def predicted(algo: str, raw: Column | str = "raw") -> Column:
    """The class of a raw score: boosting sums margins, a forest averages shares."""
    return (F.col(raw) if isinstance(raw, str) else raw).__gt__(0.0 if algo == "gbt" else 0.5).cast("double")


def score_sql(nodes: str, rows: str, key: str) -> str:
    """The same walk as recursive SQL over a table of nodes and a table of rows with a list column ``features``."""
    return f"""
WITH RECURSIVE walk AS (
  SELECT {key}, features, tree, {ROOT} AS node FROM {rows}, (SELECT DISTINCT tree FROM {nodes}) t
  UNION ALL
  SELECT {key}, features, w.tree, CASE WHEN features[feature + 1] <= threshold THEN "left" ELSE "right" END
  FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.node = w.node WHERE "left" IS NOT NULL)
SELECT {key}, sum(weight * value) AS raw FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.node = w.node
WHERE "left" IS NULL GROUP BY ALL"""
