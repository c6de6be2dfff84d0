"""The registered queries of the package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import (deep_shallow, filter_audit, hamming, hyperplane, jump_shards, line_runs, merge_path, ordinal, packing, piece_viterbi, quality_rules,
                         secrets, surrogates)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: pairs the ledger lacks are scanned, its findings joined back to all paths."""
    versions = secrets.versions_of(_table(spark, sf_dir, "documents"))
    return secrets.digest(secrets.update(versions, secrets.ledger_path(spark)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op10_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = ordinal.train(docs, ordinal.graded(_table(spark, sf_dir, "labels")))
    return ordinal.score(docs, model).select(
        "doc_id", "expected_grade", F.get("at_least", 0).alias("p_not_toxic"),
        F.get("at_least", 1).alias("p_good"), ordinal.accepted().alias("kept"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("byte_bpe_50k.tiktoken"))


def op8_hyperplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    return hyperplane.near_duplicates(_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (
  SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM v
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.98),
r AS (
  SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS least FROM r GROUP BY node),
d AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(c.least, vec_id) AS component_id,
       coalesce(c.least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.node = vec_id LEFT JOIN d ON d.a = vec_id"""


def op9_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by their 5-word shingles."""
    return hamming.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document when later copies of repeated line runs are deleted."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_runs.dedup(docs.withColumn("n_lines", F.size(F.split("text", "\n")).cast("long")), alone_words=line_runs.ALONE_WORDS)
    return cut.select("doc_id", "n_lines", F.col("_op7_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op5_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur elsewhere."""
    cut = deep_shallow.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    docs, model = _table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    return piece_viterbi.checked(docs, model).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", "ids", "exact")


#: The key of the surrogates; a deployment passes its own secret.
SURROGATE_KEY = b"oreline surrogates"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs, SURROGATE_KEY).withColumnRenamed("_op1_replaced", "n_replaced")


def op11_merge_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers line up in every document."""
    return merge_path.alignment(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.tiktoken"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, by language, in every order."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, its number there, and its shard were there one more."""
    return jump_shards.shard(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op11_merge_path": (op11_merge_path, None),
    "op12_filter_audit": (op12_filter_audit, filter_audit.AUDIT_SQL),
    "op13_jump_shards": (op13_jump_shards, jump_shards.shard_sql()),
    "op1_surrogates": (op1_surrogates, None),
    "op6_piece_viterbi": (op6_piece_viterbi, None),
    "op5_deep_shallow": (op5_deep_shallow, None),
    "op7_line_runs": (op7_line_runs, line_runs.DIGEST_SQL),
    "op9_hamming_join": (op9_hamming_join, None),
    "op8_hyperplane": (op8_hyperplane, OP8_SQL),
    "op3_cutting_stock": (op3_cutting_stock, None),
    "op10_ordinal": (op10_ordinal, None),
    "op2_blob_ledger": (op2_blob_ledger, secrets.digest_sql()),
    "op4_quality_rules": (op4_quality_rules, quality_rules.judge_sql()),
}
