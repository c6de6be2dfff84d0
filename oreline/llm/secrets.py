"""Secret scan over an incremental ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its content.  A ledger
holds the (blob, rule version) pairs already scanned with their findings, so a
run scans only pairs the ledger lacks; findings are then joined back to every
path that ever held the blob.  All work is built-in functions: a rule's places
are found by splitting the text at the rule's matches and adding up the lengths
of pieces and matches.

Defined results: a null text is the empty text, which holds no secret; rows
with the same text share one blob, and each still gets its own result row (null
ids included); an empty table gives an empty result.  Only the named columns
are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates, leftmost and not overlapping; ``keep`` must hold for a finding."""

    kind: str
    version: int
    pattern: str
    keep: str | None = None
    base: bool = True


#: The three base kinds, in their order; then the kinds this scan adds.
_NAMED = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = [
    Rule("assign", 1, rf"(?i){_NAMED}([A-Za-z0-9+/_.=-]+)", rf"(?i)^{_NAMED}[A-Za-z0-9+/_.=-]{{6,}}$"),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 2, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,20}-----END [A-Z ]{0,30}PRIVATE KEY-----)?", base=False),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
]

#: A whole private key: to its END line, or else to the end of its headers and base64 lines.  Line ends may be
#: escaped; every loop is possessive, so long keys need no deep stack.
_NL = r"[\x20\t]*+(?:\r\n?|\n|(?:\\r)?\\n)[\x20\t]*+"
_KEY = (r"-----BEGIN ([A-Z ]{0,30})PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END \1PRIVATE KEY-----|"
        rf"(?:(?:{_NL}[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)++(?:{_NL}(?={_NL}))?+)?+"
        rf"(?:(?:{_NL}|[\x20\t]++)[A-Za-z0-9+/]{{24,}}+={{0,2}}|{_NL}[A-Za-z0-9+/]++={{0,2}}(?={_NL}|[\x20\t]*+\z))*+)")
#: What redaction masks: of a key without its END line also the lines that follow, which RULES, made for the SQL, too, cannot tell.
MASKED = [Rule("pem", 3, _KEY, base=False) if r.kind == "pem" else r for r in RULES]
SPAN = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, kind string, version int, spans {SPAN}"


def _places(text: Column, rule: Rule) -> Column:
    """Start and end (exclusive, code points) of the findings of a rule in a text."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.transform(F.split(text, rule.pattern), lambda p: F.char_length(p))

    def walk(found: Column, lengths: Column) -> Column:
        step = lambda acc, m, i: F.struct(
            (acc["at"] + F.get(lengths, i) + F.char_length(m)).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.get(lengths, i)).alias("start"),
                (acc["at"] + F.get(lengths, i) + F.char_length(m)).alias("end"), m.alias("hit")))).alias("spans"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("spans"))
        numbered = F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i")))
        spans = F.aggregate(numbered, start, lambda acc, x: step(acc, x["m"], x["i"]), lambda acc: acc["spans"])
        if rule.keep:
            spans = F.filter(spans, lambda s: s["hit"].rlike(rule.keep))
        return F.transform(spans, lambda s: F.struct(s["start"], s["end"]))

    walked = F.element_at(F.transform(F.array(F.struct(hits.alias("h"), pieces.alias("p"))), lambda x: walk(x["h"], x["p"])), 1)
    return F.when(text.rlike(rule.pattern), walked).otherwise(F.array().cast(SPAN))


def versions_of(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, content): each row's content and its address."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(path).alias("path"), F.sha2(content, 256).alias("blob"), content.alias("content"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """Ledger rows (blob, kind, version, spans) for the pairs that ``ledger`` lacks.

    One row per unseen pair, also without findings, so that the next run skips it.
    """
    blobs = versions.groupBy("blob").agg(F.first("content").alias("content"))
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
        blobs = (blobs.join(seen.hint("merge"), "blob", "left")  # Spark takes a collected set for one value, and would broadcast it
                 .withColumn("todo", F.array_except(table, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>"))))
                 .where(F.size("todo") > 0))
    else:
        blobs = blobs.withColumn("todo", table)
    wanted = lambda r: F.array_contains("todo", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")))
    found = blobs.select("blob", F.array_compact(F.array(*[
        F.when(wanted(r), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _places(F.col("content"), r).alias("spans")))
        for r in rules])).alias("pairs"))
    return found.select("blob", F.inline("pairs"))


def extended(versions: DataFrame, path: str, rules: list[Rule] = RULES) -> DataFrame:
    """The whole ledger in the folder ``path``, after a scan of the pairs it lacked; a missing folder is an empty ledger."""
    spark = versions.sparkSession
    try:
        old = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    scan(versions, old, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def update(versions: DataFrame, path: str, rules: list[Rule] = RULES) -> DataFrame:
    """:func:`findings` of the versions, earlier ones included, after the ledger in ``path`` is extended."""
    return findings(versions, extended(versions, path, rules), rules)


def ledger_path(spark: SparkSession) -> str:
    """The folder of the ledger: ``spark.oreline.ledger``, kept between runs, or else a fresh one."""
    return spark.conf.get("spark.oreline.ledger", None) or scratch_path(spark, "ledger")


def findings(versions: DataFrame, ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(path, blob, spans): for every version all spans (kind, start, end) in order of start, then kind as listed.

    Only blobs with a finding meet the versions in the join; the other versions
    get the empty list.  A pair that overlapping runs appended twice counts once.
    """
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind} {r.version}"), F.lit(i))])
    place = F.element_at(rank, F.concat_ws(" ", "kind", "version"))
    hits = (ledger.where(F.size("spans") > 0).withColumn("rank", place).where(F.col("rank").isNotNull())
            .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_set(F.transform(
                "spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind")))))).alias("spans")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return (versions.select("path", "blob").join(hits, "blob", "left")
            .select("path", "blob", F.coalesce("spans", none).alias("spans")))


def digest(found: DataFrame, id_: str = "doc_id", rules: list[Rule] = RULES) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in rules if r.base]))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(r.kind)).cast("long").alias(f"n_{r.kind}") for r in rules if r.base]
    return found.select(F.col("path").alias(id_), *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_: str = "doc_id", text: str = "text", mask: str = "<SECRET>", rules: list[Rule] = MASKED) -> DataFrame:
    """``docs`` with every finding of ``scan`` by ``rules`` replaced by ``mask``; overlapping findings are one.

    The findings come from the ledger (:func:`ledger_path`) by content, so equal texts are cut alike.
    """
    versions = versions_of(docs, id_, text)
    hits = (findings(versions.dropDuplicates(["blob"]).hint("merge"), extended(versions, ledger_path(docs.sparkSession), rules), rules).where(F.size("spans") > 0)
            .select(F.col("blob").alias("_op2_blob"), F.col("spans").alias("_op2_spans")))
    whole = F.col(text)

    def cut(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.char_length(whole))))

    joined = docs.withColumn("_op2_blob", F.sha2(F.coalesce(whole, F.lit("")), 256)).join(hits, "_op2_blob", "left")
    new = F.when(F.col("_op2_spans").isNull(), whole).otherwise(cut(F.col("_op2_spans")))
    return joined.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def digest_sql(rules: list[Rule] = RULES) -> str:
    """The result of :func:`digest` over ``documents`` in DuckDB."""
    parts = []
    for i, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        keep = f"WHERE regexp_matches(hit, '{r.keep.replace(chr(39), chr(39) * 2)}')" if r.keep else ""
        parts.append(f"""
  SELECT r, {i} AS rank, '{r.kind}' AS kind, s AS s, s + length(hit) AS e FROM (
    SELECT r, hits[i] AS hit,
           (list_sum(list_transform(list_slice(pieces, 1, i), lambda p: length(p)))
            + coalesce(list_sum(list_transform(list_slice(hits, 1, i - 1), lambda h: length(h))), 0))::BIGINT AS s
    FROM (SELECT r, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS pieces
      FROM t WHERE regexp_matches(text, '{pattern}')))) {keep}""")
    base = ", ".join(f"'{r.kind}'" for r in rules if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules if r.base)
    written = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank){}, '')"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(parts)})
SELECT any_value(doc_id) AS doc_id, {counts},
       sha256({written.format(f" FILTER (kind IN ({base}))")}) AS base_sha256, {written.format("")} AS spans
FROM t LEFT JOIN f USING (r) GROUP BY r"""
