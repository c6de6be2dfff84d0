"""Queries over text: n-grams, posts, tokens, popularity per group."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.functions.text import SEPARATORS, normalise
from oreline.functions.tokens import (NAMED_PIECES, NUMERIC_PIECES, TOKEN, URL, decode_html,
                                      explode_tokens, named_entities)
from oreline.operators import popularity as pop
from oreline.operators.ngrams import order_totals, sentence_rows, top_ngrams
from oreline.plans.tables import quoted, rounded, table
from oreline.session import scratch_path
from oreline.sources import readers, sinks

# --- n-grams --------------------------------------------------------------------

_WORDS_SQL = f"""
WITH s AS (SELECT unnest(string_split(text, '. ')) AS sentence FROM documents),
w AS (SELECT list_filter(regexp_split_to_array(lower(sentence), {quoted(SEPARATORS)}),
                         lambda x: x <> '') AS w FROM s)"""

_NGRAMS_SQL = _WORDS_SQL + """,
g AS (SELECT n, unnest(list_transform(range(1, CAST(len(w) - n + 2 AS BIGINT)),
                 lambda i: array_to_string(w[i:i + n - 1], ' '))) AS ngram
      FROM w, (VALUES (1), (2), (3), (4), (5)) AS t(n)),
c AS (SELECT n, ngram, count(*) AS cnt FROM g GROUP BY n, ngram)"""


def ngram_top5(spark, sf):
    return top_ngrams(table(spark, sf, "documents")).select("n", "rank", "ngram", "cnt")


NGRAM_TOP5_SQL = _NGRAMS_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY cnt DESC, ngram) AS rank FROM c)
SELECT CAST(n AS INTEGER) AS n, CAST(rank AS INTEGER) AS rank, ngram, cnt FROM r WHERE rank <= 5"""


def ngram_order_totals(spark, sf):
    """Occurrences and different n-grams per order, over every n-gram."""
    return order_totals(table(spark, sf, "documents"))


NGRAM_ORDER_TOTALS_SQL = _NGRAMS_SQL + """
SELECT CAST(n AS INTEGER) AS n, CAST(sum(cnt) AS BIGINT) AS occurrences,
       count(*) AS different, max(cnt) AS top_count FROM c GROUP BY n"""


def normalised_sentences(spark, sf):
    return (sentence_rows(table(spark, sf, "documents"))
            .select(normalise(F.col("sentence")).alias("s"))
            .groupBy("s").agg(F.count(F.lit(1)).alias("cnt")))


NORMALISED_SENTENCES_SQL = f"""
WITH s AS (SELECT unnest(string_split(text, '. ')) AS sentence FROM documents)
SELECT lower(regexp_replace(sentence, {quoted(SEPARATORS[:-1])}, ' ', 'g')) AS s,
       count(*) AS cnt FROM s GROUP BY 1"""


# --- scans ------------------------------------------------------------------------

def paragraph_scan(spark, sf):
    """Documents written as paragraph records and read back."""
    path = scratch_path(spark, "paragraphs")
    sinks.write_lines(table(spark, sf, "documents").select("text"), path, readers.PARAGRAPH)
    return (readers.read_paragraphs(spark, path)
            .groupBy(F.md5("value").alias("digest"))
            .agg(F.count(F.lit(1)).alias("cnt")))


PARAGRAPH_SCAN_SQL = "SELECT md5(text) AS digest, count(*) AS cnt FROM documents GROUP BY 1"


def manifest_scan(spark, sf):
    """Two line files named by a manifest with trailing blanks."""
    names, urls, manifest = (scratch_path(spark, n) for n in ("names", "urls", "manifest"))
    sinks.write_lines(table(spark, sf, "customer").select("c_name"), names)
    sinks.write_lines(table(spark, sf, "pages").select("url"), urls)
    listed = spark.createDataFrame([(f"{names}  ",), (f"{urls}\t",), ("",)], "value string")
    sinks.write_lines(listed, manifest)
    lines = readers.read_manifest(spark, manifest)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("cnt"))


MANIFEST_SCAN_SQL = """
SELECT line, count(*) AS cnt
FROM (SELECT c_name AS line FROM customer UNION ALL SELECT url FROM pages) GROUP BY line"""


def posts_from_json(spark, sf):
    """Turns as JSON lines: user turns are posts, the other roles spoil the line."""
    turns = table(spark, sf, "conversations")
    post = F.to_json(F.struct("text", F.struct(F.col("conv_id").cast("string").alias("id_str"))
                              .alias("user")))
    notice = F.to_json(F.struct(F.struct(F.col("turn").alias("track")).alias("limit")))
    line = (F.when(F.col("role") == "user", post)
            .when(F.col("role") == "assistant", F.expr("substr(post, 1, length(post) - 1)"))
            .otherwise(notice))
    lines = turns.withColumn("post", post).select(line.alias("value"))
    return (readers.parse_posts(lines).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("posts"), F.sum(F.length("text")).alias("chars")))


POSTS_FROM_JSON_SQL = """
SELECT CAST(conv_id AS VARCHAR) AS user_id, count(*) AS posts,
       CAST(sum(length(text)) AS BIGINT) AS chars
FROM conversations WHERE role = 'user' GROUP BY 1"""


def post_files_popularity(spark, sf):
    """The whole post job: manifest of JSON-lines files to ranked tokens per group.

    Each role is a file; assistant turns are cut short and do not parse.
    """
    turns = table(spark, sf, "conversations")
    post = F.to_json(F.struct("text", F.struct(F.col("conv_id").cast("string").alias("id_str"))
                              .alias("user")))
    paths = {role: scratch_path(spark, "posts") for role in ("user", "assistant", "system")}
    for role, path in paths.items():
        line = post if role != "assistant" else F.expr("substr(post, 1, length(post) - 1)")
        sinks.write_lines(turns.where(F.col("role") == role).withColumn("post", post)
                          .select(line.alias("value")), path)
    manifest = scratch_path(spark, "manifest")
    sinks.write_lines(spark.createDataFrame([(p,) for p in paths.values()], "value string"), manifest)
    mapping = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("user_id"), F.col("quality").alias("group_id"))
    posts = readers.read_posts(spark, manifest)
    return _popularity(explode_tokens(posts), mapping, 5)


def json_field_counts(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = table(spark, sf, "events").select(
        readers.json_object(F.col("props"), schema)["k"].alias("k"))
    return (parsed.where("k is not null").groupBy("k")
            .agg(F.count(F.lit(1)).alias("cnt")))


JSON_FIELD_COUNTS_SQL = """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS cnt
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1"""


# --- posts per group ----------------------------------------------------------------

def unique_users(spark, sf):
    return pop.unique_users(table(spark, sf, "events"))


UNIQUE_USERS_SQL = "SELECT count(*) AS posts, count(DISTINCT user_id) AS users FROM events"


def posts_per_group(spark, sf):
    """Events of users grouped by a table that covers a part of them."""
    groups = readers.read_lookup(spark, f"{sf}/supplier.parquet", "s_suppkey", "s_nationkey")
    mapping = groups.select(F.col("s_suppkey").alias("user_id"),
                            F.expr("s_nationkey % 7").alias("group_id"))
    return pop.posts_per_group(table(spark, sf, "events"), mapping)


POSTS_PER_GROUP_SQL = """
SELECT coalesce(s_nationkey % 7, 7) AS group_id, CAST(count(*) AS BIGINT) AS cnt
FROM events LEFT JOIN supplier ON user_id = s_suppkey GROUP BY 1"""


# --- tokens -------------------------------------------------------------------------

def _tokens_sql(source: str, key: str, where: str = "text") -> str:
    return f"""
raw AS (SELECT {key} AS user_id, unnest(regexp_extract_all({where}, {quoted(TOKEN)}, 1)) AS t
        FROM {source}),
tok AS (SELECT user_id, CASE WHEN contains(t, '://') AND regexp_matches(t, {quoted(URL)})
                             THEN t ELSE lower(t) END AS token FROM raw)"""


def _document_posts(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("user_id"), "text")


def _turn_posts(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("user_id"), "text")


def tokenizer_counts(spark, sf):
    texts = (table(spark, sf, "documents").select("text")
             .unionAll(table(spark, sf, "pages").select(F.col("html").alias("text"))))
    return explode_tokens(texts).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


TOKENIZER_COUNTS_SQL = f"""
WITH src AS (SELECT 0 AS id, text FROM documents UNION ALL SELECT 1, html FROM pages),
{_tokens_sql('src', 'id')}
SELECT token, count(*) AS cnt FROM tok GROUP BY token"""


def distinct_tokens(spark, sf):
    return pop.distinct_tokens(explode_tokens(_document_posts(spark, sf)))


DISTINCT_TOKENS_SQL = f"""
WITH {_tokens_sql('documents', 'doc_id')}
SELECT count(DISTINCT token) AS tokens FROM tok"""


def entity_decode_counts(spark, sf):
    """Decoded text of every page, as a digest."""
    decoded = table(spark, sf, "pages").select("page_id", decode_html(F.col("html")).alias("d"))
    return decoded.select("page_id", F.length("d").cast("bigint").alias("chars"),
                          F.md5("d").alias("digest"))


_ENTITY_MAP = "MAP {" + ", ".join(
    f"{quoted(k)}: {quoted(v)}" for k, v in named_entities().items()) + "}"

ENTITY_DECODE_COUNTS_SQL = f"""
WITH a AS (SELECT page_id, array_to_string(list_transform(
        regexp_extract_all(html, {quoted(NUMERIC_PIECES)}, 1),
        lambda p: CASE WHEN starts_with(p, '&#')
                       THEN chr(CAST(regexp_extract(p, '[0-9]+') AS INTEGER)) ELSE p END), '') AS h
    FROM pages),
b AS (SELECT page_id, unnest(regexp_extract_all(h, {quoted(NAMED_PIECES)}, 1)) AS p,
             generate_subscripts(regexp_extract_all(h, {quoted(NAMED_PIECES)}, 1), 1) AS i FROM a),
names AS (SELECT unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v
          FROM (SELECT {_ENTITY_MAP} AS m)),
c AS (SELECT page_id, replace(string_agg(coalesce(v, p), '' ORDER BY i), '&amp;', ' and ') AS d
      FROM b LEFT JOIN names ON p = k GROUP BY page_id)
SELECT page_id, length(d) AS chars, md5(d) AS digest FROM c"""


def token_mentions_top20(spark, sf):
    """Tokens by the number of conversations (users with many posts) that use them."""
    return (pop.top_tokens(explode_tokens(_turn_posts(spark, sf)), min_users=10)
            .select("token", "cnt"))


TOKEN_MENTIONS_TOP20_SQL = f"""
WITH {_tokens_sql('conversations', 'conv_id')},
m AS (SELECT token, count(DISTINCT user_id) AS cnt FROM tok GROUP BY token)
SELECT token, cnt FROM m WHERE cnt >= 10 ORDER BY cnt DESC, token LIMIT 20"""


def frequent_tokens(spark, sf):
    """All tokens that at least 100 documents use."""
    return pop.token_mentions(explode_tokens(_document_posts(spark, sf)))


FREQUENT_TOKENS_SQL = f"""
WITH {_tokens_sql('documents', 'doc_id')}
SELECT token, count(DISTINCT user_id) AS cnt FROM tok GROUP BY token
HAVING count(DISTINCT user_id) >= 100"""


def _popularity_sql(source: str, key: str, group: str, min_users: int) -> str:
    return f"""
WITH {_tokens_sql(source, key)},
pairs AS (SELECT DISTINCT user_id, token FROM tok),
g AS (SELECT coalesce({group}, 7) AS group_id, token, count(*) AS cnt
      FROM pairs LEFT JOIN labels ON user_id = doc_id GROUP BY 1, 2),
a AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY token) AS BIGINT) AS total FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY group_id
                                   ORDER BY cnt::DOUBLE / total DESC, token) AS rank
      FROM a WHERE total >= {min_users})
SELECT group_id, CAST(rank AS INTEGER) AS rank, token, cnt, total,
       round(log2(cnt::DOUBLE / total), 6) AS score
FROM r WHERE rank <= 10"""


def _popularity(tokens, mapping, min_users):
    out = pop.relative_popularity(tokens, mapping, min_users=min_users)
    return out.select("group_id", "rank", "token", "cnt", "total",
                      rounded("score").alias("score"))


def relative_popularity_top10(spark, sf):
    """Documents as users, grouped by quality; unlabelled ones are the default group."""
    mapping = table(spark, sf, "labels").select(
        F.col("doc_id").alias("user_id"), F.col("quality").alias("group_id"))
    return _popularity(explode_tokens(_document_posts(spark, sf)), mapping, 100)


RELATIVE_POPULARITY_TOP10_SQL = _popularity_sql("documents", "doc_id", "quality", 100)


def conversation_popularity_top10(spark, sf):
    """Conversations as users with many posts, four groups and the default one."""
    mapping = table(spark, sf, "labels").select(
        F.col("doc_id").alias("user_id"), F.expr("quality * 2 + toxic").alias("group_id"))
    return _popularity(explode_tokens(_turn_posts(spark, sf)), mapping, 10)


CONVERSATION_POPULARITY_TOP10_SQL = _popularity_sql(
    "conversations", "conv_id", "quality * 2 + toxic", 10)

POST_FILES_POPULARITY_SQL = _popularity_sql(
    "(SELECT * FROM conversations WHERE role <> 'assistant')", "conv_id", "quality", 5)

QUERIES = {
    "ngram_top5": (ngram_top5, NGRAM_TOP5_SQL),
    "ngram_order_totals": (ngram_order_totals, NGRAM_ORDER_TOTALS_SQL),
    "normalised_sentences": (normalised_sentences, NORMALISED_SENTENCES_SQL),
    "paragraph_scan": (paragraph_scan, PARAGRAPH_SCAN_SQL),
    "manifest_scan": (manifest_scan, MANIFEST_SCAN_SQL),
    "posts_from_json": (posts_from_json, POSTS_FROM_JSON_SQL),
    "post_files_popularity": (post_files_popularity, POST_FILES_POPULARITY_SQL),
    "json_field_counts": (json_field_counts, JSON_FIELD_COUNTS_SQL),
    "unique_users": (unique_users, UNIQUE_USERS_SQL),
    "posts_per_group": (posts_per_group, POSTS_PER_GROUP_SQL),
    "tokenizer_counts": (tokenizer_counts, TOKENIZER_COUNTS_SQL),
    "distinct_tokens": (distinct_tokens, DISTINCT_TOKENS_SQL),
    "entity_decode_counts": (entity_decode_counts, ENTITY_DECODE_COUNTS_SQL),
    "token_mentions_top20": (token_mentions_top20, TOKEN_MENTIONS_TOP20_SQL),
    "frequent_tokens": (frequent_tokens, FREQUENT_TOKENS_SQL),
    "relative_popularity_top10": (relative_popularity_top10, RELATIVE_POPULARITY_TOP10_SQL),
    "conversation_popularity_top10": (conversation_popularity_top10,
                                      CONVERSATION_POPULARITY_TOP10_SQL),
}
