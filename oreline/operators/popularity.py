"""Posts per user group and relative popularity of tokens per group.

Mentions count users, not posts: a user adds at most one to a token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.tokens import explode_tokens
from oreline.operators.lookup import enrich, one_row_per_key
from oreline.operators.topk import top_overall, top_per_group

DEFAULT_GROUP = 7      # users outside the partition
MIN_USERS = 100        # a token needs this many users
# Up to so many groups a token's counts are one row of the aggregation.
FEW_GROUPS = 64


def unique_users(posts: DataFrame, user: str = "user_id") -> DataFrame:
    """Row count and number of different users."""
    return posts.agg(F.count(F.lit(1)).alias("posts"),
                     F.countDistinct(user).alias("users"))


def posts_per_group(posts: DataFrame, mapping: DataFrame, user: str = "user_id",
                    group: str = "group_id", default: int = DEFAULT_GROUP) -> DataFrame:
    """Posts of each group, users without a group counted under ``default``.

    Posts are counted per user first, so the lookup joins one row per user and
    no user can be a hot key.
    """
    per_user = posts.groupBy(user).agg(F.count(F.lit(1)).alias("cnt"))
    grouped = enrich(per_user, one_row_per_key(mapping, user, group), [user], "left")
    return (grouped.groupBy(F.coalesce(F.col(group), F.lit(default)).alias(group))
            .agg(F.sum("cnt").alias("cnt")).orderBy(group))


def user_tokens(tokens: DataFrame, user: str = "user_id", token: str = "token") -> DataFrame:
    """Distinct ``(user, token)`` pairs, deduplicated map-side before the shuffle."""
    return tokens.select(user, token).distinct()


def distinct_tokens(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Number of different tokens."""
    return tokens.agg(F.countDistinct(token).alias("tokens"))


def token_mentions(tokens: DataFrame, user: str = "user_id", token: str = "token",
                   min_users: int = MIN_USERS) -> DataFrame:
    """Users per token, for tokens with at least ``min_users`` of them."""
    return (user_tokens(tokens, user, token)
            .groupBy(token).agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") >= min_users))


def top_tokens(tokens: DataFrame, user: str = "user_id", token: str = "token",
               min_users: int = MIN_USERS, k: int = 20) -> DataFrame:
    """The ``k`` tokens mentioned by most users, ties by token."""
    return top_overall(token_mentions(tokens, user, token, min_users),
                       [F.desc("cnt"), F.asc(token)], k)


def group_scores(tokens: DataFrame, mapping: DataFrame, user: str = "user_id",
                 token: str = "token", group: str = "group_id",
                 min_users: int = MIN_USERS, default: int = DEFAULT_GROUP) -> DataFrame:
    """``(group, token, cnt, total, score)`` with score = log2(cnt / total).

    A token's total is the sum of its group counts.  With up to ``FEW_GROUPS``
    groups a token's counts are one small row from the start, added up in every
    task and shuffled once by token; with more, pairs are counted first.  Tokens
    with too few users leave before anything is expanded.
    """
    pairs = user_tokens(tokens, user, token)
    lookup = one_row_per_key(mapping, user, group)
    owner = F.coalesce(F.col(group), F.lit(default))
    grouped = (enrich(pairs, lookup, [user], "left", spread=[F.col(token)])
               .select(token, owner.alias(group)))
    names = {r[0] for r in lookup.select(group).distinct().limit(FEW_GROUPS + 1).collect()} - {None} | {default}
    enough = F.col("total") >= min_users
    if len(names) <= FEW_GROUPS:
        kind = grouped.schema[group].dataType
        cells = [F.count(F.when(F.col(group) == F.lit(g), 1)) for g in sorted(names)]
        row = F.array(*[F.struct(F.lit(g).cast(kind).alias(group), c.alias("cnt")) for g, c in zip(sorted(names), cells)])
        whole = grouped.groupBy(token).agg(F.count(F.lit(1)).alias("total"), row.alias("_g")).where(enough)
    else:
        counts = grouped.groupBy(group, token).agg(F.count(F.lit(1)).alias("cnt"))
        whole = (counts.groupBy(token)
                 .agg(F.sum("cnt").alias("total"), F.collect_list(F.struct(group, "cnt")).alias("_g")).where(enough))
    return (whole.select(token, "total", F.inline("_g")).where("cnt > 0").select(group, token, "cnt", "total")
            .withColumn("score", F.log2(F.col("cnt") / F.col("total"))))


def relative_popularity(tokens: DataFrame, mapping: DataFrame, user: str = "user_id",
                        token: str = "token", group: str = "group_id",
                        min_users: int = MIN_USERS, default: int = DEFAULT_GROUP,
                        k: int = 10) -> DataFrame:
    """The ``k`` relatively most popular tokens of each group, ties by token."""
    scores = group_scores(tokens, mapping, user, token, group, min_users, default)
    return top_per_group(scores, [group], [F.desc("score"), F.asc(token)], k)


def popular_tokens_of_posts(posts: DataFrame, mapping: DataFrame, min_users: int = MIN_USERS,
                            k: int = 10, keep_case: str = "url",
                            decode_entities: bool = False) -> DataFrame:
    """Posts ``(user_id, text)`` to ranked tokens per group, tokeniser included."""
    tokens = explode_tokens(posts.select("user_id", "text"), keep_case=keep_case,
                            decode_entities=decode_entities)
    return relative_popularity(tokens, mapping, min_users=min_users, k=k)
