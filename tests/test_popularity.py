import math
import random
from collections import defaultdict

import pytest

from oreline.operators import popularity as pop
from oreline.operators.lookup import enrich, one_row_per_key


def fixture_rows():
    """User 0 writes a third of all rows; users above 60 have no group."""
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    rows = [(0, rnd.choice(words)) for _ in range(1500)]
    for _ in range(3000):
        rows.append((rnd.randrange(1, 90), words[int(rnd.random() ** 2 * 40)]))
    return rows, {u: u % 3 for u in range(61)}


def brute(rows, groups, min_users, k):
    users = defaultdict(lambda: defaultdict(set))
    for u, t in rows:
        users[t][groups.get(u, 7)].add(u)
    out = {}
    for g in sorted({groups.get(u, 7) for u, _ in rows}):
        scored = []
        for t, by_group in users.items():
            total = sum(len(s) for s in by_group.values())
            if total >= min_users and by_group.get(g):
                scored.append((-math.log(len(by_group[g]) / total) / math.log(2), t))
        out[g] = [t for _, t in sorted(scored)[:k]]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows, groups = fixture_rows()
    return (spark.createDataFrame(rows, "user_id bigint, token string"),
            spark.createDataFrame(list(groups.items()), "user_id bigint, group_id int"))


def ranked(df):
    out = defaultdict(list)
    for r in df.orderBy("group_id", "rank").collect():
        out[r["group_id"]].append(r["token"])
    return dict(out)


def test_matches_brute_force(data):
    rows, groups = fixture_rows()
    got = ranked(pop.relative_popularity(*data, min_users=20, k=5))
    assert got == brute(rows, groups, 20, 5)


def test_salted_join_gives_the_same(data, no_broadcast):
    rows, groups = fixture_rows()
    df = pop.relative_popularity(*data, min_users=20, k=5)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert ranked(df) == brute(rows, groups, 20, 5)


def test_salted_inner_and_left_join(spark, data, no_broadcast):
    from pyspark.sql import functions as F
    facts, mapping = data
    for how in ("inner", "left"):
        salted = enrich(facts, mapping, ["user_id"], how, spread=[F.col("token")])
        plain = facts.join(mapping, ["user_id"], how)
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_posts_per_group(data):
    rows, groups = fixture_rows()
    want = defaultdict(int)
    for u, _ in rows:
        want[groups.get(u, 7)] += 1
    got = pop.posts_per_group(*data)
    assert {r.group_id: r.cnt for r in got.collect()} == dict(want)
    assert [r.group_id for r in got.collect()] == sorted(want)


def test_a_user_counts_once(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (2, "b"), (3, "c")]
    df = spark.createDataFrame(rows, "user_id int, token string")
    got = {r.token: r.cnt for r in pop.token_mentions(df, min_users=1).collect()}
    assert got == {"a": 2, "b": 1, "c": 1}
    assert [r.token for r in pop.top_tokens(df, min_users=1, k=2).collect()] == ["a", "b"]
    assert pop.distinct_tokens(df).first()[0] == 3
    assert tuple(pop.unique_users(df).first()) == (6, 3)


def test_duplicate_mapping_rows_do_not_multiply(spark):
    mapping = spark.createDataFrame([(1, 5), (1, 2), (None, 0)], "user_id int, group_id int")
    posts = spark.createDataFrame([(1,), (1,), (4,)], "user_id int")
    assert one_row_per_key(mapping, "user_id", "group_id").count() == 1
    got = {r.group_id: r.cnt for r in pop.posts_per_group(posts, mapping).collect()}
    assert got == {2: 2, 7: 1}


def test_whole_job(spark):
    posts = spark.createDataFrame(
        [("u1", "Rain again http://T.co/A"), ("u2", "rain!"), ("u3", "Wind &amp; rain")],
        "user_id string, text string")
    mapping = spark.createDataFrame([("u1", 0), ("u3", 1)], "user_id string, group_id int")
    got = ranked(pop.popular_tokens_of_posts(posts, mapping, min_users=3))
    assert got == {0: ["rain"], 1: ["rain"], 7: ["rain"]}
    got = ranked(pop.popular_tokens_of_posts(posts, mapping, min_users=1, decode_entities=True))
    assert got[1] == ["and", "wind", "rain"] and "http://T.co/A" in got[0]


def test_pairs_are_counted_in_one_pass(data):
    """The lookup is the only join: totals come from the group counts."""
    plan = pop.relative_popularity(*data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("WindowGroupLimit") == 2


def test_many_groups_count_alike(spark, monkeypatch):
    from oreline.operators import popularity
    tokens = spark.createDataFrame([(u, f"t{k}") for u in range(30) for k in range(5) if (u * 7 + k) % 3], "user_id int, token string")
    mapping = spark.createDataFrame([(u, u % 4) for u in range(20)], "user_id int, group_id int")
    rows = lambda: sorted(map(tuple, popularity.group_scores(tokens, mapping, min_users=2).collect()))
    few = rows()
    monkeypatch.setattr(popularity, "FEW_GROUPS", 0)
    assert few == rows() and {r[0] for r in few} == {0, 1, 2, 3, 7}
