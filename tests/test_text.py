from collections import Counter

import pytest
from pyspark.sql import functions as F

from oreline.functions import text as tx
from oreline.operators import ngrams as ng

TEXTS = [
    "To know you\r\nis to love you. To know you is_to love. One. . Where? Here! There. ",
    "Élan vital x² ① ½ ７ 中文 naïve. ÉLAN  VITAL",
    "",
    "alone",
    "a a a a a a. a a a. b-b b'b",
    "no full stop here.next to it. end",
]


def plain_words(sentence):
    kept = "".join(c.lower() if c.isalpha() else c if c.isdigit() else " " for c in sentence)
    return kept.split()


def plain_counts(texts, max_n=5):
    out = Counter()
    for text in texts:
        for sentence in text.split(". "):
            w = plain_words(sentence)
            for n in range(1, max_n + 1):
                for i in range(len(w) - n + 1):
                    out[n, " ".join(w[i:i + n])] += 1
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "text string")


def test_counts_match_brute_force(corpus):
    got = {(r.n, r.ngram): r.cnt for r in ng.ngram_counts(corpus).collect()}
    assert got == dict(plain_counts(TEXTS))


def plain_totals(texts):
    groups = {}
    for (n, _), c in plain_counts(texts).items():
        groups.setdefault(n, []).append(c)
    return {n: (sum(c), len(c), max(c)) for n, c in groups.items()}


@pytest.mark.parametrize("words,part_chars", [(1 << 20, 8 << 20), (3, 1)])
def test_totals_match_brute_force(spark, corpus, monkeypatch, words, part_chars):
    """Many tables per task and many parts, too; an empty corpus has no orders."""
    monkeypatch.setattr(ng, "TABLE_WORDS", words)
    got = {r.n: tuple(r)[1:] for r in ng.order_totals(corpus, part_chars=part_chars).collect()}
    assert got == plain_totals(TEXTS)
    assert ng.order_totals(corpus.limit(0)).count() == 0
    assert ng.order_totals(spark.createDataFrame([(None,), ("..",)], "text string")).count() == 0


def test_order_totals_shuffle_tables_instead_of_strings(spark):
    """20,000 different words make 100,000 n-grams but few rows, and no n-gram leaves a task as a string."""
    corpus = spark.createDataFrame([(" ".join(f"w{i}" for i in range(20_000)),)], "text string").coalesce(1)
    tables = ng.gram_tables(corpus, bits=4)
    assert tables.count() == 5 * 16
    assert {f.dataType.simpleString() for f in tables.schema} == {"int", "binary"}
    got = {r.n: tuple(r)[1:] for r in ng.order_totals(corpus).collect()}
    assert got == {n: (20_001 - n, 20_001 - n, 1) for n in range(1, 6)}


def test_names_that_agree_in_half_are_parted():
    import numpy as np
    high, low, cnt = (np.array(x, dtype) for x, dtype in (([7, 7, 3, 7], np.uint64), ([1, 2, 5, 1], np.uint32), ([1, 10, 100, 1000], np.int64)))
    assert [c.tolist() for c in ng._summed(high, low, cnt)] == [[3, 7, 7], [5, 1, 2], [100, 1001, 10]]


def test_normalise_keeps_one_character_per_character(spark):
    rows = spark.createDataFrame([("A_b-Ç²½ x",)], "s string")
    assert rows.select(tx.normalise(F.col("s"))).first()[0] == "a b ç²  x"


def brute_top(texts, k):
    out = []
    for n in range(1, 6):
        ranked = sorted(((-c, g) for (m, g), c in plain_counts(texts).items() if m == n))
        out += [(n, i + 1, g, -c) for i, (c, g) in enumerate(ranked[:k])]
    return sorted(out)


@pytest.mark.parametrize("buckets,first", [(1 << 20, 100), (3, 1), (50, 2), (1, 1)])
def test_top_is_exact_for_any_number_of_buckets(corpus, buckets, first):
    """Few buckets collide heavily and force the second exact count."""
    df = ng.top_ngrams(corpus, k=5, buckets=buckets, first=first)
    got = sorted((r["n"], r["rank"], r["ngram"], r["cnt"]) for r in df.collect())
    assert got == brute_top(TEXTS, 5)


def test_top_is_exact_without_broadcast(corpus, no_broadcast):
    df = ng.top_ngrams(corpus, k=5, buckets=7, first=1)
    got = sorted((r["n"], r["rank"], r["ngram"], r["cnt"]) for r in df.collect())
    assert got == brute_top(TEXTS, 5)


def test_direct_agrees(corpus):
    got = sorted((r["n"], r["rank"], r["ngram"], r["cnt"])
                 for r in ng.top_ngrams_direct(corpus, k=3).collect())
    assert got == brute_top(TEXTS, 3)


def test_fewer_than_k(spark):
    df = spark.createDataFrame([("only two",)], "text string")
    got = {(r["n"], r["ngram"]) for r in ng.top_ngrams(df).collect()}
    assert got == {(1, "only"), (1, "two"), (2, "only two")}


def test_ties_go_to_the_smaller_ngram(spark):
    df = spark.createDataFrame([("b a d c",)], "text string")
    got = [r["ngram"] for r in ng.top_ngrams(df, max_n=1, k=2).orderBy("rank").collect()]
    assert got == ["a", "b"]


def test_group_limit_runs_before_the_shuffle(corpus):
    plan = ng.top_ngrams_direct(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_a_letter_with_a_long_lower_case_stays_in_its_word(spark):
    got = spark.createDataFrame([("Gel \u0130stanbul-Ankara",)], "s string").select(tx.words(F.col("s")).alias("w")).first().w
    assert got == ["gel", "i\u0307stanbul", "ankara"]
