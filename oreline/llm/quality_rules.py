"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a chain of built-in functions on the text of one row: no
shuffle, no user function.  Words are runs of characters other than space and
U+0009..U+000D, lines are separated by a line feed.

Defined results: a null or empty text has no words and fails the base rule;
rows are judged one by one, so ties, repeated rows and null ids do not matter;
an empty table gives an empty table.  Only the named id and text columns are
read, whatever other columns are called.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.arrays import bound

WORD_GAP = r"[\x20\x09-\x0D]+"
A_WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SHOUTED = r"^\p{Lu}{2,}\P{Ll}*$"
WINDOW = 8
#: Taken off both ends of a word before it is compared with the stop words.
EDGE = ".,;:!?\"()[]{}<>*_"

#: Frequent words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "with", "on", "are", "was", "this", "be", "by", "from", "or", "an"],
    "fr": ["le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "que", "qui", "dans", "pour", "par", "sur", "est", "pas", "au", "aux"],
    "de": ["der", "die", "das", "und", "den", "dem", "des", "von", "zu", "mit", "ist", "ein", "eine", "nicht", "auf", "für", "im", "in", "als", "auch"],
    "es": ["el", "la", "los", "las", "de", "del", "y", "que", "en", "un", "una", "por", "con", "para", "es", "su", "se", "al", "no", "lo"],
}


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * of / per <= high``; a bound of None is open.

    ``per`` None compares ``of`` itself.  Everything is in whole numbers, so
    no rounding decides a verdict.
    """

    name: str
    of: str
    per: str | None = None
    low: int | None = None
    high: int | None = None

    def passed(self) -> Column:
        value = F.col(self.of) if self.per is None else F.col(self.of) * 100
        scale = F.lit(1) if self.per is None else F.col(self.per)
        tests = [value >= scale * self.low] if self.low is not None else []
        tests += [value <= scale * self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def passed_sql(self) -> str:
        value, scale = (self.of, "1") if self.per is None else (f"100 * {self.of}", self.per)
        tests = [f"{value} >= {scale} * {self.low}"] if self.low is not None else []
        tests += [f"{value} <= {scale} * {self.high}"] if self.high is not None else []
        return "(" + (" AND ".join(tests) or "TRUE") + ")"


#: The threshold table.  ``per`` names the denominator; bounds are per cent of it.
RULES = [
    Rule("long_enough", "n_words", low=20),
    Rule("few_repeated_words", "n_repeat_words", "n_words", high=30),
    Rule("mean_word_length", "word_chars", "n_words", low=150, high=2000),
    Rule("few_symbols", "n_symbols", "n_words", high=30),
    Rule("some_stop_words", "n_stop_words", "n_words", low=5),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", high=40),
    Rule("not_shouting", "n_shouted_words", "n_words", high=50),
]
BASE_RULES = RULES[:2]
#: Measures besides those of the base rules.
MORE = ("n_lines", "n_stop_words", "n_shouted_words")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of every window of 8 words, by joining neighbours 1, 2 and 4 apart."""
    def joined(hashes: Column, apart: int) -> Column:
        return bound(hashes, lambda h: F.zip_with(
            F.slice(h, 1, F.size(h) - apart), F.slice(h, apart + 1, F.size(h) - apart), lambda a, b: F.xxhash64(a, b)))

    return joined(joined(joined(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)


def _repeated_words(words: Column) -> Column:
    """Words covered by a window of 8 words that the same text holds twice or more.

    Windows are compared by hash first; texts with an equal pair sort
    (hash, place) and confirm neighbours on the words themselves.
    """
    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(
            F.coalesce(F.get(places, i + 1), p + WINDOW) - p, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def places(ws: Column, hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(ordered: Column, x: Column, j: Column) -> Column:
            y = F.get(ordered, j)
            return F.coalesce((y["h"] == x["h"])
                              & (F.slice(ws, y["i"] + 1, WINDOW) == F.slice(ws, x["i"] + 1, WINDOW)), F.lit(False))

        return bound(keyed, lambda s: F.sort_array(F.filter(
            F.transform(s, lambda x, j: F.when(same(s, x, j - 1) | same(s, x, j + 1), x["i"])), lambda i: i.isNotNull())))

    return F.when(F.size(words) > WINDOW, bound(words, lambda ws: bound(
        _window_hashes(ws), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
        .otherwise(bound(places(ws, h), covered))))).otherwise(F.lit(0))


def judge(docs: DataFrame, id_: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, the measures, ``base_failed`` and ``kept``."""
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    whole = F.coalesce(F.col(text), F.lit(""))
    core = F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))
    split = docs.select(
        F.col(id_),
        F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, WORD_GAP)).alias("words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(A_WORD_CHAR)).alias("lines"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    folded = lambda w: F.lower(F.btrim(w, F.lit(EDGE)))
    counted = split.select(
        F.col(id_),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: folded(w).isin(*stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.rlike(SHOUTED))).cast("long").alias("n_shouted_words"))
    base = reduce(lambda a, b: a & b, [r.passed() for r in BASE_RULES])
    verdict = reduce(lambda a, b: a & b, [r.passed() for r in rules])
    first = [c for c in counted.columns if c not in MORE]
    return counted.withColumns({"base_failed": ~base, "kept": base & verdict}).select(*[F.col(f"`{c}`") for c in first], "base_failed", "kept", *MORE)


def judge_sql(rules: list[Rule] = RULES) -> str:
    """The same for ``documents`` in DuckDB."""
    stops = ", ".join("'" + w + "'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (
  SELECT r, doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split_regex(text, '{WORD_GAP}'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{A_WORD_CHAR}')) AS lines
  FROM t),
w AS (
  SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM s WHERE len(words) > {WINDOW})),
d AS (
  SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (
  SELECT r, sum(least({WINDOW}, nxt - i)) AS n FROM (
    SELECT r, i, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i), i + {WINDOW}) AS nxt FROM d) GROUP BY r),
c AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda w: lower(trim(w, '{EDGE}')) IN ({stops})))::BIGINT AS n_stop_words,
         len(list_filter(words, lambda w: regexp_matches(w, '{SHOUTED}')))::BIGINT AS n_shouted_words
  FROM s LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_shouted_words,
       NOT ({" AND ".join(r.passed_sql() for r in BASE_RULES)}) AS base_failed,
       {" AND ".join(r.passed_sql() for r in rules)} AS kept
FROM c"""
