"""Line dedup: suffixes of line-ID sequences by distributed prefix doubling.

Every line with a visible character gets an ID; a document is its sequence of
IDs, and runs never cross documents.  Suffixes are named by their first h
lines: a name at depth 2h joins the names of a suffix and of the one h lines
on.  A set of suffixes with one name is an LCP interval of depth h or more;
suffixes whose name is unique leave, since no deeper interval holds them, and
the doubling ends when no name is shared.  Of every suffix the deepest interval
is kept in which it is not the first occurrence; the lines of these intervals,
joined where they overlap or touch, are the maximal repeated runs of a document, and go.
The first occurrence (by id, null first, then text hash, then place) stays.  A
run counts from ``min_lines`` on; with ``alone_words`` a line of more words than
that is a run by itself.

A name's count and first occurrence are an aggregate.  Names that hold more
than one row in ``SHARE`` are fewer than ``SHARE``, so they are broadcast back;
the others meet their suffixes in a join without a hot key.  The later rounds are
small: the names of at most ``FEW`` suffixes are broadcast back in one plan, which
keeps what the driver plans and compiles per round small.

Defined results: a null text has no lines and stays null; lines without a
visible character are in no run and stay, unless nothing else of the document
does; rows with equal id and text are one document and are cut alike; equal
texts under different ids are copies, and all but the first lose their runs; an
empty table gives an empty table.  Other columns are kept as they are, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.arrays import bound
from oreline.llm.codes import written

VISIBLE = r"[^\x20\x09-\x0D]"
MIN_LINES = 2
#: A line of more words is a repeated run by itself in the registered query.
ALONE_WORDS = 50
#: A name with more than one row in so many is hot.
SHARE = 4096
#: The names of so few suffixes are broadcast whole.
FEW = 50_000


def _key(id_: str, text: str):
    return F.unhex(F.md5(F.concat_ws("\x00", F.col(id_).cast("string"), F.coalesce(F.col(id_).isNull().cast("string"), F.lit("")), F.col(text))))


def _alone(line: Column, alone_words: int | None) -> Column:
    """Whether a line has words enough to be a run by itself."""
    if alone_words is None:
        return F.lit(False)
    words = F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return (F.char_length(line) > 2 * alone_words) & (words > alone_words)  # only long lines are split


def line_ids(docs: DataFrame, id_: str = "doc_id", text: str = "text", alone_words: int | None = None) -> DataFrame:
    """(key, id, i, name, alone): visible lines, numbered from 0 within the document."""
    names = F.transform(F.filter(F.split(F.col(text), "\n"), lambda s: s.rlike(VISIBLE)),
                        lambda s: F.struct(F.xxhash64(s).alias("name"), _alone(s, alone_words).alias("alone")))
    lines = docs.select(_key(id_, text).alias("key"), F.col(id_).alias("id"), names.alias("names")).dropDuplicates(["key"])
    return lines.select("key", "id", F.posexplode("names").alias("i", "line")).select("key", "id", "i", "line.name", "line.alone")


def _met(suffixes: DataFrame) -> DataFrame:
    """``suffixes`` (a written table) whose name occurs more than once, with ``first``: whether it is the name's first occurrence."""
    order = F.struct(F.col("id").isNotNull().alias("has"), "id", "key", "i")
    names = suffixes.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("least")).where("n > 1")
    rows = suffixes.count()
    if rows <= FEW:                                                          # at most FEW / 2 names
        return suffixes.join(F.broadcast(names.drop("n")), "name").withColumn("first", F.col("least") == order).drop("least")
    names = written(names, "names")
    hot = F.col("n") > rows / SHARE
    crowded = F.broadcast(names.where(hot).select("name", "least"))          # fewer than SHARE rows
    apart = suffixes.join(crowded, "name", "left_anti").join(names.where(~hot).select("name", "least").hint("merge"), "name")
    return suffixes.join(crowded, "name").unionByName(apart).withColumn("first", F.col("least") == order).drop("least")


def repeated_suffixes(lines: DataFrame, min_lines: int = MIN_LINES, alone: bool = False) -> DataFrame:
    """(key, i, n): suffixes that share ``n`` lines with an earlier one, once for every depth of the doubling that counts.

    With ``alone`` lines that are runs by themselves come besides, with n = 1.
    Every round's suffixes are written before they are used twice.
    """
    columns = ["key", "id", "i", "name", *(["alone"] if alone else [])]
    now, depth = written(_met(written(lines.select(*columns), "lines")), "depth1"), 1
    counts = F.lit(True) if min_lines == 1 else F.col("alone") if alone else F.lit(False)
    found = [now.where(~F.col("first") & counts).select("key", "i", F.lit(1).alias("n"))]
    while not now.isEmpty():
        step = min(depth, min_lines - depth) if depth < min_lines else depth
        # the name `step` lines on, if it is still shared, completes `depth + step` lines
        later = now.select("key", (F.col("i") - step).alias("i"), F.col("name").alias("next"))
        ahead = now.select("key", "id", "i", "name").join(later.hint("merge"), ["key", "i"]).select("key", "id", "i", F.xxhash64("name", "next").alias("name"))
        depth += step
        now = written(_met(written(ahead, "ahead")), f"depth{depth}")
        if depth >= min_lines:
            found.append(now.where(~F.col("first")).select("key", "i", F.lit(depth).alias("n")))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def maximal_runs(docs: DataFrame, id_: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                 alone_words: int | None = None) -> DataFrame:
    """(key, start, n): the runs of visible lines that repeat earlier ones, joined where they overlap or touch."""
    lines = line_ids(docs, id_, text, alone_words)
    deepest = repeated_suffixes(lines, min_lines, alone_words is not None).groupBy("key", "i").agg(F.max("n").alias("n"))
    place = Window.partitionBy("key").orderBy("i")
    reach = F.max(F.col("i") + F.col("n")).over(place.rowsBetween(Window.unboundedPreceding, -1))
    opened = deepest.withColumn("opens", F.coalesce(F.col("i") > reach, F.lit(True)).cast("int"))
    return (opened.withColumn("run", F.sum("opens").over(place)).groupBy("key", "run")
            .agg(F.min("i").alias("start"), F.max(F.col("i") + F.col("n")).alias("end"))
            .select("key", "start", (F.col("end") - F.col("start")).alias("n")))


def removed_lines(docs: DataFrame, id_: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                  alone_words: int | None = None) -> DataFrame:
    """(key, gone): for documents that lose lines, the numbers (of visible lines) that go."""
    runs = maximal_runs(docs, id_, text, min_lines, alone_words)
    numbers = F.transform(F.collect_list(F.struct("start", "n")), lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1))
    return runs.groupBy("key").agg(F.flatten(numbers).alias("gone"))


def dedup(docs: DataFrame, id_: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
          alone_words: int | None = None) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted, and ``_op7_removed``, the number of lines that went.

    ``_op7_empty`` marks documents that had visible lines and lost all of them.
    The texts meet their runs in one shuffle, at every size.
    """
    gone = written(removed_lines(docs, id_, text, min_lines, alone_words).select(F.col("key").alias("_op7_key"), F.col("gone").alias("_op7_gone")), "gone")
    joined = docs.withColumn("_op7_key", _key(id_, text)).join(gone.hint("merge"), "_op7_key", "left")
    lines = F.split(F.col(text), "\n")
    visible = F.filter(F.transform(lines, lambda s, j: F.when(s.rlike(VISIBLE), j)), lambda j: j.isNotNull())
    bad = bound(visible, lambda places: F.transform("_op7_gone", lambda i: F.get(places, i)))
    left = bound(lines, lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), bad), lambda j: F.get(ls, j)))
    marked = joined.withColumn("_op7_empty", F.coalesce(F.size("_op7_gone") == F.size(visible), F.lit(False)))
    new = (F.when(F.col("_op7_gone").isNull(), F.col(text)).when(F.col("_op7_empty"), F.lit(""))
           .otherwise(F.array_join(left, "\n")))
    return marked.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns],
                         F.coalesce(F.size("_op7_gone"), F.lit(0)).cast("long").alias("_op7_removed"), "_op7_empty")


DIGEST_SQL = r"""
WITH d AS (
  SELECT doc_id, text, md5(text) AS h, list_filter(list_transform(string_split(text, chr(10)), lambda s, j: {'s': s, 'j': j}),
         lambda x: regexp_matches(x.s, '[^\x20\x09-\x0D]')) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i].s AS s, lines[i].j AS j, lead(lines[i].s) OVER (PARTITION BY doc_id ORDER BY i) AS t
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
w AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s, t ORDER BY doc_id, i) AS k FROM l WHERE t IS NOT NULL) WHERE k > 1),
a AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM l
                             WHERE len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) > 50) WHERE k > 1),
g AS (SELECT doc_id, i + k AS i FROM w, (SELECT unnest([0, 1]) AS k) UNION SELECT doc_id, i FROM a),
b AS (SELECT doc_id, list(j) AS bad FROM g JOIN l USING (doc_id, i) GROUP BY doc_id),
o AS (SELECT d.doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, coalesce(len(bad), 0)::BIGINT AS n_removed,
        CASE WHEN bad IS NULL THEN text WHEN len(bad) = len(lines) THEN ''
        ELSE array_to_string(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda s, j: {'s': s, 'j': j}),
             lambda x: NOT list_contains(bad, x.j)), lambda x: x.s), chr(10)) END AS kept
      FROM d LEFT JOIN b USING (doc_id))
SELECT doc_id, n_lines, n_removed, sha256(kept) AS kept_sha256 FROM o"""
