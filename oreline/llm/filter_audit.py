"""Interactions of document filters, audited on a sparse document-term matrix.

1. Tasks cut whole texts into words and build CSR shards: row starts, column
   numbers and counts, with the shard's own dictionary of words.  The flags that
   need no words (capitals, symbols) and a digest of the text are attached to
   the rows.
2. Every shard sends its dictionary, cut by ranges of the words' hashes, to the
   tasks that number the words of a range for all shards, and gets the global
   numbers back in the same order.  A word leaves a shard once, whatever its
   count, and the number of ranges follows from the size of the dictionaries.
   Every shard's column numbers are replaced by the global ones.
3. In the encoded matrix the sum of a row is its number of words and its count of
   nonzeros the number of different words; they decide filters A and B.  Equal
   digests decide E: copies are counted by group before they meet.
4. A document is then a set of failed filters.  Documents are counted by part
   and set; 32 counts per part give every order and step.

Defined results: a null text is the empty text; a null part is the empty
string; repeated rows count as often as they stand, and none of the rows with
the smallest id of a text is a copy; rows without an id are neither copies nor
originals and have no labels; a document labelled more than once is good (toxic)
if any label says so; an empty table gives no rows.  Only the named columns are
read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.codes import written

FILTERS = "ABCDE"
#: A shard closes at so many bytes of text (a longer text is a shard by itself); words are cut out of so many bytes at a time.
SHARD_BYTES, BATCH_BYTES = 5 << 20, 1 << 20
#: The most words that a range of the dictionary may hold.
RANGE_WORDS = 200_000
UPPER, SYMBOL, INNER = 1, 2, 4
SHARDS = ("shard long, ids array<{id}>, parts array<string>, capitals array<boolean>, symbols array<boolean>, digests array<binary>, "
          "starts binary, columns binary, counts binary, own long, words binary")
#: Between the words of a dictionary, which is one value: a word holds none, and an element per word would cost tasks several times its bytes.
GAP = b" "


def _marks() -> np.ndarray:
    """For every byte: whether it is a capital, a symbol, or inside a character."""
    marks = np.zeros(256, dtype=np.uint8)
    marks[65:91] |= UPPER
    marks[np.frombuffer(b"#$%&*|", dtype=np.uint8)] |= SYMBOL
    marks[128:192] |= INNER
    return marks


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes, which compress well where the numbers are small."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _words(told: bytes) -> list[bytes]:
    """The words of a dictionary or a part of it."""
    return told.split(GAP) if told else []


def _csr(sizes: list[int], words: list[pa.Array]):
    """Row starts, columns and counts of texts of so many words, and their different words in the order of the words' hashes."""
    coded = pa.concat_arrays([pa.array([], pa.binary()), *words]).dictionary_encode()
    own = coded.dictionary.to_pylist()
    order = np.argsort(np.array([zlib.crc32(w) for w in own], dtype=np.int64), kind="stable")
    place = np.empty(len(own), dtype=np.int64)
    place[order] = np.arange(len(own))
    row, wide = np.repeat(np.arange(len(sizes)), sizes), max(1, len(own))
    cell, count = np.unique(row * wide + place[coded.indices.to_numpy()], return_counts=True)
    return np.searchsorted(cell, np.arange(len(sizes) + 1) * wide), cell % wide, count, [own[i] for i in order.tolist()]


def csr_shards(docs: DataFrame, id_: str = "doc_id", text: str = "text", part: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix in shards, columns numbered by each shard's own ``words``."""
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        marks = _marks()

        def shard(number: int, ids: list, parts: list, facts: list, words: list):
            starts, columns, counts, own = _csr([f[0] for f in facts], words)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(facts)], pa.concat_arrays(ids)),
                 *[pa.ListArray.from_arrays([0, len(facts)], pa.array(list(x), t)) for x, t in (
                     (parts, pa.string()), ([f[1] for f in facts], pa.bool_()), ([f[2] for f in facts], pa.bool_()), ([f[3] for f in facts], pa.binary()))],
                 *[pa.array([packed(x)], pa.binary()) for x in (starts, np.diff(columns, prepend=0) % (1 << 32), counts)],
                 pa.array([len(own)], pa.int64()), pa.array([GAP.join(own)], pa.binary())],
                names=["shard", "ids", "parts", "capitals", "symbols", "digests", "starts", "columns", "counts", "own", "words"])

        def read(texts: pa.Array, facts: list, words: list) -> None:
            rows = pc.ascii_split_whitespace(texts)
            flat, ends = rows.flatten().cast(pa.binary()), rows.offsets.to_numpy()
            filled = pc.greater(pc.binary_length(flat), 0)  # spaces at the ends of a text leave empty words
            words.append(flat.filter(filled))
            before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
            for t, n in zip(texts.cast(pa.binary()).to_pylist(), np.diff(before[ends - ends[0]]).tolist()):
                found = marks[np.frombuffer(t, dtype=np.uint8)]
                many = lambda mark: int(np.count_nonzero(found & mark))
                facts.append((n, 100 * many(UPPER) > 10 * (len(t) - many(INNER)), many(SYMBOL) > 0, hashlib.sha256(t).digest()))

        number, size, ids, parts, facts, words = TaskContext.get().partitionId() << 32, 0, [], [], [], []
        for batch in batches:
            texts, at, open_ = pc.fill_null(batch.column(1), ""), 0, 0
            for i, n in enumerate(pc.binary_length(texts).to_pylist()):
                size, open_ = size + n, open_ + n
                full = size >= shard_bytes
                if full or open_ >= BATCH_BYTES or i + 1 == batch.num_rows:
                    read(texts.slice(at, i + 1 - at), facts, words)
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    parts += [p or "" for p in batch.column(2).slice(at, i + 1 - at).to_pylist()]
                    at, open_ = i + 1, 0
                if full:
                    yield shard(number, ids, parts, facts, words)
                    number, size, ids, parts, facts, words = number + 1, 0, [], [], [], []
        if facts:
            yield shard(number, ids, parts, facts, words)

    return (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"), F.col(part).cast("string").alias("part"))
            .mapInArrow(kernel, SHARDS.format(id=kind)))


def numbered(shards: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """(range, shard, columns): the global numbers of a shard's words, in their order, range after range.

    A range's words are numbered as they are met, shards in order, so a task
    that is run again gives the same numbers.
    """
    ranges = max(1, -(-(shards.agg(F.sum("own")).first()[0] or 0) // range_words))

    def cut(batches):
        edges = np.arange(1, ranges) * (1 << 32) // ranges
        for batch in batches:
            for i in range(batch.num_rows):
                own = _words(batch.column(1)[i].as_py())
                ends = [0, *[bisect_left(own, edge, key=zlib.crc32) for edge in edges.tolist()], len(own)]
                told = [GAP.join(own[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(ranges)), pa.array(np.full(ranges, batch.column(0)[i].as_py())), pa.array(told, pa.binary())],
                    names=["range", "shard", "words"]).filter(pa.array(np.diff(ends) > 0))

    def number(batches):
        now, known = None, {}
        for batch in batches:
            where, out = batch.column(0).to_pylist(), []
            for i, own in enumerate(where):
                if own != now:
                    now, known = own, {}
                found = [known.setdefault(w, len(known)) for w in _words(batch.column(2)[i].as_py())]
                out.append((np.array(found, dtype="<i8") * ranges + own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["range", "shard", "columns"])

    parts = shards.select("shard", "words").mapInArrow(cut, "range long, shard long, words binary")
    return (parts.repartition("range").sortWithinPartitions("range", "shard")
            .mapInArrow(number, "range long, shard long, columns binary"))


def dictionary(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """(word, column): every word of all shards with its global number."""
    def kernel(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                told = b"".join(x["columns"] for x in batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(_words(batch.column(0)[i].as_py()), pa.binary()), pa.array(np.frombuffer(told, "<i8"))], names=["word", "column"])

    return shards.select("shard", "words").join(_by_shard(numbers), "shard").select("words", "told").mapInArrow(kernel, "word binary, column long").distinct()


def _by_shard(numbers: DataFrame) -> DataFrame:
    return numbers.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("range", "columns"))).alias("told"))


def _encoding(batches):
    """Shards, one by one, with global column numbers; the last column holds what was told of their own words."""
    for batch in batches:
        names = batch.schema.names[:-1]
        place = {c: names.index(c) for c in ("starts", "columns", "counts")}
        for i in range(batch.num_rows):
            own = {c: unpacked(batch.column(at)[i].as_buffer()) for c, at in place.items()}
            table = np.frombuffer(b"".join(x["columns"] for x in batch.column(len(names))[i].as_py() or []), "<i8")
            own["columns"] = table[np.cumsum(own["columns"]) % (1 << 32)]
            yield pa.RecordBatch.from_arrays([pa.array([own[c].tobytes()], pa.binary()) if c in own else batch.column(at).slice(i, 1)
                                              for at, c in enumerate(names)], names=names)


def _row_facts(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            own = batch.slice(i, 1)
            starts, counts = [np.frombuffer(own.column(own.schema.get_field_index(c))[0].as_buffer(), "<i8") for c in ("starts", "counts")]
            sums = np.concatenate([[0], np.cumsum(counts)])[starts]
            flat = lambda c: own.column(own.schema.get_field_index(c)).flatten()
            yield pa.RecordBatch.from_arrays([flat("ids"), flat("parts"), flat("digests"), pa.array(np.diff(sums)),
                                              pa.array(np.diff(starts)), flat("capitals"), flat("symbols")],
                                             names=["id", "part", "digest", "n_words", "n_distinct", "capitals", "symbols"])


def _told(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    return shards.drop("own", "words").join(_by_shard(numbers), "shard", "left")


def encoded(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """``shards`` with global column numbers (64-bit) in place of their own words; starts and counts are 64-bit, too."""
    return _told(shards, numbers).mapInArrow(_encoding, shards.drop("own", "words").schema)


def _rows_schema(shards: DataFrame) -> str:
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    return f"id {kind}, part string, digest binary, n_words long, n_distinct long, capitals boolean, symbols boolean"


def rows_of(matrix: DataFrame) -> DataFrame:
    """(id, part, digest, n_words, n_distinct, capitals, symbols): row sums and nonzero counts with the flags."""
    return matrix.mapInArrow(_row_facts, _rows_schema(matrix))


def encoded_rows(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """:func:`rows_of` the encoded shards; a shard's 64-bit numbers stay inside the task that encodes it."""
    return _told(shards, numbers).mapInArrow(lambda batches: _row_facts(_encoding(batches)), _rows_schema(shards))


def failures(rows: DataFrame) -> Column:
    """The set of failed filters without E, one bit each from A."""
    a, b = F.col("n_words") < 100, 100 * F.col("n_distinct") < 80 * F.col("n_words")
    return sum((F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate((a, b, F.col("capitals"), F.col("symbols")))), F.lit(0))


def failure_counts(rows: DataFrame, labels: DataFrame, id_: str = "doc_id") -> DataFrame:
    """(part, failed, n, good, toxic): documents by the set of filters that they fail.

    Rows are added up by id first and by text next, so neither a much repeated
    id nor a much copied text is gathered.
    """
    marks = (labels.where(F.col(id_).isNotNull()).groupBy(F.col(id_).alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    told = rows.withColumn("failed", failures(rows)).groupBy("id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    named = (told.where(F.col("id").isNotNull()).join(marks, "id", "left")
             .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")}))
    # of each text and kind of document: all rows, and those with the smallest id
    first = F.min(F.struct("id", "n")).alias("first")
    alike = (named.groupBy("digest", "part", "failed", "good", "toxic", "id").agg(F.sum("n").alias("n"))
             .groupBy("digest", "part", "failed", "good", "toxic").agg(F.sum("n").alias("n"), first))
    smallest = F.min("first.id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("first.id") == smallest, F.col("first.n")).otherwise(0)
    split = alike.withColumn("originals", originals)
    copy_bit = 1 << FILTERS.index("E")
    sets = (split.select("part", F.col("failed"), F.col("originals").alias("n"), "good", "toxic")
            .unionAll(split.select("part", F.col("failed") + copy_bit, F.col("n") - F.col("originals"), "good", "toxic"))
            .unionAll(told.where(F.col("id").isNull()).select("part", "failed", "n", F.lit(0), F.lit(0))))
    return (sets.groupBy("part", "failed")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of :func:`failure_counts`."""
    parts = counts.groupBy("part").agg(*[F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets")])  # at most 32 a part
    total = lambda keep, value: F.aggregate(F.filter("sets", keep), F.lit(0).cast("long"), lambda acc, s: acc + s[value])
    orders = F.split(F.lit(" ".join("".join(order) for order in permutations(FILTERS))), " ")
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    rows = (parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
            .withColumn("bits", F.expr(f"transform(split(filter_order, ''), x -> shiftleft(1, ascii(x) - {ord(FILTERS[0])}))"))
            .withColumn("this", F.get("bits", F.col("step") - 1))
            .withColumn("before", F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda acc, b: acc.bitwiseOR(b))))
    passed = lambda s: s["failed"].bitwiseAND(F.col("before")) == 0
    fails = lambda s: s["failed"].bitwiseAND(F.col("this")) != 0
    out = rows.select(
        "part", "filter_order", "step", "this",
        total(lambda s: s["failed"].bitwiseAND(F.col("before").bitwiseOR(F.col("this"))) == 0, "n").alias("kept"),
        total(lambda s: passed(s) & fails(s), "n").alias("removed"),
        total(lambda s: ~passed(s) & fails(s), "n").alias("redundant"),
        total(lambda s: s["failed"] == F.col("this"), "n").alias("unique_fails"),
        total(lambda s: passed(s) & fails(s), "good").alias("good_lost"),
        total(lambda s: passed(s) & fails(s), "toxic").alias("toxic_lost"))
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "this"))).drop("this")


def audit(docs: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The interactions of the five filters over ``docs``, by part, order and step."""
    shards = written(csr_shards(docs, id_, text, part), "csr")
    rows = encoded_rows(shards, numbered(shards))
    return interactions(failure_counts(written(rows, "rows"), labels, id_))


AUDIT_SQL = r"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS failed
      FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
s AS (SELECT filter_order, step, bits[step] AS this, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, this,
             sum(CASE WHEN failed & (before | this) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN failed & before = 0 AND failed & this <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN failed & before <> 0 AND failed & this <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN failed = this THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN failed & before = 0 AND failed & this <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN failed & before = 0 AND failed & this <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, this)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, this))::BIGINT AS shapley FROM r"""
