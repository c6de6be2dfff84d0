"""Alignment of two tokenizers by merge-path partitioning.

Every text is encoded by both tokenizers, and each token gets the byte where it
ends.  The two rising lists of ends of a batch of texts are merged: diagonals
are laid across the merge at equal distances, a binary search on each finds how
many ends of either list lie before it, and the pieces between two diagonals
are merged on their own, all of the same size.  Each piece tells the pairs of
tokens that end together inside it; a pair that a diagonal parts is found from
the ends on both its sides, which stitches the pieces' open groups together.

The pairs of a shard of texts are numbered by the shard.  Over all shards they
are counted, the best count of every B id is kept, and both are joined back to
the shards once per shard and pair.

Defined results: a text that is null or empty, or that one of the tokenizers
does not give back byte by byte, has no tokens: its numbers are 0 and its digest
is empty; rows are taken one by one, so ids may be null or repeated; an empty
table gives an empty table.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.codes import keys_of, looked_up, written
from oreline.llm.packing import PATTERN

#: Ends merged by one piece.
WORK = 1 << 14
#: A shard closes at so many bytes of text; tokens are laid out for so many bytes at a time.
SHARD_BYTES, BATCH_BYTES = 8 << 20, 1 << 20
MARK = "▁"


# ---- tokens ----------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A: ids of the text with a space in front, special strings taken as text, and the bytes of every id.

    With ``ranks`` (the same vocabulary in order of merging) texts of Latin-1
    characters are encoded by a faster library; the ids are the same.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.full, self.quick = Tokenizer.from_file(path), None
        self.full.encode_special_tokens = True
        letters = byte_letters()
        words = self.full.get_vocab(with_added_tokens=True)
        self.spelled = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.spelled[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.quick is not None and all(ord(c) < 256 for c in set(text)):
            return self.quick.encode_ordinary(" " + text)
        return self.full.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: ids of the text, to which the model adds a space, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


# ---- merging ---------------------------------------------------------------

def diagonals(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the diagonals cut the merge of two rising lists: how many of ``a`` and of ``b`` lie before each.

    The first is at the start, the last at the end, neighbours ``work`` elements
    apart.  Of equal elements that of ``a`` comes first.
    """
    at = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        earlier = a[mid] <= b[at[open_] - mid - 1]  # then a[mid] lies before the diagonal
        low[open_[earlier]] = mid[earlier] + 1
        high[open_[~earlier]] = mid[~earlier]
    return low, at - low


def piece_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in one piece's parts of both lists where they hold the same end."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    same = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a)
    return same, at[same]


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly rising lists of the ends they share, from independent pieces of equal size."""
    i, j = diagonals(a, b, work)
    found = [[], []]
    for k in range(len(i) - 1):
        if k and i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:  # the diagonal parts an equal pair
            found[0].append(i[k:k + 1] - 1)
            found[1].append(j[k:k + 1])
        x, y = piece_pairs(a[i[k]:i[k + 1]], b[j[k]:j[k + 1]])
        found[0].append(x + i[k])
        found[1].append(y + j[k])
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


class Speller:
    """Writes groups as ``a1,a2|b1;a3|b2``: every id with each of its separators is spelled once."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.spelled = ([f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)]
                        + [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)])

    def ordered(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[int]:
        """Numbers of the spelled ids in the order of writing; ``cut_a`` and ``cut_b`` are the last tokens of the groups."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a] = last_b[cut_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.append(0, cut_b + 1)[group_a]] = a + last_a * self.n_a
        out[np.arange(len(b)) + cut_a[group_b] + 1] = 2 * self.n_a + b + last_b * self.n_b
        return out.tolist()

    def digest(self, numbers: list[int]) -> str:
        return hashlib.sha256("".join([self.spelled[i] for i in numbers])[:-1].encode()).hexdigest()


def align(texts: list[str | None], first: ByteLevel, second: Pieces, speller: Speller, work: int = WORK):
    """For a batch of texts: (n_a, n_b, n_groups, digest) of each, and text number, A id and B id of every link."""
    ids_a, ids_b, sizes = [], [], []
    for t in texts:
        whole = b"" if not t else (" " + t).encode("utf-8", "surrogatepass")
        a, b = (first.encode(t), second.encode(t)) if t else ([], [])
        if b"".join([first.spelled[i] for i in a]) != whole or b"".join([second.spelled[i] for i in b]) != whole:
            a, b, whole = [], [], b""
        ids_a.append(a)
        ids_b.append(b)
        sizes.append(len(whole))
    flat_a, flat_b = [np.fromiter((i for x in ids for i in x), np.int64) for ids in (ids_a, ids_b)]
    width_a, width_b = [np.array([len(s) for s in t.spelled], np.int64) for t in (first, second)]
    # ends are counted through the batch, so those of one text never meet those of another
    end_a, end_b = np.cumsum(width_a[flat_a]), np.cumsum(width_b[flat_b])
    at_a, at_b = common_ends(end_a, end_b, work)
    text_end = np.cumsum(sizes)
    owner = np.searchsorted(text_end, end_a[at_a])
    stop_a, stop_b = np.cumsum([len(x) for x in ids_a]), np.cumsum([len(x) for x in ids_b])
    stop_g = np.searchsorted(owner, np.arange(len(texts)), side="right")
    numbers = speller.ordered(flat_a, flat_b, at_a, at_b)
    rows, a, b, g = [], 0, 0, 0
    for na, nb, ng in zip(stop_a.tolist(), stop_b.tolist(), stop_g.tolist()):
        rows.append((na - a, nb - b, ng - g, speller.digest(numbers[a + b:na + nb]) if ng > g else ""))
        a, b, g = na, nb, ng
    return rows, owner, flat_a[at_a], flat_b[at_b]


# ---- the job ---------------------------------------------------------------

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def link_shards(docs: DataFrame, byte_level: str, pieces: str, ranks: str | None = None, id_: str = "doc_id", text: str = "text",
                shard_bytes: int = SHARD_BYTES, work: int = WORK) -> DataFrame:
    """One row per shard of texts: their numbers and digests, and their links as a sparse matrix of texts by pairs.

    ``starts``, ``columns`` and ``counts`` are the matrix, ``pairs`` the shard's
    own list of pairs (A id times 2^32 plus B id) and ``times`` their counts.
    """
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        first, second = ByteLevel(byte_level, ranks), Pieces(pieces)
        speller = Speller(len(first.spelled), len(second.spelled))

        def shard(number: int, ids: list, rows: list, links: list):
            owner, a, b = [np.concatenate([x[i] for x in links]) for i in range(3)]
            pairs, column = np.unique(a << 32 | b, return_inverse=True)
            cell, count = np.unique(owner * max(1, len(pairs)) + column, return_counts=True)
            starts = np.searchsorted(cell, np.arange(len(rows) + 1) * max(1, len(pairs)))
            times = np.bincount(column, minlength=len(pairs))
            n_links = np.bincount(owner, minlength=len(rows))
            numbers = [[r[i] for r in rows] for i in range(3)] + [n_links.tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(rows)], pa.concat_arrays(ids)),
                 *[pa.array([x], pa.list_(pa.int64())) for x in numbers], pa.array([[r[3] for r in rows]], pa.list_(pa.string())),
                 *[pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (starts, cell % max(1, len(pairs)), count)],
                 *[pa.array([x], pa.list_(pa.int64())) for x in (pairs, times)]],
                names=["shard", "ids", *NUMBERS, "digests", "starts", "columns", "counts", "pairs", "times"])

        number, ids, rows, links, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        for batch in batches:
            texts, at = batch.column(1), 0
            for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
                size += n or 0
                full = size >= shard_bytes
                if full or i + 1 == batch.num_rows or size // BATCH_BYTES > (size - (n or 0)) // BATCH_BYTES:
                    found, owner, a, b = align(texts.slice(at, i + 1 - at).to_pylist(), first, second, speller, work)
                    links.append((owner + len(rows), a, b))
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    rows += found
                    at = i + 1
                if full:
                    yield shard(number, ids, rows, links)
                    number, ids, rows, links, size = number + 1, [], [], [], 0
        if rows:
            yield shard(number, ids, rows, links)

    return (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
            .mapInArrow(kernel, f"shard long, ids array<{kind}>, {', '.join(f'{n} array<long>' for n in NUMBERS)}, digests array<string>, "
                                "starts binary, columns binary, counts binary, pairs array<long>, times array<long>"))


def pair_counts(shards: DataFrame) -> DataFrame:
    """(key, n, best): how often a pair is linked over all shards, and whether no pair of its B id is linked more often."""
    one = shards.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("key"), F.col("x.times").alias("n"))
    counts = written(one.groupBy("key").agg(F.sum("n").alias("n")).withColumn("b", F.col("key").bitwiseAND((1 << 32) - 1)), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, byte_level: str, pieces: str, ranks: str | None = None, id_: str = "doc_id", text: str = "text",
              shard_bytes: int = SHARD_BYTES, work: int = WORK) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    shards = written(link_shards(docs, byte_level, pieces, ranks, id_, text, shard_bytes, work), "links")
    told = looked_up(shards, "pairs", written(pair_counts(shards), "counts"), "n", "best")
    kind = docs.schema[id_].dataType.simpleString()
    names = ["id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]

    def kernel(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                flat = lambda c: own.column(own.schema.get_field_index(c)).flatten()
                starts, columns, counts = [np.frombuffer(own.column(own.schema.get_field_index(c))[0].as_buffer(), "<i4") for c in ("starts", "columns", "counts")]
                n, best = [flat(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "best")]
                sums = [np.concatenate([[0], np.cumsum(counts * v[columns])]) for v in (best, n)]
                yield pa.RecordBatch.from_arrays([flat("ids"), *[flat(c) for c in NUMBERS],
                                                  *[pa.array(s[starts[1:]] - s[starts[:-1]]) for s in sums], flat("digests")], names=names)

    return (shards.drop("pairs", "times").join(told, "shard", "left")
            .mapInArrow(kernel, f"id {kind}, {', '.join(f'{n} long' for n in names[1:-1])}, groups_sha256 string").withColumnRenamed("id", id_))
