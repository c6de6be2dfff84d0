"""Removal of repeated byte strings: a sparse suffix array sorted deep-shallow.

A byte goes if a string of ``width`` bytes that covers it also starts anywhere
else.  Sorting every suffix of a corpus would move the corpus hundreds of
times, so the suffix array is sparse, at places that the content itself picks:

1. In every window of ``width`` bytes the 40-byte string with the smallest hash
   is the window's anchor.  Equal windows have equal anchors at equal offsets,
   so only windows with equal anchor strings need be compared.  About one place
   in 80 is an anchor; an anchor's context is all windows it belongs to.
2. Anchors are counted by (string, context).  A context met twice is repeated
   as a whole.  A string met once is settled too.  What stays are strings with
   several contexts, as at the edges of copied passages.
3. Their contexts, one each, are read at the anchor: to the right, and
   backwards to the left.  Both lists are sorted deep-shallow: multikey
   quicksort by 8-byte words down to a shallow depth, and blind tries for the
   groups that agree up to there.  The common prefixes of neighbours then say,
   for each offset, which contexts agree left and right, and so which windows
   are equal.
4. A string with very many contexts is not sorted in one task.  Its windows are
   dealt by their core, the part that a run of neighbouring offsets shares, and
   each part is sorted in the same way.

All bytes are those of the input (overlaps count); matches never cross
documents.  Defined results: a null text is the empty text; rows with equal
text are copies of each other, whatever their ids; an empty table gives an
empty result.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.session import scratch_path

WIDTH = 200
ANCHOR = 40
SHALLOW = 64
#: Contexts of one anchor string that are sorted in one task.
MANY = 2000
#: Offsets that share a core when an anchor string has more, level by level.
STEPS = (40, 6, 1)
#: Bytes of text hashed at a time: of one long text, and of several short ones, whose arrays should stay in a core's cache.
CHUNK, SHORT = 1 << 19, 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- anchors ---------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place, by doubling."""
    if size >= 8 and len(data) >= 8:  # the first eight bytes are read as one number
        raw = np.ascontiguousarray(data)
        h, have = _mixed(np.ndarray((len(raw) - 7,), np.dtype("<u8"), raw, strides=(1,)) * _ODD), 8
    else:
        h, have = data.astype(np.uint64) + np.uint64(1), 1
    while have < size:
        step = min(have, size - have)
        h = _mixed(h[:max(0, len(h) - step)] * _ODD + h[step:])
        have += step
    return h


def window_minima(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every ``span`` neighbours, by doubling."""
    have = 1
    while have < span:
        step = min(have, span - have)
        values = np.minimum(values[:max(0, len(values) - step)], values[step:])
        have += step
    return values


def _least_places(data: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the first place, among those in it, with the smallest hash; and the hash of every place."""
    below = np.uint64(2 * CHUNK - 1)
    h = string_hashes(data, anchor)
    # the place rides in the low bits: the minimum carries it, and of equal hashes the first wins
    return (window_minima((h & ~below) | np.arange(len(h), dtype=np.uint64), width - anchor + 1) & below).astype(np.int64), h


def _context_hashes(h: np.ndarray, place: np.ndarray, first: np.ndarray, end: np.ndarray, width: int, anchor: int) -> np.ndarray:
    """Hash of the bytes ``first .. end`` and of the anchor's place in them, from the hashes ``h`` of the strings that cover them."""
    out = _mixed((end - first).astype(np.uint64) * _ODD + (place - first).astype(np.uint64))
    for at in range(0, 2 * width - anchor, anchor):
        out = _mixed(out * _ODD + h[np.minimum(first + at, end - anchor)])
    return out


def anchors(data: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(place, first, last, hash, context hash): each anchor with the first and last start of its windows.

    A window belongs to the first place, among those in it, with the smallest
    hash; equal windows therefore have their anchor at the same offset.
    """
    return anchors_of(data, np.array([0, len(data)]), width, anchor)[1:]


def anchors_of(data: np.ndarray, ends: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(owner, place, first, last, hash, context hash) of texts that lie in ``data`` one behind the other, cut at ``ends``.

    ``owner`` is the number of the text, places count from its start.  Short
    texts are hashed together; windows that cross an end belong to no text.
    """
    out, at, n_texts = [], 0, len(ends) - 1
    while at < n_texts:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + SHORT, side="right")) - 1)
        begins, sizes = ends[at:upto].astype(np.int64) - ends[at], np.maximum(np.diff(ends[at:upto + 1]).astype(np.int64) - width + 1, 0)
        part = data[ends[at]:ends[upto]]
        if sizes.sum():
            owner = np.repeat(np.arange(len(sizes)), sizes)
            start = np.arange(len(owner)) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
            if len(part) <= CHUNK:
                place, h = _least_places(part, width, anchor)
                place = place[start]
            else:  # one long text
                found = [(k, *_least_places(part[k:k + CHUNK + width - 1], width, anchor)) for k in range(0, len(part) - width + 1, CHUNK)]
                place = np.concatenate([p + k for k, p, _ in found])
                h = np.concatenate([x[:CHUNK] for _, _, x in found[:-1]] + [found[-1][2]])
            new = np.flatnonzero(np.diff(place, prepend=-1))
            owner, place, first, last = owner[new], place[new], start[new], start[np.append(new[1:], len(start)) - 1]
            context = _context_hashes(h, place, first, last + width, width, anchor)
            out.append((owner + at, place - begins[owner], first - begins[owner], last - begins[owner], h[place], context))
        at = upto
    kinds = (np.int64,) * 4 + (np.uint64,) * 2
    return tuple(np.concatenate([x[k] for x in out]) if out else np.zeros(0, kind) for k, kind in enumerate(kinds))


# ---- deep-shallow sorting --------------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Strings by the places where they first differ.

    A node holds only the depth at which its children part and the next bytes
    of the children; a search skips the bytes between, then compares with one
    leaf to learn the true depth and goes back up to there.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None  # a leaf is [None, [indices]]; a node [depth, {byte: child}]

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def add(self, index: int) -> None:
        s = self.strings[index]
        if self.root is None:
            self.root = [None, [index]]
            return
        node = self.root
        while node[0] is not None:
            child = node[1].get(self._byte(s, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(index)
            return
        node = self.root
        while node[0] is not None and node[0] < depth:
            node = node[1][self._byte(s, node[0])]
        if node[0] == depth:
            node[1][self._byte(s, depth)] = [None, [index]]
        else:
            node[0], node[1] = depth, {self._byte(other, depth): [node[0], node[1]], self._byte(s, depth): [None, [index]]}

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            depth, held = stack.pop()
            if depth is None:
                out.extend(held)
            else:
                stack.extend(held[b] for b in sorted(held, reverse=True))
        return out


def multikey_quicksort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words``, and which places of it start a group of equal rows.

    Ternary: an open group is parted around a pivot of its current word into
    smaller, equal and larger; only the equal part goes on to the next word.
    All open groups are parted in the same pass; a group is closed, and never
    looked at again, once it is single or out of words.
    """
    n, depth = words.shape
    order, starts = np.arange(n), np.zeros(n, dtype=bool)
    starts[:1] = True
    start, size, level = np.array([0]), np.array([n]), np.array([0])
    while True:
        wide = (size > 1) & (level < depth)
        start, size, level = start[wide], size[wide], level[wide]
        if not len(start):
            return order, starts
        ends = np.cumsum(size)
        group = np.repeat(np.arange(len(start)), size)
        place = np.arange(ends[-1]) + np.repeat(start - ends + size, size)
        row = order[place]
        word = words[row, level[group]]
        three = np.sort(np.stack([word[ends - size], word[ends - size + size // 2], word[ends - 1]]), axis=0)
        pivot = three[1][group]
        part = group * 3 + np.where(word < pivot, 0, np.where(word == pivot, 1, 2))
        held = np.bincount(part, minlength=3 * len(start))
        order[place] = row[np.argsort(part, kind="stable")]
        first = np.repeat(start - ends + size, 3) + np.cumsum(held) - held
        starts[first[held > 0]] = True
        start, size, level = first, held, np.repeat(level, 3) + np.tile([0, 1, 0], len(level))


def deep_shallow(strings: list[bytes], width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and the common prefix of each with the one before it.

    Shallow: multikey quicksort by big-endian 8-byte words.  Deep: groups that
    agree to the shallow depth are ordered by blind tries.
    """
    n = len(strings)
    depth = min(width, shallow) // 8 * 8
    padded = np.frombuffer(b"".join(s[:depth].ljust(depth, b"\0") for s in strings), dtype=">u8").reshape(n, depth // 8)
    order, new = multikey_quicksort(padded.astype(np.uint64))
    if n:
        starts = np.flatnonzero(new)
        for start, end in zip(starts, [*starts[1:], n]):
            if end - start > 1:
                trie = BlindTrie(strings)
                for i in order[start:end]:
                    trie.add(int(i))
                order[start:end] = trie.ordered()
    prefix = np.array([0, *[common_prefix(strings[a], strings[b]) for a, b in zip(order[:-1], order[1:])]][:n], dtype=np.int64)
    return order, prefix


def repeated_offsets(contexts: list[bytes], before: np.ndarray, low: np.ndarray, high: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """For each context the offsets (bytes of the window before the anchor) whose window another context holds too.

    ``before`` is the place of the anchor in the context; its own windows have
    the offsets ``low .. high``.  Two windows are equal if they agree to the
    right and to the left of the anchor.
    """
    n = len(contexts)
    right = [c[b:] for c, b in zip(contexts, before.tolist())]
    left = [c[:b][::-1] for c, b in zip(contexts, before.tolist())]
    (by_right, prefix_r), (by_left, prefix_l) = deep_shallow(right, width), deep_shallow(left, width)
    out: list[list[int]] = [[] for _ in range(n)]
    for offset in range(int(low.min()), int(high.max()) + 1):
        owns = np.flatnonzero((low <= offset) & (offset <= high))
        if len(owns) < 2:
            continue
        r, l = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        r[by_right] = np.cumsum(prefix_r < width - offset)
        l[by_left] = np.cumsum(prefix_l < offset)
        pair = r[owns] * (n + 2) + l[owns]
        _, back, many = np.unique(pair, return_inverse=True, return_counts=True)
        for i in owns[many[back] > 1]:
            out[i].append(offset)
    return [np.array(o, dtype=np.int64) for o in out]


# ---- the jobs --------------------------------------------------------------

def _anchored(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(owner, place, first, last, anchor hash, context hash) of the texts of a batch."""
    told = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, raw = told.buffers()
    ends = np.frombuffer(ends, np.int64)[told.offset:told.offset + len(told) + 1] if len(told) else np.zeros(1, np.int64)
    found = anchors_of(np.frombuffer(raw or b"", np.uint8), ends)
    return *found[:4], found[4].view(np.int64), found[5].view(np.int64)


def _texts(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, name, text); ``name`` is the hash of the text."""
    return docs.select(F.col(id_).alias("id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("name"),
                       F.col(text).alias("text")).where(F.col("name").isNotNull())


def context_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(a, c, n, contexts): contexts of the anchor strings that occur more than once.

    Each batch adds up its own contexts before they are dealt by anchor string.
    """
    def kernel(batches):
        for batch in batches:
            a, c = _anchored(batch.column(0))[4:]
            order = np.lexsort((c, a))
            a, c = a[order], c[order]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (np.diff(a) != 0) | (np.diff(c) != 0)]))
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(c[first]), pa.array(np.diff(np.append(first, len(a))))], names=["a", "c", "n"])

    pairs = (docs.select(text).mapInArrow(kernel, "a long, c long, n long").repartition("a")
             .groupBy("a", "c").agg(F.sum("n").alias("n")))
    strings = pairs.groupBy("a").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("contexts")).where("total > 1")
    return pairs.join(strings.select("a", "contexts"), "a")


def found_anchors(texts: DataFrame, counts: DataFrame, id_kind: str) -> DataFrame:
    """(id, name, place, first, last, a, c, n, contexts): the anchors whose string occurs more than once."""
    layout = f"id {id_kind}, name binary, place int, first int, last int, a long, c long"

    def kernel(batches):
        for batch in batches:
            owner, *cells = _anchored(batch.column(2))
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), *[pa.array(x.astype(np.int32)) for x in cells[:3]], pa.array(cells[3]), pa.array(cells[4])],
                names=["id", "name", "place", "first", "last", "a", "c"])

    return texts.mapInArrow(kernel, layout).join(counts, ["a", "c"])


CONTEXT = "a long, name binary, place int, first int, last int, open boolean, context binary"


def read_contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of CONTEXT for the anchors in ``wanted`` (name, id, place, first, last, a, open, contexts)."""
    asked = wanted.groupBy("name", "id").agg(F.collect_set(F.struct("place", "first", "last", "a", "open", "contexts")).alias("asked"))
    joined = (texts.join(asked.withColumnRenamed("id", "rep"), "name").where(F.col("id").eqNullSafe(F.col("rep")))
              .select("name", "text", "asked"))

    def kernel(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode("utf-8", "surrogatepass")
                asked_ = batch.column(2)[i].as_py()
                name = batch.column(0)[i].as_py()
                cells = [[x[k] for x in asked_] for k in ("a", "place", "first", "last", "open", "contexts")]
                yield pa.RecordBatch.from_arrays([
                    pa.array(cells[0], pa.int64()), pa.array([name] * len(asked_), pa.binary()), *[pa.array(x, pa.int32()) for x in cells[1:4]],
                    pa.array(cells[4], pa.bool_()), pa.array([raw[x["first"]:x["last"] + WIDTH] for x in asked_], pa.binary()), pa.array(cells[5], pa.int64())],
                    names=["a", "name", "place", "first", "last", "open", "context", "contexts"])

    return joined.mapInArrow(kernel, CONTEXT + ", contexts long")


def _runs(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring offsets as (lowest, highest)."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > 1)
    return list(zip(offsets[np.append(0, cut + 1)].tolist(), offsets[np.append(cut, len(offsets) - 1)].tolist()))


def sorted_windows(contexts: DataFrame, rows: int = 8 * MANY) -> DataFrame:
    """(name, first, last): window starts of open contexts that another context of the same string holds.

    Contexts come sorted by their string; several strings are sorted together.
    """
    def solved(held: list[dict]):
        place, first, last = (np.array([x[k] for x in held], dtype=np.int64) for k in ("place", "first", "last"))
        found = repeated_offsets([x["context"] for x in held], place - first, place - last, place - first)
        out = [(x["name"], x["place"] - high, x["place"] - low) for x, o in zip(held, found) if x["open"] for low, high in _runs(o)]
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), *[pa.array([o[k] for o in out], pa.int32()) for k in (1, 2)]],
                                          names=["name", "first", "last"])

    def kernel(batches):
        held: list[dict] = []
        for batch in batches:
            for x in batch.to_pylist():
                if len(held) >= rows and x["a"] != held[-1]["a"]:
                    yield solved(held)
                    held = []
                held.append(x)
        if held:
            yield solved(held)

    return (contexts.repartition("a").sortWithinPartitions("a")
            .mapInArrow(kernel, "name binary, first int, last int"))


def dealt(contexts: DataFrame, step: int) -> DataFrame:
    """Contexts cut at multiples of ``step`` offsets, named by string, multiple and core."""
    def kernel(batches):
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                raw, before = x["context"], x["place"] - x["first"]
                for k in range((x["place"] - x["last"]) // step, before // step + 1):
                    low, high = max(k * step, x["place"] - x["last"]), min(k * step + step - 1, before)
                    core = raw[before - k * step:before - (k * step + step - 1) + WIDTH]
                    seed = (x["a"] * 1_000_003 + k) & ((1 << 63) - 1)
                    a = int.from_bytes(xxhash.xxh3_64_digest(core, seed), "big", signed=True)
                    out.append((a, x["name"], x["place"], x["place"] - high, x["place"] - low, x["open"], raw[before - high:before - low + WIDTH]))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(
                list(zip(*out)) or [[]] * 7, (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()))],
                names=["a", "name", "place", "first", "last", "open", "context"])

    cut = contexts.mapInArrow(kernel, CONTEXT)
    return cut.join(cut.groupBy("a").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1"), "a")


def repeated_windows(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The texts (id, name, text), and (name, first, last): starts of windows that occur elsewhere too."""
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "windows")
    texts = _texts(docs, id_, text)
    context_counts(docs, text).write.parquet(f"{base}/counts")
    counts = spark.read.parquet(f"{base}/counts")
    kind = docs.schema[id_].dataType.simpleString()
    found_anchors(texts, counts, kind).write.parquet(f"{base}/anchors")
    known = spark.read.parquet(f"{base}/anchors")
    whole = known.where("n > 1").select("name", "first", "last")
    several = known.where("contexts > 1")
    at = F.struct("name", "id", "place", "first", "last")
    wanted = (several.where("n = 1").select("name", "id", "place", "first", "last", "a", F.lit(True).alias("open"), "contexts")
              .unionByName(several.where("n > 1").groupBy("a", "c", "contexts").agg(F.min(at).alias("x"))
                           .select("x.*", "a", F.lit(False).alias("open"), "contexts")))
    left = read_contexts(texts, wanted)
    columns = ["a", "name", "place", "first", "last", "open", "context"]
    windows = whole.unionByName(sorted_windows(left.where(F.col("contexts") <= MANY).select(*columns)))
    for step in STEPS:
        left = dealt(left.where(F.col("contexts") > MANY).select(*columns), step)
        if step > 1:
            windows = windows.unionByName(sorted_windows(left.where(F.col("contexts") <= MANY).select(*columns)))
        else:  # the core is the window
            windows = windows.unionByName(left.where("open").select("name", "first", "last"))
    return texts, windows


def remove_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary): one row per row of ``docs``."""
    texts, windows = repeated_windows(docs, id_, text)
    spans = windows.groupBy("name").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cells: list[tuple] = []
                for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = (t or "").encode("utf-8", "surrogatepass")
                    if not found:
                        cells.append((len(raw), 0, 0, raw))
                        continue
                    change = np.zeros(len(raw) + 1, dtype=np.int32)
                    np.add.at(change, [x["first"] for x in found], 1)
                    np.add.at(change, [x["last"] + WIDTH for x in found], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    cells.append((len(raw), int(gone.sum()), n_spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([x[k] for x in cells], pa.int64()) for k in range(3)], pa.array([x[3] for x in cells], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (texts.join(spans, "name", "left").select("id", "text", "spans")
            .mapInArrow(kernel, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_))
