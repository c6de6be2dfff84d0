"""SentencePiece-style encoding and decoding by Aho-Corasick and Viterbi.

The pieces of a vocabulary form an Aho-Corasick automaton.  One pass over a
text yields, at each place, every piece that ends there (the automaton follows
its output links); each relaxes the best score at that place.  Characters that
no piece covers fall back to their UTF-8 bytes, at a penalty below every piece.
Of equal scores the longer last piece wins.

A space becomes the mark U+2581, and one mark is put in front of the text.  In
the usual vocabularies a mark only starts a piece, so texts are cut before runs
of marks and each part is solved once and looked up when met again; a
vocabulary with other pieces is solved in whole texts.  A mark in the text
itself is spelled by its bytes, so decoding gives back every text exactly.

Defined results: a null text gives null ids and decodes to null; the empty text
has no ids; rows are taken one by one, so ids may be null or repeated; an empty
table gives an empty table.  Only the named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CACHE = 200_000
LONG = 48
PENALTY = 10.0
#: Pieces with scores down here are reserved by their vocabulary; they take the lowest ordinary score.
RESERVED = -1e8


class Pieces:
    """A vocabulary: the automaton, scores, byte ids and the bytes of every id."""

    def __init__(self, entries: list[tuple[str, float, str]]):
        """``entries``: (piece, score, kind) by id; kind is "piece", "byte" or "other"."""
        import ahocorasick
        self.automaton, self.byte_ids, self.spelled = ahocorasick.Automaton(), {}, []
        usable = []
        lowest = min((score for _, score, kind in entries if kind == "piece" and score > RESERVED), default=0.0)
        for i, (piece, score, kind) in enumerate(entries):
            if kind == "byte":
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.spelled.append(bytes([value]))
            else:
                self.spelled.append(piece.replace(MARK, " ").encode() if kind == "piece" else b"")
            if kind == "piece" and piece:
                usable.append(piece)
                self.automaton.add_word(piece, (i, len(piece), max(score, lowest)))
        self.automaton.make_automaton()
        self.sizes = [len(p) for p, _, _ in entries]
        self.unknown = lowest - PENALTY
        self.parts = all(MARK not in p.lstrip(MARK) for p in usable)
        self.known: dict[str, tuple[bytes, float]] = {}

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"
        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())])

    def best(self, text: str, stand_in: str = "") -> tuple[bytes, float]:
        """Ids (little-endian 32-bit) and score of the best segmentation; ``stand_in`` is spelled as a mark."""
        n, sizes, unknown = len(text), self.sizes, self.unknown
        score, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        done = 0
        for end, (i, size, value) in self.automaton.iter(text):
            while done < end:  # places before this one are settled: a character alone may still be best
                done += 1
                if score[done - 1] + unknown > score[done]:
                    score[done], back[done] = score[done - 1] + unknown, -1
            at = end + 1
            new = score[at - size] + value
            if new > score[at] or (new == score[at] and back[at] != -1 and size > sizes[back[at]]):
                score[at], back[at] = new, i
        while done < n:
            done += 1
            if score[done - 1] + unknown > score[done]:
                score[done], back[done] = score[done - 1] + unknown, -1
        ids, at = [], n
        while at:
            i = back[at]
            if i == -1:
                char = MARK if text[at - 1] == stand_in else " " if text[at - 1] == MARK else text[at - 1]
                ids.extend(self.byte_ids[b] for b in reversed(char.encode("utf-8", "surrogatepass")))
                at -= 1
            else:
                ids.append(i)
                at -= sizes[i]
        return np.array(ids[::-1], dtype="<i4").tobytes(), score[n]

    def encode(self, text: str) -> tuple[bytes, float]:
        if not text:
            return b"", 0.0
        if MARK in text:  # a character that the text lacks stands in for its own marks
            stand_in = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in text)
            return self.best(MARK + text.replace(MARK, stand_in).replace(" ", MARK), stand_in)
        marked = MARK + text.replace(" ", MARK)
        if not self.parts:
            return self.best(marked)
        if MARK * 2 in marked:
            parts = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked)
        else:
            parts = [MARK + w for w in marked[1:].split(MARK)]
        out, total, known = [], 0.0, self.known
        for part in parts:
            found = known.get(part)
            if found is None:
                found = self.best(part)
                if len(part) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[part] = found
            out.append(found[0])
            total += found[1]
        return b"".join(out), total

    def decode(self, ids) -> str:
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


def _lists(rows: list[bytes | None]) -> pa.Array:
    flat = np.frombuffer(b"".join(r or b"" for r in rows), dtype="<i4")
    ends = np.cumsum([0, *[len(r or b"") // 4 for r in rows]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([r is None for r in rows], pa.bool_()))


def encode(docs: DataFrame, model: str, id_: str = "doc_id", text: str = "text", rows: int = 256) -> DataFrame:
    """(id, ids array<int>, score): one row per row of ``docs``."""
    return checked(docs, model, id_, text, rows).drop("exact")


def checked(docs: DataFrame, model: str, id_: str = "doc_id", text: str = "text", rows: int = 256) -> DataFrame:
    """(id, ids, score, exact): encoded, decoded again, and compared; null texts compare as exact."""
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        pieces = Pieces.load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = [(None, None) if t is None else pieces.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64()),
                                                  pa.array([f[0] is None or pieces.decode(np.frombuffer(f[0], "<i4").tolist()) == t
                                                            for f, t in zip(found, part.column(1).to_pylist())])],
                                                 names=["id", "ids", "score", "exact"])

    return (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
            .mapInArrow(kernel, f"id {kind}, ids array<int>, score double, exact boolean").withColumnRenamed("id", id_))


def decode(encoded: DataFrame, model: str, id_: str = "doc_id", ids: str = "ids", rows: int = 256) -> DataFrame:
    """(id, text): the texts back from their ids; an id outside the vocabulary fails."""
    kind = encoded.schema[id_].dataType.simpleString()

    def kernel(batches):
        pieces = Pieces.load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([None if x is None else pieces.decode(x) for x in part.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return (encoded.select(F.col(id_).alias("id"), F.col(ids).alias("ids"))
            .mapInArrow(kernel, f"id {kind}, text string").withColumnRenamed("id", id_))
