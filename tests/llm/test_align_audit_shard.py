"""Alignment of tokenizers, audit of filters and sharding against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from helpers import SCHEMA, awkward_texts, documents, sentence

from oreline.llm import filter_audit, jump_shards, merge_path
from oreline.llm.queries import vocabulary

A, B, RANKS = vocabulary(), vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.tiktoken")


# ---- op11 ------------------------------------------------------------------

def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = merge_path.byte_letters()

    def spans(ids, spelled):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(spelled(i)), i))
            at += len(spelled(i))
        return out

    def spell_a(i):
        word = a.id_to_token(i)
        return bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()

    def spell_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for t in texts:
        ia = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ib = b.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        if not t or b"".join(map(spell_a, ia)) != whole or b"".join(map(spell_b, ib)) != whole:
            ia, ib = [], []
        sa, sb = spans(ia, spell_a), spans(ib, spell_b)
        links = [(x[2], y[2]) for x in sa for y in sb if x[1] == y[1]] if len(sa) < 3000 else None
        if links is None:
            by_end = {y[1]: y[2] for y in sb}
            links = [(x[2], by_end[x[1]]) for x in sa if x[1] in by_end]
        ends = {x[1] for x in sa} & {y[1] for y in sb}
        groups, ga, gb = [], {}, {}
        for e in sorted(ends):
            groups.append(e)
        edges = np.array(sorted(ends))
        for x in sa:
            ga.setdefault(int(np.searchsorted(edges, x[1])), []).append(str(x[2]))
        for y in sb:
            gb.setdefault(int(np.searchsorted(edges, y[1])), []).append(str(y[2]))
        told = ";".join(",".join(ga[k]) + "|" + ",".join(gb[k]) for k in range(len(groups)))
        docs.append((len(ia), len(ib), len(groups), links, hashlib.sha256(told.encode()).hexdigest() if ia else ""))
    count = Counter(p for d in docs for p in d[3])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(na, nb, ng, len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls), sha) for na, nb, ng, ls, sha in docs]


def odd_texts():
    rng = random.Random(3)
    return awkward_texts() + ["<|endoftext|> and <s> </s> <unk> <0x41>", "▁ mark", " leading", "  two  spaces ", "tab\tand\r\nline\n\n", "日本語のテキスト、漢字",
                              "\U0001F469‍\U0001F467 emoji", "ﬁ ligature ½ é", "x" * 5000, " " * 300, sentence(rng, 20_000), "a\x00b", "a" * 3 + "é" * 50]


@pytest.mark.parametrize("work", [1, 2, 7, merge_path.WORK])
def test_alignment_is_that_of_all_pairs(spark, work):
    texts = odd_texts() if work == merge_path.WORK else odd_texts()[:20]
    got = {r.doc_id: tuple(r)[1:] for r in merge_path.alignment(documents(spark, texts), A, B, RANKS, shard_bytes=4000, work=work).collect()}
    assert [got[i] for i in range(len(texts))] == plain_alignment(texts)
    assert any(g[0] == 0 for g in got.values()) and any(g[3] > g[4] > 0 for g in got.values())


def test_alignment_needs_no_ranks(spark):
    docs = documents(spark, odd_texts()[:24])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(merge_path.alignment(docs, A, B)) == rows(merge_path.alignment(docs.repartition(3), A, B, RANKS))


@pytest.mark.parametrize("seed", range(4))
def test_merge_path(seed):
    rng = np.random.default_rng(seed)
    for na, nb in ((0, 0), (0, 5), (5, 0), (1, 1), (40, 60), (300, 20)):
        a, b = [np.sort(rng.choice(400, n, replace=False)) for n in (na, nb)]
        for work in (1, 3, 16, 1000):
            i, j = merge_path.diagonals(a, b, work)
            merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
            for x, y in zip(i, j):
                assert sum(1 - m[1] for m in merged[:x + y]) == x
            assert set(np.diff(i + j)[:-1]) <= {work} and (i[-1], j[-1]) == (na, nb)
            x, y = merge_path.common_ends(a, b, work)
            want, wx, wy = np.intersect1d(a, b, return_indices=True)
            assert x.tolist() == wx.tolist() and y.tolist() == wy.tolist()


# ---- op12 ------------------------------------------------------------------

def plain_audit(docs, labels):
    """``docs``: (id, text, lang); ``labels``: (id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and first[t] < i)) if bad}
        rows.append((lang or "", failed, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, removed = [r for r in rows if r[0] == part], {}
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                alive = [r for r in own if not r[1] & set(order[:k])]
                gone = [r for r in alive if f in r[1]]
                removed[f] = removed.get(f, 0) + len(gone)
                out.append([part, "".join(order), k + 1, len(alive) - len(gone), len(gone), sum(f in r[1] for r in own) - len(gone),
                            sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f])
        for o in out:
            if o[0] == part:
                o[-1] = removed[o[-1]]
    return sorted(map(tuple, out))


def test_audit_is_that_of_a_plain_one(spark):
    rng = random.Random(5)
    texts = awkward_texts() + [sentence(rng, 150) for _ in range(5)] + [" ".join(f"w{k}" for k in range(n)) for n in (99, 100, 101, 300)]
    texts += ["A" + "b" * 9, "A" + "b" * 8, "Ä" + "é" * 9 + "B", "a|b", "price $5", "a\x0bb\x0cc\x1cd\x85e f", " ".join(["same"] * 21 + [f"v{k}" for k in range(79)])]
    rows = [(rng.choice([None, *range(60)]), t, rng.choice(["en", None, "", "de"])) for t in texts * 4]
    rows += [(7, texts[20], "en"), (7, texts[20], "en"), (7, texts[20], "de"), (None, texts[20], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 40), *range(0, 10), 99, None, None]]
    docs = spark.createDataFrame([(i, t, lang, "s", 0, "id", "name", "key") for i, t, lang in rows], SCHEMA)
    marks = spark.createDataFrame([(*x, "part") for x in labels], "doc_id long, quality int, toxic int, part string")
    for shard_bytes in (1, 5000, filter_audit.SHARD_BYTES):
        shards = filter_audit.written(filter_audit.csr_shards(docs.repartition(3), shard_bytes=shard_bytes), "csr")
        matrix = filter_audit.rows_of(filter_audit.encoded(shards, filter_audit.numbered(shards, 40)))
        got = filter_audit.interactions(filter_audit.failure_counts(matrix, marks)).collect()
        assert sorted(map(tuple, got)) == plain_audit(rows, labels)
    assert sorted(map(tuple, filter_audit.audit(docs, marks).collect())) == plain_audit(rows, labels)


@pytest.mark.parametrize("range_words", [1, 30, filter_audit.RANGE_WORDS])
def test_matrix_is_that_of_a_global_dictionary(spark, range_words):
    texts = awkward_texts()
    shards = filter_audit.written(filter_audit.csr_shards(documents(spark, texts).repartition(4), shard_bytes=500), "csr")
    numbers = filter_audit.written(filter_audit.numbered(shards, range_words), "numbers")
    told = {bytes(r.word): r.column for r in filter_audit.dictionary(shards, numbers).collect()}
    assert set(told) == {w for t in texts for w in (t or "").encode().split()}
    number = {v: k for k, v in told.items()}
    assert len(number) == len(told)
    for r in filter_audit.encoded(shards, numbers).collect():
        starts, columns, counts = [np.frombuffer(x, "<i8") for x in (r.starts, r.columns, r.counts)]
        for k, i in enumerate(r.ids):
            row = {number[c]: n for c, n in zip(columns[starts[k]:starts[k + 1]], counts[starts[k]:starts[k + 1]])}
            assert row == Counter((texts[i] or "").encode().split())


def test_a_dictionary_is_one_value(spark):
    """Shards carry their words, and the ranges their parts, without an element per word; empty dictionaries have no parts."""
    texts = ["b a\x1cc é\x85 a", None, " \t\x0b", "", "z"]
    shards = filter_audit.written(filter_audit.csr_shards(documents(spark, texts).coalesce(1), shard_bytes=1), "csr")
    assert shards.schema["words"].dataType.simpleString() == "binary"
    assert sorted((r.own, set(bytes(r.words).split(b" "))) for r in shards.where("own > 0").collect()) == [
        (1, {b"z"}), (4, {"a".encode(), b"b", b"a\x1cc", "é\x85".encode()})]
    assert {bytes(r.words) for r in shards.where("own = 0").collect()} <= {b""}
    assert filter_audit.numbered(shards.where("own = 0")).count() == 0
    numbers = filter_audit.written(filter_audit.numbered(shards, 1), "numbers")
    assert numbers.count() <= 5
    rows = filter_audit.encoded_rows(shards, numbers)
    assert sorted(map(str, rows.collect())) == sorted(map(str, filter_audit.rows_of(filter_audit.encoded(shards, numbers)).collect()))


# ---- op13 ------------------------------------------------------------------

def plain_jump(key, n):
    mask, x = (1 << 64) - 1, key & ((1 << 64) - 1)
    for shift, factor in jump_shards.MIX:
        x = ((x ^ (x >> shift)) * factor) & mask
    b, j = -1, 0
    while j < n:
        b = j
        x = (x * 2862933555777941757 + 1) & mask
        j = int((b + 1) * (float(1 << 31) / float((x >> 33) + 1)))
    return b


def test_jump_is_the_published_function():
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, *range(100, 400), *random.Random(1).sample(range(2 ** 62), 200)]
    packed = jump_shards.mixed(np.array(keys, dtype=np.int64).view(np.uint64))
    for counts in ((1, 2), (8, 9), (1000, 1001)):
        for n, got in zip(counts, jump_shards.jump(packed, *counts)):
            assert got.tolist() == [plain_jump(k, n) for k in keys]


def test_growth_moves_only_into_the_new_shard(spark):
    rows = jump_shards.place(spark.range(20_000).withColumnRenamed("id", "doc_id"), 8).collect()
    sizes = Counter(r._op13_shard for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.1 * 2500
    moved = [r for r in rows if r._op13_shard != r._op13_grown]
    assert {r._op13_grown for r in moved} == {8} and abs(len(moved) - 20_000 / 9) < 0.1 * 20_000 / 9


def test_shards_of_awkward_rows(spark, monkeypatch):
    texts = awkward_texts()
    ids = [None, None, 3, 3, 3, 5, 5, 7, None, -9, 10, 11, 12, 13, 14, 2 ** 62]
    docs = documents(spark, texts * 3, ids * 3)
    monkeypatch.setattr(jump_shards.slots, "__defaults__", ("slot", 5))
    got = jump_shards.shard(docs).collect()
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids * 3, texts * 3))
    for r in got:
        assert (r.law, r["shard"], r.grown_shard) == ("key", plain_jump(r.doc_id or 0, 8), plain_jump(r.doc_id or 0, 9))
    for k in {r["shard"] for r in got}:
        own = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r["shard"] == k)
        assert [o[0] for o in own] == list(range(len(own))) and [o[1:] for o in own] == sorted(o[1:] for o in own)


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = documents(spark).withColumnRenamed("name", "_op13_other")
    jump_shards.write(docs, str(tmp_path / "out"), shards=3, id_="doc_id", files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == [*docs.columns, "shard"] and back.count() == docs.count()
    assert all(r["shard"] == plain_jump(r.doc_id, 3) for r in back.collect())
    texts = spark.createDataFrame([("a",), ("b",), (None,)], "doc_id string")
    assert {r._op13_shard for r in jump_shards.place(texts, 1).collect()} == {0}
