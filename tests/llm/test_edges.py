"""Empty tables, nulls, repeated rows and clashing columns for every operator and stage."""

import pytest
from helpers import SCHEMA, awkward_texts, documents

from oreline.llm import (deep_shallow, filter_audit, hamming, hyperplane, jump_shards, line_runs, merge_path, ordinal, packing, piece_viterbi,
                         quality_rules, secrets, surrogates)
from oreline.llm.queries import vocabulary

MODEL = ordinal.fit([], ordinal.np.zeros(0, dtype=int), 2)


def _matrix_rows(docs):
    shards = filter_audit.written(filter_audit.csr_shards(docs), "csr")
    return filter_audit.rows_of(filter_audit.encoded(shards, filter_audit.numbered(shards)))


OPERATORS = {
    "op1": lambda d: surrogates.pseudonymize(d, b"k"),
    "op2": lambda d: secrets.digest(secrets.findings(secrets.versions_of(d), secrets.scan(secrets.versions_of(d)))),
    "op2 redact": secrets.redact,
    "op4": quality_rules.judge,
    "op5": deep_shallow.remove_repeats,
    "op6": lambda d: piece_viterbi.checked(d, vocabulary("piece_bpe_32k.model")),
    "op7": line_runs.dedup,
    "op9": hamming.near_duplicates,
    "op9 survivors": hamming.survivors,
    "op10": lambda d: ordinal.score(d, MODEL),
    "op10 select": lambda d: ordinal.select(d, MODEL),
    "op3": lambda d: packing.pack(d, vocabulary()),
    "op11": lambda d: merge_path.alignment(d, vocabulary(), vocabulary("piece_bpe_32k.model")),
    "op12": _matrix_rows,
    "op12 audit": lambda d: filter_audit.audit(d, d.selectExpr("doc_id", "1 AS quality", "CAST(NULL AS INT) AS toxic")),
    "op13": jump_shards.shard,
    "op13 place": lambda d: jump_shards.place(d, 4),
}
FILTERS = {"op9 survivors": None, "op3": None, "op12 audit": None}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_null_and_repeated_ids_and_rows(spark, name):
    texts = awkward_texts()
    ids = [None, None, 3, 3, 3, 5, 5, 7, None, 9, 10, 11, 12, 13, 14, 15]
    docs = documents(spark, texts + texts[:3], ids + ids[:3])
    got = OPERATORS[name](docs)
    n = got.count()
    if name not in FILTERS:
        assert n == docs.count()
    assert n > 0


def test_only_rows_of_nulls(spark):
    docs = documents(spark, [None, None], [None, None])
    for name, operator in OPERATORS.items():
        assert operator(docs).count() == (600 if name == "op12 audit" else 2), name


def test_extra_columns_are_kept(spark):
    docs = documents(spark)
    for operator in (secrets.redact, hamming.survivors, lambda d: ordinal.select(d, MODEL)):
        assert operator(docs).columns == docs.columns
    assert line_runs.dedup(docs).columns[:-2] == docs.columns
    assert jump_shards.place(docs, 4).columns[:-2] == docs.columns
    assert surrogates.pseudonymize(docs, b"k").columns[:-1] == docs.columns


def test_hyperplane_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, key string, v int"
    empty = spark.createDataFrame([], schema)
    assert hyperplane.near_duplicates(empty).count() == 0
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 1), (None, [0.0, 1.0], 1),
            (None, [0.0, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    got = hyperplane.near_duplicates(spark.createDataFrame([(*r, "k", 0) for r in rows], schema)).collect()
    assert len(got) == len(rows)
    told = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert told[1] == (3, 1, True) and told[2] == (3, 1, False) and told[10] == (3, 1, False)
    assert told[None] == (1, None, True)
    for alone in (3, 4, 5, 6, 7, 8, 9, 12):
        assert told[alone] == (0, alone, True)


def test_pipeline_edges(spark, tmp_path):
    import corpus_pipeline
    labels = spark.createDataFrame([(5, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    texts = awkward_texts()
    for name, docs in (("empty", spark.createDataFrame([], SCHEMA)), ("odd", documents(spark, texts, [None, None, *range(2, len(texts))]))):
        now = docs
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = str(tmp_path / f"{name}{i}")
            stage(spark, now, str(tmp_path)).write.parquet(out)
            now = spark.read.parquet(out)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert now.columns == docs.columns
        assert (now.count() == 0) == (name == "empty")
