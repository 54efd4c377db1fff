"""Every operator and pipeline stage on awkward rows: nulls, empty and very
long texts, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from studylake.llm import byte_cnn, lattice, licenses, minhash, mixing, packing, pii, quality_rules, secrets, sharding

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, kept boolean, piece int, labels string, shard int, s string, id long, key long")
LONG = " ".join(f"word{i % 997} of line {i}." for i in range(20_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from here today", "en", "a", 3),
    (1, "the quick brown fox jumps over the lazy dog and runs away from here today", "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", None, 4),
    (5, LONG, "en", "b", 10),
    (6, "password = \"abcdefgh1234\" mail bob@example.com under the MIT License", None, "b", None),
    (7, "ünïcode 日本語 🙂 text — with ÉCLAIR", "fr", "b", 1),
    (None, "the quick brown fox jumps over the lazy dog and runs away from here today", "en", "a", 3),
    (None, None, None, None, None),
]
FILL = (9, True, 4, "x", 2, "y", 5, 6)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *FILL) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, None, None), (None, 1, 1), (6, 0, 0), (6, 0, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")


PER_ROW = {
    "sharding": lambda d, _: sharding.shard(d),
    "mixing": lambda d, _: mixing.mix(d),
    "licenses": lambda d, _: licenses.scan(d),
    "minhash": lambda d, _: minhash.near_duplicates(d),
    "byte_cnn": lambda d, labels: byte_cnn.classify(d, labels),
    "secrets": lambda d, _: secrets.report(d),
    "quality_rules": lambda d, _: quality_rules.judge(d),
    "pii": lambda d, _: pii.report(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_input_row(name, docs, empty, labels):
    rows = PER_ROW[name](docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    out = PER_ROW[name](empty, labels)
    assert out.count() == 0 and "doc_id" in out.columns


def test_packing(docs, empty):
    rows = packing.pack(docs).collect()
    assert {str(r["doc_id"]) for r in rows} == {str(r[0]) for r in ROWS}
    assert sum(r["piece"] == 0 for r in rows) == len(ROWS)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, stage, docs, empty):
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    out.collect()
    none = stage(spark, empty, "")
    assert none.columns == docs.columns and none.count() == 0


def test_stage_decisions(spark, docs):
    kept = {r["doc_id"] for r in corpus_pipeline.quality_stage(spark, docs, "").collect()}
    assert kept <= {1, None} | {5} and 1 in kept
    masked = {r["doc_id"]: r for r in corpus_pipeline.secrets_stage(spark, docs, "").collect()}
    assert "[SECRET]" in masked[6]["text"] and "abcdefgh1234" not in masked[6]["text"]
    assert masked[6]["n_chars"] == len(masked[6]["text"])
    assert masked[5]["text"] == LONG and masked[2]["text"] is None


def test_embeddings(spark):
    one, near, other = [1.0, 0.0, 0.5], [1.0, 0.01, 0.5], [0.0, 1.0, 0.0]
    rows = [(1, one), (2, near), (3, other), (4, one), (5, None), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]),
            (8, [float("nan"), 0.0, 0.0]), (9, [float("inf"), 0.0, 0.0]), (10, []), (None, one), (11, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 3, True) for r in rows], "vec_id long, embedding array<float>, n_links int, kept boolean")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_duplicates(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[4] == (2, 1, False)
    assert got[None] == (0, None, False)
    assert all(got[i] == (0, i, True) for i in (3, 5, 6, 7, 8, 9, 10, 11))
    assert lattice.near_duplicates(df.limit(0)).count() == 0
