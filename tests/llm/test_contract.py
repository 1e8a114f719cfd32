"""Queries of the corpus operators against DuckDB, and the pipeline end to end."""

import hashlib

import pytest

import corpus_pipeline
import oracle
from conftest import SMALL
from llm_fixtures import documents  # noqa: F401
from tickloom.llm import bpe
from tickloom.llm.queries import TOKENIZER, build_queries, build_sql

QUERIES, SQL = build_queries(), build_sql()


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert oracle.difference(QUERIES[name](spark, SMALL), oracle.connect(SMALL), SQL[name]) is None


@pytest.mark.parametrize("name", ["op1_sharding", "op7_license_scan"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_pipeline_stages(spark):
    """Each stage against a plain computation on what it was given."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(spark.createDataFrame(stage(spark, frames[-1], SMALL).collect(), docs.schema))
        assert frames[-1].columns == docs.columns
    given, good, single, mixed = ([r for r in f.collect()] for f in frames)
    scores = {r.doc_id: r.predicted for r in QUERIES["op9_quality_classifier"](spark, SMALL).collect()}
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in given if scores[r.doc_id] == 1)

    words = lambda text: (text or "").encode().lower().split()
    sets = {r.doc_id: frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
            for r in good if (w := words(r.text))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    expected = sorted(i for i in {r.doc_id for r in good} if i not in sets or find(i) == i)
    assert sorted(r.doc_id for r in single) == expected

    texts = {r.doc_id: r.text for r in single}
    assert sum(len(words(r.text)) for r in mixed) == pytest.approx(
        sum(len(words(t)) for t in texts.values()), rel=0.05)
    # Whole documents, but for one that is longer than its source's target.
    assert all(texts[r.doc_id] == r.text for r in mixed if len(words(texts[r.doc_id])) < 1000)
    assert sum(texts[r.doc_id] != r.text for r in mixed) <= len({r.source for r in mixed})
    tokenizer = bpe.ByteBPE(TOKENIZER)
    encoded = corpus_pipeline.STAGES[-1][1](spark, frames[-1], SMALL).collect()
    row = lambda ids, t: (len(ids), hashlib.sha256(t.encode()).hexdigest())
    assert sorted((e.doc_id, e.n_tokens, e.decoded_sha256) for e in encoded) == sorted(
        (r.doc_id, *row(tokenizer.encode(r.text), r.text)) for r in mixed)


def test_pipeline_of_an_empty_table(spark, documents, tmp_path):
    documents().write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, documents, tmp_path):
    """Nulls in every column, empty texts and repeated rows."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " end"), (3, None), (None, "alone and free of id here"), (4, ""), (5, "x", None)]
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    # 2 is a near copy of 1, whose rows are one document; 3 and 4 have no words to mix.
    assert set(found) <= {1, None, 5} and 1 in found


def test_near_duplicates_go_row_by_row(spark, documents):
    """Repeated ids with different texts, copies without ids: one row of each group stays, in any order of the input."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (None, c), (None, c + " end"), (None, c), (4, None), (None, ""),
            (5, "end"), (5, "end")]
    for given in (rows, rows[::-1]):
        kept = corpus_pipeline.drop_near_duplicates(spark, documents(*given), SMALL).collect()
        assert sorted((str(r.doc_id), (r.text or "")[:2]) for r in kept) == sorted(
            [("1", "a0"), ("1", "b0"), ("None", "c0"), ("4", ""), ("None", ""), ("5", "en")])
