"""Registered queries against their SQL, and the pipeline against its stages run one by one."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as contract
import corpus_pipeline
from cartwright.llm import exact_dedup, importance, language, near_dedup, queries


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SMALL)


def test_one_query_per_operator():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, tables, name):
    assert compare.differences(queries.QUERIES[name](spark, SMALL), tables, queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_one_row_or_more_per_document(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    ids = {row.doc_id for row in found.select("doc_id").distinct().collect()}
    assert ids == {row.doc_id for row in queries.table(spark, SMALL, "documents").select("doc_id").collect()}


def test_language_is_right_on_the_held_out_third(spark):
    docs = queries.table(spark, SMALL, "documents").select("doc_id", "lang")
    held = queries.op6_language(spark, SMALL).filter("held_out").join(docs, "doc_id").collect()
    assert sum(row.lang == row.lang_pred for row in held) >= 0.95 * len(held)


def test_pipeline_is_its_stages_in_order(spark):
    docs = queries.table(spark, SMALL, "documents")
    labels = queries.table(spark, SMALL, "labels")
    columns = docs.columns
    known = {row.doc_id for row in language.identify(docs).filter("lang_pred <> 'und' and score >= 0.4").select("doc_id").collect()}
    kept = {}
    steps = iter(corpus_pipeline.STAGES)

    def step(docs):
        name, stage = next(steps)
        out = stage(spark, docs, SMALL).cache()
        kept[name] = {row.doc_id for row in out.select("doc_id").collect()}
        return out

    docs = step(docs)
    assert docs.columns == columns and kept["language ID"] == known
    wanted = {row.doc_id for row in importance.sample(docs, labels).filter("kept").collect()}
    docs = step(docs)
    assert docs.columns == columns and kept["quality classifier"] == wanted
    wanted = {row.doc_id for row in exact_dedup.decide(docs).filter("kept").collect()}
    docs = step(docs)
    assert docs.columns == columns and kept["exact dedup"] == wanted
    wanted = {row.doc_id for row in near_dedup.near_duplicates(docs, 5, 80).filter("kept").collect()}
    docs = step(docs)
    assert docs.columns == columns and kept["MinHash near-dedup"] == wanted
    packed = step(docs)
    assert kept["packing"] == wanted
    run = corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, packed.drop("sequence_id", "offset").collect()))
