"""The registered text queries against their SQL, and the pipeline against brute force."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ballstats.llm import language_id, oracles, queries, toxicity
from tests.llm import test_jaccard_join, test_line_dedup, test_tokens
from tests.llm.helpers import SF_DIR, as_rows
from tests.llm.test_scoring import labels

KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


def test_one_query_per_operator():
    names = entry.text_query_names()
    assert names == {*queries.queries(), "pipeline"}
    assert sorted(int(name[2:].split("_")[0]) for name in names - {"pipeline"}) == list(range(1, 14))


# Queries that SQL cannot express, and the tests that hold their operators against brute force.
WITHOUT_SQL = {
    "op1_fingerprints": "test_fingerprints", "op2_packing": "test_tokens", "op3_line_dedup": "test_line_dedup",
    "op5_token_counts": "test_tokens", "op6_language_id": "test_scoring", "op7_sentencepiece": "test_tokens",
    "op9_toxicity": "test_scoring", "op11_fill_in_middle": "test_fill_in_middle", "op12_whitening": "test_whitening",
    "op13_vector_dedup": "test_vector_dedup", "pipeline": "test_queries",
}


def test_every_query_is_held_against_something():
    assert {*oracles.ORACLES, *WITHOUT_SQL} == entry.text_query_names()
    folder = Path(__file__).parent
    assert all((folder / f"{name}.py").exists() for name in WITHOUT_SQL.values())


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    want = con.execute(oracles.ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in want.description}
    found = queries.queries()[name](spark, str(SF_DIR))
    assert {n: KINDS[t] for n, t in found.dtypes} == kinds
    assert as_rows(found, *kinds) == sorted(want.fetchall(), key=repr)


def small_table(spark):
    """Few documents, with copies, near copies, repeated lines, gaps and a further column."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 90 and n_chars < 2500")
    extra = [(1000, "Released under one license of many lines\nown text", "en", "s", 49), (1001, "Released under one license of many lines!", "en", "s", 41)]
    extra += [(1002, None, None, None, None), (1003, "", "en", "s", 0), (1004, "12 34 !!", "en", "s", 8)]
    words = [f"haus{k % 26}{chr(97 + k % 7)}" for k in range(80)]
    extra += [(1010 + k, " ".join([*words[: 40 + k], f"other{k}", *words[41 + k :]]), "de", "s", 500) for k in range(3)]
    return docs.union(spark.createDataFrame(extra, docs.schema))


def test_pipeline(spark, tmp_path):
    docs = small_table(spark)
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language ID", "line dedup", "n-gram Jaccard join", "packing"]
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == inputs[name].columns
    inputs["end"] = docs
    content = {name: {row.doc_id: row.text for row in df.collect()} for name, df in inputs.items() if name != "end"}

    predicted = toxicity.toxicity(inputs["toxicity"], marks).where("predicted = 0").collect()
    assert set(content["language ID"]) == {row.doc_id for row in predicted}
    found = language_id.predicted(inputs["language ID"], language_id.fit(inputs["language ID"])).collect()
    assert set(content["line dedup"]) == {row.doc_id for row in found if row.lang_pred != "und" and row.score >= 0.5}
    assert not {1002, 1003, 1004} & set(content["line dedup"])

    given = content["line dedup"]
    first = {(i, k): (i, k) == (a, b) for i, k, a, b, _ in test_line_dedup.expected(sorted(given.items()))}
    want = {}
    for doc_id, text in given.items():
        keep = [x for k, x in enumerate(text.split("\n")) if first.get((doc_id, k), True) or len(x.encode()) < 24]
        if "\n".join(keep).strip(" "):
            want[doc_id] = "\n".join(keep)
    assert content["n-gram Jaccard join"] == want
    assert len(want) < len(given)

    groups = test_jaccard_join.expected(sorted(want.items()))
    left = {i for i, _, component in groups if i == component}
    assert content["packing"] == {i: want[i] for i in left}
    assert 1010 in left and not {1011, 1012} & left

    pieces = {}
    for row in inputs["end"].collect():
        pieces[row.doc_id] = pieces.get(row.doc_id, 0) + row.length
    assert pieces == {i: len(test_tokens.ids(want[i])) + 1 for i in left}


def test_run_gives_the_last_stage(spark, tmp_path):
    small_table(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(1, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    assert set(corpus_pipeline.run(spark, str(tmp_path)).columns) >= {"doc_id", "piece", "sequence_id", "offset"}


def test_pipeline_of_nothing(spark, tmp_path):
    small_table(spark).where("false").write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
