"""The pipeline's stages and the registered queries, against plain versions of each."""

import compare
import pytest
import rows as plain
from pyspark.sql import functions as F
from test_llm_decontam import normal
from test_llm_mixing import slow_mix
from test_llm_simhash import slow_components, slow_fingerprint
from test_llm_substring import brute

import __spark_entry__ as entry_point
import corpus_pipeline
from flightlake.llm import langid, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage, in order."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "mixture":
            assert after.schema.names == docs.schema.names
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        rows = after.collect()
        out[name] = (docs.collect(), rows)
        docs = spark.createDataFrame(rows, after.schema)
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_are_the_dealt_ones(stages):
    assert list(stages) == [
        "language",
        "near_duplicates",
        "repeated_passages",
        "benchmark_free",
        "mixture",
    ]


def test_language_drops_only_rejected_documents(spark, stages):
    before, after = stages["language"]
    docs = spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema)
    model = langid.fit(docs, corpus_pipeline.remainder("doc_id", 5) != 0)
    judged = langid.identify(docs, model).collect()
    assert ids(after) == sorted(r.doc_id for r in judged if not r.rejected)
    assert len(after) > 0.97 * len(before)


def test_near_duplicates_keep_the_least_of_each_group(stages):
    before, after = stages["near_duplicates"]
    marks = {r.doc_id: slow_fingerprint(r.text) for r in before}
    groups = slow_components(sorted(set(marks.values())))
    least = {}
    for doc, mark in marks.items():
        root = groups.find(mark)
        least[root] = min(doc, least.get(root, doc))
    assert ids(after) == sorted(least.values())


def test_repeated_passages_are_cut(stages):
    before, after = stages["repeated_passages"]
    expected = {int(i): (n, gone) for i, n, gone, _ in brute([(r.doc_id, r.text) for r in before])}
    texts = {r.doc_id: r.text for r in before}
    left = {r.doc_id: r for r in after}
    assert set(left) == {i for i, (n, gone) in expected.items() if not gone or gone < n}
    for i, r in left.items():
        n, gone = expected[i]
        assert len(plain.words(r.text)) == n - gone
        assert gone or r.text == texts[i]
        if gone:
            assert r.n_chars == len(r.text)


def test_benchmark_items_are_gone(spark, stages):
    before, after = stages["benchmark_free"]
    items = [f" {normal(r.text)} " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in before if any(i in f" {normal(r.text)} " for i in items)}
    assert held and ids(after) == sorted({r.doc_id for r in before} - held)


def test_mixture(spark, stages):
    before, after = stages["mixture"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    best = {}
    for r in labels:
        best[r.doc_id] = max(best.get(r.doc_id, 0), r.quality)
    weights = {i: 2.0 if q >= 1 else 0.5 for i, q in best.items()}
    expected = slow_mix([(r.doc_id, r.text, r.source) for r in before], weights)
    taken = sorted(e for e in expected if e[-1] > 0)
    got = sorted(
        (str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in after if r.taken
    )
    assert got == taken


def test_run_applies_all_stages(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, stages["mixture"][1]))


NAMES = ["size", "block", "kept_hash", "score", "n_words", "n_removed", "rejected", "row", "value"]


@pytest.mark.parametrize("texts", [[], ["a b", None, "", " \n", "a b", "é " * 30_000, "one two three four five"]])
def test_odd_documents_pass_every_stage(spark, texts):
    """Nulls in any column, empty and long texts, repeated rows, no rows, clashing columns."""
    ids = [None if i == 1 else i % 5 for i in range(len(texts))]
    docs = plain.documents(spark, texts, ids=ids, lang=[None] * len(texts))
    docs = docs.withColumns({n: F.lit("own") for n in NAMES})
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        if name != "mixture":
            assert docs.columns == before.columns
            assert all(r[n] == "own" for r in docs.collect() for n in NAMES)
    assert docs.count() <= len(texts)


def test_one_query_for_each_operator():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert names == [f"op{i}" for i in range(1, 11)]
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(entry_point.queries())
    assert "pipeline" in entry_point.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    found = compare.spark_rows(queries.QUERIES[name](spark, SF))
    assert found == compare.oracle_rows(compare.connect(SF), queries.ORACLES[name])


COLUMNS = {
    "op2_lm_score": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op3_toxicity": {"doc_id", "severity", "grade", "toxic"},
    "op4_language": {"doc_id", "held_out", "lang_pred", "score", "rejected"},
    "op5_simhash": {"doc_id", "fingerprint", "component_id"},
    "op8_html_text": {"page_id", "url", "text", "n_chars"},
    "op10_substring": {"doc_id", "n_words", "n_removed", "kept_sha256"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_return_a_row_for_every_input_row(spark, name):
    source = "pages" if name == "op8_html_text" else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    got = queries.QUERIES[name](spark, SF)
    assert set(got.columns) == COLUMNS[name]
    expected = spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()
    assert sorted(r[key] for r in got.collect()) == sorted(r[key] for r in expected)
