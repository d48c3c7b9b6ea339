import numpy as np
import pyarrow as pa
import pytest
import rows as plain
from pyspark.sql import functions as F

from flightlake.llm import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def judged(spark):
    """Documents held out by id, graded by a model of the others, with their labels."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.col("doc_id") % 5 == 0
    model = toxicity.fit(docs, labels.filter(~held))
    graded = toxicity.grade(docs.filter(held), model, keep_text=False)
    return graded.join(labels.filter("toxic is not null"), "doc_id").select(
        graded["doc_id"], "severity", "grade", graded["toxic"].alias("said"), labels["toxic"].alias("is")
    ).toPandas()


def test_held_out_toxic_documents_are_caught_and_clean_ones_left(judged):
    bad, clean = judged[judged["is"] == 1], judged[judged["is"] == 0]
    assert len(bad) > 50
    assert bad["said"].mean() > 0.85
    assert clean["said"].mean() < 0.01


def test_severity_is_ordered(judged):
    means = judged.groupby("grade")["severity"].mean()
    assert means.is_monotonic_increasing
    assert judged["severity"].between(0, toxicity.GRADES - 1).all()


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(3)
    x = rng.random((600, 2))
    grade = np.digitize(3 * x[:, 0] + 0.3 * rng.standard_normal(600), [1, 2])
    weights, thresholds = toxicity.fit_ordinal(x, grade, 3)
    assert (np.diff(thresholds) > 0).all()
    assert weights[0] > 5 * abs(weights[1])
    over = toxicity.above(x @ weights, thresholds)
    assert (over[:, 0] >= over[:, 1]).all()
    assert np.corrcoef(over.sum(axis=1), grade)[0, 1] > 0.85


def test_counts_of_features_are_exact():
    texts = pa.array(["Idiot idiots, IDIOT!", None, "", "stupidity"])
    features, owners, words = toxicity.word_features(texts)
    chosen = np.unique(features)
    rows, at, counts, again = toxicity.chosen_counts(texts, chosen)
    assert list(words) == [3, 0, 0, 1] and list(again) == list(words)
    expected = {}
    for f, o in zip(features.tolist(), owners.tolist(), strict=True):
        expected[o, f] = expected.get((o, f), 0) + 1
    assert {(r, int(chosen[a])): c for r, a, c in zip(rows, at, counts, strict=True)} == expected


def test_no_labels_repeats_nulls_and_clashes(spark):
    docs = plain.documents(spark, ["idiot scum", None, "", "kind"] * 2, ids=[1, 2, 3, 4] * 2)
    schema = "doc_id long, toxic int, text string"
    for labels in ([], [(1, None, "x")], [(1, 1, "x")], [(None, 1, "x"), (4, 0, "x")]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, schema))
        got = toxicity.grade(docs.withColumn("grade", F.lit("own")), model).collect()
        assert len(got) == 8 and not any(r.toxic for r in got)
    assert toxicity.grade(docs.limit(0), model).collect() == []
    bad = [(10 + i, "idiot scum word" if i < 40 else "kind word") for i in range(80)]
    few = spark.createDataFrame(bad, "doc_id long, text string")
    labels = few.select("doc_id", (F.col("doc_id") < 50).cast("int").alias("toxic"))
    model = toxicity.fit(few, labels.unionByName(labels))
    got = {r.doc_id: r.toxic for r in toxicity.grade(docs, model).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_sample_is_bounded(spark):
    few = spark.range(200).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "idiot").otherwise("kind").alias("text")
    )
    labels = few.select("doc_id", (F.col("doc_id") < 100).cast("int").alias("toxic"))
    sampled = toxicity._sampled(few, labels, "text", "doc_id", "toxic", 30)
    assert {r["bad"]: r["count"] for r in sampled.groupBy("bad").count().collect()} == {True: 30, False: 30}


def test_hundreds_of_rare_insults_are_learned(spark):
    rng = np.random.default_rng(7)

    def words(n):
        return ["".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(n)]

    insults, plain_words = words(300), words(500)
    texts = []
    for i in range(7200):
        text = list(rng.choice(plain_words, 30))
        if i % 2:
            text[5] = insults[i // 2 % 300]
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = docs.filter("doc_id < 6000")
    labels = known.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = toxicity.grade(docs.filter("doc_id >= 6000"), toxicity.fit(known, labels)).toPandas()
    assert got[got["doc_id"] % 2 == 1]["toxic"].mean() > 0.9
    assert got[got["doc_id"] % 2 == 0]["toxic"].mean() < 0.02


def test_a_small_table_of_labels_is_enough_for_a_perfect_word(spark):
    rows = [(i, "you idiot there" if i < 6 else "you there") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 6).cast("int").alias("toxic"))
    got = toxicity.grade(docs, toxicity.fit(docs, labels)).collect()
    assert all(r.toxic == (r.doc_id < 6) for r in got)


def test_equal_evidence_has_one_grade():
    assert toxicity.grades_of(np.array([5.0, 1, 1, 1, 9, 1]), 4).tolist() == [3, 1, 1, 1, 3, 1]
    assert toxicity.grades_of(np.arange(9.0)[::-1], 4).tolist() == [3, 3, 3, 2, 2, 2, 1, 1, 1]
    assert toxicity.grades_of(np.ones(5), 4).tolist() == [1] * 5


def test_severity_matches_plain_sums_over_thresholds(judged, spark):
    """Scores feature by feature, probabilities threshold by threshold."""
    import math

    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    hashes = {}
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        hashes[word] = toxicity_words(data)
    order = sorted(words, key=hashes.__getitem__)
    features = np.array([hashes[w] for w in order], np.uint64)
    weights = rng.normal(size=len(words))
    model = toxicity.Model(features, weights, np.array([0.2, 1.0, 2.5]))
    texts = ["alpha beta", "gamma gamma other", "", None, "delta " * 40, "nothing known"]
    got = {r.doc_id: r for r in toxicity.grade(plain.documents(spark, texts), model).collect()}
    scores = toxicity.score_texts(pa.array(texts, pa.string()), model)
    for i, text in enumerate(texts):
        found = (text or "").split()
        want = 0.0
        for weight, word in zip(weights, order, strict=True):
            n = found.count(word)
            if n:
                value = toxicity.values_of(np.array([n]), np.array([len(found)]))[0]
                want += weight * value
        assert abs(scores[i] - want) < 1e-9
        over = [1 / (1 + math.exp(t - want)) for t in model.thresholds]
        steps = [1.0, *over, 0.0]
        shares = [a - b for a, b in zip(steps, steps[1:], strict=False)]
        assert abs(got[i].severity - sum(over)) < 1e-9
        assert got[i].grade == shares.index(max(shares))
        assert got[i].toxic == (over[0] > 0.5)


def toxicity_words(data):
    from flightlake.llm.common import Words

    return int(Words(data, np.array([0, len(data)])).hashes()[0])
