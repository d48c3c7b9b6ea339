import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, cell string"


def brute(rows, k, modulus):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and usable(v)]
    queries = {}
    for i, v in whole:
        if i % modulus == 0:
            queries[i] = min(queries.get(i, v), v)
    out = set()
    for q, w in queries.items():
        scored = [(-sum(a * b for a, b in zip(w, v)), i) for i, v in whole if i != q]
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.add((q, rank, i, -s))
    return out


def found(spark, rows, modulus=5, k=5):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    result = topk.top_k(frame, F.col("vec_id") % modulus == 0, k=k)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    got = [tuple(r) for r in result.collect()]
    assert len(got) == len(set(got))
    return set(got)


def as_float(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def test_matches_brute_force_with_ties_holes_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, as_float([rng.gauss(0, 0.1) for _ in range(33)])) for i in range(300)]
    same = as_float([0.1] * 33)
    rows += [(1000 + i, same) for i in range(60)]
    rows += [(2000, None), (2005, as_float([None, 1.0])), (2010, [float("nan")] * 33)]
    rows += [(2015, [float("inf")] * 33), (None, same), (7, same), (10, same)]
    assert found(spark, rows) == brute(rows, 5, 5)


def test_several_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_CANDIDATES", 40)
    monkeypatch.setattr(topk, "CELL_QUERIES", 15)
    rng = random.Random(2)
    rows = [(i, as_float([rng.gauss(0, 0.1) for _ in range(20)])) for i in range(200)]
    assert found(spark, rows) == brute(rows, 5, 5)


def test_unequal_lengths_few_candidates_and_empty(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5]), (2, [])]
    assert found(spark, rows, modulus=2) == {
        (0, 1, 1, 128 * 128),
        (0, 2, 2, 0),
        (2, 1, 0, 0),
        (2, 2, 1, 0),
    }
    assert found(spark, [(0, [1.0])], modulus=1) == set()
    assert found(spark, []) == set()


def test_scores_beyond_doubles_are_exact_and_stop_at_long():
    big = np.array([[2.0**40, 3.0]])
    query, vector, score = topk.search_cell(
        np.array([0]), big, np.array([1, 2]), np.array([[2.0**20, 5.0], [2.0**40, 0.0]]), 5
    )
    assert list(zip(vector, score, strict=True)) == [(2, 2**63 - 1), (1, 2**60 + 15)]
    assert list(query) == [0, 0]


@pytest.mark.parametrize("dims", [1, 16, 40])
def test_pruning_loses_nothing(dims):
    rng = np.random.default_rng(dims)
    vectors = np.floor(rng.normal(0, 30, (500, dims)))
    vectors[100:200] = vectors[100]
    ids = np.arange(500)
    got = topk.search_cell(ids[::50], vectors[::50], ids, vectors, 7)
    for q in ids[::50]:
        scores = vectors @ vectors[q]
        best = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:7]
        mine = sorted((-s, v) for a, v, s in zip(*got, strict=True) if a == q)
        assert mine == [(int(s), i) for s, i in best]
