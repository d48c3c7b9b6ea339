import random

import numpy as np
import pytest
import rows as plain
import xxhash

from flightlake.llm import components, simhash

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(b" ".join(p), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, distance=4):
    groups = plain.Groups()
    for i, x in enumerate(values):
        groups.find(x)
        for y in values[:i]:
            if (x ^ y).bit_count() <= distance:
                groups.join(x, y)
    return groups


def test_fingerprints_match_a_plain_version():
    texts = ["a b c d e", "A  b\tc", "", None, "one", "x y z w " * 300, "é É ß"]
    for text in texts:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 10)]
    values = set(centres)
    while len(values) < n:
        value = rng.choice(centres)
        for _ in range(rng.randint(1, 8)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    return sorted(values)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def joined(spark, values):
    nodes = spark.createDataFrame([(signed(v),) for v in values], "value long")
    roots = components.components(simhash.links(nodes)).collect()
    groups = plain.Groups()
    for r in roots:
        groups.join(r["node"] % (1 << 64), r["root"] % (1 << 64))
    return {v: groups.find(v) for v in values}


@pytest.mark.parametrize("probe_cost", [1e-3, 100.0, 1e9])
def test_no_link_is_lost_whatever_the_plan(spark, monkeypatch, probe_cost):
    monkeypatch.setattr(simhash, "PROBE_COST", probe_cost)
    values = clustered(400, 5)
    expected = slow_components(values)
    got = joined(spark, values)
    assert got == {v: expected.find(v) for v in values}


def test_crowded_keys_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_ROWS", 16)
    values = sorted({(i * 0x9E3779B97F4A7C15 % (1 << 64)) & ~0xFFFFFFFFFFFF | i for i in range(300)})
    expected = slow_components(values)
    assert joined(spark, values) == {v: expected.find(v) for v in values}


def test_plan_allots_distances_that_cover():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64)).astype(np.uint8)
    bits[:, 10:20] = bits[:, 10:11]
    correlation = np.corrcoef(bits.T)
    for n in (1e3, 1e6, 1e9):
        parts = simhash.plan(bits, correlation, int(n), 4)
        groups = [set(p.bits) for p in parts]
        assert all(not a & b for i, a in enumerate(groups) for b in groups[:i])
    m = 4
    grouped = simhash.bit_groups(correlation, m)
    assert sorted(b for g in grouped for b in g) == list(range(64))
    assert any(set(range(10, 20)) <= set(g) for g in grouped)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(200)] + [(500, x) for x in range(501, 700)] + [(9999, 9999)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert roots == {i: 0 for i in range(1, 201)} | {x: 500 for x in range(501, 700)}
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).collect() == []


def test_documents_against_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in source.collect()]
    long = "word " * 200 + " ".join(f"w{i}" for i in range(300))
    rows += [(5000, long), (5001, long + " tail"), (5002, ""), (5003, None), (5002, ""), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as value", "2 as root")
    got = simhash.near_duplicates(docs).collect()
    groups = slow_components(sorted({slow_fingerprint(t) for _, t in rows}))
    least = {}
    for i, t in rows:
        root = groups.find(slow_fingerprint(t))
        if i is not None:
            least[root] = min(i, least.get(root, i))
    expected = sorted(
        (str(i), f"{slow_fingerprint(t):016x}", least[groups.find(slow_fingerprint(t))]) for i, t in rows
    )
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(least.values())


def test_empty_table_and_nameless_documents(spark):
    assert simhash.near_duplicates(plain.documents(spark, [])).collect() == []
    nameless = plain.documents(spark, ["a b", "a b", "c d"], ids=[None, None, None])
    assert [r.component_id for r in simhash.near_duplicates(nameless).collect()] == [None] * 3
    assert simhash.keep_one(nameless).count() == 2
