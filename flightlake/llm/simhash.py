"""SimHash near-duplicates: all pairs within a bit distance, by generalised pigeonhole."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import free_name, pieces, small_batches, stored
from flightlake.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
# Fingerprints the plan is estimated from; the plan changes the work, never the result.
PLAN_SAMPLE = 2048
# Relative cost of one probe row against one compared pair.
PROBE_COST = 100.0
# Rows of one key compared in one piece of work; larger keys are laid on a grid.
MOST_ROWS = 2048

_INDEX, _PROBE = 0, 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half the XXH64 values of the word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
        starts = [0, *(e + 1 for e in ends[:-shingle])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[at : at + (1 << 15)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    set_bits = 2 * ones > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str, out: str, shingle: int = SHINGLE, keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (by default all) and the fingerprint as a long."""
    small_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if keep is None or f.name in keep]
    schema = T.StructType([*kept, T.StructField(out, T.LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                values = [fingerprint(t, shingle) for t in part.column(text).to_pylist()]
                columns = [part.column(f.name) for f in kept]
                columns.append(pa.array(np.array(values, np.uint64).view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(compute, schema)


@dataclass(frozen=True)
class Part:
    """Some bits of a fingerprint and the distance within which they are probed."""

    bits: tuple[int, ...]
    radius: int


def bit_groups(correlation: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """The bits in so many groups of about equal size, correlated bits together.

    Each group starts with the free pair of strongest correlation and takes the free bit that
    is most correlated with it on average, until it is full.
    """
    strength = np.abs(np.nan_to_num(correlation))
    np.fill_diagonal(strength, 0)
    free, groups = list(range(len(strength))), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        inner = strength[np.ix_(free, free)]
        group = [free[int(np.argmax(inner.max(axis=1)))]]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            gain = strength[np.ix_(rest, group)].mean(axis=1)
            group.append(rest[int(np.argmax(gain))])
        free = [b for b in free if b not in group]
        groups.append(tuple(sorted(group)))
    return groups


def _near_share(sample: np.ndarray, bits: tuple[int, ...], most: int) -> np.ndarray:
    """Estimated share of pairs that differ in at most t of the bits, for t from 0 to `most`.

    The larger of what the sample's pairs show and what independent bits would give.
    """
    picked = sample[:, list(bits)].astype(np.float32)
    ones = picked.sum(axis=1)
    distance = np.rint(ones[:, None] + ones[None, :] - 2 * picked @ picked.T).astype(np.int64)
    pairs = max(1, len(sample) * (len(sample) - 1))
    shares = np.bincount(distance.ravel(), minlength=len(bits) + 1)[: most + 1].astype(float)
    shares[0] -= len(sample)
    seen = np.cumsum(shares) / pairs
    differ = np.clip(2 * picked.mean(axis=0) * (1 - picked.mean(axis=0)), 1e-6, 1)
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.maximum(seen, np.cumsum(chance))


def plan(sample: np.ndarray, correlation: np.ndarray, n: int, distance: int) -> list[Part]:
    """Parts and their probing distances that find all pairs at the least estimated cost.

    Two values within `distance` must, for distances t of m parts that add up to
    distance - m + 1, be within t in at least one part (t = -1: the part is not probed). For
    each m, dynamic programming over the parts allots the distances; the cheapest m wins.
    """
    best: tuple[float, list[Part]] = (np.inf, [])
    for m in range(1, distance + 2):
        groups = bit_groups(correlation, m)
        budget = distance - m + 1
        costs = []
        for bits in groups:
            share = _near_share(sample, bits, budget + m - 1)
            cost = [0.0]
            for t in range(budget + m):
                ball = sum(comb(len(bits), e) for e in range(t + 1))
                cost.append(n * ball * PROBE_COST + 0.5 * n * n * (share[t] if t < len(share) else 1))
            costs.append(cost)
        # spent[s]: the least cost so far with distances that add up to s, counting -1 as 0.
        spent = {0: (0.0, [])}
        for cost in costs:
            following: dict[int, tuple[float, list[int]]] = {}
            for s, (c, chosen) in spent.items():
                for t in range(-1, budget + m):
                    at, total = s + t + 1, c + cost[t + 1]
                    if at <= budget + m and (at not in following or total < following[at][0]):
                        following[at] = (total, [*chosen, t])
            spent = following
        total, chosen = spent[budget + m]
        if total < best[0]:
            parts = zip(groups, chosen, strict=True)
            best = (total, [Part(bits, t) for bits, t in parts if t >= 0])
    return best[1]


def _bits_of(values: np.ndarray) -> np.ndarray:
    flat = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(flat, axis=1, bitorder="little")


def _correlation(nodes: DataFrame, value: str) -> np.ndarray:
    """Correlations of the bits over all values: 64 x 64 sums, added up by Spark."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            bits = _bits_of(np.asarray(batch.column(value), np.int64)).astype(np.float32)
            bits = np.concatenate([bits, np.ones((len(bits), 1), np.float32)], axis=1)
            total += np.rint(bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(np.arange(total.size)), "n": pa.array(total.ravel())}
        )

    cells = (
        nodes.select(value).mapInArrow(sums, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    )
    total = np.zeros((BITS + 1) ** 2)
    for row in cells.collect():
        total[row["cell"]] = row["n"]
    total = total.reshape(BITS + 1, BITS + 1)
    n = max(1.0, total[-1, -1])
    mean = total[-1, :-1] / n
    covariance = total[:-1, :-1] / n - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    return covariance / np.outer(deviation, deviation)


def _probes(parts: list[Part]):
    """Rows (key, kind, value): each value under its own part values and under those nearby."""
    masks = []
    for p in parts:
        own = np.uint64(sum(1 << b for b in p.bits))
        near = [
            np.uint64(sum(1 << b for b in flipped))
            for e in range(1, p.radius + 1)
            for flipped in combinations(p.bits, e)
        ]
        masks.append((own, np.array(near, np.uint64)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("value"), np.int64).view(np.uint64)
            for at in range(0, len(values), 1 << 14):
                some = values[at : at + (1 << 14)]
                for i, (own, near) in enumerate(masks):
                    base = some & own
                    yield _rows(i, base, np.full(len(some), _INDEX, np.int8), some)
                    for flip in near:
                        yield _rows(i, base ^ flip, np.full(len(some), _PROBE, np.int8), some)

    def _rows(i, key, kind, value):
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array(np.full(len(key), i, np.int32)),
                "key": pa.array(key.view(np.int64)),
                "kind": pa.array(kind),
                "value": pa.array(value.view(np.int64)),
            }
        )

    return emit


def near_pairs(values: np.ndarray, kinds: np.ndarray, cell: np.ndarray, distance: int):
    """Pairs of rows of one cell within the distance, at least one of them an index row.

    Rows are sorted by cell. Round d compares each row with the d-th after it, for all cells at
    once; pairs found are reduced to one link per value and round of the comparison.
    """
    n = len(values)
    ends = np.searchsorted(cell, cell, "right")
    alive = np.arange(n)
    found = []
    d = 0
    while len(alive):
        d += 1
        alive = alive[alive + d < ends[alive]]
        other = alive + d
        index = (kinds[alive] == _INDEX) | (kinds[other] == _INDEX)
        x, y = values[alive[index]], values[other[index]]
        close = (np.bitwise_count(x ^ y) <= distance) & (x != y)
        if close.any():
            found.append(np.stack([x[close], y[close]]))
            if sum(f.shape[1] for f in found) > 4 * n + 10_000:
                found = [forest(*np.concatenate(found, axis=1))]
    return forest(*np.concatenate(found, axis=1)) if found else np.zeros((2, 0), np.uint64)


def forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As few links with the same components: every value to the least of its component."""
    nodes, places = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = places[: len(x)], places[len(x) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        following = root.copy()
        np.minimum.at(following, root[a], low)
        np.minimum.at(following, root[b], low)
        following = following[following]
        if (following == root).all() and (root[a] == root[b]).all():
            break
        root = following
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[linked], nodes[root[linked]]])


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links between distinct values (column `value`) that join all near ones.

    Any two values within the distance end up connected. A key under which more than MOST_ROWS
    rows meet is cut into pieces, and each pair of pieces compared as a cell of its own.
    """
    n = nodes.count()
    if n < 2:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    sample = nodes.orderBy(F.xxhash64("value"), "value").limit(PLAN_SAMPLE).collect()
    sample_bits = _bits_of(np.array([r["value"] for r in sample], np.int64))
    parts = plan(sample_bits, _correlation(nodes, "value"), n, distance)
    rows = nodes.select("value").mapInArrow(
        _probes(parts), "part int, key long, kind byte, value long"
    )
    sizes = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    crowded = sizes.filter(F.col("n") > MOST_ROWS).select(
        "part", "key", F.ceil(F.col("n") / MOST_ROWS).cast("int").alias("pieces")
    )
    piece = F.pmod(F.xxhash64("value", "kind"), F.col("pieces")).cast("int")
    others = F.sequence(F.lit(0), F.col("pieces") - 1)
    cells = F.when(
        F.col("pieces").isNotNull(),
        F.transform(
            others,
            lambda o: F.concat_ws(
                "-", F.least(piece, o).cast("string"), F.greatest(piece, o).cast("string")
            ),
        ),
    ).otherwise(F.array(F.lit("")))
    dealt = (
        rows.join(crowded, ["part", "key"], "left")
        .withColumn("at", F.explode(cells))
        .select(F.xxhash64("part", "key", "at").alias("cell"), "kind", "value")
        .repartition("cell")
        .sortWithinPartitions("cell", "kind", "value")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = np.zeros(0, np.int64)
        kind, value = np.zeros(0, np.int8), np.zeros(0, np.uint64)
        for batch in batches:
            cell = np.concatenate([cell, np.asarray(batch.column("cell"), np.int64)])
            kind = np.concatenate([kind, np.asarray(batch.column("kind"), np.int8)])
            more = np.asarray(batch.column("value"), np.int64).view(np.uint64)
            value = np.concatenate([value, more])
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            yield _links(near_pairs(value[:whole], kind[:whole], cell[:whole], distance))
            cell, kind, value = cell[whole:], kind[whole:], value[whole:]
        yield _links(near_pairs(value, kind, cell, distance))

    return dealt.mapInArrow(compare, "a long, b long")


def _links(pairs: np.ndarray) -> pa.RecordBatch:
    pairs = np.ascontiguousarray(pairs).astype(np.uint64)
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(pairs[0].view(np.int64)), "b": pa.array(pairs[1].view(np.int64))}
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, root, row_hash: a row per document.

    component_id is the least doc_id reachable over fingerprints that differ in at most
    `distance` bits. Equal fingerprints are one node, so copies cost nothing. Texts without a
    word have fingerprint zero and are linked like any other; null text is empty. Repeated rows
    give repeated rows; a null id belongs to its component without naming it, and component_id
    is null where no document of a component has an id. An empty table gives no rows. Other
    columns, whatever their names, only enter row_hash, a hash of the row; root is the least
    fingerprint of the component.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(*[f"`{c}`" for c in docs.columns]).alias("row_hash"),
        F.col(text).alias("text"),
    )
    found = stored(fingerprints(slim, "text", "value", shingle, keep=["doc_id", "row_hash"]))
    nodes = stored(found.groupBy("value").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes, distance))
    rooted = nodes.join(roots, nodes["value"] == roots["node"], "left").select(
        "value", "least_id", F.coalesce("root", "value").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named, "root").select("value", "component_id", "root")
    return found.join(classes, "value").select(
        "doc_id",
        F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
        "row_hash",
    )


def keep_one(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One document of each component: that with the least id (null last), then row hash.

    Rows alike in every column are one document.
    """
    rows = near_duplicates(docs, text, doc_id, shingle, distance)
    best = (
        rows.groupBy("root", "row_hash")
        .agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(F.min(F.struct(F.isnull("doc").alias("nameless"), "doc", "row_hash", "n")).alias("best"))
    )
    hashed, least, copies = (free_name(docs, f"kept_{k}") for k in ("hash", "least", "copies"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.withColumn(hashed, F.xxhash64(*own)).join(
        best.select(F.col("best.row_hash").alias(least), F.col("best.n").alias(copies)),
        F.col(hashed) == F.col(least),
    )
    alone = kept.filter(F.col(copies) == 1).select(*own)
    repeated = kept.filter(F.col(copies) > 1).select(*own).dropDuplicates()
    return alone.unionByName(repeated)
