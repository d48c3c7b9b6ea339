"""Exact top-k search: inner products block by block of dimensions, with pruning by bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
# Dimensions added up between two rounds of pruning.
BLOCK_DIMS = 16
# Vectors of one side in a cell of the grid; a cell fits one task.
CELL_CANDIDATES = 8192
CELL_QUERIES = 2048
# Vectors packed into one row.
PACK = 1024
# Sums beyond this are added as whole numbers of any size instead of doubles.
EXACT_DOUBLE = float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)

_PACKED = "cell long, ids binary, dims int, data binary"


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """vec_id and the whole-number components; vectors with a hole are left out."""
    usable = (
        F.col(embedding).isNotNull()
        & F.col(vec_id).isNotNull()
        & F.forall(
            embedding,
            lambda x: x.isNotNull()
            & ~F.isnan(x)
            & (F.abs(x.cast("double")) < float("inf")),
        )
    )
    # Infinity after scaling is the largest double.
    most = float(np.finfo(np.float64).max)
    whole = F.transform(
        embedding,
        lambda x: F.greatest(
            F.least(_whole(x.cast("double") * float(scale)), F.lit(most)), F.lit(-most)
        ),
    )
    return vectors.filter(usable).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v")
    )


def _whole(x):
    """The floor as a double; doubles beyond 2^53 are whole already."""
    return F.when(F.abs(x) < EXACT_DOUBLE, F.floor(x).cast("double")).otherwise(x)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, vec_id, v) as rows that hold up to PACK vectors of a cell each."""
    for batch in batches:
        cells = np.asarray(batch.column("cell"), np.int64)
        ids = np.asarray(batch.column("vec_id"), np.int64)
        lists = batch.column("v")
        lengths = np.diff(np.asarray(lists.offsets, np.int64))
        dims = int(lengths.max(initial=0))
        matrix = np.zeros((len(ids), dims))
        matrix[np.arange(dims) < lengths[:, None]] = np.asarray(lists.flatten(), np.float64)
        order = np.lexsort((ids, cells))
        cuts = np.flatnonzero(np.diff(cells[order])) + 1
        for rows in np.split(order, cuts):
            for at in range(0, len(rows), PACK):
                part = rows[at : at + PACK]
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": pa.array([int(cells[part[0]])], pa.int64()),
                        "ids": pa.array([ids[part].tobytes()], pa.binary()),
                        "dims": pa.array([dims], pa.int32()),
                        "data": pa.array([matrix[part].tobytes()], pa.binary()),
                    }
                )


def _unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors, padded with zeros to one length."""
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in rows["ids"]] or [np.zeros(0, int)])
    dims = int(rows["dims"].max()) if len(rows) else 0
    matrix = np.zeros((len(ids), dims))
    at = 0
    for packed, width, data in zip(rows["ids"], rows["dims"], rows["data"], strict=True):
        n = len(packed) // 8
        matrix[at : at + n, :width] = np.frombuffer(data, np.float64).reshape(n, width)
        at += n
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order]


def search_cell(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every query of a cell its k best of the cell's vectors: query, vector, score.

    Vectors stand by column. After each block of dimensions, a vector stays only if its partial
    score plus the largest product the remaining dimensions allow (the product of the remaining
    norms) still reaches the k-th best score known; of an equal bound, only a smaller id stays.
    """
    dims = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    vectors = np.pad(vectors, ((0, 0), (0, dims - vectors.shape[1])))
    most = np.abs(queries).max(initial=0.0) * np.abs(vectors).max(initial=0.0) * max(dims, 1)
    found = []
    if not most < EXACT_DOUBLE:
        big_v = np.array([[int(x) for x in row] for row in vectors], object).reshape(vectors.shape)
        for q, row in zip(query_ids, queries, strict=True):
            weights = [int(x) for x in row]
            scores = [int(sum(a * b for a, b in zip(weights, v, strict=True))) for v in big_v]
            best = sorted((-s, int(i)) for s, i in zip(scores, ids, strict=True) if i != q)[:k]
            found += [(int(q), i, min(max(-s, LONG[0]), LONG[1])) for s, i in best]
    else:
        order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        columns = np.ascontiguousarray(vectors[:, order].T)
        weights = queries[:, order]
        cuts = [*range(0, dims, BLOCK_DIMS), dims]
        rest_v = [np.sqrt((columns[c:] ** 2).sum(axis=0)) for c in cuts]
        rest_q = [np.sqrt((weights[:, c:] ** 2).sum(axis=1)) for c in cuts]
        for i, q in enumerate(query_ids):
            found += _search(
                int(q), weights[i], [r[i] for r in rest_q], ids, columns, cuts, rest_v, k
            )
    out = np.array(found, object).reshape(len(found), 3)
    return tuple(out[:, j].astype(np.int64) for j in range(3))


def _search(query, weights, rest_q, ids, columns, cuts, rest_v, k):
    # The first block is scored for all vectors; the most promising are finished at once, which
    # gives a lower bound of the k-th best score.
    alive = np.flatnonzero(ids != query)
    partial = np.zeros(len(alive))
    bar = None
    for b in range(len(cuts) - 1):
        low, high = cuts[b], cuts[b + 1]
        block = columns[low:high] if len(alive) == len(ids) else columns[low:high, alive]
        partial = partial + weights[low:high] @ block
        bound = partial + rest_q[b + 1] * rest_v[b + 1][alive]
        if len(alive) > 4 * k:
            lead = alive[np.argpartition(-bound, 4 * k)[: 4 * k]]
            scores = weights @ columns[:, lead]
            worst = sorted(zip(-scores, ids[lead], strict=True))[k - 1]
            if bar is None or worst < bar:
                bar = worst
        if bar is not None:
            # A margin covers the rounding of the norms; scores are whole numbers.
            margin = bound * (1 + 1e-12) + 1e-3
            keep = (margin > -bar[0] + 1) | ((margin >= -bar[0]) & (ids[alive] <= bar[1]))
            keep |= margin >= -bar[0] + 1
            alive, partial = alive[keep], partial[keep]
    scores = np.rint(partial).astype(np.int64)
    best = np.lexsort((ids[alive], -scores))[:k]
    return [(query, int(ids[alive[j]]), int(scores[j])) for j in best]


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products, ties to smaller ids.

    `is_query` is a condition on the quantised rows (vec_id, v). Queries and candidates are
    packed into blocks and laid on a grid, whose cells are searched independently: a query meets
    every candidate in exactly one cell. Per cell k rows a query leave, so the last step ranks
    k rows for each cell column.

    A vector that is null, or holds a null or non-finite component, and a null id take no part. Vectors of
    different lengths are compared as if filled up with zeros. Rows that repeat an id are all
    candidates; as a query an id counts once (with its smallest vector) and is never its own
    candidate. Scores beyond the range of a long stop at its ends. An empty table gives no rows.
    """
    usable = quantised(vectors, vec_id, embedding, scale)
    queries = usable.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    counts = usable.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")
    ).first()
    across = max(1, -(-counts["n"] // CELL_CANDIDATES))
    down = max(1, -(-counts["q"] // CELL_QUERIES))
    spread = F.explode(F.sequence(F.lit(0), F.lit(across - 1)).cast("array<long>"))
    deep = F.explode(F.sequence(F.lit(0), F.lit(down - 1)).cast("array<long>"))
    right = (
        usable.withColumn("cell", F.pmod(F.xxhash64("vec_id", "v"), F.lit(across)))
        .repartition("cell")
        .select("cell", "vec_id", "v")
        .mapInArrow(_pack, _PACKED)
        .withColumn("row", deep)
        .withColumn("cell", F.col("row") * across + F.col("cell"))
    )
    left = (
        queries.withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.lit(down)))
        .repartition("cell")
        .select("cell", "vec_id", "v")
        .mapInArrow(_pack, _PACKED)
        .withColumn("column", spread)
        .withColumn("cell", F.col("cell") * across + F.col("column"))
    )

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = search_cell(*_unpack(q), *_unpack(c), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    best = (
        left.groupBy("cell")
        .cogroup(right.groupBy("cell"))
        .applyInPandas(cell, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
