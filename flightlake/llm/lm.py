"""LM scoring: smoothed n-grams as a weighted backoff automaton, traversed once per text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import (
    Words,
    blocks_for,
    by_range,
    frugal,
    lowered,
    mixed,
    pack_small,
    pack_sorted,
    power_of_two,
    small_batches,
    text_bytes,
    text_or_empty,
    unpack_small,
    unpack_sorted,
)

ORDER = 3
# How many observations the shorter history's estimate is worth.
PRIOR = 128.0
# Added to every count of a single token.
ADDED = 0.1
# Text per block of documents, and per range of n-gram fingerprints.
BLOCK_BYTES = 3 << 20
SHARD_BYTES = 8 << 20
# A long text is read in parts of so many tokens, each entered through the tokens before it.
PART = 1024

_START = mixed(np.array([1], np.uint64))[0]
_END = mixed(np.array([2], np.uint64))[0]
_REQUEST = "shard int, block long, grams binary, counts binary"
_ANSWER = "block long, shard int, level int, counts binary, tokens long, kinds long"


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they wait on disk until every round has read them."""
    compressor = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = pa.array([compressor.compress(t) for t in texts], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", packed)


def unpacked_texts(docs: pa.Table) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    raw = pa.array([unpack(t) for t in docs.column("text").to_pylist()], pa.large_binary())
    # The same bytes as they came, whether or not they are UTF-8.
    return pa.Array.from_buffers(pa.large_string(), len(raw), raw.buffers())


@dataclass
class Grams:
    """The n-grams of a block's texts: one entry per distinct fingerprint, in order."""

    keys: np.ndarray  # distinct fingerprints, ascending
    order: np.ndarray  # n of each
    first: np.ndarray  # a place (in the token sequence) at which each ends
    at: list[np.ndarray]  # at[n-1][t]: the n-gram that ends at place t, or -1
    bounds: np.ndarray  # first place of each text; a text is START, words, END


def read_grams(texts: pa.Array, order: int) -> Grams:
    data, text_bounds = text_bytes(texts)
    words = Words(lowered(data), text_bounds)
    n = len(words.counts)
    bounds = np.concatenate([[0], np.cumsum(words.counts + 2)])
    sequence = np.empty(int(bounds[-1]), np.uint64)
    sequence[bounds[:-1]] = _START
    sequence[bounds[1:] - 1] = _END
    inner = np.ones(len(sequence), bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    sequence[inner] = words.hashes()
    places = np.arange(len(sequence)) - np.repeat(bounds[:-1], np.diff(bounds))
    hashes, where, orders = [sequence], [np.arange(len(sequence))], [1]
    longer = sequence
    for k in range(2, order + 1):
        # The k-gram's fingerprint continues that of the k-1-gram one place before.
        following = np.zeros(len(sequence), np.uint64)
        following[1:] = mixed(longer[:-1] * np.uint64(2 * k + 1) + sequence[1:])
        longer = following
        ends = np.flatnonzero(places >= k - 1)
        hashes.append(longer[ends])
        where.append(ends)
        orders.append(k)
    every = np.concatenate(hashes)
    keys, inverse = np.unique(every, return_inverse=True)
    at, low = [], 0
    kinds, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for k, ends in zip(orders, where, strict=True):
        ids = inverse[low : low + len(ends)]
        low += len(ends)
        kinds[ids], first[ids] = k, ends
        line = np.full(len(sequence), -1, np.int64)
        line[ends] = ids
        at.append(line)
    return Grams(keys, kinds, first, at, bounds if n else np.zeros(1, np.int64))


def own_counts(docs: pa.Table, grams: Grams) -> np.ndarray:
    """How often each n-gram stands in the block's own training texts."""
    learn = np.asarray(docs.column("learn").to_numpy(zero_copy_only=False), bool)
    known = np.repeat(learn, np.diff(grams.bounds))
    counts = np.zeros(len(grams.keys), np.int64)
    for line in grams.at:
        ids = line[known & (line >= 0)]
        counts += np.bincount(ids, minlength=len(counts))
    return counts


def _asked(block: int, shards: int, keys: np.ndarray, orders: np.ndarray, counts: np.ndarray) -> pa.Table:
    """A block's n-grams with their counts, by ranges of fingerprints. A count's lowest bit tells
    whether the n-gram is a single token."""
    cuts = by_range(keys, shards)
    counts = 2 * counts + (orders == 1)
    parts = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table(
        {
            "shard": pa.array(np.arange(shards, dtype=np.int32)),
            "block": pa.array(np.full(shards, block, np.int64)),
            "grams": pa.array([pack_sorted(keys[a:b]) for a, b in parts], pa.binary()),
            "counts": pa.array([pack_small(counts[a:b]) for a, b in parts], pa.binary()),
        }
    )


def _request(order: int, shards: int):
    """The first round: all n-grams but those of the full order."""

    def request(docs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        grams = read_grams(unpacked_texts(docs), max(1, order - 1))
        counts = own_counts(docs, grams)
        return _asked(docs.column("block")[0].as_py(), shards, grams.keys, grams.order, counts)

    return request


def _request_longest(order: int, shards: int):
    """The second round: n-grams of the full order that another block can have."""

    def request(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        if docs.num_rows == 0:
            return _asked(0, shards, *np.zeros((3, 0), np.int64)).slice(0, 0)
        grams = read_grams(unpacked_texts(docs), order)
        ids = sharable(grams, _first_round(grams, answers))
        counts = own_counts(docs, grams)[ids]
        block = docs.column("block")[0].as_py()
        return _asked(block, shards, grams.keys[ids], grams.order[ids], counts)

    return request


def _told(answers: pa.Table) -> np.ndarray:
    """The counts answered to a block, in the order of its request."""
    ranked = np.argsort(np.asarray(answers.column("shard")))
    packed = answers.column("counts").to_pylist()
    return np.concatenate([unpack_small(packed[i]) for i in ranked])


def _first_round(grams: Grams, answers: pa.Table) -> np.ndarray:
    """The counts of the first round, zero for n-grams that were not asked for."""
    counts = np.zeros(len(grams.keys), np.int64)
    counts[grams.order < max(2, len(grams.at))] = _told(answers)
    return counts


def sharable(grams: Grams, answered: np.ndarray) -> np.ndarray:
    """The n-grams of the full order that training text of another block can hold: those of which
    both shorter n-grams were answered. Of others the block's own count is all there is."""
    most = len(grams.at)
    ids = np.flatnonzero(grams.order == most)
    ends = grams.first[ids]
    shorter = grams.at[most - 2]
    return ids[(answered[shorter[ends - 1]] > 0) & (answered[shorter[ends]] > 0)]


def _answer(level: int):
    """Counts over all blocks, for each block in the order of its request; 0 for n-grams no other
    block asked for, the count of which the block knows."""

    def answer(requests: pa.Table) -> pa.Table:
        asked = [unpack_sorted(x.as_py()) for x in requests.column("grams")]
        counts = np.concatenate([unpack_small(x.as_py()) for x in requests.column("counts")])
        keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(inverse, counts >> 1, len(keys)).astype(np.int64)
        single = np.zeros(len(keys), bool)
        single[inverse] = counts & 1
        shared = np.where(np.bincount(inverse, minlength=len(keys)) > 1, total, 0)
        token = single & (keys != _START) & (total > 0)
        cuts = np.cumsum([0, *map(len, asked)])
        own = [shared[inverse[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        n = len(asked)
        return pa.table(
            {
                "block": requests.column("block"),
                "shard": requests.column("shard"),
                "level": pa.array(np.full(n, level, np.int32)),
                "counts": pa.array([pack_small(x) for x in own], pa.binary()),
                "tokens": pa.array(np.full(n, total[token].sum(), np.int64)),
                "kinds": pa.array(np.full(n, token.sum(), np.int64)),
            }
        )

    return answer


@dataclass
class Automaton:
    """States are seen n-grams that can be a history (0 is the empty one, g + 1 n-gram g).

    An arc (state, token) has a weight (log10) and a next state; a state without the arc asked
    for passes on to its failure state, at the failure arc's weight.
    """

    keys: np.ndarray  # state * tokens + token, ascending
    weight: np.ndarray
    following: np.ndarray
    failure: np.ndarray
    failure_weight: np.ndarray
    tokens: int


def build(grams: Grams, counts: np.ndarray, n: int, kinds: int, prior: float) -> Automaton:
    """The automaton of the n-grams of a block, from their counts in all training text.

    The estimate after a history h is (c(h w) + prior * p(w | shorter h)) / (c(h) + prior). So
    an unseen h w costs the failure weight prior / (c(h) + prior) and the estimate there.
    """
    size, most = len(grams.keys), len(grams.at)
    single = (counts + ADDED) / (n + ADDED * (kinds + 1))
    p = np.where(grams.order == 1, single, 0.0)
    prefix, suffix = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    for k in range(2, most + 1):
        ids = np.flatnonzero(grams.order == k)
        ends = grams.first[ids]
        prefix[ids] = grams.at[k - 2][ends - 1]
        suffix[ids] = grams.at[k - 2][ends]
        p[ids] = (counts[ids] + prior * p[suffix[ids]]) / (counts[prefix[ids]] + prior)
    arcs = np.flatnonzero((grams.order == 1) | (counts > 0))
    label = grams.at[0][grams.first[arcs]]
    keys = (prefix[arcs] + 1) * size + label
    # A full n-gram leads to its last n - 1 tokens; an unseen token leads to the empty history.
    target = np.where(grams.order[arcs] < most, arcs, suffix[arcs]) + 1
    target = np.where(counts[arcs] > 0, target, 0)
    sort = np.argsort(keys)
    failure_weight = np.zeros(size + 1)
    failure_weight[1:] = np.log10(prior / (counts + prior))
    return Automaton(
        keys[sort],
        np.log10(p[arcs])[sort],
        target[sort],
        np.concatenate([[0], suffix + 1]),
        failure_weight,
        size,
    )


def traverse(automaton: Automaton, grams: Grams, counts: np.ndarray) -> np.ndarray:
    """log10 probability of each text: all texts are read at once, token by token.

    A text longer than PART tokens is read in parts; a part starts in the empty state and enters
    its first token's state through the n - 1 tokens before, whose weights do not count.
    """
    most = len(grams.at)
    sizes = np.diff(grams.bounds)
    parts = np.maximum(1, -(-(sizes - 1) // PART))
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    # The first place of each part that counts (START itself never does), and its end.
    begin = grams.bounds[owner] + 1 + nth * PART
    end = np.minimum(begin + PART, grams.bounds[owner + 1])
    enter = np.maximum(begin - (most - 1), grams.bounds[owner])
    lane = np.argsort(enter - end, kind="stable")
    begin, end, enter, owner = begin[lane], end[lane], enter[lane], owner[lane]
    length = end - enter
    state = np.zeros(len(lane), np.int64)
    score = np.zeros(len(lane))
    tokens = grams.at[0]
    for t in range(int(length.max(initial=0))):
        active = int(np.searchsorted(-length, -t, "left"))
        place = enter[:active] + t
        label = tokens[place]
        counted = place >= begin[:active]
        pending = np.arange(active)
        while len(pending):
            key = state[pending] * automaton.tokens + label[pending]
            at = np.searchsorted(automaton.keys, key)
            at[at == len(automaton.keys)] = 0
            hit = automaton.keys[at] == key
            done, arc = pending[hit], at[hit]
            score[done] += np.where(counted[done], automaton.weight[arc], 0.0)
            state[done] = automaton.following[arc]
            pending = pending[~hit]
            score[pending] += np.where(
                counted[pending], automaton.failure_weight[state[pending]], 0.0
            )
            state[pending] = automaton.failure[state[pending]]
    return np.bincount(owner, score, minlength=len(sizes))


_ADDED_COLUMNS = (
    ("n_tokens", T.LongType()),
    ("n_known", T.LongType()),
    ("train_tokens", T.LongType()),
    ("base_score", T.DoubleType()),
    ("score", T.DoubleType()),
)


def _scorer(order: int, prior: float, kept: list[str], schema: pa.Schema):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return schema.empty_table()
        grams = read_grams(unpacked_texts(docs), order)
        level = np.asarray(answers.column("level"))
        counts = _first_round(grams, answers.filter(pa.array(level == 1)))
        if order > 1:
            counts[sharable(grams, counts)] = _told(answers.filter(pa.array(level == 2)))
        counts = np.maximum(counts, own_counts(docs, grams))
        n, kinds = (int(np.asarray(answers.column(c)).sum()) for c in ("tokens", "kinds"))
        automaton = build(grams, counts, n, kinds, prior)
        total = traverse(automaton, grams, counts)
        token = np.ones(int(grams.bounds[-1]), bool)
        token[grams.bounds[:-1]] = False
        c = counts[grams.at[0]]
        base = np.where(token, np.log10((c + ADDED) / (n + ADDED * (kinds + 1))), 0.0)
        heads = grams.bounds[:-1]
        values = [
            np.diff(grams.bounds) - 1,
            np.add.reduceat(((c > 0) & token).astype(np.int64), heads),
            np.full(len(heads), n, np.int64),
            np.add.reduceat(base, heads),
            total,
        ]
        columns = [docs.column(name) for name in kept] + [pa.array(v) for v in values]
        return pa.Table.from_arrays(columns, schema=schema)

    return score


def score(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    keep: list[str] | None = None,
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The documents with n_tokens, n_known, train_tokens, base_score and score.

    Learns from the rows where `learn` holds and scores all rows, whole. Documents are dealt
    into blocks by a hash. A block counts its own n-grams and asks for their counts everywhere;
    the requests meet by ranges of n-gram fingerprints (64 bits), are added up and answered
    where several blocks ask. N-grams of the full order are asked for in a second round, and only
    if both shorter n-grams in them came back with a count: else no other block's training text
    holds them, and the block's own count is exact. Then the block builds the automaton of its
    n-grams and reads its texts through it. So no task holds more than a block or a range of
    n-grams, and a frequent n-gram is one entry per block. Nothing is cut off.

    Null or empty text is just the end token. Repeated rows each count and get equal scores.
    Without anything to learn from, N and V are 0 and every token has probability 1. An empty
    table gives no rows. Input columns named like an output column are replaced.
    """
    small_batches(docs.sparkSession)
    added = [name for name, _ in _ADDED_COLUMNS]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    inner = {c: f"own_{i}" for i, c in enumerate(keep)}
    blocks = blocks_for(docs, text, block_bytes)
    shards = power_of_two(blocks * block_bytes / shard_bytes)
    names = [F.col(f"`{c}`") for c in docs.columns]
    dealt = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in inner.items()],
        F.coalesce(learn, F.lit(False)).alias("learn"),
        text_or_empty(text).alias("text"),
        F.pmod(F.xxhash64(*names), F.lit(blocks)).alias("block"),
    )
    waiting = T.StructType(
        [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in dealt.schema]
    )
    by_block = dealt.mapInArrow(packed_texts, waiting).groupBy("block")

    def answered(requests: DataFrame, level: int) -> DataFrame:
        told = requests.groupBy("shard").applyInArrow(frugal(_answer(level)), _ANSWER)
        # Dealt by block once: the second round and the scores read the same answers of the first.
        return told.repartition("block")

    answers = first = answered(by_block.applyInArrow(frugal(_request(order, shards)), _REQUEST), 1)
    if order > 1:
        longest = by_block.cogroup(first.groupBy("block")).applyInArrow(
            frugal(_request_longest(order, shards)), _REQUEST
        )
        answers = first.unionByName(answered(longest, 2))
    fields = [T.StructField(n, docs.schema[c].dataType) for c, n in inner.items()]
    schema = T.StructType([*fields, *[T.StructField(n, k) for n, k in _ADDED_COLUMNS]])
    empty = docs.sparkSession.createDataFrame([], schema).toArrow().schema
    scored = (
        by_block.cogroup(answers.groupBy("block"))
        .applyInArrow(frugal(_scorer(order, prior, list(inner.values()), empty)), schema)
    )
    return scored.select(*[F.col(n).alias(c) for c, n in inner.items()], *added)
