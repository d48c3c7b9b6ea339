"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import Words, mixed, pieces, small_batches, text_bytes

# BM25.
K1, B = 1.2, 0.75
# Share of an item's own BM25 score a passage must reach to be looked at word by word.
THRESHOLD = 0.6
# Words of a shingle, and the share of a part's shingles that must occur in the passage.
SHINGLE = 3
OVERLAP = 0.6
# Items of a block share one bound. Items of all indexes sent along with a pass, in bytes.
BLOCK = 8
INDEX_BYTES = 16 << 20

_ALNUM = np.full(256, 32, np.uint8)
for _b in (*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)):
    _ALNUM[_b] = _b
_TABLE = 1 << 18
_SENTENCE_END = re.compile(r"[.!?]\s+")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of lower-cased runs of letters and digits, and their bounds per text."""
    data, bounds = text_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    words = Words(_ALNUM[data], bounds)
    return words.hashes(), words.bounds


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's last sentence is its answer; of a single sentence, the last quarter of words."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    if ends:
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = len(words) - max(1, len(words) // 4) if words else 0
    return " ".join(words[:cut]), " ".join(words[cut:])


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct fingerprints of SHINGLE words in a row (of all words, if there are fewer)."""
    size = min(SHINGLE, len(words))
    if size == 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        out = mixed(out + words[j : j + len(out)])
    return np.unique(out)


@dataclass
class Item:
    item_id: int | None
    question: np.ndarray
    answer: np.ndarray


class Bounds:
    """The largest impact per term and block, of the blocks only in which a term occurs."""

    def __init__(self, block_most: dict[int, dict[int, float]], terms: int, blocks: int):
        sizes = np.zeros(terms, np.int64)
        for term, most in block_most.items():
            sizes[term] = len(most)
        ordered = [block_most[t] for t in sorted(block_most)]
        self.blocks = blocks
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.block = np.array([b for most in ordered for b in most], np.int64)
        self.value = np.array([v for most in ordered for v in most.values()])
        self.used = sizes > 0

    def sums(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Per row and block the bounds of the row's terms added up."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[terms] - (ends - sizes), sizes)
        cells = np.repeat(rows, sizes) * self.blocks + self.block[at]
        return np.bincount(cells, self.value[at], n * self.blocks).reshape(n, self.blocks)


@dataclass
class Lists:
    """The inverted index of items of similar length, of at most `words` words."""

    words: int
    items: list[int] = field(default_factory=list)  # numbers of its items, ascending
    postings: dict[int, tuple[list[int], list[float]]] = field(default_factory=dict)
    most: dict[int, float] = field(default_factory=dict)
    block_most: dict[int, dict[int, float]] = field(default_factory=dict)
    bounds: Bounds | None = None


@dataclass
class Index:
    items: list[Item]
    terms: np.ndarray  # fingerprints, ascending; a term's number is its place
    lists: list[Lists]
    threshold: float


def build(rows: list[dict], count: int, mean_length: float, threshold: float) -> Index:
    """Index of items from rows (item_id, text, terms, tf, df, length), in a fixed order.

    An impact is a BM25 contribution divided by the item's score for its own text, so that one
    threshold holds for all items.
    """
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *[r["terms"] for r in rows]]))
    items: list[Item] = []
    classes: dict[int, Lists] = {}
    for r in rows:
        question, answer = question_and_answer(r["text"])
        hashes, bounds = word_hashes(pa.array([question, answer], pa.string()))
        items.append(
            Item(
                r["item_id"],
                shingles(hashes[bounds[0] : bounds[1]]),
                shingles(hashes[bounds[1] : bounds[2]]),
            )
        )
        idf = np.log(1 + (count - r["df"] + 0.5) / (r["df"] + 0.5))
        norm = K1 * (1 - B + B * r["length"] / mean_length)
        impact = idf * r["tf"] * (K1 + 1) / (r["tf"] + norm)
        impact = impact / impact.sum()
        size = 1 << max(3, int(r["length"] - 1).bit_length())
        group = classes.setdefault(size, Lists(size))
        place = len(group.items)
        group.items.append(len(items) - 1)
        for term, value in zip(np.searchsorted(terms, r["terms"]).tolist(), impact.tolist(), strict=True):
            places, values = group.postings.setdefault(term, ([], []))
            places.append(place)
            values.append(value)
    for group in classes.values():
        for term, (places, values) in group.postings.items():
            most = group.block_most[term] = {}
            for place, value in zip(places, values, strict=True):
                most[place // BLOCK] = max(value, most.get(place // BLOCK, 0.0))
            group.most[term] = max(values)
        group.bounds = Bounds(group.block_most, len(terms), -(-len(group.items) // BLOCK))
    return Index(items, terms, [classes[k] for k in sorted(classes)], threshold)


def block_max_wand(group: Lists, query: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (place, score) of the group's items whose impacts for the query reach the threshold.

    Cursors stand on the query terms' postings, in order of their items. The pivot is the first
    item that the terms up to it could lift to the threshold. If the bounds of its block can't,
    all cursors up to the pivot pass the block; else the item is scored in full.
    """
    lists = [(group.postings[t], group.most[t], group.block_most[t]) for t in query if t in group.postings]
    cursors = [[p[0][0], 0, p[0], p[1], most, blocks] for p, most, blocks in lists]
    slack = threshold - 1e-6  # sums are rounded
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            total += c[4]
            if total >= slack:
                pivot = i
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        block = item // BLOCK
        if sum(c[5].get(block, 0.0) for c in cursors[: pivot + 1]) < slack:
            target = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            moving = cursors[: pivot + 1]
        elif cursors[0][0] == item:
            score = sum(c[3][c[1]] for c in cursors[: pivot + 1])
            if score >= threshold:
                found.append((item, score))
            target, moving = item + 1, cursors[: pivot + 1]
        else:
            target, moving = item, [c for c in cursors[:pivot] if c[0] < item]
        for c in moving:
            c[1] = bisect_left(c[2], target, c[1])
            c[0] = c[2][c[1]] if c[1] < len(c[2]) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return found


def _lookup(index: Index, hashes: np.ndarray) -> np.ndarray:
    """Term numbers of words; -1 for words of no item."""
    known = np.zeros(_TABLE, bool)
    known[(index.terms & np.uint64(_TABLE - 1)).astype(np.int64)] = True
    numbers = np.full(len(hashes), -1, np.int64)
    maybe = np.flatnonzero(known[(hashes & np.uint64(_TABLE - 1)).astype(np.int64)])
    if len(maybe):
        at = np.minimum(np.searchsorted(index.terms, hashes[maybe]), len(index.terms) - 1)
        numbers[maybe] = np.where(index.terms[at] == hashes[maybe], at, -1)
    return numbers


def matches(texts: pa.Array, index: Index) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of every contaminated text and item.

    For items of up to n words (a power of two), passages are 2 n words long and start every n
    words, so that every place an item can stand in lies in a passage. A first pass adds up, for
    all passages, the block bounds of their terms; only passages that some block could lift to
    the threshold are searched.
    """
    hashes, bounds = word_hashes(texts)
    numbers = _lookup(index, hashes)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(hashes)) - bounds[:-1][owner]
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for group in index.lists:
        halves = -(-np.diff(bounds) // group.words)
        first = np.concatenate([[0], np.cumsum(halves)])
        half_owner = np.repeat(np.arange(len(halves)), halves)
        mine = np.flatnonzero((numbers >= 0) & group.bounds.used[numbers])
        if len(mine) == 0:
            continue
        half = first[owner[mine]] + place[mine] // group.words
        pairs = _distinct(half * len(index.terms) + numbers[mine])
        half, term = pairs // len(index.terms), pairs % len(index.terms)
        bound = group.bounds.sums(half, term, int(first[-1]) + 1)
        # A passage is a half and the next, if that is of the same text.
        follows = np.zeros(int(first[-1]), bool)
        follows[:-1] = half_owner[1:] == half_owner[:-1]
        total = bound[:-1] + np.where(follows[:, None], bound[1:], 0)
        for k in np.flatnonzero((total >= index.threshold - 1e-4).any(axis=1)).tolist():
            low, high = np.searchsorted(half, [k, k + 1 + bool(follows[k])])
            # Terms of both halves counted twice so far.
            query = _distinct(term[low:high])
            if group.bounds.sums(np.zeros(len(query), np.int64), query, 1).max() < index.threshold - 1e-4:
                continue
            hits = block_max_wand(group, query.tolist(), index.threshold)
            if not hits:
                continue
            text = int(half_owner[k])
            begin = int(bounds[text]) + (k - int(first[text])) * group.words
            end = min(begin + 2 * group.words, int(bounds[text + 1]))
            # Shingles cross from one passage into the words after it.
            words = hashes[begin : min(end + SHINGLE, int(bounds[text + 1]))]
            seen = np.unique(np.concatenate([shingles(words), words, _short(words)]))
            for at, score in hits:
                number = group.items[at]
                item = index.items[number]
                question, answer = _share(item.question, seen), _share(item.answer, seen)
                if question >= OVERLAP and answer >= OVERLAP:
                    now = (score, question, answer)
                    best[text, number] = max(now, best.get((text, number), now))
    return [(text, number, *values) for (text, number), values in sorted(best.items())]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=-1))]


def _short(words: np.ndarray) -> np.ndarray:
    """Fingerprints of one and two words, which stand for parts shorter than a shingle."""
    one = mixed(words)
    return np.concatenate([one, mixed(one[:-1] + words[1:])]) if len(words) else words


def _share(part: np.ndarray, seen: np.ndarray) -> float:
    """Share of a part's shingles that were seen; a part without words is found anywhere."""
    return float(np.isin(part, seen).mean()) if len(part) else 1.0


def fit(items: DataFrame, text: str = "text", item_id: str = "item_id", threshold: float = THRESHOLD) -> list[Index]:
    """The indexes of all items; one, unless the items exceed INDEX_BYTES.

    Statistics are of all items: Spark counts the documents of each term and joins them back.
    Items are dealt by a hash into as many indexes as keep each below INDEX_BYTES, so that what
    is sent along with a pass over the documents has that bound. Equal rows are one item; items
    without words are left out.
    """
    rows = (
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
        .filter(F.col("text").isNotNull())
        .distinct()
        .withColumn("digest", F.sha2("text", 256))
    )
    # A posting names its item by id and hash; texts are joined back once, an item each.
    schema = "item_id long, digest string, bytes long, length long, term long, tf long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bounds = word_hashes(batch.column("text"))
            for i in range(batch.num_rows):
                terms, tf = np.unique(hashes[bounds[i] : bounds[i + 1]], return_counts=True)
                n = len(terms)
                size = len(batch.column("text")[i].as_py().encode())
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([batch.column("item_id")[i].as_py()] * n, pa.int64()),
                        "digest": pa.array([batch.column("digest")[i].as_py()] * n, pa.string()),
                        "bytes": pa.array(np.full(n, size, np.int64)),
                        "length": pa.array(np.full(n, tf.sum(), np.int64)),
                        "term": pa.array(terms.view(np.int64)),
                        "tf": pa.array(tf.astype(np.int64)),
                    }
                )

    postings = rows.mapInArrow(count, schema)
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    entries = (
        postings.join(df, "term")
        .groupBy("item_id", "digest", "length")
        .agg(F.sort_array(F.collect_list(F.struct("term", "tf", "df"))).alias("entries"))
    )
    same = entries["item_id"].eqNullSafe(rows["item_id"]) & (entries["digest"] == rows["digest"])
    entries = entries.join(rows, same).select(entries["item_id"], "text", "length", "entries")
    totals = (
        postings.select("item_id", "digest", "bytes", "length")
        .distinct()
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("length").alias("mean"),
            F.sum(F.col("bytes") + 64 * F.col("length")).alias("bytes"),
        )
        .first()
    )
    if not totals["n"]:
        return []
    shards = -(-totals["bytes"] // INDEX_BYTES)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    indexes = []
    for s in range(shards):
        part = entries.filter(shard == s).collect()
        part.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        plain = [
            {
                "item_id": r["item_id"],
                "text": r["text"],
                "length": r["length"],
                "terms": np.array([e["term"] for e in r["entries"]], np.int64).view(np.uint64),
                "tf": np.array([e["tf"] for e in r["entries"]], float),
                "df": np.array([e["df"] for e in r["entries"]], float),
            }
            for r in part
        ]
        for r in plain:
            order = np.argsort(r["terms"])
            r["terms"], r["tf"], r["df"] = r["terms"][order], r["tf"][order], r["df"][order]
        if plain:
            indexes.append(build(plain, totals["n"], totals["mean"], threshold))
    return indexes


FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def find(docs: DataFrame, indexes: list[Index], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every leaked item.

    All passages of all documents are queries; the values are those of the best passage. A
    document holds an item if a passage reaches THRESHOLD of the item's own score, and at least
    OVERLAP of the shingles of its question and of its answer stand in that passage.

    Null and empty texts hold nothing. Repeated document rows give repeated results. An empty
    table of documents or of items gives no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], FOUND)
    for index in indexes:

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", 1 << 20):
                    rows = matches(part.column("text"), index)
                    texts = pa.array([r[0] for r in rows], pa.int64())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": part.column("doc_id").take(texts),
                            "item_id": pa.array([index.items[r[1]].item_id for r in rows], pa.int64()),
                            "score": pa.array([r[2] for r in rows], pa.float64()),
                            "question_overlap": pa.array([r[3] for r in rows], pa.float64()),
                            "answer_overlap": pa.array([r[4] for r in rows], pa.float64()),
                        }
                    )

        found = found.unionByName(slim.mapInArrow(search, FOUND))
    return found


def keep_clean(docs: DataFrame, indexes: list[Index], text: str = "text") -> DataFrame:
    """The documents that hold no item, with their own columns."""
    small_batches(docs.sparkSession)
    for index in indexes:

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, text, 1 << 20):
                    held = np.zeros(part.num_rows, bool)
                    held[[r[0] for r in matches(part.column(text), index)]] = True
                    yield part.filter(pa.array(~held))

        docs = docs.mapInArrow(clean, T.StructType(docs.schema.fields))
    return docs
