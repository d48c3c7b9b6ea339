"""Cross-tokenizer alignment: inverted pair bitmaps over documents, whose postings return scores."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.bpe import SLICE, WHITE, Encoder, Remembered, Vocabulary, chunks_of
from flightlake.llm.common import (
    free_name,
    frugal,
    mixed,
    pack_small,
    pack_sorted,
    pieces,
    power_of_two,
    small_batches,
    stored,
    unpack_small,
    unpack_sorted,
)

# Text and documents that one block's bitmaps cover.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 1 << 15
# Pairs (one for each block that has it) that meet in one task.
SHARD_PAIRS = 1 << 21
REMEMBERED = 1 << 17
_WORDS_AT_ONCE = 1 << 16

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_REQUEST = "shard int, block long, pairs binary, documents binary, links binary"
_ANSWER = "block long, shard int, counts binary, a_ids binary, most binary"
_PAIRS = "a_id long, b_id long, documents long, links long"


class Pieces:
    """A sentence-piece model: its pieces as bytes, with the mark for a space as a space."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.tokens = [self._bytes(i) for i in range(size)]
        self.crossing = regex.compile(rf"[^{WHITE}] ")

    def _bytes(self, at: int) -> bytes:
        piece = self.model.id_to_piece(at)
        if self.model.is_byte(at):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def splits(self) -> bool:
        """Whether no piece reaches over the end of a chunk, so that chunks can be encoded each
        for itself."""
        return not any(self.crossing.search(t.decode("utf-8", "replace")) for t in self.tokens)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """The pieces of chunks that begin with a space, which the model itself puts before a text.
        It does not before an empty one, so a space by itself is looked up."""
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        for i, chunk in enumerate(chunks):
            if chunk == " ":
                found[i] = [self.model.piece_to_id("▁")]
        return found


class Aligner:
    """Aligned tokens of texts, which begin with a space; remembers frequent chunks.

    For a chunk: number of A tokens, B tokens and groups, the linked pairs (as A id times the
    size of B plus B id, 64 bits each) and the groups as text; False where a tokenizer does not
    give the chunk's bytes back.
    """

    def __init__(self, vocabulary: Vocabulary, model: bytes):
        self.a = Encoder(vocabulary, special=False)
        self.b = Pieces(model)
        self.size_b = len(self.b.tokens)
        self.whole = not self.b.splits()
        self.lengths_a = vocabulary.lengths()
        self.lengths_b = np.array([len(t) for t in self.b.tokens], np.int64)
        self.aligned = Remembered(self._fresh, REMEMBERED)
        names = [str(i).encode() for i in range(max(vocabulary.size, self.size_b))]
        self.digits = np.array([len(n) for n in names], np.int64)
        width = int(self.digits.max()) + 1
        flat = b"".join(n.ljust(width) for n in names)
        self.names = np.frombuffer(flat, np.uint8).reshape(len(names), width)

    def chunks(self, text: str) -> Iterable[list[str]]:
        return [[text]] if self.whole else chunks_of(text)

    def _fresh(self, asked: set[str]) -> dict[str, tuple | bool]:
        chunks = list(asked)
        ids_a = self.a.fresh(chunks)
        ids_b = self.b.encode(chunks)
        found: dict[str, tuple | bool] = {}
        kept, parts_a, parts_b = [], [], []
        tokens_a, tokens_b = self.a.vocabulary.tokens, self.b.tokens
        for chunk, b in zip(chunks, ids_b, strict=True):
            a = np.frombuffer(ids_a[chunk], "<u4")
            raw = chunk.encode()
            same = b"".join(map(tokens_b.__getitem__, b)) == raw
            if same and b"".join(map(tokens_a.__getitem__, a.tolist())) == raw:
                kept.append(chunk)
                parts_a.append(a)
                parts_b.append(b)
            else:
                found[chunk] = False
        if kept:
            found.update(zip(kept, self._align(parts_a, parts_b), strict=True))
        return found

    def _align(self, parts_a: list[np.ndarray], parts_b: list[list[int]]) -> Iterator[tuple]:
        """The entries of chunks, laid end to end so that all are aligned at once."""
        n_a = np.array([len(p) for p in parts_a])
        n_b = np.array([len(p) for p in parts_b])
        a = np.concatenate(parts_a).astype(np.int64)
        b = np.fromiter((i for p in parts_b for i in p), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        chunk_ends = ends_a[np.cumsum(n_a) - 1]
        # Between two neighbouring ends of any kind lies one overlap of one A and one B token.
        ends = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, ends)] * self.size_b + b[np.searchsorted(ends_b, ends)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        # Tokens by group, in a group those of A first.
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        ids = np.empty(len(a) + len(b), np.int64)
        marks = np.full(len(ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        marks[place_a[np.append(group_a[1:] != group_a[:-1], True)]] = ord("|")
        marks[place_b[np.append(group_b[1:] != group_b[:-1], True)]] = ord(";")
        sizes = self.digits[ids]
        shown = self.names[ids]
        shown[np.arange(len(ids)), sizes] = marks
        text = shown[np.arange(shown.shape[1]) <= sizes[:, None]].tobytes()
        text_ends = np.cumsum(sizes + 1)[np.cumsum(n_a + n_b) - 1].tolist()
        link_ends = np.searchsorted(ends, chunk_ends, "right").tolist()
        group_ends = np.searchsorted(common, chunk_ends, "right").tolist()
        packed = links.astype("<u8").tobytes()
        text_at = link_at = group_at = 0
        for i, (of_a, of_b) in enumerate(zip(n_a.tolist(), n_b.tolist(), strict=True)):
            groups = text[text_at : text_ends[i] - 1]
            yield of_a, of_b, group_ends[i] - group_at, packed[8 * link_at : 8 * link_ends[i]], groups
            text_at, link_at, group_at = text_ends[i], link_ends[i], group_ends[i]

    def read(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray]]:
        """For each text its numbers of A tokens, B tokens, groups and links, the hash of its
        groups, and its linked pairs with how often each is linked. Chunks of texts of usual
        length are looked up together; of a long text only the distinct pairs are gathered."""
        few: list[list[str]] = []
        for text in texts:
            if len(text) <= SLICE or self.whole:
                few.append([c for chunks in self.chunks(f" {text}") for c in chunks] if text else [])
                continue
            yield from self._together(few)
            few = []
            yield _summary(self.aligned(chunks) for chunks in self.chunks(f" {text}"))
        yield from self._together(few)

    def _together(self, texts: list[list[str]]) -> Iterator[tuple]:
        found = self.aligned([c for chunks in texts for c in chunks])
        at = 0
        for chunks in texts:
            yield _summary([found[at : at + len(chunks)]] if chunks else [])
            at += len(chunks)


def _summary(parts: Iterable[list]) -> tuple[list[int], str, np.ndarray, np.ndarray]:
    totals, digest = [0, 0, 0, 0], hashlib.sha256()
    pairs, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    nothing = [0, 0, 0, 0], "", pairs, times
    for found in parts:
        if not all(found):
            return nothing
        if totals[0]:
            digest.update(b";")
        of_a, of_b, groups, packed, texts = zip(*found, strict=True)
        digest.update(b";".join(texts))
        links = np.frombuffer(b"".join(packed), "<u8")
        for i, more in enumerate((sum(of_a), sum(of_b), sum(groups), len(links))):
            totals[i] += more
        some, some_times = np.unique(links, return_counts=True)
        if len(pairs):
            some, some_times = _added(np.concatenate([pairs, some]), np.concatenate([times, some_times]))
        pairs, times = some, some_times
    return (totals, digest.hexdigest(), pairs, times) if totals[0] else nothing


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[heads], np.add.reduceat(values[order], heads) if len(keys) else values


class Bitmaps:
    """Bitmaps of many pairs over the documents of a block, of which only words that are not
    zero are kept: their places (pair times words per bitmap, plus word), ascending, and bits."""

    def __init__(self, places: np.ndarray, words: np.ndarray, per_bitmap: int):
        self.places, self.words, self.per_bitmap = places, words, per_bitmap

    @classmethod
    def of(cls, pairs: np.ndarray, docs: np.ndarray, per_bitmap: int) -> Bitmaps:
        places = pairs * per_bitmap + (docs >> 6)
        bits = np.uint64(1) << (docs & 63).astype(np.uint64)
        return cls(places, bits, per_bitmap)._merged()

    def _merged(self) -> Bitmaps:
        if len(self.places) == 0:
            return self
        order = np.argsort(self.places, kind="stable")
        places = self.places[order]
        heads = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        words = np.bitwise_or.reduceat(self.words[order], heads)
        return Bitmaps(places[heads], words, self.per_bitmap)

    def either(self, other: Bitmaps) -> Bitmaps:
        """The OR of both, pair by pair."""
        places = np.concatenate([self.places, other.places])
        return Bitmaps(places, np.concatenate([self.words, other.words]), self.per_bitmap)._merged()

    def counts(self, pairs: int) -> np.ndarray:
        """Documents of each pair."""
        found = np.zeros(pairs, np.int64)
        np.add.at(found, self.places // self.per_bitmap, np.bitwise_count(self.words).astype(np.int64))
        return found

    def members(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pairs, documents) of all set bits, some at a time."""
        for start in range(0, len(self.words), _WORDS_AT_ONCE):
            words = np.ascontiguousarray(self.words[start : start + _WORDS_AT_ONCE], "<u8")
            at = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
            places = self.places[start + (at >> 6)]
            yield places // self.per_bitmap, (places % self.per_bitmap) * 64 + (at & 63)

    def pack(self) -> list[bytes]:
        return [pack_sorted(self.places.astype(np.uint64)), pack_small(self.words)]

    @classmethod
    def unpack(cls, places: bytes, words: bytes, per_bitmap: int) -> Bitmaps:
        bits = unpack_small(words).view(np.uint64)
        return cls(unpack_sorted(places).astype(np.int64), bits, per_bitmap)


def planes_of(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, per_bitmap: int) -> list[Bitmaps]:
    """Multiplicity planes: plane k has the documents whose number of links has bit k."""
    found = []
    for k in range(int(times.max()).bit_length() if len(times) else 0):
        some = (times >> k) & 1 == 1
        found.append(Bitmaps.of(pairs[some], docs[some], per_bitmap))
    return found


def _document_counts(planes: list[Bitmaps], pairs: int) -> np.ndarray:
    present = planes[0]
    for plane in planes[1:]:
        present = present.either(plane)
    return present.counts(pairs)


def _link_counts(planes: list[Bitmaps], pairs: int) -> np.ndarray:
    return sum(plane.counts(pairs) << k for k, plane in enumerate(planes))


class _Block:
    """Documents read so far of the block at work."""

    def __init__(self):
        self.rows = self.bytes = 0
        self.pairs, self.times = [], []

    def take(self, text: str, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows += 1
        self.bytes += len(text)
        self.pairs.append(pairs)
        self.times.append(times)

    def full(self) -> bool:
        return self.rows >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES

    def row(self) -> dict:
        keys = np.concatenate(self.pairs)
        docs = np.repeat(np.arange(self.rows), [len(p) for p in self.pairs])
        times = np.concatenate(self.times)
        distinct, pairs = np.unique(keys, return_inverse=True)
        planes = planes_of(pairs, docs, times, -(-self.rows // 64))
        documents = links = np.zeros(0, np.int64)
        if planes:
            documents = _document_counts(planes, len(distinct))
            links = _link_counts(planes, len(distinct))
        return {
            "n_pairs": len(distinct),
            "rows_in": self.rows,
            "pairs": pack_sorted(distinct),
            "documents": pack_small(documents),
            "links": pack_small(links),
            "planes": [part for plane in planes for part in plane.pack()],
        }


_BLOCK_SCHEMA = {
    "n_pairs": T.LongType(),
    "rows_in": T.LongType(),
    "pairs": T.BinaryType(),
    "documents": T.BinaryType(),
    "links": T.BinaryType(),
    "planes": T.ArrayType(T.BinaryType()),
}


def _own_names(docs: DataFrame, keep: list[str] | None, added: Iterable[str]) -> dict[str, str]:
    """The columns to keep, by names that no column of ours has."""
    taken = {c.lower() for c in added}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    return {c: f"own_{i}" for i, c in enumerate(keep)}


def _index(docs: DataFrame, inner: dict[str, str], a_path: str, b_path: str, text: str) -> DataFrame:
    """A row per document with its numbers, and one per block with its pairs and bitmaps
    (`place` -1). Documents stay in the tasks that read them; a block is what a task reads one
    after the other until it has BLOCK_BYTES of text."""
    small_batches(docs.sparkSession)
    with open(b_path, "rb") as file:
        model = file.read()
    # Both are of fixed size, whatever the documents are.
    shared = docs.sparkSession.sparkContext.broadcast((Vocabulary(a_path), model))
    own_text = free_name(docs, "aligned_text")
    slim = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in inner.items()], F.col(f"`{text}`").cast("string").alias(own_text)
    )
    schema = T.StructType(
        [
            *[T.StructField(n, slim.schema[n].dataType) for n in inner.values()],
            T.StructField("block", T.LongType()),
            T.StructField("place", T.LongType()),
            *[T.StructField(c, T.LongType()) for c in _COUNTS],
            T.StructField("groups_sha256", T.StringType()),
            *[T.StructField(c, t) for c, t in _BLOCK_SCHEMA.items()],
        ]
    )
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        number = TaskContext.get().partitionId() << 32
        block = _Block()

        def closed() -> pa.RecordBatch:
            row = block.row() | {"block": number, "place": -1}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for part in pieces(batch, own_text, rows=BLOCK_ROWS):
                texts = [t or "" for t in part.column(own_text).to_pylist()]
                found = []
                for text, (totals, digest, pairs, times) in zip(texts, aligner.read(texts), strict=True):
                    found.append((number, block.rows, *totals, digest))
                    block.take(text, pairs, times)
                yield _doc_rows(part, found, arrow)
                if block.full():
                    yield closed()
                    number, block = number + 1, _Block()
        if block.rows:
            yield closed()

    return slim.mapInArrow(run, schema)


def _doc_rows(batch: pa.RecordBatch, found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    told = dict(zip(("block", "place", *_COUNTS, "groups_sha256"), zip(*found, strict=True), strict=True))
    columns = []
    for field in schema:
        if field.name in told:
            columns.append(pa.array(told[field.name], field.type))
        elif field.name in _BLOCK_SCHEMA:
            columns.append(pa.nulls(batch.num_rows, field.type))
        else:
            columns.append(batch.column(field.name).cast(field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(pairs) % np.uint64(shards)).astype(np.int64)


def _ask(shards: int, links: bool):
    """A block's pairs and their counts, dealt by a hash of the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = unpack_sorted(row["pairs"])
                counts = [unpack_small(row["documents"])]
                if links:
                    counts.append(unpack_small(row["links"]))
                shard = _shard_of(pairs, shards)
                order = np.argsort(shard, kind="stable")
                ends = np.searchsorted(shard[order], np.arange(shards + 1))
                out = []
                for s in np.flatnonzero(np.diff(ends)).tolist():
                    some = order[ends[s] : ends[s + 1]]
                    told = [pack_small(c[some]) for c in counts] + [None] * (not links)
                    out.append((s, row["block"], pack_sorted(pairs[some]), *told))
                if out:
                    names = ["shard", "block", "pairs", "documents", "links"]
                    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _answer(size_b: int):
    """The counts over all blocks of the pairs each block asks for, and per A id the highest."""

    def run(table: pa.Table) -> pa.Table:
        pairs = [unpack_sorted(p) for p in table.column("pairs").to_pylist()]
        counts = [unpack_small(c) for c in table.column("documents").to_pylist()]
        distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        ends = np.cumsum([len(p) for p in pairs])[:-1]
        answers = [pack_small(total[some]) for some in np.split(at, ends)]
        a_ids = (distinct // np.uint64(size_b)).astype(np.uint64)
        heads = np.flatnonzero(np.append(True, a_ids[1:] != a_ids[:-1]))
        most = np.maximum.reduceat(total, heads)
        shard = table.column("shard")[0].as_py()
        blocks = table.column("block").to_pylist()
        n = len(blocks)
        return pa.table(
            {
                "block": pa.array([*blocks, None], pa.int64()),
                "shard": pa.array([shard] * (n + 1), pa.int32()),
                "counts": pa.array([*answers, None], pa.binary()),
                "a_ids": pa.array([None] * n + [pack_sorted(a_ids[heads])], pa.binary()),
                "most": pa.array([None] * n + [pack_small(most)], pa.binary()),
            }
        )

    return run


def _sum_pairs(size_b: int):
    def run(table: pa.Table) -> pa.Table:
        pairs = np.concatenate([unpack_sorted(p) for p in table.column("pairs").to_pylist()])
        distinct, at = np.unique(pairs, return_inverse=True)
        sums = []
        for name in ("documents", "links"):
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, at, np.concatenate([unpack_small(c) for c in table.column(name).to_pylist()]))
            sums.append(total)
        ids = [(distinct // np.uint64(size_b)), (distinct % np.uint64(size_b))]
        columns = [pa.array(c.astype(np.int64)) for c in (*ids, *sums)]
        return pa.Table.from_arrays(columns, ["a_id", "b_id", "documents", "links"])

    return run


def _highest(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The A ids that occur and each one's highest count: a row per token of A at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, most in zip(*(batch.column(c).to_pylist() for c in ("a_ids", "most")), strict=True):
                columns = [pa.array(unpack_sorted(ids).astype(np.int64)), pa.array(unpack_small(most))]
                yield pa.RecordBatch.from_arrays(columns, ["a_id", "most"])

    rows = answers.filter(F.col("block").isNull()).select("a_ids", "most")
    table = rows.mapInArrow(run, "a_id long, most long").groupBy("a_id").agg(F.max("most").alias("most"))
    found = table.orderBy("a_id").toArrow()
    return tuple(found.column(c).to_numpy().astype(np.int64) for c in ("a_id", "most"))


def _return_scores(shards: int, size_b: int, shared, own: list[str], schema: pa.Schema):
    """A block's documents with the scores its postings give them."""

    def run(mine: pa.Table, told: pa.Table) -> pa.Table:
        place = mine.column("place").to_numpy()
        docs = mine.filter(pa.array(place >= 0)).sort_by("place")
        row = mine.filter(pa.array(place < 0)).select([*_BLOCK_SCHEMA]).to_pylist()[0]
        pairs = unpack_sorted(row["pairs"])
        scores, best = np.zeros((2, docs.num_rows), np.int64)
        if len(pairs):
            counts = np.zeros(len(pairs), np.int64)
            by_shard = np.argsort(_shard_of(pairs, shards), kind="stable")
            ranked = np.argsort(told.column("shard").to_numpy())
            packed = told.column("counts").to_pylist()
            counts[by_shard] = np.concatenate([unpack_small(packed[i]) for i in ranked])
            a_ids, most = shared.value
            of_a = most[np.searchsorted(a_ids, (pairs // np.uint64(size_b)).astype(np.int64))]
            is_best = (counts == of_a).astype(np.int64)
            parts, per_bitmap = row["planes"], -(-row["rows_in"] // 64)
            for k in range(len(parts) // 2):
                plane = Bitmaps.unpack(parts[2 * k], parts[2 * k + 1], per_bitmap)
                for pair, doc in plane.members():
                    np.add.at(scores, doc, counts[pair] << k)
                    np.add.at(best, doc, is_best[pair] << k)
        columns = [docs.column(n) for n in (*own, *_COUNTS)]
        columns += [pa.array(best), pa.array(scores), docs.column("groups_sha256")]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _size_b(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def _shards(blocks: DataFrame) -> int:
    return power_of_two((blocks.agg(F.sum("n_pairs").alias("n")).first()["n"] or 0) / SHARD_PAIRS)


def align(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The documents with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A space and the text are encoded by a byte-level vocabulary (A) and by a sentence-piece model
    (B). Byte offsets where tokens of both end cut them into groups; tokens that share bytes are
    linked. Per block of documents every linked pair has bitmaps: plane k has the documents in
    which bit k of the number of its links is set. The OR of the planes counts the pair's
    documents. Blocks cover different documents, so the counts of a pair's bitmaps add up; they
    meet by a hash of the pair, a frequent pair as one number per block. The answers go back to
    the blocks, whose postings give each document `count_sum` (counts over its links) and
    `n_best` (links whose count is the highest of their A id).

    Texts that are null, empty or not given back byte for byte by both have no tokens: zeros, and
    an empty `groups_sha256`. Special tokens in texts are plain text. Repeated rows each are a
    document. An empty table gives no rows; input columns named like new ones are replaced. The
    paths are read on the driver.
    """
    added = [*_COUNTS, "n_best", "count_sum", "groups_sha256"]
    inner = _own_names(docs, keep, added)
    own = list(inner.values())
    size_b = _size_b(b_path)
    rows = stored(_index(docs, inner, a_path, b_path, text))
    blocks = rows.filter("place = -1")
    shards = _shards(blocks)
    asked = blocks.select("block", "pairs", "documents").mapInArrow(_ask(shards, False), _REQUEST)
    answers = stored(asked.groupBy("shard").applyInArrow(frugal(_answer(size_b)), _ANSWER))
    shared = docs.sparkSession.sparkContext.broadcast(_highest(answers))
    kinds = [T.StringType() if c == "groups_sha256" else T.LongType() for c in added]
    schema = T.StructType(
        [
            *[T.StructField(n, docs.schema[c].dataType) for c, n in inner.items()],
            *[T.StructField(c, k) for c, k in zip(added, kinds, strict=True)],
        ]
    )
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema
    replies = answers.filter(F.col("block").isNotNull()).select("block", "shard", "counts")
    scored = (
        rows.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(frugal(_return_scores(shards, size_b, shared, own, arrow)), schema)
    )
    return scored.select(*[F.col(n).alias(c) for c, n in inner.items()], *added)


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Every linked pair: a_id, b_id, how many documents hold it, and how many links there are.

    The links are counted from the multiplicity planes: a document in plane k has 2^k of them.
    """
    size_b = _size_b(b_path)
    rows = stored(_index(docs, {}, a_path, b_path, text).filter("place = -1"))
    shards = _shards(rows)
    asked = rows.select("block", "pairs", "documents", "links").mapInArrow(_ask(shards, True), _REQUEST)
    return asked.groupBy("shard").applyInArrow(frugal(_sum_pairs(size_b)), _PAIRS)
