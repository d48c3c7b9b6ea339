"""BPE encoding and decoding: adjacent ranks in a contiguous array per word, least rank first."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import free_name, give_back, pieces, small_batches, text_or_empty

# Fixed value: how byte-level vocabularies cut text into words before any merge.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters with Unicode's property White_Space, which \s stands for there.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A word of more bytes is merged by a heap, as scanning takes the square of its length.
SHORT = 64
# Rank of a pair that no merge has.
NONE = np.int32(np.iinfo(np.int32).max)
# How many chunks a generation of an encoder's memory holds, and the longest chunk it does.
REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 128
# Characters of a text that are cut into chunks at once.
SLICE = 1 << 20
_CELLS = 1 << 20

# Chunks end before a space that follows something other than white space. No word and no merge
# reaches over such a place, so chunks are encoded each for itself, and once if they come again.
_CHUNK = re.compile(rf"(?s:.)[^ ]*(?:(?<=[{WHITE}]) [^ ]*)*")
_SAFE_CUT = re.compile(rf"(?<=[^{WHITE}]) ")


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is
    printable Latin-1, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    stand_in = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(stand_in)) for b in range(256)]


class Vocabulary:
    """Merges and tokens of a byte-level vocabulary file; small, so tasks get it whole."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        ids = model["vocab"]
        byte_of = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"] if t["special"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens = [b""] * size
        for token, at in ids.items():
            self.tokens[at] = b"".join(byte_of[c] for c in token)
        for token, at in self.special.items():
            self.tokens[at] = token.encode()
        self.byte_ids = np.array([ids[c] for c in byte_characters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        # In the order of their keys, for binary search.
        keys = left * size + right
        by_key = np.argsort(keys, kind="stable")
        self.size = size
        self.keys = keys[by_key]
        self.rank_of_key = by_key.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of tokens, or NONE."""
        if len(self.keys) == 0:
            return np.full(left.shape, NONE, np.int32)
        asked = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.rank_of_key[at], NONE)

    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)


def merge_short(words: np.ndarray, vocabulary: Vocabulary) -> Iterator[tuple]:
    """Tokens of words of one length, a row of bytes each: (rows, ids, boundaries), in parts.

    A row holds its parts' boundaries and the ranks of adjacent parts without gaps. Each round
    finds every row's least rank, the leftmost of equal ones, deletes the boundary between these
    two parts and looks up the ranks beside the new part. All rows still at work lose one
    boundary a round, so they stay a rectangle; a row without a merge leaves.
    """
    n, width = words.shape
    rows = np.arange(n)
    ids = vocabulary.byte_ids[words]
    bounds = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
    ranks = vocabulary.ranks(ids[:, :-1], ids[:, 1:])
    while width > 1:
        at = ranks.argmin(axis=1)
        least = ranks[np.arange(len(rows)), at]
        left = least == NONE
        if left.any():
            yield rows[left], ids[left], bounds[left]
            rows, ids, bounds, ranks, at, least = (
                x[~left] for x in (rows, ids, bounds, ranks, at, least)
            )
        if len(rows) == 0:
            return
        every = np.arange(len(rows))
        ids[every, at] = vocabulary.merged[least]
        place = np.arange(width + 1)
        gone = at[:, None] + 1
        ids = ids[place[:width] != gone].reshape(len(rows), width - 1)
        bounds = bounds[place != gone].reshape(len(rows), width)
        ranks = ranks[place[: width - 1] != at[:, None]].reshape(len(rows), width - 2)
        width -= 1
        for beside in (at - 1, at):
            some = np.flatnonzero((beside >= 0) & (beside < width - 1))
            where = beside[some]
            ranks[some, where] = vocabulary.ranks(ids[some, where], ids[some, where + 1])
    yield rows, ids, bounds


def merge_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """The same merges for one long word: a heap of (rank, place) over a linked list."""
    ids = vocabulary.byte_ids[np.frombuffer(word, np.uint8)]
    first = vocabulary.ranks(ids[:-1], ids[1:])
    heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
    heapq.heapify(heap)
    known = dict(zip(vocabulary.keys.tolist(), vocabulary.rank_of_key.tolist(), strict=True))
    part = ids.tolist()
    before, after = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
    size, merged = vocabulary.size, vocabulary.merged.tolist()

    def rank(i: int) -> int | None:
        return known.get(part[i] * size + part[after[i]]) if after[i] >= 0 else None

    while heap:
        least, i = heapq.heappop(heap)
        if part[i] is None or rank(i) != least:
            continue  # one of the two parts has changed since
        gone = after[i]
        part[i], part[gone] = merged[least], None
        after[i] = after[gone]
        if after[gone] >= 0:
            before[after[gone]] = i
        for j in (before[i], i):
            if j >= 0 and (r := rank(j)) is not None:
                heapq.heappush(heap, (r, j))
    return np.array([p for p in part if p is not None], np.int32)


class Remembered:
    """What `compute` makes of chunks, remembered for those that come again.

    Two generations are remembered; the older one goes when the younger one is full, and what was
    asked for meanwhile has moved to the younger one.
    """

    def __init__(self, compute: Callable[[set[str]], dict[str, Any]], most: int):
        self.compute, self.most = compute, most
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def __call__(self, chunks: list[str]) -> list:
        found = list(map(self.young.get, chunks))
        missing = [i for i, value in enumerate(found) if value is None]
        if not missing:
            return found
        asked = {chunks[i] for i in missing}
        fresh = {c: self.old[c] for c in asked if c in self.old}
        fresh.update(self.compute(asked.difference(fresh)))
        for i in missing:
            found[i] = fresh[chunks[i]]
        if len(self.young) + len(fresh) > self.most:
            self.old, self.young = self.young, {}
        if len(fresh) <= self.most:
            self.young.update((c, v) for c, v in fresh.items() if len(c) <= LONGEST_REMEMBERED)
        return found


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers; remembers frequent chunks."""

    def __init__(self, vocabulary: Vocabulary, special: bool = True):
        self.vocabulary = vocabulary
        self.words = regex.compile(WORDS)
        self.ids = Remembered(self.fresh, REMEMBERED)
        names = sorted(vocabulary.special, key=len, reverse=True) if special else []
        marks = "|".join(map(re.escape, names))
        self.marks = re.compile(f"({marks})") if names else None

    def merge(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each distinct word."""
        found: dict[bytes, bytes] = {}
        by_length: dict[int, list[bytes]] = {}
        for word in set(words):
            by_length.setdefault(len(word), []).append(word)
        for length, some in by_length.items():
            if length > SHORT:
                found.update((w, merge_long(w, self.vocabulary).astype("<u4").tobytes()) for w in some)
                continue
            step = max(1, _CELLS // length)
            for start in range(0, len(some), step):
                few = some[start : start + step]
                block = np.frombuffer(b"".join(few), np.uint8).reshape(len(few), length)
                for rows, ids, _ in merge_short(block, self.vocabulary):
                    packed, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    for k, row in enumerate(rows.tolist()):
                        found[few[row]] = packed[k * width : (k + 1) * width]
        return found

    def fresh(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """The ids of distinct chunks, merged anew."""
        cut = {c: [w.encode() for w in self.words.findall(c)] for c in chunks}
        ids = self.merge([w for words in cut.values() for w in words])
        return {c: b"".join([ids[w] for w in words]) for c, words in cut.items()}

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """The text as lists of chunks, and the special tokens between them."""
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                yield self.vocabulary.special[part]
            else:
                yield from chunks_of(part)

    def encode(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text its ids, in pieces of bounded size. Texts of usual length are looked up
        together."""
        few: list[list[list[str] | int]] = []
        for text in texts:
            if len(text) <= SLICE:
                few.append(list(self.parts(text)))
                continue
            yield from self._together(few)
            few = []
            yield (self._ids(part) for part in self.parts(text))
        yield from self._together(few)

    def _ids(self, part: list[str] | int) -> bytes:
        return _one(part) if isinstance(part, int) else b"".join(self.ids(part))

    def _together(self, texts: list[list[list[str] | int]]) -> Iterator[Iterator[bytes]]:
        found = self.ids([c for parts in texts for p in parts if not isinstance(p, int) for c in p])
        at = 0
        for parts in texts:
            out = []
            for part in parts:
                if isinstance(part, int):
                    out.append(_one(part))
                else:
                    out.append(b"".join(found[at : at + len(part)]))
                    at += len(part)
            yield iter(out)


def _one(token: int) -> bytes:
    return token.to_bytes(4, "little")


def chunks_of(text: str) -> Iterator[list[str]]:
    """Chunks that are encoded each for itself, those of SLICE characters or a little more at
    a time."""
    start = 0
    while start < len(text):
        cut = _SAFE_CUT.search(text, start + SLICE)
        end = cut.start() if cut else len(text)
        yield _CHUNK.findall(text, start, end)
        start = end


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class TextDecoder:
    """UTF-8 of decoded bytes; what is no UTF-8 becomes the replacement character."""

    def __init__(self):
        self.decoder = codecs.getincrementaldecoder("utf-8")("replace")

    def take(self, data: bytes, last: bool = False) -> str:
        return self.decoder.decode(data, last)


def _shared(docs: DataFrame, path: str):
    """The vocabulary, read once and sent to every executor once; its size is that of a file of
    fixed size, whatever the documents are."""
    return docs.sparkSession.sparkContext.broadcast(Vocabulary(path))


def _mapped(docs: DataFrame, text: str, work, added: list[T.StructField], keep: list[str] | None):
    """`docs` with the columns `work` makes of a list of texts. An input column named like a new
    one is replaced."""
    small_batches(docs.sparkSession)
    taken = {f.name.lower() for f in added}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    own = free_name(docs, "own_text")
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(own))
    schema = T.StructType([*[slim.schema[c] for c in keep], *added])
    types = [T.ArrayType(T.IntegerType())]
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), types[0]: pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for part in pieces(batch, own) if pa.types.is_string(batch.column(own).type) else [batch]:
                values = step(part.column(own))
                columns = [part.column(c) for c in keep]
                columns += [pa.array(v, kinds[f.dataType]) for v, f in zip(values, added, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *[f.name for f in added]])
            give_back()

    return slim.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", special: bool = True) -> DataFrame:
    """The documents with `tokens`, the ids of each whole text (array of int).

    `path` names a byte-level vocabulary file, read on the driver. Special tokens in a text are
    recognised unless `special` is off; none are added. Null or empty text has no tokens.
    Repeated rows get equal tokens; an empty table gives no rows; an input column `tokens` is
    replaced.
    """
    shared = _shared(docs, path)

    def work():
        encoder = Encoder(shared.value, special)

        def step(texts: pa.Array):
            ids = encoder.encode([t or "" for t in texts.to_pylist()])
            return [[np.frombuffer(b"".join(parts), "<u4").astype(np.int32) for parts in ids]]

        return step

    return _mapped(docs, text, work, [T.StructField("tokens", T.ArrayType(T.IntegerType()))], None)


def decode(rows: DataFrame, path: str, tokens: str = "tokens", into: str = "text") -> DataFrame:
    """The rows with the text of their token ids, special tokens included. Null gives an empty
    text; an id the vocabulary lacks fails the job."""
    shared = _shared(rows, path)

    def work():
        vocabulary = shared.value

        def step(ids: pa.Array):
            packed = (np.array(i or [], "<u4").tobytes() for i in ids.to_pylist())
            return [[decode_ids(p, vocabulary.tokens).decode("utf-8", "replace") for p in packed]]

        return step

    return _mapped(rows, tokens, work, [T.StructField(into, T.StringType())], None)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Number of tokens, hash of the ids and hash of the text decoded from them, per document.

    Ids are hashed as little-endian 32-bit numbers. A text is encoded, hashed and decoded in
    pieces, so that a very long one takes no more memory than its own. Null is an empty text.
    """
    shared = _shared(docs, path)
    added = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def work():
        vocabulary = shared.value
        encoder = Encoder(vocabulary)

        def step(texts: pa.Array):
            counts, ids_hashes, text_hashes = [], [], []
            for parts in encoder.encode([t or "" for t in texts.to_pylist()]):
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                decoder = TextDecoder()
                for ids in parts:
                    n += len(ids) // 4
                    ids_hash.update(ids)
                    text_hash.update(decoder.take(decode_ids(ids, vocabulary.tokens)).encode())
                text_hash.update(decoder.take(b"", True).encode())
                counts.append(n)
                ids_hashes.append(ids_hash.hexdigest())
                text_hashes.append(text_hash.hexdigest())
            return counts, ids_hashes, text_hashes

        return step

    return _mapped(docs.withColumn(text, text_or_empty(text)), text, work, added, keep)
