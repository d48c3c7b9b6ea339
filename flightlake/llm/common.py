"""Small helpers the operators share: free column names, stored steps, sizes, batches of texts."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from inspect import signature

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what separates words, in UTF-8 bytes: space and the five controls 09 to 0D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
# Fixed value: a word, as a pattern.
WORD = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no input column has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame) -> DataFrame:
    """The frame computed once and read back from the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored steps, which the driver and all executors share.

    It is the session's `spark.checkpoint.dir`. Only on one machine, as in tests, a temporary one
    is taken where none is named; executors of a cluster would not see it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python a thousand at a time, unless the session says otherwise; Spark's own
    number is made for rows of a few numbers."""
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, 1000)


_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def give_back() -> None:
    """Hand freed memory to the system: workers are kept, and what they hold adds to what the
    executor needs later."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def frugal(work: Callable) -> Callable:
    """A step over a group that gives its memory back at the end."""

    # Spark counts a step's arguments: one group, or two side by side.
    def alone(group):
        result = work(group)
        give_back()
        return result

    def beside(left, right):
        result = work(left, right)
        give_back()
        return result

    return alone if len(signature(work).parameters) == 1 else beside


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text modulo a divisor; a null id counts as empty text."""
    return F.crc32(text_or_empty(doc_id).cast("binary")) % divisor


def blocks_for(docs: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about so many bytes of text the documents make."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("n"))
    found = total.first()
    # A document weighs some bytes even without text.
    return max(1, -(-((found["bytes"] or 0) + 64 * found["n"]) // block_bytes))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column laid end to end, and the texts' bounds; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes unchanged."""
    return _LOWER[data]


def pieces(
    batch: pa.RecordBatch, text: str, limit: int = 2 << 20, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows, so that a piece holds about `limit` bytes of text at most."""
    _, bounds = text_bytes(batch.column(text))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows, row + (rows or batch.num_rows))
        yield batch.slice(row, end - row)
        row = end
    give_back()


class Words:
    """Where the words of a batch of texts lie: starts, ends (bytes) and counts per text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data = data
        inside = ~_IS_SPACE[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = bounds[1:] > bounds[:-1]
        heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.bounds)
        self._inside = inside

    def hashes(self) -> np.ndarray:
        """64-bit fingerprints of the words: sums of byte values times powers, then mixed."""
        lengths = self.ends - self.starts
        out = np.zeros(len(lengths), np.uint64)
        ends = np.cumsum(lengths)
        done = 0
        while done < len(lengths):
            # So many words at once that their bytes take little memory.
            base = int(ends[done - 1]) if done else 0
            upto = max(done + 1, int(np.searchsorted(ends, base + _AT_ONCE, "right")))
            some = lengths[done:upto]
            firsts = np.cumsum(some) - some
            places = np.arange(int(some.sum()), dtype=np.int32)
            places -= np.repeat(firsts.astype(np.int32), some)
            begin, end = self.starts[done], self.ends[upto - 1]
            values = _BYTE[self.data[begin:end][self._inside[begin:end]]]
            values *= _powers(int(some.max()))[places]
            out[done:upto] = np.add.reduceat(values, firsts)
            done = upto
        return mixed(out + lengths.astype(np.uint64))

    def prefixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the words' first bytes, and which words are longer than that.

        A fingerprint differs from that of the same bytes as a whole word.
        """
        lengths = self.ends - self.starts
        longer = lengths > length
        starts = self.starts[longer]
        values = np.full(len(starts), -length, np.int64).view(np.uint64)
        power = _powers(length)
        for j in range(length):
            values += _BYTE[self.data[starts + j]] * power[j]
        return mixed(values), longer


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWER
    if len(_POWER) < n:
        base = np.full(max(n, 2 * len(_POWER)), 0x9E3779B97F4A7C15, np.uint64)
        base[0] = 1
        _POWER = np.multiply.accumulate(base)
    return _POWER


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_POWER = np.ones(1, np.uint64)
_AT_ONCE = 1 << 20


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values, as compressed differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def unpack_sorted(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(_unpack(packed), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u8").ravel(), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Whole numbers that are mostly small, byte plane by byte plane and compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return _pack(np.ascontiguousarray(planes))


def unpack_small(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(packed), np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(planes).view("<u8").ravel().astype(np.int64)


def _pack(planes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def by_range(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each of `shards` (a power of two) equal ranges of hashes starts and ends."""
    if shards == 1:
        return np.array([0, len(hashes)])
    firsts = np.arange(1, shards, dtype=np.uint64) << np.uint64(65 - shards.bit_length())
    return np.concatenate([[0], np.searchsorted(hashes, firsts), [len(hashes)]])
