"""Helpers of these tests: frames from rows, and slow but plain versions of shared steps."""

from __future__ import annotations

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def remainder(doc_id, divisor: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def documents(spark, texts, ids=None, **columns):
    """Documents with the given texts; ids from 0 unless given; other columns null."""
    ids = list(range(len(texts))) if ids is None else ids
    more = [columns.get(name, [None] * len(texts)) for name in ("lang", "source", "n_chars")]
    return spark.createDataFrame(list(zip(ids, texts, *more, strict=True)), DOCS)


class Groups:
    """Union-find over any values, with the least value as a group's name."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
