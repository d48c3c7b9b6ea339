"""Language identification: nearest of several TF-IDF centroids per language, with rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import free_name, pieces, small_batches, text_bytes

# Length of a feature in bytes, and the number of buckets features are hashed into.
GRAM = 3
BUCKETS = 8192
_BITS = BUCKETS.bit_length() - 1
# Labelled documents per language the model is fitted on, at most.
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 10
# A text is rejected below this share of a low quantile of the similarities seen at its length,
# of so many texts at least. A word or two say nothing about the distance: such texts are kept.
SLACK, QUANTILE = 0.6, 0.01
LEAST_TEXTS = 30
LEAST_GRAMS = 8
# Similarities are counted in so many steps.
STEPS = 1000
UNKNOWN = "und"

# Length classes: powers of two of the number of n-grams.
CLASSES = 64

_ROWS, _PIECE = 256, 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True


@dataclass
class Model:
    """idf per bucket; a centroid per row with its language; the rejection floor by length."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floors: np.ndarray


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed n-grams of letters, a row per text.

    Texts are lower-cased; whatever is not a letter becomes one space, as do the text's ends.
    """
    data, bounds = text_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    letter = _LETTER[data]
    # One space before each word and after each text's last word; other bytes go.
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    heads = bounds[:-1][bounds[1:] > bounds[:-1]]
    starts[heads] = letter[heads]
    kept = np.flatnonzero(letter)
    spaced = kept + np.cumsum(starts[kept]) + owner[kept]
    size = len(data) + int(starts.sum()) + n + 1
    line = np.full(size, 255, np.uint16)  # 255 marks unused places; UTF-8 never holds it
    line[spaced] = data[kept]
    line[spaced[starts[kept]] - 1] = 32
    used = np.flatnonzero(line != 255)
    owners = np.zeros(size, np.int64)
    owners[spaced] = owner[kept]
    owners[spaced[starts[kept]] - 1] = owner[kept[starts[kept]]]
    line, owners = line[used].astype(np.uint64), owners[used]
    if len(line) < GRAM:
        return np.zeros((n, BUCKETS), np.float32)
    last = len(line) - GRAM + 1
    code = np.zeros(last, np.uint64)
    for j in range(GRAM):
        code = (code << np.uint64(8)) | line[j : j + last]
    whole = owners[:last] == owners[GRAM - 1 :]
    # A multiplicative hash: the product's high bits.
    bucket = (code[whole] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)
    cells = owners[:last][whole] * BUCKETS + bucket.astype(np.int64)
    return np.bincount(cells, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square roots of counts times idf, scaled to length 1 (zero stays zero)."""
    vectors = np.sqrt(counts) * idf
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors / np.maximum(norms, 1e-30)[:, None]


def _length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts.sum(axis=1), 1)).astype(np.int64)


def _centroids(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the mean and then the vectors farthest from all centres."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < min(k, len(vectors)):
        near = np.max(vectors @ np.array(centres).T, axis=1)
        centres.append(vectors[int(np.argmin(near))])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-30)[:, None]
        nearest = np.argmax(vectors @ centres.T, axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                centres[c] = vectors[nearest == c].mean(axis=0)
    return centres / np.maximum(np.linalg.norm(centres, axis=1), 1e-30)[:, None]


def fit_arrays(counts: np.ndarray, languages: np.ndarray, centroids: int = CENTROIDS) -> Model:
    seen = (counts > 0).sum(axis=0)
    idf = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
    vectors = weighted(counts, idf)
    names, rows = [], []
    for language in sorted(set(languages)):
        mine = _centroids(vectors[languages == language], centroids)
        rows.append(mine)
        names += [language] * len(mine)
    centres = np.concatenate(rows).astype(np.float32) if rows else np.zeros((0, BUCKETS), np.float32)
    return Model(idf, centres, names, np.zeros(CLASSES))


def similarity_cells(texts: pa.Array, model: Model) -> np.ndarray:
    """Each text's length class and step of similarity, as one number."""
    counts = gram_counts(texts)
    near = (weighted(counts, model.idf) @ model.centroids.T).max(axis=1).clip(0, 1)
    return _length_class(counts) * (STEPS + 1) + (near * STEPS).astype(np.int64)


def floors(seen: np.ndarray) -> np.ndarray:
    """The rejection floor by length class, from counts of texts by class and similarity step.

    A class counts with as many neighbours on both sides as make LEAST_TEXTS texts, so one
    longer than any seen has the floor of the longest. Below the shortest seen, floors fall like
    similarities do, with the square root of the length.
    """
    out = np.zeros(CLASSES)
    filled = np.flatnonzero(seen.sum(axis=1))
    if len(filled) == 0:
        return out
    for c in range(LEAST_GRAMS.bit_length() - 1, CLASSES):
        for reach in range(CLASSES):
            near = seen[max(0, c - reach) : c + reach + 1].sum(axis=0)
            if near.sum() >= min(LEAST_TEXTS, seen.sum()):
                break
        step = int(np.searchsorted(np.cumsum(near), QUANTILE * near.sum()))
        out[c] = SLACK * step / STEPS * 2.0 ** (min(0, c - int(filled[0])) / 2)
    return out


def fit(
    docs: DataFrame,
    learn,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    sample: int = SAMPLE,
    centroids: int = CENTROIDS,
) -> Model:
    """Learn from at most `sample` documents per language among those where `learn` holds.

    The sample is the documents with the smallest hashes of their ids, so it is the same on
    every run. Their n-gram counts come to the driver: at most `sample` times the number of
    languages, of BUCKETS numbers each. The floors are those of the similarities of all documents
    where `learn` holds, which Spark counts by length and similarity.
    """
    small_batches(docs.sparkSession)
    usable = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id).alias("at")
    )
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return fit_arrays(np.zeros((0, BUCKETS), np.float32), np.array([], object), centroids)
    # About twice the sample passes a bound on the hash; the window then cuts it exactly.
    bound = F.lit(None).cast("double")
    for name, n in sizes.items():
        bound = F.when(F.col("lang") == name, min(1.0, 2 * sample / n)).otherwise(bound)
    share = F.col("at").cast("double") / float(1 << 64) + 0.5
    few = usable.filter(share <= bound)
    order = Window.partitionBy("lang").orderBy("at", "text")
    chosen = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", _PIECE, _ROWS):
                counts = gram_counts(part.column("text"))
                cells = [np.flatnonzero(row) for row in counts]
                values = [row[c] for row, c in zip(counts, cells, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": part.column("lang"),
                        "at": part.column("at"),
                        "cells": pa.array([c.astype(np.int16).tobytes() for c in cells], pa.binary()),
                        "counts": pa.array([v.tobytes() for v in values], pa.binary()),
                    }
                )

    rows = (
        chosen.select("lang", "at", "text")
        .mapInArrow(count, "lang string, at long, cells binary, counts binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], r["at"], bytes(r["cells"]), bytes(r["counts"])))
    counts = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r["cells"], np.int16)] = np.frombuffer(r["counts"], np.float32)
    model = fit_arrays(counts, np.array([r["lang"] for r in rows], object), centroids)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", _PIECE, _ROWS):
                cells, n = np.unique(similarity_cells(part.column("text"), model), return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "n": pa.array(n)})

    counted = usable.select("text").mapInArrow(compare, "cell long, n long").groupBy("cell")
    seen = np.zeros((CLASSES, STEPS + 1), np.int64)
    for r in counted.agg(F.sum("n").alias("n")).collect():
        seen[divmod(r["cell"], STEPS + 1)] = r["n"]
    model.floors = floors(seen)
    return model


OUT = ("lang_pred", "score", "rejected")


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep_text: bool = True,
    out: tuple[str, str, str] = OUT,
) -> DataFrame:
    """The documents with the predicted language, its score, and whether it is rejected.

    lang_pred is the language of the nearest centroid and score the cosine to it; `und` and score
    0 where the text is null or has no letter, which is rejected, or nothing was learned. A text is
    rejected when its score lies below the floor for its length (SLACK times the similarity that
    all but QUANTILE of the learning texts of about that length reach; none below LEAST_GRAMS
    n-grams). Of equal scores the first language by name wins.
    Whole texts count, whatever their length. Input columns named like an output column are
    replaced; an empty table gives no rows; repeated rows are judged alike.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in out])
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    added = [T.StructField(n, k) for n, k in zip(out, kinds, strict=True)]
    schema = T.StructType([*kept, *added])
    names = np.array([*model.languages, UNKNOWN], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, _PIECE, _ROWS):
                best, score, rejected = judge(part.column(text), model)
                columns = [part.column(f.name) for f in kept]
                columns += [
                    pa.array(names[best], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(predict, schema)


def judge(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the place of its language in the model (its end: none), score, rejected."""
    counts = gram_counts(texts)
    lettered = [t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
    lettered = np.array(lettered, bool)
    known = lettered & (len(model.languages) > 0)
    best, score = np.full(len(counts), len(model.languages)), np.zeros(len(counts))
    if known.any():
        near = weighted(counts, model.idf) @ model.centroids.T
        best = np.where(known, near.argmax(axis=1), best)
        score = np.where(known, near.max(axis=1).clip(0, 1), 0.0).astype(np.float64)
    far = known & (score < model.floors[_length_class(counts)])
    return best, score, ~lettered | far


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    out = tuple(free_name(docs, f"judged_{n}") for n in OUT)
    judged = identify(docs, model, text, out=out)
    return judged.filter(~F.col(out[2])).select(*[f"`{c}`" for c in docs.columns])
