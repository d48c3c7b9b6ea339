"""Toxicity: cumulative-link ordinal regression of severity grades on sparse word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import Words, lowered, pieces, small_batches, stored, text_bytes

# Labelled documents of each class the model is fitted on, at most.
SAMPLE = 4000
# Features are words and their first bytes of these lengths.
PREFIXES = (4, 5, 6, 7, 8)
# Features that speak for toxic documents are all taken, as long as about this share of them
# at most would do so by chance.
FALSE_SHARE = 0.05
# The evidence of a feature is the negative log of a bound on its chance; counted in such steps.
_STEP = 0.1
# A feature's value is the log of one plus so many times its share of the words.
SHARE_SCALE = 200.0
# Grades: 0 is clean; toxic documents are graded by how dense the evidence is in them.
GRADES = 4
RIDGE = 1e-4
STEPS = 800

_LETTERS = np.full(256, 32, np.uint8)
for _b in (*range(ord("a"), ord("z") + 1), *range(128, 256)):
    _LETTERS[_b] = _b
_TABLE = 1 << 20


@dataclass
class Model:
    """Feature fingerprints in order, the weight of each, and the thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of features, the text each lies in, and the number of words per text.

    Words are runs of letters (any byte beyond ASCII counts as one) in lower case.
    """
    data, bounds = text_bytes(texts)
    words = Words(_LETTERS[lowered(data)], bounds)
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    features, owners = [words.hashes()], [owner]
    for length in PREFIXES:
        prefix, longer = words.prefixes(length)
        features.append(prefix)
        owners.append(owner[longer])
    return np.concatenate(features), np.concatenate(owners), words.counts


def chosen_counts(
    texts: pa.Array, chosen: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the chosen features (in order): text, place in `chosen`, count; and words per text."""
    features, owners, words = word_features(texts)
    width = len(chosen)
    if width == 0 or len(features) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, words
    # A small table of low bits settles nearly all features; the rest are looked up.
    known = np.zeros(_TABLE, bool)
    known[(chosen % np.uint64(_TABLE)).astype(np.int64)] = True
    maybe = np.flatnonzero(known[(features & np.uint64(_TABLE - 1)).view(np.int64)])
    at = np.minimum(np.searchsorted(chosen, features[maybe]), width - 1)
    hit = chosen[at] == features[maybe]
    cells, counts = np.unique(owners[maybe[hit]] * width + at[hit], return_counts=True)
    return cells // width, cells % width, counts, words


@dataclass
class Sparse:
    """A matrix by its cells that are not zero."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    shape: tuple[int, int]

    def __len__(self) -> int:
        return self.shape[0]

    def __matmul__(self, vector: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * vector[self.columns], self.shape[0])

    @property
    def T(self) -> Sparse:
        return Sparse(self.columns, self.rows, self.values, self.shape[::-1])

    def std(self) -> np.ndarray:
        """The standard deviation of each column."""
        mean, square = (
            np.bincount(self.columns, self.values**k, self.shape[1]) / max(1, len(self)) for k in (1, 2)
        )
        return np.sqrt(np.maximum(square - mean**2, 0))

    def over(self, scale: np.ndarray) -> Sparse:
        """The columns divided by numbers."""
        return Sparse(self.rows, self.columns, self.values / scale[self.columns], self.shape)


def values_of(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.log1p(SHARE_SCALE * counts / np.maximum(words, 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def above(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for every score and threshold: the same weights, ordered thresholds."""
    return _sigmoid(score[:, None] - thresholds[None, :])


def fit_ordinal(x: np.ndarray | Sparse, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of least ridged negative log-likelihood.

    Thresholds are the first one and the logs of the gaps, so that they stay in order. Adam
    steps over the whole sample.
    """
    cuts = grades - 1
    params = np.concatenate([np.zeros(x.shape[1]), [1.0], np.zeros(cuts - 1)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(len(x))
    for step in range(1, STEPS + 1):
        w, raw = params[: x.shape[1]], params[x.shape[1] :]
        gaps = np.exp(raw[1:])
        thresholds = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        below = _sigmoid(thresholds[None, :] - (x @ w)[:, None])
        padded = np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], axis=1)
        upper, lower = padded[rows, grade + 1], padded[rows, grade]
        p = np.maximum(upper - lower, 1e-12)
        by_score = upper + lower - 1
        by_cut = np.zeros((len(x), grades + 1))
        by_cut[rows, grade + 1] += upper * (1 - upper) / p
        by_cut[rows, grade] -= lower * (1 - lower) / p
        by_cut = by_cut[:, 1:-1].mean(axis=0)
        gradient = np.concatenate(
            [
                -(x.T @ by_score) / len(x) + RIDGE * w,
                [-by_cut.sum()],
                -np.array([by_cut[j + 1 :].sum() for j in range(cuts - 1)]) * gaps,
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    raw = params[x.shape[1] :]
    return params[: x.shape[1]], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def grades_of(evidence: np.ndarray, grades: int) -> np.ndarray:
    """Grades from 1 of toxic documents, in parts of about equal size by evidence. Documents of
    equal evidence have one grade, that of the first of them."""
    below = np.searchsorted(np.sort(evidence), evidence)
    return 1 + below * (grades - 1) // len(evidence)


def fit_arrays(
    features: np.ndarray, x: Sparse, toxic: np.ndarray, grades: int = GRADES
) -> Model:
    """Fit on documents by their feature values (a row each) and whether they are toxic.

    Labels only say whether a document is toxic, so severity is a proxy: how much of what tells
    toxic documents stands in a text. The grades above 0 are the toxic documents in `grades - 1`
    parts of about equal size, by the sum of their values.
    """
    n1 = int(toxic.sum())
    if n1 == 0 or n1 == len(toxic) or len(features) == 0:
        # Nothing to tell apart: thresholds that no text without evidence passes.
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.arange(1.0, grades) * 30)
    grade = np.zeros(len(x), np.int64)
    grade[toxic] = grades_of((x @ np.ones(len(features)))[toxic], grades)
    scale = np.maximum(x.std(), 1e-9)
    weights, thresholds = fit_ordinal(x.over(scale), grade, grades)
    return Model(features, weights / scale, thresholds)


def _sampled(docs: DataFrame, labels: DataFrame, text, doc_id, toxic, sample) -> DataFrame:
    """doc, bad, text of at most `sample` labelled documents of either class."""
    known = (
        labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("label_doc"))
        .agg((F.max(toxic) > 0).alias("bad"))
        .withColumn("at", F.xxhash64("label_doc"))
    )
    sizes = {r["bad"]: r["n"] for r in known.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("bad"), min(1.0, 2 * sample / max(1, sizes.get(True, 0)))).otherwise(
        min(1.0, 2 * sample / max(1, sizes.get(False, 0)))
    )
    few = known.filter(F.col("at").cast("double") / float(1 << 64) + 0.5 <= rate)
    chosen = few.filter("bad").orderBy("at", "label_doc").limit(sample).unionByName(
        few.filter(~F.col("bad")).orderBy("at", "label_doc").limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(
        F.broadcast(chosen.select("label_doc", "bad")), F.col("doc") == F.col("label_doc")
    )
    # A document may stand in several rows; the sample is of documents.
    return rows.groupBy("doc").agg(F.max("bad").alias("bad"), F.min("text").alias("text"))


def least_evidence(steps: dict[int, int]) -> int:
    """The lowest step of evidence from which chance makes FALSE_SHARE of the features at most
    (the rule of Benjamini and Hochberg); past all steps if none is."""
    total, above_it = sum(steps.values()), 0
    least = max(steps, default=0) + 1
    for step in sorted(steps, reverse=True):
        above_it += steps[step]
        if step > 0 and total * np.exp(-step * _STEP) <= FALSE_SHARE * above_it:
            least = step
    return least


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    toxic: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Learn from at most `sample` labelled documents of either class.

    The sample has the smallest hashes of ids. Of several labels of a document the worst
    counts, of several texts the first. Spark counts the sample's features by class and chooses
    those that speak for toxic documents, however many; the driver sees at most 2 * sample rows, of
    the values that are not zero.
    """
    small_batches(docs.sparkSession)
    few = stored(_sampled(docs, labels, text, doc_id, toxic, sample))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                features, owners, _ = word_features(part.column("text"))
                once = np.unique(np.rec.fromarrays([features, owners], names="f,o"))
                bad = np.asarray(part.column("bad").to_numpy(zero_copy_only=False), bool)[once.o]
                kinds, place = np.unique(once.f, return_inverse=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": pa.array(kinds.view(np.int64)),
                        "n1": pa.array(np.bincount(place, bad, len(kinds)).astype(np.int64)),
                        "n0": pa.array(np.bincount(place, ~bad, len(kinds)).astype(np.int64)),
                    }
                )

    sizes = few.agg(F.count(F.when(F.col("bad"), 1)), F.count(F.when(~F.col("bad"), 1))).first()
    share = sizes[0] / max(1, sum(sizes))
    both = F.col("n1") + F.col("n0")

    def part(n: str, expected: float) -> Column:
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (both * max(expected, 1e-12)))).otherwise(0.0)

    # Chernoff's bound on the chance of so many toxic documents among those with the feature.
    speaks = F.col("n1") > both * share
    counted = stored(
        few.mapInArrow(held, "feature long, n1 long, n0 long")
        .groupBy("feature")
        .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .select("feature", F.when(speaks, part("n1", share) + part("n0", 1 - share)).otherwise(0.0).alias("evidence"))
    )
    steps = counted.groupBy(F.floor(F.col("evidence") / _STEP).alias("step")).count().collect()
    least = least_evidence({r["step"]: r["count"] for r in steps})
    chosen = counted.filter(F.floor(F.col("evidence") / _STEP) >= least).select("feature").collect()
    features = np.sort(np.array([r["feature"] for r in chosen], np.int64).view(np.uint64))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                rows, at, counts, words = chosen_counts(part.column("text"), features)
                values = values_of(counts, words[rows]).astype(np.float32)
                cuts = np.searchsorted(rows, np.arange(part.num_rows + 1))
                bounds = list(zip(cuts[:-1], cuts[1:], strict=True))
                at = at.astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": part.column("doc"),
                        "bad": part.column("bad"),
                        "at": pa.array([at[a:b].tobytes() for a, b in bounds], pa.binary()),
                        "x": pa.array([values[a:b].tobytes() for a, b in bounds], pa.binary()),
                    }
                )

    rows = few.mapInArrow(measure, "doc long, bad boolean, at binary, x binary").collect()
    rows.sort(key=lambda r: r["doc"])
    x = Sparse(
        np.repeat(np.arange(len(rows)), [len(r["at"]) // 4 for r in rows]),
        np.frombuffer(b"".join(r["at"] for r in rows), np.int32),
        np.frombuffer(b"".join(r["x"] for r in rows), np.float32).astype(float),
        (len(rows), len(features)),
    )
    return fit_arrays(features, x, np.array([r["bad"] for r in rows], bool))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """The linear score of each text: weights times feature values."""
    rows, at, counts, words = chosen_counts(texts, model.features)
    return np.bincount(
        rows, model.weights[at] * values_of(counts, words[rows]), minlength=len(words)
    )


OUT = ("severity", "grade", "toxic")


def grade(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with severity (expected grade), grade (likeliest) and toxic.

    severity is the sum over thresholds of the probability to lie above; toxic says that a grade
    above 0 is likelier than not. A null or empty text scores like one without evidence. Nothing
    to learn from (no label of a class): severity about 0, nothing toxic. Whole texts count.
    Input columns named like an output column are replaced; repeated rows are graded alike; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in OUT])
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    kinds = (T.DoubleType(), T.IntegerType(), T.BooleanType())
    added = [T.StructField(n, k) for n, k in zip(OUT, kinds, strict=True)]
    schema = T.StructType([*kept, *added])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                over = above(score_texts(part.column(text), model), model.thresholds)
                steps = np.concatenate(
                    [np.ones((len(over), 1)), over, np.zeros((len(over), 1))], axis=1
                )
                columns = [part.column(f.name) for f in kept]
                columns += [
                    pa.array(over.sum(axis=1), pa.float64()),
                    pa.array((steps[:, :-1] - steps[:, 1:]).argmax(axis=1), pa.int32()),
                    pa.array(over[:, 0] > 0.5, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(predict, schema)
