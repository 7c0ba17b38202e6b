"""Quality classifier: similarity-weighted votes of the nearest labelled documents in latent-semantic space.

Terms are hashed byte trigrams (case kept) and binned statistics of a text's shape. A truncated singular value
decomposition of the term weights of labelled documents gives the latent space; every document is projected into it
and its cosines with all labelled vectors are computed exactly, block by block. The ``NEIGHBOURS`` nearest vote with
their similarity as weight.

The model is fitted on at most ``MAX_LABELLED`` labelled documents of the corpus, those whose id has the smallest hashes; one row of each
is collected, which bounds what is fitted on the driver and broadcast. Every document is scored by its whole text.

``NEIGHBOURS``, ``DIMENSIONS`` and ``SHAPE_WEIGHT`` were chosen by the accuracy of four folds of the rows that may be learned from.

Defined results: null texts are empty; an empty text has only the terms of its shape and is scored like any other; without labelled
rows every score is 0.5; if labels disagree about a document the smaller holds; a null doc_id counts as the empty
text for the hold-out; repeated rows are scored alike; columns called ``score`` in the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LABELLED = 3_000
NEIGHBOURS = 5
DIMENSIONS = 32
OVERSAMPLE = 16
ITERATIONS = 8
GRAM_BITS = 12
GRAMS = 1 << GRAM_BITS
BINS = 12
SHAPE_WEIGHT = 1.0
THRESHOLD = 0.3
BLOCK = 256
FOLDS = 5

#: Shape statistics, each a share of the text between 0 and 1: capitals, ASCII symbols, bars, digits, blanks,
#: words equal to the one before, trigrams that occur once hashed, and (binned by logarithm) the length.
STATISTICS = 8


def held_out(doc_id: Column) -> Column:
    """Rows never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def kinds_of_bytes() -> np.ndarray:
    """Class of each byte: 1 capital, 2 symbol, 3 bar, 4 digit, 5 blank, 0 any other."""
    kinds = np.zeros(256, np.uint8)
    for byte in range(128):
        char = chr(byte)
        if char.isupper():
            kinds[byte] = 1
        elif char == "|":
            kinds[byte] = 3
        elif char.isdigit():
            kinds[byte] = 4
        elif char.isspace():
            kinds[byte] = 5
        elif char.isprintable() and not char.isalpha() and char not in ".,'":
            kinds[byte] = 2
    return kinds


KINDS = kinds_of_bytes()


def term_weights(text: str | None) -> np.ndarray:
    """Unit-length trigram part, then unit-length shape part."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    out = np.zeros(GRAMS + STATISTICS * BINS, np.float32)
    distinct = 0.0
    if len(data) >= 3:
        wide = data.astype(np.uint32)
        grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
        slots = (grams * np.uint32(2_654_435_761)) >> np.uint32(32 - GRAM_BITS)
        counts = np.bincount(slots, minlength=GRAMS)
        out[:GRAMS] = np.log1p(counts)
        out[:GRAMS] /= np.linalg.norm(out[:GRAMS])
        distinct = np.count_nonzero(counts) / min(len(grams), GRAMS)
    shares = np.bincount(KINDS[data], minlength=6)[1:6] / max(len(data), 1)
    words = text.split()
    repeated = sum(map(eq, words, words[1:])) / max(len(words) - 1, 1)
    stats = [*np.sqrt(shares), repeated**0.5, distinct, min(np.log1p(len(data)) / 16, 1.0)]
    shape = np.zeros((STATISTICS, BINS), np.float32)
    for row, value in enumerate(stats):
        # a value is shared by its two nearest bins, so that near values are similar
        at = value * (BINS - 1)
        low = int(at)
        shape[row, low] = 1 - (at - low)
        if low + 1 < BINS:
            shape[row, low + 1] = at - low
    out[GRAMS:] = SHAPE_WEIGHT * shape.ravel() / np.linalg.norm(shape)
    return out


@dataclass
class Model:
    """``projection`` leads from term weights to the latent space; ``vectors`` are the labelled unit vectors there."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @classmethod
    def fitted(cls, terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
        """The leading singular vectors by subspace iteration, so that beside ``terms`` (float32, changed in place) only
        narrow matrices are held."""
        rows = len(terms)
        inverse = np.log((1 + rows) / (1 + np.count_nonzero(terms, axis=0))).astype(np.float32) + 1
        inverse[GRAMS:] = 1
        terms *= inverse
        wide = min(dimensions + OVERSAMPLE, *terms.shape)
        basis = np.random.default_rng(0).standard_normal((rows, wide)).astype(np.float32)
        for _ in range(ITERATIONS):
            basis, _ = np.linalg.qr(terms @ (terms.T @ basis))
        narrow = basis.T @ terms
        values, turn = np.linalg.eigh((narrow @ narrow.T).astype(np.float64))
        keep = np.argsort(values)[::-1][:dimensions]
        keep = keep[values[keep] > 1e-9]
        projection = (narrow.T @ turn[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        return cls(inverse, projection, unit(terms @ projection), labels.astype(np.float64))

    def score(self, terms: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        cosines = unit((terms * self.weights) @ self.projection) @ self.vectors.T
        k = min(neighbours, cosines.shape[1])
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, nearest, 1).astype(np.float64), 1e-6)
        return np.clip((weight * self.labels[nearest]).sum(1) / weight.sum(1), 0, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the labelled rows outside the hold-out."""
    known = (
        labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"))
    )
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [term_weights(t.as_py()).astype(np.float16).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(made, pa.binary())], ["doc_id", "label", "terms"]
            )

    schema = T.StructType(
        [texts.schema["doc_id"], texts.schema["label"], T.StructField("terms", T.BinaryType())]
    )
    made = texts.mapInArrow(terms, schema).groupBy("doc_id").agg(F.min(F.struct("terms", "label")).alias("row"))
    rows = {row["doc_id"]: (bytes(row["row"]["terms"]), row["row"]["label"]) for row in made.collect()}
    width = GRAMS + STATISTICS * BINS
    if not rows:
        empty = np.zeros((0, width), np.float32)
        return Model(np.ones(width, np.float32), empty.T, empty, np.zeros(0))
    matrix, values = np.empty((len(rows), width), np.float32), np.empty(len(rows))
    for place, doc_id in enumerate(sorted(rows)):
        packed, values[place] = rows.pop(doc_id)
        matrix[place] = np.frombuffer(packed, np.float16)
    return Model.fitted(matrix, values)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``."""
    kept = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    names = kept.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                terms = np.stack([term_weights(t.as_py()) for t in part.column(names.index("text"))])
                values = pa.array(fitted.score(terms), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, values], [*names, "score"])

    return kept.mapInArrow(score, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))
