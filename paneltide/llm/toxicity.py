"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed words, their beginnings, word pairs and skip-grams (words
with one word between), each present or absent in the whole text.  FTRL-proximal keeps a
learning rate per coordinate and an L1 threshold that holds most weights at
zero, so the fitted model is a short list of (feature, weight), broadcast to
the tasks that score all documents in one pass without a shuffle.

The model is fitted on at most ``max_rows`` labelled rows, those with the least
hash of their id (a documented bound); their features are extracted by Spark
tasks and read by one fitting task.  Every document is scored whole.

Defined results: null and empty texts have no features and get the score of
the bias; null labels and null ids teach nothing; labels that disagree on an id
count as toxic; with no labelled rows every score is 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textscan as ts
from .common import broadcast_value, field, rows_as_structs

#: Labelled rows used for the fit.  At about 1,500 four-byte features a row
#: the fitting task holds some 70 MB.
MAX_ROWS = 12_000
BITS = 20
#: Lengths in bytes of the word beginnings that count beside whole words, so
#: that inflected and compounded forms share a feature.
STEMS = (4, 6)
_U = np.uint64


def _slots(words: ts.Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word, stem, pair and skip-gram of a piece."""
    h, row = words.hash, words.row
    rows, feats = [row], [h]
    for length in STEMS:
        rows.append(row)
        feats.append(ts.mix(words.stems(length) + _U(length)))
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        same = np.flatnonzero(row[:-gap] == row[gap:]) if len(row) > gap else np.zeros(0, np.int64)
        rows.append(row[same])
        feats.append(ts.mix(h[same] * _U(3) + h[same + gap] + _U(salt)))
    return np.concatenate(rows), np.concatenate(feats) >> _U(64 - BITS)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, feats): distinct features of each text, four bytes each."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("feats", T.BinaryType())])

    def run(batches):
        for batch in batches:
            out = []
            for lo, hi, words in ts.word_batches(field(batch, text), ts.NON_ALNUM, lower=True, limit=ts.SMALL_PIECE_BYTES):
                row, slot = _slots(words)
                own = np.unique(row.astype(np.uint64) << _U(BITS) | slot)
                cut = np.searchsorted(own, np.arange(hi - lo + 1, dtype=np.uint64) << _U(BITS))
                low = (own & _U((1 << BITS) - 1)).astype("<u4")
                out += [low[cut[r]:cut[r + 1]].tobytes() for r in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["row", "feats"])

    return rows_as_structs(docs).mapInArrow(run, schema)


def ftrl(examples: list[tuple[np.ndarray, int]], *, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
         l2: float = 0.1, epochs: int = 5, bits: int = BITS) -> tuple[np.ndarray, float]:
    """Dense weights and bias after ``epochs`` passes over binary examples."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    bias = 0.0
    for _ in range(epochs):
        for feats, label in examples:
            zi, ni = z[feats], n[feats]
            w = weights(zi, ni)
            bias = -zb / ((beta + np.sqrt(nb)) / alpha)
            p = 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, w.sum() + bias))))
            g = p - label
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[feats] = zi + g - rate * w
            n[feats] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * bias
            nb += g * g
    return weights(z, n), bias


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        may_learn: Column | None = None, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) with the non-zero weights of the fit."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).dropna()
    if may_learn is not None:
        known = known.filter(may_learn)
    known = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    sample = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
              .join(F.broadcast(known), "id").dropDuplicates(["id"]).select("id", "y", "text"))
    model = T.StructType([T.StructField("feature", T.LongType()), T.StructField("weight", T.DoubleType())])

    def train(batches):
        examples = []
        for batch in batches:
            ids, ys = field(batch, "id").to_pylist(), field(batch, "y").to_pylist()
            examples += [(i, y, np.frombuffer(f, "<u4")) for i, y, f in zip(ids, ys, batch.column(1).to_pylist())]
        if examples:
            order = sorted(range(len(examples)), key=lambda i: zlib.crc32(str(examples[i][0]).encode()))
            w, bias = ftrl([(examples[i][2], examples[i][1]) for i in order])
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))],
                                             names=["feature", "weight"])

    examples = features(sample).select(F.struct("row.id", "row.y").alias("row"), "feats")      # texts stay behind
    rows = examples.repartition(1).mapInArrow(train, model).collect()
    found = [(r[0], r[1]) for r in rows if r[0] >= 0]
    bias = next((r[1] for r in rows if r[0] < 0), -np.inf)
    return np.array([f for f, _ in found], dtype=np.int64), np.array([w for _, w in found]), float(bias)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], *, text: str = "text") -> DataFrame:
    """(row, score) of every document, from 0 to 1."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("score", T.DoubleType())])
    shipped = broadcast_value(docs.sparkSession, model)
    names = to_arrow_schema(schema).names

    def run(batches):
        feats, weights, bias = shipped.value
        dense = np.zeros(1 << BITS)
        dense[feats] = weights
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for lo, hi, words in ts.word_batches(field(batch, text), ts.NON_ALNUM, lower=True, limit=ts.SMALL_PIECE_BYTES):
                row, slot = _slots(words)
                hot = np.flatnonzero(dense[slot])
                own = np.unique(row[hot].astype(np.uint64) << _U(BITS) | slot[hot])
                total[lo:hi] += np.bincount((own >> _U(BITS)).astype(np.int64),
                                            weights=dense[(own & _U((1 << BITS) - 1)).astype(np.int64)], minlength=hi - lo)
            with np.errstate(over="ignore"):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-total)))], names=names)

    return rows_as_structs(docs).mapInArrow(run, schema)
