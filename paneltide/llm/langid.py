"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, found
by a forward recursion over its characters; a text's is the product over all
its words.  Piece probabilities are fitted by expectation-maximisation with the
matching backward recursion.

Words are white-space separated, A-Z lowered, led by the vocabulary's word
mark.  A character that no piece spells has a small fixed probability.  Words are
scored whole, however long: a recursion keeps the values of the last positions
that a piece can reach, rescaled as they get small.  Recursions run over many
words of one length at once, and each task remembers the words it has scored.

The fit uses at most ``max_docs`` documents of each language, those with the
least hash of their id (a documented bound); expected counts are summed by
Spark.  Every whole text is scored.

Defined results: ``und`` with score 0 for a null text or one without a letter,
and everywhere if nothing can be learned; otherwise the score is the winner's
posterior under equal priors; ties go to the first language name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import broadcast_value, field, rows_as_structs, stored

MAX_DOCS = 600
ROUNDS = 3
FLOOR = 1e-9
SMOOTH = 0.05
MARK = "▁"
_CACHE_WORDS = 400_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)


def read_pieces(path: str) -> list[str]:
    """Spelled-out pieces of a sentencepiece vocabulary (no control pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted({model.id_to_piece(i) for i in range(model.get_piece_size())
                   if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))})


class Vocabulary:
    """Piece lookup by the hash of code points; numbers follow sorted hashes."""

    def __init__(self, pieces: list[str]):
        pieces = [p for p in pieces if p]
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.longest = max(map(len, pieces), default=1)
        self.size = len(pieces)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & ((1 << 64) - 1)
        return h

    @staticmethod
    def points(words: list[str]) -> np.ndarray:
        """Code points of equal-length words, plus one: words x characters."""
        return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1).astype(np.uint64) + _U(1)

    def ending(self, live: np.ndarray) -> np.ndarray:
        """Piece numbers of the hashes of stretches, -1 where none is spelled so."""
        at = np.searchsorted(self.hashes, live)
        at[at == self.size] = 0
        return np.where(self.hashes[at] == live, at, -1)

    def lattice(self, words: list[str]):
        """(length, ids) for equal-length words: ids[start, stop] are the numbers
        of the pieces between two positions, or -1."""
        points = self.points(words)
        n = points.shape[1]
        ids: dict[tuple[int, int], np.ndarray] = {}
        live = np.zeros((0, len(words)), dtype=np.uint64)
        for stop in range(1, n + 1):
            live = np.concatenate((live[-(self.longest - 1):] if self.longest > 1 else live[:0], np.zeros((1, len(words)), np.uint64)))
            live = live * _BASE + points[:, stop - 1]
            for k, own in enumerate(self.ending(live)):
                ids[stop - len(live) + k, stop] = own
        return n, ids


def _probabilities(ids, table: np.ndarray, single: bool) -> np.ndarray:
    """Probability of a lattice edge per (word, language)."""
    p = table[ids]
    p[ids < 0] = FLOOR if single else 0.0
    return p


def forward(vocabulary: Vocabulary, words: list[str], table: np.ndarray) -> np.ndarray:
    """Log probability of each word (equal lengths) under each language."""
    points = vocabulary.points(words)
    n, reach = points.shape[1], vocabulary.longest
    alpha = np.ones((1, len(words), table.shape[1]))        # of the last positions
    scaled = np.zeros((len(words), table.shape[1]))
    live = np.zeros((0, len(words)), dtype=np.uint64)
    for stop in range(1, n + 1):
        live = np.concatenate((live[max(0, len(live) - reach + 1):], np.zeros((1, len(words)), np.uint64)))
        live = live * _BASE + points[:, stop - 1]
        total = 0.0
        for k, own in enumerate(vocabulary.ending(live)):
            total = total + alpha[k - len(live)] * _probabilities(own, table, k == len(live) - 1)
        alpha = np.concatenate((alpha[max(0, len(alpha) - reach + 1):], total[None]))
        if stop % 8 == 0:                                   # eight characters are worth 1e-72 at least
            small = np.where(total < 1e-100, 1e100, 1.0)
            alpha = alpha * small
            scaled -= np.log(small)
    return np.log(alpha[-1]) + scaled


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    return np.logaddexp.reduce(np.stack(terms), axis=0)


def expected(vocabulary: Vocabulary, words: list[str], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Expected uses of each piece under one language (a column ``table``)."""
    n, ids = vocabulary.lattice(words)
    reach = vocabulary.longest
    with np.errstate(divide="ignore"):
        p = {k: np.log(_probabilities(v, table, k[1] - k[0] == 1)[:, 0]) for k, v in ids.items()}
    alpha, beta = [np.zeros(len(words))], [None] * n + [np.zeros(len(words))]
    for stop in range(1, n + 1):
        alpha.append(_log_sum([alpha[s] + p[s, stop] for s in range(max(0, stop - reach), stop)]))
    for start in range(n - 1, -1, -1):
        beta[start] = _log_sum([p[start, e] + beta[e] for e in range(start + 1, min(n, start + reach) + 1)])
    out = np.zeros(vocabulary.size)
    for (start, stop), own in ids.items():
        known = np.flatnonzero(own >= 0)
        if len(known):
            share = np.exp(alpha[start][known] + p[start, stop][known] + beta[stop][known] - alpha[n][known])
            out += np.bincount(own[known], weights=share * counts[known], minlength=vocabulary.size)
    return out


def _by_length(parts: list[str]):
    groups: dict[int, list[int]] = {}
    for i, p in enumerate(parts):
        groups.setdefault(len(p), []).append(i)
    for own in groups.values():
        for lo in range(0, len(own), 20_000):
            yield own[lo:lo + 20_000]


def score_words(vocabulary: Vocabulary, words: list[str], table: np.ndarray) -> np.ndarray:
    marked = [MARK + w for w in words]
    out = np.zeros((len(words), table.shape[1]))
    for at in _by_length(marked):
        out[at] = forward(vocabulary, [marked[i] for i in at], table)
    return out


def _word_counts(sample: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            total: dict[tuple[str, bytes], int] = {}
            for lang, text in zip(langs, batch.column(1).cast(pa.large_binary()).to_pylist()):
                for w in text.lower().split():
                    total[lang, w] = total.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.binary()).cast(pa.string()),
                pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])

    return sample.mapInArrow(run, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, pieces: list[str], *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        may_learn: Column | None = None, max_docs: int = MAX_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities: pieces x languages)."""
    vocabulary = Vocabulary(pieces)
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "lang is not null and text is not null")
    if may_learn is not None:
        known = known.filter(may_learn)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = (known.select("id", "lang").withColumn("turn", turn).filter(F.col("turn") <= max_docs)
              .select(F.col("id").alias("own"), F.col("lang").alias("own_lang")).distinct())
    sample = known.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("own")) & (F.col("lang") == F.col("own_lang"))).select("lang", "text")
    words = stored(_word_counts(sample), "words")
    langs = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    table = np.full((vocabulary.size, len(langs)), 1.0 / max(1, vocabulary.size))
    shipped = broadcast_value(docs.sparkSession, vocabulary)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("n", T.DoubleType())])

    def estimate(now):
        def run(batches):
            own, (names, probabilities) = shipped.value, now.value
            total = {}
            for batch in batches:
                rows: dict[str, tuple[list, list]] = {}
                for l, w, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    a, b = rows.setdefault(l, ([], []))
                    a.append(MARK + w)
                    b.append(n)
                for l, (parts, counts) in rows.items():
                    column = probabilities[:, [names.index(l)]]
                    counts = np.array(counts, dtype=float)
                    got = total.setdefault(l, np.zeros(own.size))
                    for at in _by_length(parts):
                        got += expected(own, [parts[i] for i in at], counts[at], column)
            for l, got in total.items():
                at = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array([l] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                                  pa.array(got[at])], names=["lang", "piece", "n"])
        return run

    for _ in range(rounds if langs else 0):
        now = broadcast_value(docs.sparkSession, (langs, table))
        sums = words.mapInArrow(estimate(now), schema).groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((vocabulary.size, len(langs)), SMOOTH)
        for j, name in enumerate(langs):
            own = sums[sums.lang == name]
            table[own.piece.to_numpy(), j] += own.n.to_numpy()
        table /= table.sum(axis=0)
    return langs, table


def predict(docs: DataFrame, pieces: list[str], model: tuple[list[str], np.ndarray], *, text: str = "text") -> DataFrame:
    """(row, lang_pred, score) of every document; ``row`` has no text."""
    schema = T.StructType([
        T.StructField("row", T.StructType([f for f in docs.schema.fields if f.name != text])),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shipped = broadcast_value(docs.sparkSession, (Vocabulary(pieces), *model))

    def run(batches):
        vocabulary, langs, table = shipped.value
        seen: dict[int, int] = {}
        scores = np.zeros((0, len(langs)))
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((n, len(langs)))
            for lo, hi, words in ts.word_batches(field(batch, text), ts.SPACE, lower=True) if langs else ():
                hashes, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
                keys = hashes.tolist()
                if len(seen) > _CACHE_WORDS:
                    seen, scores = {}, scores[:0]
                new = [i for i, h in enumerate(keys) if h not in seen]
                if new:
                    spelled = [words.buf[words.start[first[i]]:words.end[first[i]]].tobytes().decode() for i in new]
                    for k, i in enumerate(new):
                        seen[keys[i]] = len(scores) + k
                    scores = np.concatenate((scores, score_words(vocabulary, spelled, table)))
                value = scores[[seen[h] for h in keys]] if keys else scores[:0]
                for j in range(len(langs)):
                    total[lo:hi, j] += np.bincount(words.row, weights=value[inverse, j], minlength=hi - lo)
            letter = batch.column(1).to_numpy(zero_copy_only=False)
            if langs:
                best = total.argmax(axis=1)
                posterior = 1.0 / np.exp(np.maximum(-700, total - total.max(axis=1, keepdims=True))).sum(axis=1)
                name = [langs[b] if ok else "und" for b, ok in zip(best, letter)]
                posterior = np.where(letter, posterior, 0.0)
            else:
                name, posterior = ["und"] * n, np.zeros(n)
            kept = [field(batch, f.name) for f in schema["row"].dataType.fields]
            yield pa.RecordBatch.from_arrays([
                pa.StructArray.from_arrays(kept, names=schema["row"].dataType.names), pa.array(name, pa.string()),
                pa.array(posterior, pa.float64())], names=["row", "lang_pred", "score"])

    letter = F.coalesce(F.col(f"row.{text}").rlike(r"\p{L}"), F.lit(False))
    return rows_as_structs(docs).withColumn("letter", letter).mapInArrow(run, schema)
