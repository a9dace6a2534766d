"""Quality rules and a hashed n-gram importance ratio.

Base rules count words, symbols, repeated lines and words in repeated windows.
The learned verdict compares two multinomials over ``BUCKETS`` hashed words and
word pairs: one of a trusted target (documents labelled as good), one of the
whole raw corpus.  A document's score is the mean log ratio over its words and
pairs.  The floor below which documents fail is the ``SPARED`` quantile of the
trusted documents' own scores, so it follows the given table; each document is
judged alone and deterministic.

Raw counts cover all documents, the target and the floor all documents labelled
as good.  Both counts take one scan, in which the texts meet their labels by a
join on the id, and are summed before the shuffle; the floor takes a scan that
joins ids and scores alone.  Only the bucket table (a fixed size) and the floor
reach the driver.  All work is DataFrame expressions.

Defined results: null and empty texts have no words and fail the base rule;
labels that disagree count as bad; without labels, or with an empty table, the
base rule alone decides; equal scores fare equally, the floor itself is kept;
repeated rows get equal results.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantile import quantile_table
from .common import let, workspace

BUCKETS = 10_000
#: Share of the trusted documents whose score may lie below the floor.
SPARED = 0.001
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


class Model(NamedTuple):
    """Log ratio of each bucket, and the least score that is kept."""

    ratios: np.ndarray
    floor: float


def words(text: Column) -> Column:
    """Runs of other than ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN, -1), "")


def _pairs(h: Column, gap: int) -> Column:
    """Hash of each element with the one ``gap`` places on."""
    n = F.greatest(F.size(h) - gap, F.lit(0))
    return F.zip_with(F.slice(h, 1, n), F.slice(h, gap + 1, n), lambda a, b: F.xxhash64(a, b))


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _score(h: Column, two: Column, ratios: np.ndarray) -> Column:
    """Mean ratio of the words ``h`` and pairs ``two``; null without words."""
    table, size = F.lit(ratios), len(ratios)

    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + table[F.pmod(v, F.lit(size)).cast("int")])

    return F.when(F.size(h) > 0, (total(h) + total(two)) / (F.size(h) + F.size(two)))


def _repeat_words(eight: Column) -> Column:
    """Words covered by 8-word windows whose hash occurs twice or more."""
    placed = F.array_sort(F.transform(eight, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def cover(s):
        same = lambda i, x: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(i - 1, x) | same(i + 1, x))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-8).alias("last"))
        return F.aggregate(at, zero, lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(8), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"].cast("long"))

    return F.when(F.size(F.array_distinct(eight)) == F.size(eight), F.lit(0).cast("long")).otherwise(let(placed, cover))


def measures(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``q``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long), score (double, null for no words) and the
    model's floor."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def rest(h):
        two = _pairs(h, 1)

        def more(t):
            eight = let(_pairs(t, 2), lambda f: _pairs(f, 4))
            score = F.lit(None).cast("double") if model is None else _score(h, t, model.ratios)
            return F.struct(F.size(h).cast("long").alias("n_words"), let(eight, _repeat_words).alias("n_repeat_words"), score.alias("score"))
        return let(two, more)

    counted = let(_hashed(words(F.col(text))), rest)
    symbols = (F.size(F.split(value, SYMBOLS, -1)) - 1).cast("long")
    chars = F.length(F.regexp_replace(value, SPACE_RUN, "")).cast("long")
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return docs.withColumn("q", let(counted, lambda c: F.struct(
        c["n_words"].alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"), dup.alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"), c["score"].alias("score"),
        F.lit(None if model is None else model.floor).cast("double").alias("floor"))))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        buckets: int = BUCKETS, spared: float = SPARED) -> Model | None:
    """The model, or None without trusted documents."""
    good = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).dropna().groupBy("id").agg(F.min("y").alias("y"))
            .filter("y = 1").select("id", F.lit(1).alias("good")).hint("merge"))             # grows with the table: never broadcast
    base = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    bucket = lambda h: F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    grams = let(_hashed(words(F.col("t"))), lambda h: F.concat(bucket(h), bucket(_pairs(h, 1))))
    rows = (base.join(good, "id", "left").select("good", F.explode(grams).alias("b")).groupBy("b")
            .agg(F.count("*").alias("raw"), F.count("good").alias("target")).collect())      # at most ``buckets``
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for b, n, t in rows:
        raw[b], target[b] = n, t
    if not target.sum():
        return None
    p = (target + 1.0) / (target.sum() + buckets)
    q = (raw + 1.0) / (raw.sum() + buckets)
    ratios = np.log(p / q).round(4)
    scored = base.select("id", let(_hashed(words(F.col("t"))), lambda h: let(_pairs(h, 1), lambda two: _score(h, two, ratios))).alias("score"))
    kept = workspace(docs.sparkSession, "quality")
    trusted = kept.stored(scored.join(good, "id").select("score"), "trusted")
    floor = quantile_table(trusted, "score", [spared]).first()["q"]
    kept.remove()
    return Model(ratios, floor)


def judge(measured: DataFrame) -> DataFrame:
    """``measures`` with base_failed and kept."""
    q = F.col("q")
    failed = (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])
    return (measured.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(q["score"] >= q["floor"], F.lit(True))))
