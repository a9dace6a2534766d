"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length of at least max(6, 4q) that no neighbouring word
extends.  Word i matches lag d if it equals word i - d, so a run of period q is
a stretch of max(6 - q, 3q) or more matches on the diagonal of lag q.

Each text is read once, word by word.  The earlier occurrences of a word's
recent words name the lags whose diagonals may begin there; each open diagonal
grows while words match, and one that ends with sufficient length is emitted at
once.  Only diagonals that can still become runs are opened:

* lags of 2^k up to 2^(k+1) - 1 are looked up at every 2^k-th word only, by the
  run of 2^(k+1) words that begins there (5 words for lags under 4).  A sufficient
  diagonal of such a lag holds one of these runs whole, so none is missed, and a
  text of n words is looked up n times per k: n log n in all, whatever it holds.
* a lag that is a multiple of an open, shorter lag and lies inside its stretch
  repeats that period, which is smaller, and is not opened.

Equal words are compared by 64-bit hashes.  A task holds one text's words.

Defined results: null, empty and blank texts have no words and no runs; repeated
rows are read separately and give equal results; runs come by start, then
period; a text is never cut, however long; an empty table gives no rows; columns
of the input stay inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import field, let, rows_as_structs

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55
#: Lookups made at once.
_CELLS = 1 << 20
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def needed(lag: int) -> int:
    """Matches on the diagonal of ``lag`` that make a run."""
    return max(6 - lag, 3 * lag)


def _grams(h: np.ndarray, size: int, shorter: np.ndarray) -> np.ndarray:
    """Hashes of ``size`` words from each word on, from those of half the size."""
    half = size // 2
    power = _U(pow(_BASE, half, 1 << 64))
    return shorter[:max(0, len(h) - size + 1)] * power + shorter[half:half + max(0, len(h) - size + 1)]


def openings(words: ts.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, gram) of every looked-up run of ``gram`` words that also
    begins ``lag`` words earlier in its text; ``word`` is the run's last word."""
    h, n = words.hash, len(words)
    size = words.counts()
    longest = int(size.max()) if len(size) else 0
    begin = words.first[:-1][words.row]
    at, left = np.arange(n) - begin, size[words.row] - (np.arange(n) - begin)
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    two = _grams(h, 2, h)
    gram = _grams(h, 4, two)                                # four words
    five = gram[:max(0, n - 4)] * _U(_BASE) + h[4:] if n > 4 else h[:0]
    low, k = 1, 0
    while 4 * low <= longest:
        if k < 2:
            own, length = five, 5
        else:
            gram = _grams(h, 2 * low, gram)
            own, length = gram, 2 * low
        begins = np.flatnonzero((at % low == 0) & (at >= low) & (left >= length) & (size[words.row] >= 4 * low))
        lags = np.arange(low, 2 * low)
        for part in np.array_split(begins, max(1, len(begins) * low // _CELLS)):
            earlier = part[:, None] - lags
            equal = own[np.maximum(earlier, 0)] == own[part][:, None]
            equal &= earlier >= begin[part][:, None]
            i, j = np.nonzero(equal)
            if len(i):
                found.append((part[i] + length - 1, lags[j], length))
        low, k = 2 * low, k + 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]),
            np.concatenate([np.full(len(f[0]), f[2]) for f in found]))


def text_runs(words: list[int], opens: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text; ``opens`` are its
    (word, lag, gram) in order of word."""
    active: dict[int, int] = {}                             # open lag: first matching word
    out: list[tuple[int, int, int]] = []

    def end(lag: int, word: int) -> None:
        first = active.pop(lag)
        if word - first >= needed(lag):
            out.append((first - lag, word - first + lag, lag))

    now = 0                                                 # words before it are read
    for word, lag, gram in opens:
        while now <= word:
            if not active:
                now = word + 1
                break
            value = words[now]
            for d in [d for d in active if words[now - d] != value]:
                end(d, now)
            now += 1
        if lag in active or any(lag % q == 0 and word - first + 1 >= lag for q, first in active.items()):
            continue
        first = word - gram + 1
        if words[first:word + 1] != words[first - lag:word + 1 - lag]:
            continue                                        # equal hashes of different words
        while first - 1 - lag >= 0 and words[first - 1] == words[first - 1 - lag]:
            first -= 1
        active[lag] = first
    while active and now < len(words):
        value = words[now]
        for d in [d for d in active if words[now - d] != value]:
            end(d, now)
        now += 1
    for d in list(active):
        end(d, len(words))
    return sorted(out, key=lambda r: (r[0], r[2]))


def batch_runs(words: ts.Words) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each row of a piece that has any."""
    word, lag, gram = openings(words)
    if not len(word):
        return {}
    order = np.lexsort((lag, word))
    word, lag, gram = word[order], lag[order], gram[order]
    row = words.row[word]
    edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
    found = {}
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        r = int(row[a])
        first = int(words.first[r])
        own = words.hash[first:int(words.first[r + 1])].tolist()
        runs = text_runs(own, list(zip((word[a:b] - first).tolist(), lag[a:b].tolist(), gram[a:b].tolist())))
        if runs:
            found[r] = runs
    return found


def find_runs(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(row, n_words, runs, kept): every document with its runs by start, then
    period, and the words that no run holds after its first period, joined by
    one space.  ``row`` has no text."""
    fields = [f for f in docs.schema.fields if f.name != text] or [T.StructField("_", T.BooleanType())]
    own = [f.name for f in docs.schema.fields if f.name != text]
    schema = T.StructType([T.StructField("row", T.StructType(fields)), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("kept", T.StringType())])
    run_type = pa.struct([(c, pa.int64()) for c in RUN.names])

    def run(batches):
        for batch in batches:
            total, runs, kept = [], [], []
            for lo, hi, words in ts.word_batches(field(batch, text), ts.SPACE):
                found = batch_runs(words)
                total += words.counts().tolist()
                for r in range(hi - lo):
                    a, b = int(words.first[r]), int(words.first[r + 1])
                    mine = found.get(r, [])
                    runs.append([dict(zip(RUN.names, x)) for x in mine])
                    if mine:
                        gone = ts.covered_ranges([(s + q, n - q) for s, n, q in mine], b - a)
                        at = np.flatnonzero(~gone) + a
                        kept.append(b" ".join(words.buf[words.start[i]:words.end[i]].tobytes() for i in at.tolist()))
                    else:
                        whole = words.buf[words.start[a]:words.end[b - 1]].tobytes() if b > a else b""
                        kept.append(b" ".join(whole.split()))
            parts = [field(batch, c) for c in own] or [pa.nulls(batch.num_rows, pa.bool_())]
            yield pa.RecordBatch.from_arrays([
                pa.StructArray.from_arrays(parts, names=own or ["_"]), pa.array(total, pa.int64()),
                pa.array(runs, pa.list_(run_type)), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return rows_as_structs(docs).mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period) as a
    struct, null where there is none."""
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p"))))
    return F.when(F.size(runs) > 0, F.struct(best["s"].alias("start"), (-best["n"]).alias("length"), best["p"].alias("period")))


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose tail repeats, for ids whose crc32 is divisible by 10: with
    h that crc32, g = floor(h / 10) and n words, word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    Other texts stay as they are."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(ws):
        n = F.size(ws).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))

        def at(x):
            i = F.when(x < a, x).otherwise(a + F.pmod(x - a, p))
            return F.get(ws, i.cast("int"))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), at), " ")).otherwise("")

    return F.when(F.pmod(h, F.lit(10)) == 0, let(words, repeat)).otherwise(text)
