"""Repeated-phrase removal by sharded automata.

A word is removed if it lies in a window of ``WINDOW`` consecutive words whose
word sequence also starts earlier (smaller document id, or earlier in the same
document), judged on the input.

1. Every window picks as its anchor the run of ``GRAM`` words with the least
   hash inside it (winnowing), so equal windows pick equal anchors and about one
   word in eight is an anchor.  Anchors that occur once cannot belong to a
   repeated window and are dropped.
2. For anchors that recur, the stretch of words that their windows cover is cut
   out as a fragment (32-bit word numbers) and sent to the shard of its anchor,
   so all occurrences of a phrase meet in one shard and no shard reads
   documents that cannot hold its phrases.
3. A shard confirms which word sequences recur, compiles them to Aho-Corasick
   automata of bounded size and streams its fragments through; every
   occurrence but the first becomes a removal range.
4. Ranges return to their documents by row key.

Equal rows share a row key.  A task reads them once, and the places and ranges
of a key are sets, so both are bounded by the row's words however often it is
repeated.

An anchor with more than ``HOT`` occurrences is dealt by whole windows instead,
so a frequent phrase with many different surroundings spreads over shards; a
frequent window alone needs one entry of memory, since its shard reads it as a
sorted stream.

Words are compared by 64-bit hashes reduced to 32 bits in a sequence of 20 or
more, that is by 640 bits.  Defined results: null and empty texts have no
words; repeated rows count as one document; different texts under one id are
ordered by the hash of the row; a null id comes before all others.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import field, rows_as_structs

WINDOW = 20
GRAM = 6
#: Occurrences from which an anchor is dealt by windows.  Results are the same.
HOT = 5_000
#: Fragments for which one automaton is compiled: some 60,000 nodes, which stay
#: in a core's cache.  Results are the same.
SHARD_FRAGMENTS = 2_000
_U = np.uint64
_AT = np.dtype([("rk", "<i8"), ("at", "<i4")])
_PLACE = np.dtype([("id", "<i8"), ("rk", "<i8"), ("start", "<i4")])


def anchor_runs(words: ts.Words, window: int, gram: int):
    """(anchor hash, anchor word, first window, last window) of every run of
    windows of one row that share an anchor; words count from the piece."""
    n = len(words) - window + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    m = len(words) - gram + 1
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(gram):
        acc = acc * _U(0xD6E8FEB86659FD93) + words.hash[j:j + m]
    acc = ts.mix(acc)
    _, place = ts.least(acc, window - gram + 1)
    whole = np.flatnonzero(words.row[:n] == words.row[window - 1:])
    if not len(whole):
        return none.astype(np.uint64), none, none, none
    place = place[whole]
    new = np.ones(len(whole), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(whole)) - 1
    return acc[place[begin]], place[begin], whole[begin], whole[end]


def _grouped(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Distinct keys, each with its places (a structured array) in order."""
    order = np.lexsort((*(places[f] for f in reversed(places.dtype.names)), keys))
    keys, places = keys[order], places[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    raw, size = places.tobytes(), places.dtype.itemsize
    ends = np.append(at[1:], len(keys))
    return keys[at], [raw[size * b:size * e] for b, e in zip(at.tolist(), ends.tolist())]


def _unseen(batch: pa.RecordBatch, column: int, seen: set[int]) -> pa.RecordBatch:
    """The rows whose key in ``column`` is not in ``seen`` yet, one of each key."""
    new = []
    for i, key in enumerate(batch.column(column).to_pylist()):
        if key not in seen:
            seen.add(key)
            new.append(i)
    return batch if len(new) == batch.num_rows else batch.take(pa.array(new, pa.int64()))


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, places): a row for each anchor of a piece of a batch, so that a
    frequent anchor is gathered before the shuffle.  A task reads a repeated row
    once."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("places", T.BinaryType())])

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            batch = _unseen(batch, 0, seen)
            keys = batch.column(0).to_numpy()
            for lo, _, words in ts.word_batches(batch.column(1), ts.SPACE):
                h, _, first, _ = anchor_runs(words, window, gram)
                row = words.row[first]
                places = np.empty(len(first), dtype=_AT)
                places["rk"], places["at"] = keys[lo + row], first - words.first[row]
                anchors, packed = _grouped(h.view(np.int64), places)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(packed, pa.binary())], names=["anchor", "places"])

    return docs.mapInArrow(run, schema)


def _recurring_runs(anchors: DataFrame, hot: int) -> DataFrame:
    """(rk, at, hot, anchor) of every occurrence of an anchor with two or more."""
    n = F.sum(F.octet_length("places").cast("long")).over(Window.partitionBy("anchor"))
    several = anchors.withColumn("n", n).filter(F.col("n") > _AT.itemsize)
    schema = T.StructType([T.StructField("rk", T.LongType()), T.StructField("at", T.IntegerType()),
                           T.StructField("hot", T.BooleanType()), T.StructField("anchor", T.LongType())])

    def run(batches):
        for batch in batches:
            places = [np.frombuffer(p, _AT) for p in batch.column(1).to_pylist()]
            size = [len(p) for p in places]
            flat = np.concatenate(places) if places else np.zeros(0, _AT)
            many = batch.column(2).to_numpy() > hot * _AT.itemsize
            yield pa.RecordBatch.from_arrays([
                pa.array(flat["rk"]), pa.array(flat["at"]), pa.array(np.repeat(many, size)),
                pa.array(np.repeat(batch.column(0).to_numpy(), size))], names=["rk", "at", "hot", "anchor"])

    return several.mapInArrow(run, schema)


def _fragments(chosen: DataFrame, window: int, gram: int, text: str) -> DataFrame:
    """Fragments of the chosen runs: (key, id, rk, start, words, more).  Equal
    fragments of a piece are one row with the places beyond the first in
    ``more``, so a frequent fragment is gathered before the shuffle.  A task
    reads a repeated row once."""
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("id", T.LongType()), T.StructField("rk", T.LongType()),
        T.StructField("start", T.IntegerType()), T.StructField("words", T.BinaryType()), T.StructField("more", T.BinaryType())])

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            batch = _unseen(batch, 2, seen)
            ids, rks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            runs = batch.column(3)
            for lo, hi, words in ts.word_batches(field(batch, text), ts.SPACE):
                _, _, first, last = anchor_runs(words, window, gram)
                row = words.row[first]
                own = first - words.first[row]
                part = runs.slice(lo, hi - lo)
                size = np.diff(part.offsets.to_numpy())
                flat = part.flatten()
                start, hot, anchor = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "hot", "anchor"))
                wanted = np.repeat(np.arange(hi - lo), size).astype(np.int64) << 32 | start
                mine = row.astype(np.int64) << 32 | own
                order = np.argsort(wanted, kind="stable")
                wanted, hot, anchor = wanted[order], hot[order], anchor[order]
                at = np.searchsorted(wanted, mine)
                at[at == len(wanted)] = 0
                hit = np.flatnonzero(wanted[at] == mine) if len(wanted) else np.zeros(0, np.int64)
                number = words.hash.astype(np.uint32)
                raw = number.tobytes()
                key, begin, end = [], [], []
                cool = hit[~hot[at[hit]]]
                key.append(anchor[at[cool]])
                begin.append(first[cool])
                end.append(last[cool] + window)
                warm = hit[hot[at[hit]]]
                if len(warm):
                    each = np.concatenate([np.arange(first[k], last[k] + 1) for k in warm])
                    _, grams = _window_hashes(words, window)
                    key.append(grams[each].view(np.int64))
                    begin.append(each)
                    end.append(each + window)
                key, begin, end = np.concatenate(key), np.concatenate(begin), np.concatenate(end)
                row = words.row[begin]
                places = np.empty(len(begin), dtype=_PLACE)
                places["id"], places["rk"], places["start"] = ids[lo + row], rks[lo + row], begin - words.first[row]
                yield _fragment_rows(key, places, [raw[4 * b:4 * e] for b, e in zip(begin.tolist(), end.tolist())], schema.names)

    return chosen.mapInArrow(run, schema)


def _fragment_rows(key: np.ndarray, places: np.ndarray, fragments: list[bytes], names: list[str]) -> pa.RecordBatch:
    own: dict[tuple[int, bytes], list[int]] = {}
    keys = key.tolist()
    for i in np.lexsort((places["start"], places["rk"], places["id"])).tolist():
        own.setdefault((keys[i], fragments[i]), []).append(i)
    first = [at[0] for at in own.values()]
    more = [places[at[1:]].tobytes() if len(at) > 1 else None for at in own.values()]
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _ in own], pa.int64()), pa.array(places["id"][first]), pa.array(places["rk"][first]),
        pa.array(places["start"][first]), pa.array([w for _, w in own], pa.binary()), pa.array(more, pa.binary())], names=names)


def _window_hashes(words: ts.Words, window: int):
    m = len(words) - window + 1
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(window):
        acc = acc * _U(0x9FB21C651E98DF25) + words.hash[j:j + m]
    return np.arange(m), ts.mix(acc)


class Shard:
    """Groups of fragments under one key, read in order of (key, id, row, start)."""

    def __init__(self, window: int):
        self.window = window
        self.known: dict[tuple[int, bytes], tuple] = {}       # phrase of an unfinished key: its first place

    def locate(self, rows: list[tuple], unfinished) -> list[tuple[int, int, int]]:
        """(row, start, length) of every occurrence but the first of each phrase.
        Rows come in order of their first place, so a phrase is first met where
        it first occurs.  ``rows`` are whole groups, but for the last key's if ``unfinished``."""
        groups: dict[int, dict[bytes, int]] = {}
        for key, _, _, _, words, more in rows:
            own = groups.setdefault(key, {})
            own[words] = own.get(words, 0) + 1 + (len(more) // _PLACE.itemsize if more else 0)
        phrases: set[bytes] = set()
        searched: set[int] = set()                            # keys with phrases; a phrase lies in its own key's fragments only
        carried = {key for key, _ in self.known}
        for key, own in groups.items():
            if len(own) == 1 and key not in carried and key != unfinished:
                (words, n), = own.items()
                if n > 1:
                    phrases.add(words)
                    searched.add(key)
            elif found := self._recurring(key, own, key == unfinished):
                phrases |= found
                searched.add(key)
        out = []
        if phrases:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for p in phrases:
                automaton.add_word(tuple(memoryview(p).cast("I")), p)
            automaton.make_automaton()
            for key, id_, rk, start, words, more in rows:
                if key not in searched:
                    continue
                others = np.frombuffer(more, _PLACE)[["rk", "start"]].tolist() if more else ()
                for end, p in automaton.iter(tuple(memoryview(words).cast("I"))):
                    n = len(p) // 4
                    at = end + 1 - n
                    place = (id_, rk, start + at)
                    if self.known.setdefault((key, p), place) != place:
                        out.append((rk, start + at, n))
                    out += [(r, s + at, n) for r, s in others if (r, s) != (rk, start)]
        self.known = {k: v for k, v in self.known.items() if k[0] == unfinished}
        return out

    def _recurring(self, key: int, own: dict[bytes, int], unfinished: bool) -> set[bytes]:
        """Windows of a group that occur twice or more; all of them while the
        group goes on, since a later part may repeat them."""
        size, count = 4 * self.window, {}
        for words, n in own.items():
            for b in range(0, len(words) - size + 1, 4):
                w = words[b:b + size]
                count[w] = count.get(w, 0) + n
        return {w for w, n in count.items() if unfinished or n > 1 or (key, w) in self.known}


def _ranges(fragments: DataFrame, window: int, shard_fragments: int) -> DataFrame:
    schema = T.StructType([T.StructField("rk", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])

    def run(batches):
        shard, rows = Shard(window), []

        def found(unfinished):
            got = shard.locate(rows, unfinished)
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()),
                 pa.array([g[2] for g in got], pa.int32())], names=["rk", "start", "length"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if len(rows) >= shard_fragments and (row[0] != rows[-1][0] or len(rows) >= 2 * shard_fragments):
                    yield found(row[0] if row[0] == rows[-1][0] else None)
                    rows = []
                rows.append(row)
        if rows:
            yield found(None)

    return (fragments.repartition("key").sortWithinPartitions("key", "id", "rk", "start").mapInArrow(run, schema))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   gram: int = GRAM, hot: int = HOT, shard_fragments: int = SHARD_FRAGMENTS) -> DataFrame:
    """(row, n_words, n_removed, kept): every document with its kept words
    joined by one space."""
    base = rows_as_structs(docs).withColumn("rk", F.xxhash64(f"row.{doc_id}", f"row.{text}"))
    anchors = _anchors(base.select("rk", F.col(f"row.{text}").alias("text")), window, gram)
    runs = _recurring_runs(anchors, hot).groupBy("rk").agg(F.collect_set(F.struct("at", "hot", "anchor")).alias("runs"))
    order = F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(-(1 << 63)))
    chosen = base.join(runs, "rk").select("row", order.alias("id"), "rk", "runs")
    ranges = (_ranges(_fragments(chosen, window, gram, text), window, shard_fragments)
              .groupBy("rk").agg(F.collect_set(F.struct("start", "length")).alias("ranges")))
    schema = T.StructType([
        T.StructField("row", docs.schema), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def cut(batches):
        for batch in batches:
            texts = field(batch, text).cast(pa.large_binary()).to_pylist()
            total, removed, kept = [], [], []
            for value, own in zip(texts, batch.column(1).to_pylist()):
                words = (value or b"").split()
                total.append(len(words))
                if own:
                    mask = ts.covered_ranges([(r["start"], r["length"]) for r in own], len(words))
                    removed.append(int(mask.sum()))
                    words = compress(words, (~mask).tolist())
                else:
                    removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())], names=["row", "n_words", "n_removed", "kept"])

    return base.join(ranges, "rk", "left").select("row", "ranges").mapInArrow(cut, schema)
