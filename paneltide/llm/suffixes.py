"""Removal of repeated bytes by sharded suffix arrays.

A byte is removed if a string of ``WINDOW`` bytes that covers it also starts
earlier (smaller document id, or earlier in the same document), judged on the
input; strings never cross documents.

1. Parse.  Texts are cut into phrases where a hash of the next bytes says so, so
   equal passages are cut alike.  A phrase, with the bytes that windows beginning
   in it still need, is kept where it occurs first; elsewhere all of its windows
   are known to occur earlier and are removed.  What is sorted is the dictionary
   of distinct phrases.
2. Route.  Each window left picks the ``GRAM`` bytes with the least hash inside it
   as its anchor (winnowing), so equal windows pick equal anchors.  Windows of an
   anchor that occurs once cannot repeat and drop out.  The stretch of bytes that
   consecutive windows of one anchor cover goes to the anchor's shard.
3. Sort.  A shard reads its stretches as a stream, in groups of one anchor, and
   sorts their suffixes with common prefixes by external induced sorting
   (``induced``).  Neighbours with ``WINDOW`` bytes in common are the same window;
   every occurrence but the first becomes a removal range.  Equal stretches of a
   group are one string with several places, and a string alone in its group
   holds no window twice, since each window has its anchor elsewhere.  Windows
   whose hash is alone in their group are no one's equal either: of a string, the
   bytes from the first to the last of its other windows are sorted.
4. Ranges return to their documents by row key.

Shards are never held: a task sorts a bounded part of its stream at a time and
carries the first place of each string of an unfinished group; the queues of the
sort keep a bounded number of suffix tuples and the rest in the shared folder.
An anchor with more than ``HOT`` places is dealt by single windows and salts
instead; the first places of a window's salts are compared at the end.

Anchors, row keys and windows of hot anchors are told apart by 64-bit hashes,
phrases by 128 bits; a sort compares bytes.  Defined results: null and empty texts
have no bytes; repeated rows count as one document; different texts under one id
are ordered by the hash of the row; a null id comes before all others; an empty
table gives no rows; columns of the input stay inside ``row``; a text of any
length is scanned whole, in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import field, rows_as_structs, workspace
from .induced import DiskQueue, sort_suffixes

WINDOW = 100
GRAM = 24
#: Bytes whose hash ends a phrase, and the mean length of one.
TRIGGER, PHRASE = 16, 256
#: Places from which an anchor is dealt by windows and salts.  Results are the same.
HOT, SALTS = 5_000, 32
#: Bytes of anchors in one bucket, bytes of stretches that a task sorts at once,
#: and suffix tuples that one queue keeps in memory.
BUCKET_BYTES, SORT_BYTES, QUEUE_ROWS = 16 << 20, 24 << 20, 1_000_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C55
_BYTES = ts.mix(np.arange(256, dtype=np.uint64) + _U(1))
#: Windows whose anchors are found at once.
BLOCK = 32 << 10
#: Order of ids where one is null.
_LEAST = -(1 << 63)
_ANCHOR = np.dtype([("h", "<u8"), ("rk", "<i8"), ("at", "<u4")])
_PLACE = np.dtype([("id", "<i8"), ("rk", "<i8"), ("start", "<i4")])


def rolling(raw: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of the ``size`` bytes from each byte on; its high bits are
    mixed, its low bits are not."""
    one = _BYTES[raw]
    if len(raw) < size:
        return one[:0]
    h, k = one, 1
    for bit in bin(size)[3:]:
        h = h[:-k] * _U(pow(_BASE, k, 1 << 64)) + h[k:]
        k *= 2
        if bit == "1":
            h = h[:-1] * _U(_BASE) + one[k:]
            k += 1
    return h


def anchors(raw: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, new) of every ``span`` hashes of ``gram`` bytes in a row: the least
    hash, and whether its first place is another than that of the span before.
    Found in blocks that stay in a core's cache."""
    n, more = len(raw) - gram - span + 2, gram + span - 2
    value, new = np.empty(n, np.uint64), np.ones(n + 1, bool)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        least = h = rolling(raw[lo:hi + more], gram)
        k = 1
        while k < span:
            step = min(k, span - k)
            least = np.minimum(least[step:], least[:-step])
            k += step
        value[lo:hi] = least
        np.equal(h[:hi - lo], least, out=new[lo + 1:hi + 1])    # the least one is the first, which the next span lacks
    new[1:n] |= value[1:] != value[:-1]
    return value, new[:n]


class Piece:
    """Texts of a batch as one buffer, with the row and place of each byte."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, lo: int, hi: int):
        self.raw = raw[int(off[lo]):int(off[hi])]
        self.first = off[lo:hi + 1] - off[lo]
        self.size = np.diff(self.first)

    def rows(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1

    def phrases(self, window: int, phrase: int):
        """(row, start, bytes with what its windows need, windows) of every
        phrase with windows."""
        last = self.first[:-1] + self.size - window + 1     # no window begins from here on
        h = rolling(self.raw, TRIGGER)
        cut = np.flatnonzero(h < _U((1 << 64) // phrase))
        cut = np.union1d(cut, self.first[:-1][self.size >= window])
        row = self.rows(cut)
        inside = cut < last[row]
        cut, row = cut[inside], row[inside]
        stop = np.minimum(np.append(cut[1:], len(self.raw)), last[row])
        return row, cut - self.first[row], cut, stop + window - 1, stop - cut

    def runs(self, window: int, gram: int, dropped: list | None):
        """(anchor, first window, last window) of every run of windows in a row
        that share an anchor place, without the windows in ``dropped`` (start,
        windows) of each row."""
        n = len(self.raw) - window + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 3
        value, new = anchors(self.raw, gram, window - gram + 1)
        keep = np.zeros(n + 1, np.int32)
        begin, end = self.first[:-1], self.first[:-1] + np.maximum(self.size - window + 1, 0)
        np.add.at(keep, begin[end > begin], 1)
        np.add.at(keep, end[end > begin], -1)
        for r, own in enumerate(dropped or ()):
            for start, windows in own or ():
                keep[self.first[r] + start] -= 1
                keep[self.first[r] + start + windows] += 1
        inside = np.cumsum(keep[:-1]) > 0
        new[1:] |= ~inside[:-1]
        new &= inside
        stop = inside
        stop[:-1] &= new[1:] | ~inside[1:]
        first = np.flatnonzero(new)
        return value[first], first, np.flatnonzero(stop)


def _batches(batch: pa.RecordBatch, text: str):
    raw, off = ts.buffer_of(field(batch, text))
    for lo, hi in ts.pieces(off):
        yield lo, hi, Piece(raw, off, lo, hi)


class _Once:
    """Rows of a batch whose key a task has not met yet."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, batch: pa.RecordBatch, column: int) -> pa.RecordBatch:
        new = []
        for i, key in enumerate(batch.column(column).to_pylist()):
            if key not in self.seen:
                self.seen.add(key)
                new.append(i)
        return batch if len(new) == batch.num_rows else batch.take(pa.array(new, pa.int64()))


def _struct(*fields) -> T.StructType:
    kinds = {"l": T.LongType(), "i": T.IntegerType(), "b": T.BinaryType(), "f": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields])


def _phrases(base: DataFrame, text: str, window: int, phrase: int) -> DataFrame:
    """(phrase: digest, id, rk, start, windows) of all texts."""
    schema = _struct(("phrase", "b"), ("id", "l"), ("rk", "l"), ("start", "i"), ("windows", "i"))

    def run(batches):
        once = _Once()
        for batch in batches:
            batch = once(batch, 1)
            rk, ids = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lo, _, piece in _batches(batch, text):
                row, start, a, b, windows = piece.phrases(window, phrase)
                data = piece.raw.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxhash.xxh3_128_digest(data[i:j]) for i, j in zip(a.tolist(), b.tolist())], pa.binary()),
                    pa.array(ids[lo + row]), pa.array(rk[lo + row]), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32))],
                    names=schema.names)

    return base.mapInArrow(run, schema)


def _anchors(base: DataFrame, text: str, window: int, gram: int, buckets: int) -> DataFrame:
    """(bucket, anchors) of the windows left: anchors of a piece by range of hash."""
    schema = _struct(("bucket", "i"), ("anchors", "b"))

    def run(batches):
        once = _Once()
        for batch in batches:
            batch = once(batch, 1)
            rk, dropped = batch.column(1).to_numpy(), batch.column(3).to_pylist()
            for lo, hi, piece in _batches(batch, text):
                h, first, _ = piece.runs(window, gram, [_pairs(d) for d in dropped[lo:hi]])
                row = piece.rows(first)
                found = np.empty(len(h), _ANCHOR)
                found["h"], found["rk"], found["at"] = h, rk[lo + row], first - piece.first[row]
                found = found[np.argsort(found["h"], kind="stable")]
                # high halves of the least hashes crowd together; mixed bits spread them
                bucket = (ts.mix(found["h"]) % _U(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                found, raw = found[order], found[order].tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[order][edges[:-1]]),
                    pa.array([raw[_ANCHOR.itemsize * a:_ANCHOR.itemsize * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())],
                    names=schema.names)

    return base.mapInArrow(run, schema)


def _pairs(packed: list[bytes] | None) -> list:
    return [] if not packed else np.concatenate([np.frombuffer(p, "<i4") for p in packed]).reshape(-1, 2).tolist()


def _recurring(anchors: DataFrame, buckets: int, hot: int) -> DataFrame:
    """(rk, runs): first windows of the runs whose anchor occurs again, as numbers
    with the lowest bit set for hot anchors."""
    schema = _struct(("rk", "l"), ("runs", "b"))

    def out(held):
        found = np.concatenate(held)
        found = np.unique(found)                            # by anchor; repeated rows count once
        new = np.flatnonzero(np.diff(found["h"], prepend=found["h"][:1] - _U(1)))
        n = np.diff(np.append(new, len(found)))
        n = np.repeat(n, n)
        found, n = found[n > 1], n[n > 1]
        value = found["at"].astype("<i8") * 2 + (n > hot)
        order = np.argsort(found["rk"], kind="stable")
        rk, value = found["rk"][order], value[order]
        if not len(rk):
            return None
        edges = np.append(np.flatnonzero(np.diff(rk, prepend=rk[0] - 1)), len(rk))
        raw = value.tobytes()
        return pa.RecordBatch.from_arrays([
            pa.array(rk[edges[:-1]]), pa.array([raw[8 * a:8 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())],
            names=schema.names)

    def run(batches):
        at, held = None, []
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != at:
                    if held and (got := out(held)) is not None:
                        yield got
                    at, held = bucket, []
                held.append(np.frombuffer(raw, _ANCHOR))
        if held and (got := out(held)) is not None:
            yield got

    return anchors.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


_STRETCH = _struct(("key", "l"), ("whole", "l"), ("id", "l"), ("rk", "l"), ("start", "i"), ("bytes", "b"), ("more", "b"))


def _stretches(chosen: DataFrame, text: str, window: int, gram: int, salts: int) -> DataFrame:
    """Bytes of the recurring runs by anchor, of hot ones by window and salt
    (``whole``: the window).  Equal ones of a piece are one row, its first place
    apart and the others in ``more``."""
    def run(batches):
        once = _Once()
        for batch in batches:
            batch = once(batch, 1)
            rk, ids, dropped, wanted = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for lo, hi, piece in _batches(batch, text):
                h, first, last = piece.runs(window, gram, [_pairs(d) for d in dropped[lo:hi]])
                row = piece.rows(first)
                own = [np.concatenate([np.frombuffer(p, "<i8") for p in parts]) for parts in wanted[lo:hi]]
                size = [len(x) for x in own]
                flat = np.concatenate(own) if own else np.zeros(0, np.int64)
                asked = np.repeat(piece.first[:-1], size) + (flat >> 1)
                warm = np.zeros(len(piece.raw) + 1, bool)
                ask = warm.copy()
                ask[asked], warm[asked[flat & 1 == 1]] = True, True
                cool = ask[first] & ~warm[first]
                key, begin, end = [h[cool]], [first[cool]], [last[cool] + window]
                some = np.flatnonzero(warm[first])
                each = np.concatenate([np.arange(first[k], last[k] + 1) for k in some]) if len(some) else np.zeros(0, np.int64)
                if len(each):
                    key.append(rolling(piece.raw, window)[each])
                    begin.append(each)
                    end.append(each + window)
                key, begin, end = np.concatenate(key).view(np.int64), np.concatenate(begin), np.concatenate(end)
                row = piece.rows(begin)
                places = np.empty(len(begin), _PLACE)
                places["id"], places["rk"], places["start"] = ids[lo + row], rk[lo + row], begin - piece.first[row]
                yield _gathered(key, places, begin, end, piece.raw.tobytes(), len(key) - len(each), int(rk[lo]) % salts)

    return chosen.mapInArrow(run, _STRETCH)


def _gathered(key, places, begin, end, data: bytes, cool: int, salt: int) -> pa.RecordBatch:
    """Rows of distinct (key, bytes); those from ``cool`` on are single windows,
    dealt by window and the piece's salt."""
    met: dict[tuple, list[int]] = {}
    order = np.lexsort((places["start"], places["rk"], places["id"])).tolist()
    keys, a, b = key.tolist(), begin.tolist(), end.tolist()
    for i in order:
        met.setdefault((keys[i], i >= cool, data[a[i]:b[i]]), []).append(i)
    first = [own[0] for own in met.values()]
    whole = [k if w else None for k, w, _ in met]
    salted = ts.mix(np.array([k for k, _, _ in met], np.int64).view(np.uint64) + _U(salt)).view(np.int64).tolist()
    dealt = [s if w is not None else k for s, w, (k, _, _) in zip(salted, whole, met)]
    return pa.RecordBatch.from_arrays([
        pa.array(dealt, pa.int64()), pa.array(whole, pa.int64()), pa.array(places["id"][first]), pa.array(places["rk"][first]),
        pa.array(places["start"][first]), pa.array([s for _, _, s in met], pa.binary()),
        pa.array([places[own[1:]].tobytes() if len(own) > 1 else None for own in met.values()], pa.binary())], names=_STRETCH.names)


class Shard:
    """Finds the windows of a stream of stretches that occur earlier."""

    def __init__(self, window: int, folder: str, queue_rows: int = QUEUE_ROWS):
        self.window, self.folder, self.queue_rows = window, folder, queue_rows
        self.carried: list[tuple] = []                      # (key, bytes, id, rk, start) of an unfinished group

    def _heads(self, strings: list[bytes], group: np.ndarray, first: np.ndarray) -> list[np.ndarray | None]:
        """Of each string, whether each of its windows occurs first at the
        string's first place; None where all do."""
        size = np.array([len(s) for s in strings], np.int64)
        heads: list[np.ndarray | None] = [None] * len(strings)
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        several, low, high = self._alike(strings, size, group, several)
        if not len(several):
            return heads
        length = high - low + 1
        begin = np.cumsum(length) - length
        symbols = np.zeros(int(length.sum()), np.int32)
        filled = np.ones(len(symbols), bool)
        filled[begin + length - 1] = False
        cut = zip(several.tolist(), low.tolist(), high.tolist())
        symbols[filled] = np.frombuffer(b"".join([strings[i][a:b] for i, a, b in cut]), np.uint8).astype(np.int32) + 1
        own = group[several]
        new = np.flatnonzero(np.diff(own, prepend=-1))
        number = np.cumsum(np.diff(own, prepend=-1) != 0) - 1
        places, common = sort_suffixes(symbols, np.repeat(number, length).astype(np.int32), begin[new], self.window,
                                       lambda keys: DiskQueue(keys, self.queue_rows, self.folder))
        owner = np.searchsorted(begin, places, side="right") - 1
        offset = places - begin[owner]
        inside = offset <= length[owner] - 1 - self.window  # suffixes that begin a window
        same = common >= self.window
        cluster = np.cumsum(~same)[inside]
        owner, offset = owner[inside], offset[inside]
        at = first[several][owner]
        order = np.lexsort((at["start"] + low[owner] + offset, at["rk"], at["id"], cluster))
        later = order[np.flatnonzero(np.diff(cluster[order], prepend=-1) == 0)]
        mask = np.ones(len(symbols), bool)
        mask[begin[owner[later]] + offset[later]] = False
        for i, b, a, n in zip(several.tolist(), begin.tolist(), low.tolist(), (length - self.window).tolist()):
            if not mask[b:b + n].all():
                heads[i] = np.ones(len(strings[i]) - self.window + 1, bool)
                heads[i][a:a + n] = mask[b:b + n]
        return heads

    def _alike(self, strings: list[bytes], size: np.ndarray, group: np.ndarray, several: np.ndarray):
        """Of the strings ``several``, those with windows whose hash occurs again in
        their group, and the bytes from the first to the last such window."""
        none = np.zeros(0, np.int64)
        if not len(several):
            return several, none, none
        n = size[several] - self.window + 1
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(several)), n)
        begin = np.cumsum(size[several]) - size[several]
        offset = np.arange(len(owner)) - first[owner]
        raw = np.frombuffer(b"".join([strings[i] for i in several.tolist()]), np.uint8)
        number = np.concatenate([rolling(raw[lo:lo + BLOCK + self.window - 1], self.window) for lo in range(0, len(raw) - self.window + 1, BLOCK)])
        number = number[begin[owner] + offset] ^ ts.mix(group.astype(np.uint64))[several[owner]]
        order = np.argsort(number)
        same = np.flatnonzero(number[order[1:]] == number[order[:-1]])
        again = np.zeros(len(owner), bool)
        again[order[same]] = again[order[same + 1]] = True
        at = np.flatnonzero(again)
        if not len(at):
            return none, none, none
        head = np.flatnonzero(np.diff(owner[at], prepend=-1))
        tail = np.append(head[1:], len(at)) - 1
        return several[owner[at[head]]], offset[at[head]], offset[at[tail]] + self.window

    def locate(self, rows: list[tuple], unfinished: int | None) -> tuple[list, list]:
        """(ranges: (rk, start, length); first windows: (whole, id, rk, start)) of
        rows in order of key and first place.  ``unfinished``: the last key, if
        more of its rows follow."""
        strings: list[bytes] = []
        group, first, own, whole = [], [], [], []
        number: dict[tuple, int] = {}
        for key, bytes_, id_, rk, start in self.carried:
            number[key, bytes_] = len(strings)
            strings.append(bytes_)
            group.append(key)
            first.append((id_, rk, start))
            own.append([])
            whole.append(None)
        old = len(strings)
        for key, window, id_, rk, start, bytes_, more in rows:
            i = number.setdefault((key, bytes_), len(strings))
            if i == len(strings):
                strings.append(bytes_)
                group.append(key)
                first.append((id_, rk, start))
                own.append([])
                whole.append(window)
            own[i].append((id_, rk, start))
            if more:
                own[i] += np.frombuffer(more, _PLACE).tolist()
        keys = {k: n for n, k in enumerate(dict.fromkeys(group))}
        places = np.array(first, _PLACE)
        heads = self._heads(strings, np.array([keys[k] for k in group], np.int64), places)
        ranges, firsts = [], []
        for i, (s, head) in enumerate(zip(strings, heads)):
            for place in set(own[i]):
                if place != first[i]:
                    ranges.append((place[1], place[2], len(s)))
                elif i >= old:
                    if whole[i] is not None:
                        firsts.append((whole[i], *place))
                    if head is not None:
                        _, rk, start = place
                        at = np.flatnonzero(~head)
                        gap = np.flatnonzero(at[1:] - at[:-1] > self.window)
                        for a, b in zip([int(at[0]), *at[gap + 1].tolist()], [*at[gap].tolist(), int(at[-1])]):
                            ranges.append((rk, start + a, b - a + self.window))
        self.carried = [(k, s, *f) for k, s, f in zip(group, strings, first) if k == unfinished]
        return ranges, firsts


def _located(stretches: DataFrame, window: int, folder: str, sort_bytes: int, queue_rows: int) -> DataFrame:
    """(rk, start, length, whole, id): removal ranges, and the first windows of
    salted keys (``whole``)."""
    schema = _struct(("rk", "l"), ("start", "i"), ("length", "i"), ("whole", "l"), ("id", "l"))

    def run(batches):
        shard = Shard(window, folder, queue_rows)
        rows, held = [], 0

        def found(unfinished):
            ranges, firsts = shard.locate(rows, unfinished)
            n, m = len(ranges), len(firsts)
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in ranges] + [f[2] for f in firsts], pa.int64()), pa.array([r[1] for r in ranges] + [f[3] for f in firsts], pa.int32()),
                pa.array([r[2] for r in ranges] + [window] * m, pa.int32()), pa.array([None] * n + [f[0] for f in firsts], pa.int64()),
                pa.array([None] * n + [f[1] for f in firsts], pa.int64())], names=schema.names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                if held >= sort_bytes:
                    yield found(rows[-1][0])                # its group may go on
                    rows, held = [], 0
                rows += zip(*(part.column(i).to_pylist() for i in range(7)))
                held += pc.sum(pc.binary_length(part.column(5))).as_py() + (pc.sum(pc.binary_length(part.column(6))).as_py() or 0)
        if rows:
            yield found(None)

    return stretches.repartition("key").sortWithinPartitions("key", "id", "rk", "start").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   phrase: int = PHRASE, hot: int = HOT, salts: int = SALTS, bucket_bytes: int = BUCKET_BYTES,
                   sort_bytes: int = SORT_BYTES, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): every document with the bytes
    that remain; ``row`` has no text."""
    spark = docs.sparkSession
    parse, keep = workspace(spark, "suffixes-parse"), workspace(spark, "suffixes")
    order = F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(_LEAST))
    base = rows_as_structs(docs).select("row", F.xxhash64(f"row.{doc_id}", f"row.{text}").alias("rk"), order.alias("id"))
    phrases = parse.stored(_phrases(base, text, window, phrase), "phrases")
    seen = phrases.groupBy("phrase").agg(F.min(F.struct("id", "rk", "start")).alias("first"), F.count("*").alias("n"))
    again = parse.stored(seen.filter("n > 1").select("phrase", "first"), "again")
    later = phrases.join(again, "phrase").filter(F.struct("id", "rk", "start") != F.col("first"))
    dropped = keep.stored(_packed(later.select("rk", "start", "windows")), "dropped").groupBy("rk").agg(F.collect_list("ranges").alias("dropped"))
    total = phrases.agg(F.sum("windows")).first()[0] or 0
    parse.remove()
    # two anchors in a stretch of starts, as many bytes each
    buckets = int(max(8, -(-2 * total * _ANCHOR.itemsize // (max(1, window - gram + 2) * bucket_bytes))))
    marked = base.join(dropped, "rk", "left").select("row", "rk", "id", "dropped")
    runs = _recurring(_anchors(marked, text, window, gram, buckets), buckets, hot).groupBy("rk").agg(F.collect_list("runs").alias("runs"))
    chosen = marked.join(runs, "rk").select("row", "rk", "id", "dropped", "runs")
    located = _located(_stretches(chosen, text, window, gram, salts), window, f"{_uri(keep.path)}/spill", sort_bytes, queue_rows)
    turn = F.row_number().over(Window.partitionBy(F.coalesce("whole", "rk"), F.col("whole").isNull()).orderBy("id", "rk", "start"))
    ranges = (located.withColumn("turn", turn).filter("whole is null or turn > 1")
              .groupBy("rk").agg(F.collect_set(F.struct("start", "length")).alias("ranges")))
    whole = marked.join(ranges, "rk", "left").select("row", "rk", "id", "dropped", "ranges")
    return _cut(whole, docs, text, window)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else "file://" + folder


def _packed(later: DataFrame) -> DataFrame:
    """(rk, ranges): (start, windows) pairs of one row key in a batch."""
    schema = _struct(("rk", "l"), ("ranges", "b"))

    def run(batches):
        for batch in batches:
            rk = batch.column(0).to_numpy()
            pairs = np.stack((batch.column(1).to_numpy(), batch.column(2).to_numpy()), axis=1).astype("<i4")
            order = np.argsort(rk, kind="stable")
            rk, raw = rk[order], pairs[order].tobytes()
            if len(rk):
                edges = np.append(np.flatnonzero(np.diff(rk, prepend=rk[0] - 1)), len(rk))
                yield pa.RecordBatch.from_arrays([
                    pa.array(rk[edges[:-1]]), pa.array([raw[8 * a:8 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())],
                    names=schema.names)

    return later.mapInArrow(run, schema)


def _cut(whole: DataFrame, docs: DataFrame, text: str, window: int) -> DataFrame:
    own = [f.name for f in docs.schema.fields if f.name != text]
    fields = [f for f in docs.schema.fields if f.name != text] or [T.StructField("_", T.BooleanType())]
    schema = T.StructType([T.StructField("row", T.StructType(fields)), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept", T.BinaryType())])

    def run(batches):
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for value, dropped, ranges in zip(field(batch, text).cast(pa.large_binary()).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                value = value or b""
                gone = [(a, n + window - 1) for a, n in _pairs(dropped)] + [(r["start"], r["length"]) for r in ranges or ()]
                n_bytes.append(len(value))
                if not gone:
                    n_removed.append(0)
                    n_spans.append(0)
                    kept.append(value)
                    continue
                mask = ts.covered_ranges(gone, len(value))
                n_removed.append(int(mask.sum()))
                n_spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                kept.append(np.frombuffer(value, np.uint8)[~mask].tobytes())
            parts = [field(batch, c) for c in own] or [pa.nulls(batch.num_rows, pa.bool_())]
            yield pa.RecordBatch.from_arrays([
                pa.StructArray.from_arrays(parts, names=own or ["_"]), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)),
                pa.array(kept, pa.binary())], names=schema.names)

    return whole.mapInArrow(run, schema)
