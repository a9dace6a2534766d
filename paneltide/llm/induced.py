"""External induced sorting of suffixes, with common-prefix lengths.

Strings come in independent groups and each ends with symbol 0.  A suffix is of
type S if it is less than the next one, of type L otherwise; an S suffix after an
L suffix is a seed.

* The stretches between seeds are sorted by their symbols and types, some at a
  time in one integer, and named by rank within their group.  Where names repeat,
  the strings of names are sorted by the same function: seeds get their order and
  their common prefixes, counted in names, from the recursion.
* From sorted seeds all L suffixes are induced in ascending and all S suffixes in
  descending order.  A suffix that is read sends the one before it to a priority
  queue under its first symbol, with the rank it was read at; two suffixes that
  leave the queue in turn share one symbol more than the least common prefix
  between the two ranks.

All groups advance together, symbol by symbol, so that each step is an operation
on arrays.  A group with over ``NAMES`` names would take a step for each of them;
its strings of names are ranked by doubling instead, with equal results.  Queues
hold a bounded number of tuples and keep the rest on disk.  Common prefixes are
counted up to ``cap``.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyarrow import fs


#: Names of a group up to which they are sorted by induction.
NAMES = 128


class DiskQueue:
    """Tuples (integer rows, the key first) that leave by key, in order of arrival
    within a key.  Keys are taken in one direction, and while a key is taken more
    may arrive for it or for keys ahead.  Beyond ``limit`` rows, all that does not
    belong to the open range of keys is written to ``folder``."""

    def __init__(self, keys: int, limit: int, folder: str):
        self.width = 1 if keys <= 1024 else math.isqrt(keys)
        self.limit, self.folder = limit, folder
        self.parts: dict[int, list] = {}                    # range of keys: chunks in order of arrival
        self.fine: dict[int, list[np.ndarray]] = {}         # of the open range: chunks of each key
        self.open, self.held, self.files, self.spilled = None, 0, [], 0

    @staticmethod
    def _split(rows: np.ndarray, by: np.ndarray):
        if not len(rows):
            return
        if len(rows) > 1 and (by[1:] < by[:-1]).any():
            order = np.argsort(by, kind="stable")
            rows, by = rows[order], by[order]
        edges = [0, *(np.flatnonzero(by[1:] != by[:-1]) + 1).tolist(), len(rows)]
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(by[a]), rows[a:b]

    def push(self, rows: np.ndarray) -> None:
        for part, own in self._split(rows, rows[:, 0] // self.width):
            if part == self.open and self.width == 1:
                self.fine.setdefault(part, []).append(own)
            elif part == self.open:
                self._deal(own)
            else:
                self.parts.setdefault(part, []).append(own)
                self.held += len(own)
        if self.held > self.limit:
            self._spill()

    def _deal(self, rows: np.ndarray) -> None:
        for key, own in self._split(rows, rows[:, 0]):
            self.fine.setdefault(key, []).append(own)

    def _spill(self) -> None:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        store, where = fs.FileSystem.from_uri(path)
        store.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.files.append((store, where))
        at = 0
        with store.open_output_stream(where, compression=None) as out:
            for chunks in self.parts.values():
                own = [c for c in chunks if isinstance(c, np.ndarray)]
                if own:
                    rows = np.concatenate(own)
                    out.write(rows.tobytes())
                    chunks[:] = [c for c in chunks if not isinstance(c, np.ndarray)] + [(len(self.files) - 1, at, rows.shape, rows.dtype)]
                    at += rows.nbytes
        self.spilled += self.held
        self.held = 0

    def _loaded(self, chunk) -> np.ndarray:
        if isinstance(chunk, np.ndarray):
            self.held -= len(chunk)
            return chunk
        number, at, shape, kind = chunk
        store, where = self.files[number]
        with store.open_input_file(where) as f:
            return np.frombuffer(f.read_at(int(np.prod(shape)) * kind.itemsize, at), kind).reshape(shape)

    def pop(self, key: int) -> np.ndarray | None:
        """All rows that have arrived for ``key`` and not left yet."""
        part = key // self.width
        if part != self.open:
            self.open, self.fine = part, {}
            chunks = [self._loaded(c) for c in self.parts.pop(part, ())]
            if self.width == 1 and chunks:
                self.fine[key] = chunks
            else:
                for chunk in chunks:
                    self._deal(chunk)
        own = self.fine.pop(key, None)
        return None if own is None else own[0] if len(own) == 1 else np.concatenate(own)

    def close(self) -> None:
        for store, where in self.files:
            store.delete_file(where)
        self.files = []


class _Strings:
    """Symbols of all strings, and what both induction passes need of them."""

    def __init__(self, symbols: np.ndarray, group: np.ndarray, base: np.ndarray):
        self.symbols, self.group, self.base = symbols, group, base
        n = len(symbols)
        self.end = np.append(base[1:], n)
        last = np.full(n, n - 1)                            # where the run of one symbol ends
        at = np.flatnonzero(symbols[1:] != symbols[:-1])
        last[at] = at
        last = np.minimum.accumulate(last[::-1])[::-1]
        self.small = symbols[np.minimum(last + 1, n - 1)] > symbols[last]
        self.small[symbols == 0] = True
        self.run = np.minimum(last - np.arange(n) + 1, 255).astype(np.uint8)
        self.seed = self.small.copy()
        self.seed[1:] &= ~self.small[:-1]
        self.seed[0] = symbols[0] == 0
        self.keys = int(symbols.max()) + 1


class _Reader:
    """Suffixes as they are read in one direction, group by group."""

    def __init__(self, s: _Strings, cap: int):
        self.s, self.cap = s, cap
        groups = len(s.base)
        self.filled = np.zeros(groups, np.int64)
        self.key, self.source, self.place = np.full(groups, -1, np.int64), np.zeros(groups, np.int64), np.zeros(groups, np.int64)
        self.common = np.zeros(len(s.symbols) + 1, np.uint8)

    def read(self, key: int, place: np.ndarray, source: np.ndarray | None, common: np.ndarray | None):
        """Ranks and common prefixes of suffixes that begin with ``key``, each
        against the suffix read before it in its group.  ``source``: ranks that
        they were induced from; or ``common``: what is known of each but the
        first of a kind."""
        s = self.s
        group = s.group[place]
        if len(group) > 1 and (group[1:] < group[:-1]).any():
            order = np.argsort(group, kind="stable")
            place, group = place[order], group[order]
            source = source if source is None else source[order]
            common = common if common is None else common[order]
        n = len(place)
        first = np.empty(n, bool)
        first[0] = True
        np.not_equal(group[1:], group[:-1], out=first[1:])
        heads = np.flatnonzero(first)
        size = np.diff(np.append(heads, n))
        own = group[heads]
        rank = np.arange(n) - np.repeat(heads - self.filled[own], size)
        self.filled[own] += size
        follows = self.key[own] == key                      # the head's predecessor begins with the key too
        if source is not None:
            before = np.empty(n, np.int64)
            before[1:] = source[:-1]
            before[heads] = self.source[own]
            valid = np.ones(n, bool)
            valid[heads] = follows
            value = np.zeros(n, np.uint8)
            at = np.flatnonzero(valid)[::-1]                # descending: no reduction over gaps
            if len(at):
                start = s.base[group[at]] + 1
                edges = np.empty(2 * len(at), np.int64)
                edges[::2], edges[1::2] = start + before[at], start + source[at]
                value[at] = np.minimum(np.minimum.reduceat(self.common, edges)[::2], self.cap - 1) + 1
            self.source[own] = source[heads + size - 1]
        else:
            value = common.copy()
            value[heads] = np.where(follows, np.minimum(np.minimum(s.run[self.place[own]], s.run[place[heads]]), self.cap), 0)
        self.common[s.base[group] + rank] = value
        self.key[own], self.place[own] = key, place[heads + size - 1]
        return place, group, rank, value

    def before(self, place: np.ndarray, rank: np.ndarray, small: bool) -> np.ndarray:
        """(key, place, rank read at) of the suffixes one symbol longer, of one type."""
        symbol = self.s.symbols[place - 1]                  # before a string stands another's 0
        want = np.flatnonzero((symbol != 0) & (self.s.small[place - 1] == small))
        return _rows(symbol[want], place[want] - 1, rank[want])


def _rows(key, place, value) -> np.ndarray:
    out = np.empty((len(place), 3), np.int32)
    out[:, 0], out[:, 1], out[:, 2] = key, place, value
    return out


def _induced(s: _Strings, seeds: np.ndarray, common: np.ndarray, cap: int, queue):
    """(places in order of suffix, group by group; common prefix with the one
    before), from seeds in order within each group."""
    order = np.argsort(s.symbols[seeds], kind="stable")
    seeds, common = seeds[order], common[order]
    at = np.searchsorted(s.symbols[seeds], np.arange(s.keys + 1)).tolist()
    large, ahead = queue(s.keys), queue(s.keys)
    reader = _Reader(s, cap)
    for key in range(s.keys):
        while (rows := ahead.pop(key)) is not None:
            place, _, rank, value = reader.read(key, rows[:, 1], rows[:, 2].astype(np.int64), None)
            large.push(_rows(key, place, value))
            ahead.push(reader.before(place, rank, False))
        a, b = at[key], at[key + 1]
        if a < b:
            place, _, rank, _ = reader.read(key, seeds[a:b], None, common[a:b])
            ahead.push(reader.before(place, rank, False))
    ahead.close()
    n = len(s.symbols)
    out, prefix = np.zeros(n, np.int32), np.zeros(n + 1, np.uint8)
    back, reader = queue(s.keys), _Reader(s, cap)

    def put(place, group, rank, value):
        where = s.end[group] - 1 - rank
        out[where] = place
        later = rank > 0
        prefix[where[later] + 1] = value[later]

    for key in range(s.keys - 1, 0, -1):
        while (rows := back.pop(key)) is not None:
            place, group, rank, value = reader.read(key, rows[:, 1], rows[:, 2].astype(np.int64), None)
            put(place, group, rank, value)
            back.push(reader.before(place, rank, True))
        if (rows := large.pop(key)) is not None:
            rows = rows[::-1]
            known = np.empty(len(rows), np.uint8)           # what the greater one shares with this one
            grouped = np.argsort(s.group[rows[:, 1]], kind="stable")
            rows = rows[grouped]
            known[1:], known[0] = rows[:-1, 2], 0
            place, group, rank, value = reader.read(key, rows[:, 1], None, known)
            put(place, group, rank, value)
            back.push(reader.before(place, rank, True))
    back.close()
    large.close()
    ends = np.flatnonzero(s.symbols == 0)[::-1]
    put(*reader.read(0, ends, None, np.zeros(len(ends), np.uint8)))
    return out, prefix[:n]


def _named(s: _Strings, seeds: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the seeds in order of the stretches that begin there, group by
    group; whether each stretch equals the one before).  Symbols of one kind and of
    two types sort L before S, so no stretch is the beginning of another."""
    code = s.symbols.astype(np.int64) * 2 + s.small
    bits = (2 * s.keys).bit_length()
    per = 63 // bits

    def packed(at, left):
        out = np.zeros(len(at), np.int64)
        for k in range(per):
            out = out << bits | np.where(left > k, code[np.minimum(at + k, len(code) - 1)], 0)
        return out

    key = packed(seeds, length)
    order = np.lexsort((key, s.group[seeds]))
    new = np.ones(len(order), bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (s.group[seeds[order[1:]]] != s.group[seeds[order[:-1]]])
    done = per
    while True:
        kind = np.cumsum(new) - 1
        open_ = np.flatnonzero((np.bincount(kind)[kind] > 1) & (length[order] > done))
        if not len(open_):
            return order, ~new
        own = order[open_]
        key = packed(seeds[own] + done, length[own] - done)
        place = np.lexsort((key, kind[open_]))
        order[open_], key = own[place], key[place]
        new[open_[1:]] |= key[1:] != key[:-1]
        done += per


def _doubled(names: np.ndarray, group: np.ndarray, base: np.ndarray, cap: int, queue):
    """``sort_suffixes`` by ranks of 1, 2, 4, ... symbols."""
    n = len(names)
    here = np.arange(n)
    ends = np.flatnonzero(names == 0)
    stop = ends[np.searchsorted(ends, here)]

    def ranks(order, differs):
        out = np.empty(n, np.int64)
        out[order] = np.concatenate(([0], np.cumsum(differs)))
        return out

    order = np.lexsort((names, group))
    levels = [ranks(order, (names[order[1:]] != names[order[:-1]]) | (group[order[1:]] != group[order[:-1]]))]
    reach = 1
    while reach < cap:
        last = levels[-1]
        key = last * (n + 1) + np.where(here + reach <= stop, last[np.minimum(here + reach, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        levels.append(ranks(order, key[order[1:]] != key[order[:-1]]))
        reach *= 2
        if levels[-1].max() == last.max():
            break
    order = np.argsort(levels[-1], kind="stable")
    first, second = order[:-1], order[1:]
    shared = np.zeros(n - 1, np.int64)
    for k in reversed(range(len(levels))):
        equal = levels[k][np.minimum(first + shared, stop[first])] == levels[k][np.minimum(second + shared, stop[second])]
        shared += equal << k
    shared = np.minimum(np.minimum(shared, cap), np.minimum(stop[first] - first, stop[second] - second))
    shared[group[first] != group[second]] = 0
    return order, np.concatenate(([0], shared))


def sort_suffixes(symbols: np.ndarray, group: np.ndarray, base: np.ndarray, cap: int, queue, names_at_once: int = NAMES):
    """(places, common): the places of all suffixes in order of their first
    ``cap`` symbols, group by group, and the symbols that each shares with the one
    before it in its group (up to ``cap``).  Strings of a group lie together from ``base`` on, each ended by 0;
    ``queue(keys)`` makes a queue."""
    s = _Strings(symbols, group, base)
    seeds = np.flatnonzero(s.seed)
    stretch = np.append(np.diff(seeds), 0) + 1              # up to and with the next seed
    stretch[symbols[seeds] == 0] = 1
    own, same = _named(s, seeds, stretch)
    ranked = seeds[own]
    new_group = np.ones(len(ranked), bool)
    new_group[1:] = group[ranked[1:]] != group[ranked[:-1]]
    shared = np.zeros(len(ranked), np.int64)                # names in common with the seed before
    tied = np.unique(group[ranked[same & (symbols[ranked] != 0)]])
    if len(tied):
        name = np.cumsum(~same) - 1
        size = np.diff(np.append(np.flatnonzero(new_group), len(ranked)))
        name -= np.repeat(name[new_group], size)
        names = np.empty(len(seeds), np.int32)
        names[own] = name
        most = np.zeros(len(base), np.int64)
        np.maximum.at(most, group[ranked], name)
        for some, sort in ((tied[most[tied] < names_at_once], sort_suffixes), (tied[most[tied] >= names_at_once], _doubled)):
            wanted = np.zeros(len(base), bool)
            wanted[some] = True
            at = np.flatnonzero(wanted[group[seeds]])
            if len(at):
                number = (np.cumsum(wanted) - 1)[group[seeds[at]]]
                starts = np.flatnonzero(np.diff(number, prepend=-1))
                places, shared[at] = sort(names[at], number, starts, cap, queue)
                own[at] = at[places]
        ranked = seeds[own]
    known = seeds[own + shared] - ranked                    # symbols that a seed is known to share
    first, second = ranked[:-1] + known[1:], ranked[1:] + known[1:]
    room = np.where(new_group[1:] | (known[1:] >= cap), 0, cap - known[1:])
    # a string's end differs from any other's
    room[(symbols[first] == 0) | (symbols[second] == 0)] = 0
    common = np.zeros(len(ranked), np.int64)
    common[1:] = np.minimum(known[1:] + _matching(symbols, first, second, room), cap)
    common[new_group] = 0
    return _induced(s, ranked, common.astype(np.uint8), cap, queue)


def _matching(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Equal symbols from a and b on, before either string ends, at most ``room``."""
    shared = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(room > 0)
    while len(open_):
        k = shared[open_]
        left = symbols[a[open_] + k]
        open_ = open_[(left == symbols[b[open_] + k]) & (left != 0)]
        shared[open_] += 1
        open_ = open_[shared[open_] < room[open_]]
    return shared
