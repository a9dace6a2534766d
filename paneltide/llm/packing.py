"""Best-fit-decreasing packing of token sequences into fixed windows.

Texts are tokenised by a public byte-level BPE; the end id closes each
document.  Documents longer than a window are first cut into full windows.
The rest is placed longest first; a segment tree over remaining capacities
finds the tightest window that still takes a piece.  What lies in windows that
stayed short is then cut freely over as few windows as it needs, and the last,
shorter window is split at powers of two, where no padding is due.

Packing runs inside each input partition over blocks of ``BLOCK_TOKENS``
tokens, so nothing is shuffled and a task holds one block.  Sequence ids carry
the partition number in their upper bits; a retried task repeats its ids.

Defined results: null and empty texts give the end id alone; repeated rows are
packed separately; no input, no output.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import broadcast_value, field, rows_as_structs

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 4 << 20
_CACHE_SEGMENTS = 300_000
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of the byte-level BPE, with a cache over space-led segments.

    The vocabulary's pattern never joins what stands before a single space to
    the run after it, so a text is the concatenation of its segments' ids.
    Texts with longer white space or the special token go through whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int]):
        import tiktoken
        self.bpe = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.cache: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        return np.array(self.bpe.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if _SPECIAL in text:
            return np.frombuffer(self._raw(text), dtype="<u4")
        cache, parts = self.cache, text.split(" ")
        if len(cache) > _CACHE_SEGMENTS:
            cache.clear()
        out = []
        head, rest = parts[0], parts[1:]
        if head:
            out.append(self._raw(head))
        for part in rest:
            ids = cache.get(part)
            if ids is None:
                if not part or part[0].isspace():
                    return np.frombuffer(self._raw(text), dtype="<u4")
                ids = self._raw(" " + part)
                if len(part) < 64:
                    cache[part] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<u4")


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a byte-level BPE file (base64 token, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


class CapacityTree:
    """Segment tree over capacities 0..size: which have an open window."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        i = self.leaves + capacity
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity of ``need`` or more with an open window."""
        i = self.leaves + need
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_decreasing(sizes: list[int], window: int) -> list[list[int]]:
    """Windows as lists of indices into ``sizes`` (each 1..window)."""
    tree = CapacityTree(window)
    open_: dict[int, list[int]] = {}
    windows: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = tree.tightest(sizes[i])
        if room is None:
            windows.append([i])
            at, left = len(windows) - 1, window - sizes[i]
        else:
            at = open_[room].pop()
            tree.add(room, -1)
            windows[at].append(i)
            left = room - sizes[i]
        if left:
            open_.setdefault(left, []).append(at)
            tree.add(left, 1)
    return windows


def _power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


def pack_block(lengths: list[int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a block."""
    out, rest = [], []
    sequence = 0
    for d, n in enumerate(lengths):
        full = n // window
        for k in range(full):
            out.append((d, k * window, window, sequence, 0))
            sequence += 1
        if n % window:
            rest.append((d, full * window, n % window))
    short = []
    for members in best_fit_decreasing([p[2] for p in rest], window):
        used = sum(rest[m][2] for m in members)
        if used == window or _power_of_two(used):
            offset = 0
            for m in members:
                out.append((*rest[m], sequence, offset))
                offset += rest[m][2]
            sequence += 1
        else:
            short += [rest[m] for m in members]
    left = sum(p[2] for p in short)
    offset, room = 0, _next_room(left, window)
    for d, start, n in short:
        while n:
            take = min(n, room - offset)
            out.append((d, start, take, sequence, offset))
            start, n, offset, left = start + take, n - take, offset + take, left - take
            if offset == room:
                sequence, offset, room = sequence + 1, 0, _next_room(left, window)
    return out


def _next_room(left: int, window: int) -> int:
    """A full window while it can be filled, then the largest power of two."""
    return window if left >= window else 1 << (left.bit_length() - 1) if left else 0


def pack(docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, special: dict[str, int] | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents: (row, start, length, ids, doc_tokens,
    sequence_id, offset).  ``row`` is the document's row without its text and
    ``ids`` the piece's ids as little-endian unsigned 32-bit integers."""
    others = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([
        T.StructField("row", T.StructType(others)), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    vocabulary = broadcast_value(docs.sparkSession, (read_ranks(ranks_path), pattern, special or {_SPECIAL: 50256}))
    arrow = to_arrow_schema(schema)
    kept = [f.name for f in others]

    def run(batches):
        encoder = Encoder(*vocabulary.value)
        base, ids, rows, held = TaskContext.get().partitionId() << 36, [], [], 0

        def flush():
            nonlocal base, ids, rows, held
            pieces = pack_block([len(x) for x in ids], window)
            table = pa.concat_arrays(rows)
            pieces.sort(key=lambda p: (p[3], p[4]))
            for lo in range(0, len(pieces), 20_000):
                part = pieces[lo:lo + 20_000]
                binary = [ids[d][s:s + n].tobytes() for d, s, n, _, _ in part]
                yield pa.RecordBatch.from_arrays([
                    table.take(pa.array([p[0] for p in part], pa.int64())),
                    pa.array([p[1] for p in part], pa.int64()), pa.array([p[2] for p in part], pa.int64()),
                    pa.array(binary, pa.binary()), pa.array(map(zlib.crc32, binary), pa.int64()),
                    pa.array([len(ids[p[0]]) for p in part], pa.int64()),
                    pa.array([base + p[3] for p in part], pa.int64()), pa.array([p[4] for p in part], pa.int64())],
                    names=arrow.names)
            base += 1 + max((p[3] for p in pieces), default=-1)
            ids, rows, held = [], [], 0

        for batch in batches:
            texts = field(batch, text)
            own = pa.StructArray.from_arrays([field(batch, c) for c in kept], fields=list(arrow.field("row").type)) \
                if kept else pa.array([{}] * batch.num_rows, pa.struct([]))
            first = 0
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                got = encoder.encode(value) if value else np.zeros(0, "<u4")
                ids.append(np.append(got, np.array([end_id], "<u4")))
                held += len(got) + 1
                if held >= block_tokens:
                    rows.append(own.slice(first, i + 1 - first))
                    first = i + 1
                    yield from flush()
            if first < batch.num_rows:
                rows.append(own.slice(first))
        if ids:
            yield from flush()

    return rows_as_structs(docs).mapInArrow(run, schema)
