"""Alignment of two public tokenizers over a corpus of distinct texts.

A is a byte-level BPE, B a piece BPE with byte fallback that leads its input with
a space; both are held against space + text.  Their tokens are byte ranges of the
same string.  Offsets where tokens of both end cut them into groups; every A-B
pair of token occurrences whose ranges overlap is a link.

1. Documents are shuffled by their full text and each distinct text is tokenised
   and aligned once, with its multiplicity; the result is stored.
2. A pair's count is the number of documents that hold it linked: pairs are
   gathered in the task, weighted by multiplicity, then summed by Spark.
3. Links return to the counts: links of a text travel as one packed row per
   bucket of A ids, together with the bucket's counts, and are read as a sorted
   stream, counts first.  Buckets are salted, so a task's share is bounded, and
   all pairs of an A id are in one bucket, which gives its highest count.
4. Measures are joined to the document ids by the 128-bit digest of the text.

No token of either vocabulary goes on past a single space between two other
characters that are not white space, so a text is the concatenation of such
segments.  Segments are tokenised and aligned once per task while they stay in
its bounded memory.

Defined results: texts that are null, empty, not valid UTF-8 or not spelled out by
both vocabularies have no tokens, measures of 0 and an empty ``groups_sha256``;
the strings of special tokens are plain text; equal texts get equal measures;
equal counts all are an A id's highest; a text of any length is aligned whole; an
empty table gives no rows; columns of the input stay inside ``row``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_value, packed, unpacked, workspace
from .packing import read_ranks

#: Segments that a task remembers, and texts (in characters) that it aligns at once.
CACHE_SEGMENTS = 400_000
PIECE_CHARS = 2 << 20
#: Characters of segments that are tokenised in one go.
CHUNK_CHARS = 100_000
#: Groups of A ids between which links are dealt, and bytes of links to one task.
BUCKETS = 8
TASK_BYTES = 16 << 20
#: Distinct pairs that a task gathers before it passes them on.
PAIRS = 2_000_000
#: A single space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_SPACE_MARK = "▁"


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and whether segments may be
    tokenised apart."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, model: bytes):
        import sentencepiece
        import tiktoken
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size_b = self.b.get_piece_size()
        spelled = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in enumerate(spelled)]
        self.length_b = np.array([len(p) for p in self.bytes_b], dtype=np.int64)
        self.length_a = np.zeros(1 + max(ranks.values(), default=0), dtype=np.int64)
        for token, i in ranks.items():
            self.length_a[i] = len(token)
        self.apart = not any(p[i] != _SPACE_MARK and p[i + 1] == _SPACE_MARK for p in spelled for i in range(len(p) - 1))
        self.code = np.uint32 if (len(self.length_a)) * self.size_b < 1 << 32 else np.uint64

    def segments(self, text: str) -> list[str]:
        """Parts of space + text that both vocabularies spell independently, each
        with the space it begins with."""
        if not self.apart:
            return [" " + text]
        first, *rest = _CUT.split(" " + text)
        return [first, *[" " + s for s in rest]]


def _runs(segments: list[str]) -> tuple[list[list[str]], list[list[str]]]:
    """Segments to tokenise in one go, as they would stand side by side in a text,
    and those that must stay alone: with white space at an end."""
    runs, alone, size = [], [], CHUNK_CHARS
    for s in segments:
        if s[1:2].isspace() or s[-1:].isspace():
            alone.append([s])
            continue
        if size >= CHUNK_CHARS:
            runs.append([])
            size = 0
        runs[-1].append(s)
        size += len(s)
    return runs, alone


def _tokens(v: Vocabularies, run: list[str]):
    """(A ids, B ids) of a run of segments, or None if B does not spell it."""
    text = "".join(run)
    b = v.b.encode(text[1:])
    return (v.a.encode_ordinary(text), b) if b"".join([v.bytes_b[i] for i in b]) == text.encode() else None


def align(v: Vocabularies, segments: list[str]):
    """The segments in the order of the results; of each whether both spell it,
    (n_a, n_b, n_groups, n_links) and the groups as text; and the codes of all
    links in order of segment."""
    order, ok, a, b, size = [], [], [], [], []
    runs, alone = _runs(segments)
    for run in [*runs, *alone]:
        got = _tokens(v, run)
        for part, found in [(run, got)] if got or len(run) == 1 else [([s], _tokens(v, [s])) for s in run]:
            order += part
            ok += [found is not None] * len(part)
            size += [len(s.encode()) if found else 0 for s in part]
            if found:
                a += found[0]
                b += found[1]
    a, b, n = np.array(a, np.int64), np.array(b, np.int64), len(order)
    ends = np.cumsum(size)
    ends_a, ends_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    every = np.union1d(ends_a, ends_b)                      # a link ends where either of its tokens ends
    codes = (a[np.searchsorted(ends_a, every)] * v.size_b + b[np.searchsorted(ends_b, every)]).astype(v.code)
    counted = [np.diff(np.searchsorted(x, ends, side="right"), prepend=0) for x in (ends_a, ends_b, both, every)]
    # groups as text: A's ids, then B's, each with the mark that follows it
    group = np.concatenate((np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)))
    side = np.repeat([0, 1], [len(a), len(b)])
    place = np.lexsort((side, group))
    group, side = group[place], side[place]
    mark = np.full(len(place), 2)
    mark[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] - side[:-1])
    at = np.cumsum(counted[0] + counted[1])
    mark[at[at > 0] - 1] = 3
    parts = [i + m for i, m in zip(map(str, np.concatenate((a, b))[place].tolist()), [",|;"[k:k + 1] for k in mark.tolist()])]
    listed = ["".join(parts[i:j]).encode() for i, j in zip([0, *at[:-1].tolist()], at.tolist())]
    return order, np.array(ok, bool), np.stack(counted).reshape(4, n), listed, codes


class Aligner:
    """Aligns texts by their segments, which it remembers."""

    def __init__(self, v: Vocabularies, remember: int = CACHE_SEGMENTS):
        self.v, self.remember = v, remember
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.ok, self.sizes = np.zeros(0, bool), np.zeros((4, 0), np.int64)
        self.codes, self.first = np.zeros(0, self.v.code), np.zeros(1, np.int64)
        self.listed: list[bytes] = []

    def _learn(self, parts: list[list[str]]) -> None:
        if len(self.number) > self.remember:
            self._forget()
        known = self.number
        new = {s: None for own in parts for s in own if s not in known}
        if new:
            order, ok, sizes, listed, codes = align(self.v, list(new))
            known.update(zip(order, range(len(known), len(known) + len(order))))
            self.ok, self.sizes = np.concatenate((self.ok, ok)), np.concatenate((self.sizes, sizes), axis=1)
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes[3])))
            self.codes = np.concatenate((self.codes, codes))
            self.listed += listed

    def texts(self, texts: list[str]):
        """Of each text: measures (4 x texts), digest of its groups; and its
        distinct links as (text, code, uses)."""
        parts = [self.v.segments(t) for t in texts]
        self._learn(parts)
        known, n = self.number, len(texts)
        row = np.repeat(np.arange(n), [len(p) for p in parts])
        own = np.fromiter((known[s] for p in parts for s in p), dtype=np.int64, count=len(row))
        whole = np.bincount(row, weights=~self.ok[own], minlength=n) == 0
        row, own = row[whole[row]], own[whole[row]]
        measures = np.stack([np.bincount(row, weights=m[own], minlength=n).astype(np.int64) for m in self.sizes])
        digest = [hashlib.sha256(b";".join([self.listed[known[s]] for s in p])).hexdigest() if k else "" for p, k in zip(parts, whole)]
        # a segment that a text repeats is opened once
        pair, times = np.unique(row << 32 | own, return_counts=True)
        row, own = pair >> 32, pair & 0xFFFFFFFF
        size = self.sizes[3][own]
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[own] - begin, size)
        text, code, uses = np.repeat(row, size), self.codes[at].astype(np.uint64), np.repeat(times, size)
        order = np.lexsort((code, text)) if self.v.code is np.uint64 else np.argsort(text.astype(np.uint64) << np.uint64(32) | code, kind="stable")
        text, code, uses = text[order], code[order], uses[order]
        new = np.ones(len(text), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
        starts = np.flatnonzero(new)
        return measures, digest, (text[starts], code[starts], np.add.reduceat(uses, starts) if len(starts) else uses)


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


_ALIGNED = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType()), *(T.StructField(c, T.LongType()) for c in MEASURES),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("links", T.ArrayType(T.StructType([
        T.StructField("bucket", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("codes", T.BinaryType()),
        T.StructField("uses", T.BinaryType())])))])


def _pieces(texts: list[bytes]):
    """Bounded index ranges of texts."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _decoded(raw: bytes) -> str | None:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def align_distinct(texts: DataFrame, vocabularies, buckets: int) -> DataFrame:
    """One row per (key, text, n): measures, digest of the groups, and the
    distinct links packed by bucket of A ids."""
    link = pa.struct([("bucket", pa.int32()), ("size", pa.int32()), ("codes", pa.binary()), ("uses", pa.binary())])

    def run(batches):
        v = Vocabularies(*vocabularies.value)
        aligner, item = Aligner(v), np.dtype(v.code).itemsize
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary()).to_pylist()
            for lo, hi in _pieces(raw):
                texts = [_decoded(t) for t in raw[lo:hi]]
                good = [i for i, t in enumerate(texts) if t]
                some, digest, (text, code, uses) = aligner.texts([texts[i] for i in good])
                measures = np.zeros((4, hi - lo), np.int64)
                measures[:, good] = some
                bucket = bucket_of(code // np.uint64(v.size_b), buckets)
                order = np.lexsort((bucket, text))
                text, code, uses, bucket = text[order], code[order].astype(v.code), uses[order], bucket[order]
                edges = np.flatnonzero(np.diff(text * buckets + bucket, prepend=-1, append=-1))
                data = code.tobytes()
                links: list[list] = [[] for _ in range(hi - lo)]
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    links[good[text[a]]].append({"bucket": int(bucket[a]), "size": b - a, "codes": data[item * a:item * b], "uses": packed(uses[a:b])})
                named = dict(zip(good, digest))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), *(pa.array(m) for m in measures),
                    pa.array([named.get(i, "") for i in range(hi - lo)], pa.string()), pa.array(links, pa.list_(link))], names=_ALIGNED.names)

    return texts.select("key", "text", "n").mapInArrow(run, _ALIGNED)


def _merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    new = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1)) if len(codes) else np.zeros(0, np.int64)
    return codes[new], np.add.reduceat(counts, new) if len(new) else counts


def pair_counts(links: DataFrame) -> DataFrame:
    """(code, n): documents that hold each pair linked, from (n, size, codes)."""
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        held, size = [], 0

        def out():
            codes, counts = _merged(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            return codes, counts

        for batch in batches:
            n, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = [unpacked(raw, k) for raw, k in zip(batch.column(2).to_pylist(), sizes.tolist())]
            if own:
                held.append(_merged(np.concatenate(own), np.repeat(n, sizes)))
                size += len(held[-1][0])
            if size > PAIRS:
                held = [out()]
                size = len(held[0][0])
                if size > PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=schema.names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out()], names=schema.names)

    return links.select("n", "size", "codes").mapInArrow(run, schema).groupBy("code").agg(F.sum("n").alias("n"))


_PACKED = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("size", T.IntegerType()),
                        T.StructField("codes", T.BinaryType()), T.StructField("uses", T.BinaryType())])


def _pack_counts(counts: DataFrame, size_b: int, buckets: int) -> DataFrame:
    """Counts as packed rows (bucket, size, codes, uses: counts)."""
    def run(batches):
        for batch in batches:
            codes, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bucket = bucket_of(codes // size_b, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            parts = [order[a:b] for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array([int(bucket[p[0]]) for p in parts], pa.int32()), pa.array([len(p) for p in parts], pa.int32()),
                pa.array([packed(codes[p], (np.uint64,)) for p in parts], pa.binary()), pa.array([packed(n[p]) for p in parts], pa.binary())],
                names=_PACKED.names)

    return counts.mapInArrow(run, _PACKED)


def _looked_up(links: DataFrame, counts: DataFrame, size_b: int, salts: int, buckets: int) -> DataFrame:
    """(key, n_best, count_sum) partial sums of each text and bucket."""
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    names = ["bucket", "salt", "key", "size", "codes", "uses"]
    own = links.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).select(names)
    all_salts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("key", F.lit(None).cast("binary")).select(names)

    def run(batches):
        at, held, table = None, [], None
        for batch in batches:
            place = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            keys, sizes = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            codes, uses = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            i = 0
            while i < len(place):
                if place[i] != at:
                    at, held, table = place[i], [], None
                j = i
                while j < len(place) and place[j] == at and (keys[j] is None) == (keys[i] is None):
                    j += 1
                got = (np.concatenate([unpacked(c, k) for c, k in zip(codes[i:j], sizes[i:j])]),
                       np.concatenate([unpacked(u, k) for u, k in zip(uses[i:j], sizes[i:j])]))
                if keys[i] is None:
                    held.append(got)
                else:
                    if table is None:
                        code, n = _merged(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                        first = np.flatnonzero(np.diff(code // size_b, prepend=-1))
                        top = np.repeat(np.maximum.reduceat(n, first), np.diff(first, append=len(n)))
                        table, held = (code, n, n == top), []
                    code, n, best = table
                    where = np.searchsorted(code, got[0])
                    starts = np.cumsum([0] + sizes[i:j - 1])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[i:j], pa.binary()), pa.array(np.add.reduceat(np.where(best[where], got[1], 0), starts)),
                        pa.array(np.add.reduceat(n[where] * got[1], starts))], names=schema.names)
                i = j

    dealt = own.unionByName(all_salts).repartition(salts * buckets, "bucket", "salt")
    return dealt.sortWithinPartitions("bucket", "salt", F.col("key").isNotNull()).mapInArrow(run, schema)


def align_corpus(docs: DataFrame, ranks_path: str, pattern: str, model_path: str, *, text: str = "text", buckets: int = BUCKETS,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every document; ``row`` has no text."""
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        shipped = broadcast_value(spark, (read_ranks(ranks_path), pattern, f.read()))
    size_b = Vocabularies(*shipped.value).size_b
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    distinct = (docs.select(F.col(text).alias("text")).filter(F.octet_length("text") > 0).groupBy("text").agg(F.count("*").alias("n"))
                .withColumn("key", digest))
    keep = workspace(spark, "alignment")
    aligned = keep.stored(align_distinct(distinct, shipped, buckets), "aligned")
    links = aligned.select("key", "n", F.explode("links").alias("l")).select("key", "n", "l.*")
    counts = keep.stored(_pack_counts(pair_counts(links), size_b, buckets), "counts")
    total = aligned.agg(F.sum(F.aggregate("links", F.lit(0).cast("long"), lambda s, l: s + l["size"] * 5))).first()[0] or 0
    salts = int(max(1, -(-total // (buckets * task_bytes))))
    sums = _looked_up(links.drop("n"), counts, size_b, salts, buckets).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = workspace(spark, "alignment-measures")
    measures = kept.stored(aligned.drop("n", "links").join(sums, "key", "left"), "measures")
    keep.remove()
    own = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("boolean").alias("_")]
    rows = docs.select(F.struct(*own).alias("row"), F.when(F.octet_length(F.col(text)) > 0, F.unhex(F.md5(F.col(text).cast("binary")))).alias("key"))
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    return rows.join(measures, "key", "left").select("row", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
