"""Near-duplicate classes: consistent weighted sampling, bands, verification.

Texts become bags of shingles of five lower-cased words (A-Z only), weighted by
count times a damped inverse document frequency: 1 for a shingle that every
document holds, 2 for one that less than ``RARE`` of them hold.  Document
frequencies are counted over all documents by a count-min sketch of ``DEPTH`` rows
of ``SLOTS`` slots, so the table that is broadcast has a fixed size.  A count is
never too low; with d distinct shingles a document on average it is too high by
more than e * d / SLOTS of the documents for at most e^-DEPTH of the shingles: by
0.13% for 5% at d = 500.  That is below ``RARE``, so a weight depends on the share
of documents, whatever their number.  Improved consistent weighted sampling draws
``bands * rows`` samples from each bag; two texts agree on a sample with the
probability of their weighted Jaccard similarity.  Equal bands make candidates.

1. Equal texts collapse to one unit by their digest.
2. Units that share a band are linked to the band's least unit, which bounds
   the candidate links by the number of band rows; components of these links
   are the groups inside which similarity is looked at.
3. Texts meet once per group.  There, units that share a band are compared
   exactly, most shared bands first, until their classes are one; the weighted
   Jaccard similarity must reach ``threshold``.
4. Components of the verified links are the classes.

A group whose texts exceed ``BLOCK_BYTES`` is dealt to several tasks, each with
the group's first ``HUBS`` units beside its own; then the band mates whose
classes still differ meet in the buckets of their bands, large buckets two
bounded parts at a time.  No pair of band mates is left out, no task holds an
unbounded group and nothing is capped.  The parts of a large bucket grow the
number of its tasks as they grow the pairs: with the square, beside its main
class linearly.

Defined results: a text without words is in no class but its own row's; a text
of fewer than five words is one shingle; repeated rows are exact copies; ids
may be null (a null id names a class only if all its ids are null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .common import broadcast_value, one_per_key, packed, row_key, rows_as_structs, stored, unpacked
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
#: P(candidate) = 1 - (1 - s**3)**10: 0.9992 at s = 0.8, 0.01 at s = 0.1.
BANDS, ROWS = 10, 3
#: Count-min sketch of document frequencies, and the slots that travel as one row.
DEPTH, SLOT_BITS, SLOT_BLOCK = 3, 20, 1 << 14
SLOTS = 1 << SLOT_BITS
#: Share of the documents below which a shingle's weight no longer grows.
RARE = 1.0 / 256
BLOCK_BYTES = 6 << 20
#: Bytes of text up to which small keys are compared in one go.
GATHER_BYTES = 1 << 20
HUBS = 64
_U = np.uint64


def bags(words: ts.Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count), sorted by row and shingle, of a piece of texts."""
    at, grams = words.grams(n)
    rows = words.row[at]
    per_row = words.counts()
    short = np.flatnonzero((per_row > 0) & (per_row < n))
    if len(short):
        whole = np.ones(len(short), dtype=np.uint64)
        for j in range(n - 1):                       # words of texts below n words
            has = np.flatnonzero(per_row[short] > j)
            whole[has] = ts.mix(whole[has] * _U(31) + words.hash[words.first[short[has]] + j])
        rows, grams = np.concatenate((rows, short)), np.concatenate((grams, whole))
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(new)
    return rows[at], grams[at], np.diff(np.append(at, len(rows)))


def bag_pieces(texts) -> Iterator[tuple[int, int, ts.Words, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(lo, hi, words, bags) of rows ``lo:hi``, a small piece of the texts at a time."""
    for lo, hi, words in ts.word_batches(texts, ts.SPACE, lower=True, limit=ts.SMALL_PIECE_BYTES):
        yield lo, hi, words, bags(words)


def _slots(gram: np.ndarray) -> list[np.ndarray]:
    """Slot of each shingle in each row of the sketch: other bits of its hash."""
    return [(gram >> _U(64 - (k + 1) * SLOT_BITS) & _U(SLOTS - 1)).astype(np.int64) for k in range(DEPTH)]


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weight of the shingles of each slot (rows of the sketch x slots)."""
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def rows_of(total, rows):
        parts = [packed(p) for p in total.reshape(-1, SLOT_BLOCK)] + [packed(np.array([rows]))]
        return pa.RecordBatch.from_arrays([pa.array([*range(len(parts) - 1), -1], pa.int32()), pa.array(parts, pa.binary())], names=["block", "counts"])

    def count(batches):
        total, rows = np.zeros((DEPTH, SLOTS), dtype=np.int64), 0
        for batch in batches:
            for _, _, _, (_, gram, _) in bag_pieces(batch.column(0)):
                for k, slot in enumerate(_slots(gram)):
                    total[k] += np.bincount(slot, minlength=SLOTS)
            rows += batch.num_rows
        yield rows_of(total, rows)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = SLOT_BLOCK if block >= 0 else 1
                sums[block] = sums.get(block, 0) + unpacked(raw, n)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([packed(x) for x in sums.values()], pa.binary())], names=schema.names)

    total, n_docs = np.zeros((DEPTH, SLOTS), dtype=np.int64), 0
    # a fixed number of rows: DEPTH * SLOTS / SLOT_BLOCK + 1
    for block, raw in docs.select(text).mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        if block < 0:
            n_docs = int(unpacked(raw, 1)[0])
        else:
            total.reshape(-1, SLOT_BLOCK)[block] = unpacked(raw, SLOT_BLOCK)
    share = np.clip(total / max(1, n_docs), RARE, 1.0)
    return (1.0 + np.log(share) / np.log(RARE)).astype(np.float32)


def weights(gram: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Count times the weight by the least of a shingle's counts in the sketch."""
    best = np.zeros(len(gram), np.float32)
    for k, slot in enumerate(_slots(gram)):
        np.maximum(best, idf[k][slot], out=best)
    return count.astype(np.float32) * best


def _unit(bits: np.ndarray, width: int) -> np.ndarray:
    return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -width)


def signatures(row: np.ndarray, gram: np.ndarray, weight: np.ndarray, n_rows: int,
               bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band hashes (n_rows x bands) by improved consistent weighted sampling;
    0 throughout for a row without shingles."""
    out = np.zeros((n_rows, bands), dtype=np.uint64)
    if not len(row):
        return out
    begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    size = np.diff(np.append(begin, len(row)))
    own = row[begin]
    log_w = np.log(weight)
    for b in range(bands):
        acc = np.full(len(own), b + 1, dtype=np.uint64)
        for k in range(rows):
            seed = ts.mix(np.array([(b * rows + k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1], dtype=np.uint64))[0]
            x = ts.mix(gram ^ seed)
            y = x * _U(0xD6E8FEB86659FD93)
            y ^= y >> _U(32)
            r = -np.log(_unit(x & _U(0xFFFFF), 20) * _unit(x >> _U(20) & _U(0xFFFFF), 20))
            beta = _unit(x >> _U(40), 24)
            log_c = np.log(-np.log(_unit(y & _U(0xFFFFFF), 24) * _unit(y >> _U(40), 24)))
            t = np.floor(log_w / r + beta)
            log_a = log_c - r * (t - beta) - r
            least = np.minimum.reduceat(log_a, begin)
            hits = np.flatnonzero(log_a == np.repeat(least, size))
            first = hits[np.searchsorted(hits, begin)]
            acc = ts.mix(acc * _U(3) + gram[first] + t[first].astype(np.int64).view(np.uint64))
        out[own, b] = acc
    return out


class Bags:
    """Bags of one block as rows of shingle copies: a shingle that counts c
    times is c copies of its inverse document frequency, so the common weight
    of two bags is a sum over the copies that both have."""

    def __init__(self, texts, idf: np.ndarray):
        rows, grams, counts, done = [], [], [], 0
        for lo, hi, _, (row, gram, count) in bag_pieces(texts):
            rows.append(row + lo)
            grams.append(gram)
            counts.append(count)
            done = hi
        row, gram, count = np.concatenate(rows), np.concatenate(grams), np.concatenate(counts)
        del rows, grams, counts                      # large arrays go as soon as they are used
        at = np.repeat(np.arange(len(gram)), count)
        self.weight = weights(gram, np.ones(len(gram), np.float32), idf)[at]
        row = row[at]
        self.first = np.searchsorted(row, np.arange(done + 1))
        self.mass = np.bincount(row, weights=self.weight, minlength=done)
        del row
        copy = np.unique(gram, return_inverse=True)[1][at] * (int(count.max(initial=0)) + 1)
        del gram, at
        copy += np.arange(len(copy)) - np.repeat(np.cumsum(count) - count, count)
        del count
        ids, self.column = np.unique(copy, return_inverse=True)
        self.marked = np.zeros(len(ids))

    def similarities(self, i: int, others: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of bag i with each of the others."""
        own = slice(self.first[i], self.first[i + 1])
        self.marked[self.column[own]] = self.weight[own]
        common = np.empty(len(others))
        for lo in range(0, len(others), 2_000):
            part = others[lo:lo + 2_000]
            size = self.first[part + 1] - self.first[part]
            begin = np.cumsum(size) - size
            at = np.arange(int(size.sum())) + np.repeat(self.first[part] - begin, size)
            common[lo:lo + 2_000] = np.add.reduceat(self.marked[self.column[at]], begin)
        self.marked[self.column[own]] = 0
        return common / (self.mass[i] + self.mass[others] - common)


def _signed(docs: DataFrame, idf, doc_id: str, text: str) -> DataFrame:
    """(id, rk, unit, size, bands): one row per document; bands is null where
    the text has no words."""
    schema = T.StructType([
        T.StructField("id", docs.schema[doc_id].dataType), T.StructField("rk", T.LongType()),
        T.StructField("unit", T.BinaryType()), T.StructField("size", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        table = idf.value
        for batch in batches:
            found = []
            for lo, hi, words, (row, gram, count) in bag_pieces(batch.column(4)):
                sig = signatures(row, gram, weights(gram, count, table), hi - lo).view(np.int64)
                has = words.counts() > 0
                found += [s if h else None for s, h in zip(sig.tolist(), has.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(4)] + [pa.array(found, pa.list_(pa.int64()))],
                names=["id", "rk", "unit", "size", "bands"])

    named = docs.select(F.col(doc_id).alias("id"), row_key(doc_id, text).alias("rk"),
                        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("unit"),
                        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("size"), F.col(text).alias("text"))
    return named.mapInArrow(run, schema)


def _candidate_links(units: DataFrame) -> DataFrame:
    rows = units.select("unit", F.posexplode("bands").alias("at", "hash"))
    heads = rows.groupBy("at", "hash").agg(F.min("unit").alias("head"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(heads, ["at", "hash"]).filter("unit != head").select(F.col("unit").alias("u"), F.col("head").alias("v"))


_LINK = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])


def _verify(rows: DataFrame, keys: list[str], idf, threshold: float) -> DataFrame:
    """Verified links among the rows of each key.  A row's ``label`` names its
    class so far; where ``at`` is a band (not -1), a pair is compared only under
    the first band that it shares.  Small keys are compared several at a time."""
    def run(batches):
        table, key, held, starts, n, size = idf.value, None, [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            upto = np.append(0, np.cumsum(pc.binary_length(batch.column(len(keys) + 6)).to_numpy()))
            lo = 0
            for i, now in enumerate(zip(*(batch.column(k).to_pylist() for k in range(len(keys))))):
                if now != key:
                    if size + upto[i] - upto[lo] >= GATHER_BYTES:
                        yield _block_links([*held, batch.slice(lo, i - lo)], len(keys), starts, table, threshold)
                        held, starts, n, size, lo = [], [], 0, 0, i
                    starts.append(n + i - lo)
                    key = now
            held.append(batch.slice(lo))
            n += batch.num_rows - lo
            size += upto[-1] - upto[lo]
        if held:
            yield _block_links(held, len(keys), starts, table, threshold)

    dealt = rows.select(*keys, "unit", "bands", "label", "at", "part", "apart", "text")
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "unit").mapInArrow(run, _LINK)


def _block_links(held: list[pa.RecordBatch], at_column: int, starts: list[int], idf: np.ndarray, threshold: float) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held)
    names, bands, labels, at, part_of, apart, texts = (rows.column(at_column + k) for k in range(7))
    names, at, part_of, apart = names.to_pylist(), at.to_numpy(), part_of.to_numpy(), apart.to_numpy()
    n = len(names)
    begin = np.repeat(starts, np.diff(np.append(starts, n)))
    band = np.array(bands.to_pylist(), dtype=np.int64).reshape(n, -1)
    own = Bags(texts, idf)
    mass = own.mass
    number: dict[bytes, int] = {}
    label = np.array([number.setdefault(x, len(number)) for x in labels.to_pylist()])
    u, v = [], []
    for i in range(1, n):
        b = int(begin[i])
        if b == i:
            continue
        shared = band[b:i] == band[i]
        near = shared.sum(axis=1)
        near[np.minimum(mass[b:i], mass[i]) < threshold * np.maximum(mass[b:i], mass[i])] = 0
        near[label[b:i] == label[i]] = 0
        if at[i] >= 0:
            near[shared.argmax(axis=1) != at[i]] = 0
        if apart[i]:
            near[part_of[b:i] == part_of[i]] = 0
        order = b + np.argsort(-near, kind="stable")[:int((near > 0).sum())]
        for part in (order[:8], order[8:]):          # most shared bands first
            part = part[label[part] != label[i]]
            for j in part[own.similarities(i, part) >= threshold] if len(part) else ():
                if label[j] != label[i]:
                    u.append(names[i])
                    v.append(names[j])
                    label[label == label[i]] = label[j]
    return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
            block_bytes: int = BLOCK_BYTES, hubs: int = HUBS) -> DataFrame:
    """(id, rk, class_id, class_size, first): one row per document.  ``class_id``
    is the least id of the class and ``first`` marks the row that has it."""
    spark = docs.sparkSession
    idf = broadcast_value(spark, document_frequencies(docs, text))
    signed = stored(_signed(docs, idf, doc_id, text), "signatures")
    units = signed.filter("bands is not null").groupBy("unit").agg(
        F.min("rk").alias("rk"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    groups = components(_candidate_links(units), "candidates", BANDS * signed.count()).withColumnRenamed("node", "unit")
    members = groups.join(units, "unit")
    blocks = (members.groupBy("component").agg(F.sum("size").alias("bytes"))
              .select("component", F.ceil(F.col("bytes") / block_bytes).cast("int").alias("blocks")))
    members = stored(members.join(blocks, "component"), "members")
    texts = one_per_key(docs.select(row_key(doc_id, text).alias("rk"), F.col(text).alias("text")))

    rank = F.row_number().over(Window.partitionBy("component").orderBy("unit"))
    hub = (members.filter("blocks > 1").select("component", "unit", rank.alias("k")).filter(F.col("k") <= hubs)
           .select("unit", F.lit(True).alias("hub")))
    own = F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int")
    dealt = (members.join(hub, "unit", "left")
             .withColumn("block", F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))))
             .withColumn("label", F.col("unit")).withColumn("at", F.lit(-1)).withColumn("part", F.lit(0)).withColumn("apart", F.lit(False)))
    links = stored(_verify(dealt.join(texts, "rk"), ["component", "block"], idf, threshold), "links")
    if members.filter("blocks > 1").limit(1).count():
        links = links.unionAll(stored(_across(members, links, texts, idf, threshold, block_bytes), "links"))

    merged = components(links, "classes", links.count()).withColumnRenamed("node", "unit")
    alone = F.when(F.col("bands").isNotNull(), F.col("unit"))
    named = signed.withColumn("unit", alone).join(merged, "unit", "left").select(
        "id", "rk", F.coalesce("component", "unit").alias("class"))
    best = named.filter("class is not null").groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull().alias("null"), "id", "rk")).alias("head"), F.count("*").alias("class_size"))
    full = named.join(best, "class", "left")
    return full.select(
        "id", "rk", F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        (F.col("class").isNull() | (F.col("head.rk") == F.col("rk"))).alias("first"))


def _across(members: DataFrame, links: DataFrame, texts: DataFrame, idf, threshold: float, block_bytes: int) -> DataFrame:
    """Links of dealt groups between the classes that their blocks left: every
    pair of band mates of different classes meets in the bucket of its first
    common band, a bucket over ``block_bytes`` two parts at a time."""
    label = components(links, "blocks", links.count()).withColumnRenamed("node", "unit").withColumnRenamed("component", "label")
    rows = stored(members.filter("blocks > 1").join(label, "unit", "left").select(
        "unit", "rk", "size", "bands", F.coalesce("label", "unit").alias("label")), "labels").select(
        "*", F.posexplode("bands").alias("at", "hash"))
    return _verify(_bucket_tasks(rows, block_bytes).join(texts, "rk"), ["at", "hash", "p", "q"], idf, threshold)


def _bucket_tasks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of the buckets (at, hash) that hold several classes, a copy for each
    task (p, q), p <= q, that compares parts p and q.  Parts have about half of
    ``block_bytes``.  The ``main`` class, the bucket's largest, has parts of its
    own, which meet only parts of other classes; a small bucket is one part."""
    half = block_bytes / 2
    sums = rows.groupBy("at", "hash", "label").agg(F.sum("size").alias("bytes"))
    mixed = (sums.groupBy("at", "hash").agg(F.count("*").alias("labels"), F.sum("bytes").alias("bytes"),
                                            F.max(F.struct("bytes", "label")).alias("most")).filter("labels > 1")
             .withColumn("parted", F.col("bytes") > block_bytes)
             .select("at", "hash", F.col("most.label").alias("main"),
                     F.when(F.col("parted"), F.ceil((F.col("bytes") - F.col("most.bytes")) / half)).otherwise(1).cast("int").alias("others"),
                     F.when(F.col("parted"), F.ceil(F.col("most.bytes") / half)).otherwise(0).cast("int").alias("mains")))
    turn = F.xxhash64("unit", "at")
    part = (F.when((F.col("mains") > 0) & (F.col("label") == F.col("main")), F.col("others") + F.pmod(turn, F.col("mains")))
            .otherwise(F.pmod(turn, F.col("others"))).cast("int"))
    last = F.when(F.col("part") < F.col("others"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    return (rows.join(mixed, ["at", "hash"]).withColumn("part", part)
            .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other"))
            .withColumn("apart", F.col("p") != F.col("q"))
            .select("at", "hash", "p", "q", "rk", "unit", "size", "bands", "label", "part", "apart"))


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs`` with one document of each class; texts
    without words all stay."""
    found = classes(docs, doc_id=doc_id, text=text, **options)
    keep = found.filter("first").groupBy("rk").agg(F.max(F.col("class_size") > 1).alias("copies"))
    rows = rows_as_structs(docs).withColumn("rk", F.xxhash64(F.col(f"row.{doc_id}"), F.col(f"row.{text}"))).join(keep, "rk")
    turn = F.row_number().over(Window.partitionBy("rk").orderBy("rk"))
    return rows.withColumn("turn", turn).filter((F.col("turn") == 1) | ~F.col("copies")).select("row.*")
