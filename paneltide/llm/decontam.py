"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are runs of digits, ASCII letters (A-Z lowered) and characters beyond
ASCII.  A window is ``n`` consecutive words of a benchmark item; an item with
fewer words, but not none, is one window.  Training texts are scanned in one
pass: a bitmap of window hashes finds candidates, each of which is compared
with the item's words before it counts.

Only the benchmark's distinct windows are broadcast, with a number each, in blocks
of at most ``block_bytes``; each block is applied to all documents, and where
there are several, the result is stored between them.  Which items a window
belongs to stays in Spark: a document's distinct window numbers are joined to
them, so neither the driver nor a task sees a window's list of items.  The scan
does not shuffle documents, and judging them needs no items.

Defined results: null or empty texts have no words and no hits; repeated rows
get a result each; equal items all count; an empty benchmark hits nothing; a
null item id is left out of item lists but its windows do hit; a document's
other columns travel in one struct, so their names clash with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textscan as ts
from .common import broadcast_value, field, rows_as_structs, workspace

#: Bytes of distinct windows in one broadcast, with what a window takes beside.
BLOCK_BYTES, WINDOW_BYTES = 32 << 20, 150
_BITS = 22


def normalised_words(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    low = ts.LOWER[raw]
    low = np.where(ts.NON_ALNUM[low], np.uint8(0x20), low)
    return low.tobytes().split()


def item_windows(benchmark: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """Distinct (window, item): the window's words joined by spaces."""
    schema = T.StructType([T.StructField("window", T.BinaryType()), T.StructField("item", benchmark.schema[item_id].dataType)])

    def windows(batches):
        for b in batches:
            found, items = [], []
            for text_, item in zip(b.column(1).to_pylist(), b.column(0).to_pylist()):
                words = normalised_words(text_)
                size = min(n, len(words))
                for i in range(len(words) - size + 1 if size else 0):
                    found.append(b" ".join(words[i:i + size]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array(items, b.schema.field(0).type)], ["window", "item"])

    return benchmark.select(item_id, text).mapInArrow(windows, schema).distinct()


class WindowSet:
    """One block of benchmark windows by their numbers, with their hashes by
    window length."""

    def __init__(self, rows):
        self.number: dict[bytes, int] = {bytes(window): number for window, number in rows}
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes: dict[int, list[bytes]] = {}
        for w in self.number:
            sizes.setdefault(w.count(b" ") + 1, []).append(w)
        for size, group in sizes.items():
            column = pa.array(group, pa.large_binary())
            hashes = np.concatenate([w.grams(size)[1] for _, _, w in ts.word_batches(column, ts.SPACE)])
            bitmap = np.zeros(1 << _BITS, dtype=bool)
            bitmap[hashes >> np.uint64(64 - _BITS)] = True
            self.by_size[size] = (np.unique(hashes), bitmap)

    def scan(self, words: ts.Words) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Hit mask over the words, and the window numbers of each row with hits."""
        hit = np.zeros(len(words), dtype=bool)
        found: dict[int, set[int]] = {}
        for size, (hashes, bitmap) in self.by_size.items():
            at, h = words.grams(size)
            near = np.flatnonzero(bitmap[h >> np.uint64(64 - _BITS)])
            near = near[np.isin(h[near], hashes)] if len(near) else near
            for i in at[near]:
                if (number := self.number.get(words.text(i, i + size))) is not None:
                    hit[i:i + size] = True
                    found.setdefault(int(words.row[i]), set()).add(number)
        return hit, found


def _number(window: str = "window"):
    return F.xxhash64(window)


def annotate(docs: DataFrame, benchmark: DataFrame, *, doc_text: str = "text", item_id: str = "item_id",
             item_text: str = "text", n: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_words, spans, windows): the document's row as a struct, its word
    count, hit word ranges ([start, end) pairs in one flat array) and the numbers
    of the windows that occur (``with_items`` names their items)."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, item_id, item_text, n).select("window").distinct()
    size = windows.agg(F.sum(F.octet_length("window") + F.lit(WINDOW_BYTES))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    schema = T.StructType([
        T.StructField("row", docs.schema), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("windows", T.ArrayType(T.LongType()))])
    result, before = rows_as_structs(docs), None
    for k in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("window", F.lit(1)), F.lit(blocks)) == k).select("window", _number())
        shipped = broadcast_value(spark, WindowSet([tuple(r) for r in part.collect()]))
        result = result.mapInArrow(_scanner(shipped, doc_text, to_arrow_schema(schema)), schema)
        if blocks > 1:                     # one block's windows are in memory at a time
            keep = workspace(spark, "decontamination")
            result = keep.stored(result, "scanned")
            shipped.destroy()
            if before is not None:
                before.remove()
            before = keep
    return result


def _scanner(shipped, doc_text, out):
    def run(batches):
        windows = shipped.value
        for batch in batches:
            n = batch.num_rows
            counts, spans, found = np.zeros(n, dtype=np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
            for lo, hi, words in ts.word_batches(field(batch, doc_text), ts.NON_ALNUM, lower=True):
                counts[lo:hi] = words.counts()
                hit, numbers = windows.scan(words)
                for r, own in numbers.items():
                    mask = hit[words.first[r]:words.first[r + 1]]
                    spans[lo + r] = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist()
                    found[lo + r] = sorted(own)
            if batch.num_columns > 1:          # merge with what earlier blocks found
                spans = [_merge(a, b) for a, b in zip(spans, batch.column(2).to_pylist())]
                found = [a + b for a, b in zip(found, batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(spans, out.field(2).type), pa.array(found, out.field(3).type)], names=out.names)
    return run


def with_items(found: DataFrame, benchmark: DataFrame, *, item_id: str = "item_id", item_text: str = "text", n: int = 13) -> DataFrame:
    """``found`` with ``items``, the sorted ids of the items whose windows occur, in
    place of ``windows``.  Rows with the same windows share one key; the others
    have keys of their own."""
    named = item_windows(benchmark, item_id, item_text, n).select(_number().alias("number"), F.col("item")).distinct()
    several = F.size("windows") > 0
    keyed = found.withColumn("_key", F.when(several, F.md5(F.to_json("windows"))).otherwise(F.xxhash64("row").cast("string")))
    hits = (found.filter(several).select(F.md5(F.to_json("windows")).alias("_key"), F.explode("windows").alias("number")).distinct()
            .join(named, "number").groupBy("_key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    none = F.array().cast(T.ArrayType(benchmark.schema[item_id].dataType))
    return keyed.join(hits, "_key", "left").withColumn("items", F.coalesce("items", none)).drop("_key", "windows")


def _merge(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted(list(zip(a[::2], a[1::2])) + list(zip(b[::2], b[1::2]))):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def judged(found: DataFrame) -> DataFrame:
    """``found`` plus ``n_hit`` and ``contaminated``: at least one word in twenty
    lies in a benchmark window."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign"))
    n_hit = F.aggregate("spans", zero, lambda acc, x: F.struct(
        (acc["sum"] + acc["sign"] * x).alias("sum"), (-acc["sign"]).alias("sign")), lambda acc: acc["sum"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def verdicts(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(row, n_words, spans, items, n_hit, contaminated) of every document."""
    of_items = {k: v for k, v in options.items() if k in ("item_id", "item_text", "n")}
    return judged(with_items(annotate(docs, benchmark, **options), benchmark, **of_items))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs`` without contaminated documents."""
    return judged(annotate(docs, benchmark, **options)).filter(~F.col("contaminated")).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, doc_text: str = "text", **options) -> DataFrame:
    """All rows of ``docs``; hit words are cut out of the text, what stood
    around the words that stay is kept as it was."""
    marked = annotate(docs, benchmark, doc_text=doc_text, **options)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("cut", T.StringType())])

    def cut(batches):
        for batch in batches:
            texts, spans = field(batch, doc_text).to_pylist(), batch.column(2).to_pylist()
            for r, own in enumerate(spans):
                if own:
                    for _, _, w in ts.word_batches(pa.array([texts[r]], pa.large_string()), ts.NON_ALNUM):
                        kept, last = [], 0
                        for s, e in zip(own[::2], own[1::2]):
                            kept.append(w.buf[last:w.start[s]].tobytes())
                            last = int(w.end[e - 1])
                        kept.append(w.buf[last:].tobytes())
                        texts[r] = b"".join(kept).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "cut"])

    fixed = marked.mapInArrow(cut, schema)
    return fixed.select(*[F.col("cut").alias(c) if c == doc_text else F.col(f"row.{c}").alias(c) for c in docs.columns])
