"""Secret scans: fixed patterns and character Markov models.

Base spans come from three patterns (assignments, access keys, long hex runs).
The models add spans: one first-order character chain of random strings and one
of ordinary identifiers, compared by the mean log-likelihood ratio per step of
every run of 20 or more token characters.  Runs that overlap a base span are
left to it.

Training: random strings are the values that the base patterns found, ordinary
identifiers the other token runs of the same texts, from at most ``MAX_DOCS``
documents with base spans (those with the least hash of their id, a documented
bound).  Everything runs as DataFrame expressions; the model is a table of one
number per pair of the 67 token characters.

Positions are code points, ends exclusive.  Defined results: null and empty
texts have no spans; without any base match no span is added; repeated rows get
equal results.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: The kinds in the order that breaks ties, and their patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ANY_BASE = r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_RUN = 8, 16, 32, 20
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WORD_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}"
TOKEN_CHARS = "".join(chr(i) for i in range(33, 127) if chr(i).isalnum() or chr(i) in "+/_.=-")
MAX_DOCS = 5_000
#: Nats per step by which the random chain must explain a run better, and the
#: weight (in pairs) of a chain's character frequencies against its pairs.
MARGIN, BACK_OFF = 0.4, 64.0
_STRIDE = 64


def _spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """Leftmost non-overlapping matches as structs (start, k, end, kind);
    ``keep(match, i)`` says which stay.  The text between matches gives their
    places; sums run in strides, so many matches cost no quadratic copying."""
    k = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:int,k:int,end:int,kind:string>>")

    def add(pieces, found):
        def one(acc, i):
            start = (acc["at"] + F.length(pieces[i])).cast("int")
            end = (start + F.length(found[i])).cast("int")
            span = F.struct(start.alias("start"), F.lit(k).alias("k"), end.alias("end"), F.lit(kind).alias("kind"))
            return F.struct(end.alias("at"), F.when(keep(found[i], i), F.concat(acc["out"], F.array(span)))
                            .otherwise(acc["out"]).alias("out"))

        def stride(acc, b):
            last = F.least(b + (_STRIDE - 1), F.size(found) - 1)
            inner = F.aggregate(F.sequence(b, last), F.struct(acc["at"].alias("at"), empty.alias("out")), one)
            return let(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out")))

        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.when(F.size(found) == 0, empty).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.size(found) - 1, F.lit(_STRIDE)), start, stride, lambda acc: acc["out"]))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(F.struct(F.split(text, pattern, -1).alias("pieces"), matches.alias("found")),
               lambda s: add(s["pieces"], s["found"]))


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, sorted by start, then kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = let(values, lambda v: _spans(text, ASSIGN, "assign", lambda m, i: F.length(v[i]) >= MIN_VALUE))
    access = _spans(text, ACCESS, "access", lambda m, i: F.length(m) >= MIN_ACCESS)
    # Shorter hex runs never overlap a longer one, so the bound can go into the pattern.
    hexes = _spans(text, r"[0-9a-f]{32,}", "hex", lambda m, i: F.lit(True))
    return F.array_sort(F.concat(assign, access, hexes))


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_docs: int = MAX_DOCS) -> np.ndarray | None:
    """Log-likelihood ratio of each pair of code points below 128 (flat
    128 x 128), or None without samples of both kinds."""
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).filter(F.col("t").rlike(ANY_BASE))
    ids = found.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(max_docs)
    texts = found.join(F.broadcast(ids), found.id.eqNullSafe(ids.id)).select("t")
    long_enough = lambda n: lambda x: F.length(x) >= n
    random = F.array_distinct(F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), long_enough(MIN_VALUE)),
        F.filter(F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)), long_enough(MIN_ACCESS)),
        F.regexp_extract_all("t", F.lit(r"[0-9a-f]{32,}"), F.lit(0))))
    plain = F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", " ")
    ordinary = F.array_except(F.regexp_extract_all(plain, F.lit(WORD_RUN), F.lit(0)), random)
    labelled = texts.select(F.explode(F.array(
        F.struct(F.lit(1).alias("label"), random.alias("tokens")), F.struct(F.lit(0).alias("label"), ordinary.alias("tokens")))).alias("s"))
    tokens = labelled.select("s.label", F.explode("s.tokens").alias("t")).distinct()
    pairs = tokens.select("label", F.explode(let(F.split("t", ""), lambda c: F.transform(
        F.sequence(F.lit(0), F.length("t") - 2), lambda i: F.ascii(c[i]) * 128 + F.ascii(c[i + 1])))).alias("pair"))
    rows = pairs.groupBy("label", "pair").count().collect()       # at most 2 x 67 x 67
    count = np.zeros((2, 128, 128))
    for label, pair, n in rows:
        count[label, pair // 128, pair % 128] = n
    if not count[0].sum() or not count[1].sum():
        return None
    size = len(TOKEN_CHARS)
    back_off = (count.sum(axis=1, keepdims=True) + 0.1) / (count.sum(axis=(1, 2), keepdims=True) + 0.1 * size)
    chain = (count + BACK_OFF * back_off) / (count.sum(axis=2, keepdims=True) + BACK_OFF)
    return np.log(chain[1] / chain[0]).round(3).reshape(-1)


def ratio(token: Column, model: np.ndarray) -> Column:
    """Mean log-likelihood ratio per step of a token of ASCII characters."""
    chars = [ord(c) for c in TOKEN_CHARS]
    lo, width = min(chars), max(chars) - min(chars) + 1
    small = F.lit(np.ascontiguousarray(model.reshape(128, 128)[lo:lo + width, lo:lo + width]).reshape(-1))
    step = lambda c, i: small[(F.ascii(c[i]) - lo) * width + F.ascii(c[i + 1]) - lo]
    total = let(F.split(token, ""), lambda c: F.aggregate(
        F.sequence(F.lit(0), F.length(token) - 2), F.lit(0.0), lambda acc, i: acc + step(c, i)))
    return total / (F.length(token) - 1)


def find(docs: DataFrame, model: np.ndarray | None, *, text: str = "text", margin: float = MARGIN,
         base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with array columns ``base`` and ``spans`` (base and added)."""
    value = F.coalesce(F.col(text), F.lit(""))
    empty = F.array().cast("array<struct<start:int,k:int,end:int,kind:string>>")
    out = docs.withColumn(base, F.when(value.rlike(ANY_BASE), base_spans(value)).otherwise(empty))
    if model is None or math.isinf(margin):
        return out.withColumn(spans, F.col(base))
    added = F.when(value.rlike(RUN), _spans(value, RUN, "markov", lambda m, i: ratio(m, model) >= margin)).otherwise(empty)
    clear = let(added, lambda a: F.filter(a, lambda x: ~F.exists(F.col(base), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))
    return out.withColumn(spans, F.when(F.size(base) == 0, added).otherwise(F.array_sort(F.concat(F.col(base), clear))))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: np.ndarray | None, *, text: str = "text", mark: str = "[SECRET]", margin: float = MARGIN) -> DataFrame:
    """The rows and columns of ``docs``; every span, overlapping ones together,
    is replaced by ``mark``.  Null texts stay null."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("t"))
    found = find(packed, model, text="t", margin=margin)
    whole = F.col("t")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.when(s["start"] >= acc["at"], F.concat(acc["out"], whole.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), gap.otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], whole.substr(acc["at"] + 1, F.length(whole))))
    fixed = found.withColumn("t", F.when(F.size("spans") > 0, cut).otherwise(whole))
    return fixed.select(*[F.col("t").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
