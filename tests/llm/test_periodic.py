"""Periodic runs against all lags and stretches."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from paneltide.llm import periodic, textscan

from .conftest import ODD


def brute(words):
    """Every maximal stretch of a lag, without those that a shorter lag covers."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.append((i - q, j - i + q, q))
            i = j
    return sorted((r for r in out if not any(o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in out)),
                  key=lambda r: (r[0], r[2]))


def found(texts):
    (_, _, words), = textscan.word_batches(pa.array(texts), textscan.SPACE)
    runs = periodic.batch_runs(words)
    return [runs.get(i, []) for i in range(len(texts))]


@st.composite
def repetitive(draw):
    parts = draw(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 12)), max_size=6))
    outer = draw(st.integers(1, 6))
    return list("".join(p * k for p, k in parts) * outer)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(repetitive(), st.text("ab", max_size=80).map(list), st.text("abc", max_size=40).map(list)), min_size=1, max_size=4))
def test_all_runs_are_found(rows):
    assert found([" ".join(r) for r in rows]) == [brute(r) for r in rows]


def test_long_repetitive_texts():
    one = ["x"] * 60_000
    two = (["x"] * 4_000 + ["y"]) * 6
    assert found([" ".join(one), " ".join(two)]) == [
        [(0, 60_000, 1)], sorted([(i * 4_001, 4_000, 1) for i in range(6)] + [(0, 24_006, 4_001)], key=lambda r: (r[0], r[2]))]


def test_text_beyond_one_piece():
    period = [f"word{i}" for i in range(3_001)]
    text = " ".join((period * 120)[:330_000])
    assert len(text) > textscan.PIECE_BYTES
    assert found([text]) == [[(0, 330_000, 3_001)]]


def test_odd_rows(odd_docs, wide_docs, no_docs):
    assert periodic.find_runs(no_docs).count() == 0
    for df in (odd_docs, wide_docs):
        rows = periodic.find_runs(df).collect()
        assert len(rows) == len(ODD) and set(rows[0].row.asDict()) == set(df.columns) - {"text"}
        kept = {r.row.doc_id: r for r in rows}
        assert kept[4].kept == "one" and kept[1].kept == kept[2].kept == kept[3].kept == "" and kept[1].runs == []
        assert [tuple(r) for r in kept[5].runs] == [(0, 60_000, 977)] and len(kept[5].kept.split()) == 977
        assert [r.kept for r in rows if r.row.doc_id == 4] == ["one", "one"]


def test_text_alone(spark):
    rows = periodic.find_runs(spark.createDataFrame([("a b " * 6,)], "text string")).collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.kept) for r in rows] == [(12, [(0, 12, 2)], "a b")]
