"""Repeated bytes against all windows of all texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from paneltide.llm import suffixes, textscan

from .conftest import ODD


def brute(rows, window):
    """(id, bytes, removed, spans, kept) of distinct rows in order of id."""
    seen, out = set(), []
    for id_, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            w = raw[i:i + window]
            if w in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((id_, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def got(df, **options):
    return [(r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df, **options).collect()]


def corpus(seed):
    """Passages in changing surroundings, near copies, copies, periodic texts."""
    rng = random.Random(seed)
    word = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(60)]
    passage = [" ".join(rng.choices(word, k=25)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([" ".join(rng.choices(word, k=rng.randint(0, 30))), rng.choice(passage), rng.choice(passage)[rng.randint(0, 20):]])
                 for _ in range(rng.randint(0, 6))]
        texts.append(" ".join(parts))
    near = texts[7][:80] + "X" + texts[7][80:]
    return [*texts, texts[3], texts[3], near, "ab" * 300, "x" * 500, "x" * 499, passage[0], "", None]


@pytest.mark.parametrize("options", [
    {}, {"phrase": 1 << 40}, {"hot": 2, "salts": 3, "phrase": 1 << 40}, {"hot": 3, "salts": 2, "sort_bytes": 200, "queue_rows": 50},
    {"phrase": 1 << 40, "sort_bytes": 300, "queue_rows": 20}, {"phrase": 20, "bucket_bytes": 2_000}])
def test_matches_brute_force(make_docs, options):
    rows = list(enumerate(corpus(5)))
    assert sorted(got(make_docs(rows).repartition(3), window=40, gram=12, **options)) == sorted(brute(rows, 40))


def test_single_source_of_copies(make_docs):
    rows = [(i, "the same passage of some length, over and over again " * 3 + str(i % 7)) for i in range(300)]
    want = brute(rows, 100)
    assert sorted(got(make_docs(rows).repartition(4))) == sorted(want)
    assert sorted(got(make_docs(rows).repartition(4), hot=20, salts=4, phrase=1 << 40)) == sorted(want)


def test_text_beyond_one_piece(make_docs):
    long = "".join(random.Random(2).choices("abcdefgh ", k=1_200_000))
    rows = [(1, long + long), (2, long[500:900] + "!"), (3, "short")]
    ((_, n, removed, spans, kept), two, three) = sorted(got(make_docs(rows)))
    assert (n, removed, spans, kept) == (2_400_000, 1_200_000, 1, long.encode())
    assert two[2:] == (400, 1, b"!") and three[2:] == (0, 0, b"short")


def test_odd_rows(odd_docs, wide_docs, no_docs):
    distinct = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    want = {}
    for id_, n, removed, spans, kept in brute(list(dict.fromkeys(distinct)), 100):
        want.setdefault(id_, []).append((n, removed, spans, kept))
    for df in (odd_docs, wide_docs):
        rows = got(df)
        assert len(rows) == len(ODD)
        assert all(tuple(r[1:]) in want[r[0]] for r in rows)
        assert {r[0]: r[2] for r in rows}[6] == len(ODD[8][1])
    assert set(suffixes.remove_repeats(wide_docs).schema["row"].dataType.names) == set(wide_docs.columns) - {"text"}
    assert got(no_docs) == []


def test_runs_share_the_first_least_hash():
    texts = ["x" * 90, "ab" * 60, "short", "".join(random.Random(3).choices("abc", k=70_000)), ""]
    raw, off = textscan.buffer_of(pa.array(texts))
    piece, window, gram = suffixes.Piece(raw, off, 0, len(texts)), 40, 12
    hashes = suffixes.rolling(piece.raw, gram)
    want = []
    for r, n in enumerate(piece.size.tolist()):
        if n >= window:
            _, place = textscan.least(hashes[piece.first[r]:piece.first[r] + n - gram + 1], window - gram + 1)
            edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
            want += [(int(hashes[piece.first[r] + place[a]]), int(piece.first[r] + a), int(piece.first[r] + b - 1)) for a, b in zip(edges[:-1], edges[1:])]
    assert [tuple(map(int, x)) for x in zip(*piece.runs(window, gram, None))] == want


def test_sort_takes_only_windows_that_may_repeat(monkeypatch):
    rng = random.Random(4)
    own = [bytes(rng.choices(range(97, 123), k=300)) for _ in range(4)]
    shared = b"the passage that two of the strings have in common, of fifty bytes and more"
    strings = [own[0] + shared + own[1], own[2] + shared, own[3], b"alone in its group" * 5]
    sorted_ = []

    def sort(symbols, *rest):
        sorted_.append(len(symbols))
        return whole(symbols, *rest)

    whole = suffixes.sort_suffixes
    monkeypatch.setattr(suffixes, "sort_suffixes", sort)
    places = np.array([(i, i, 0) for i in range(4)], suffixes._PLACE)
    heads = suffixes.Shard(40, "unused")._heads(strings, np.array([0, 0, 0, 1]), places)
    assert sorted_ == [2 * (len(shared) + 1)]
    assert heads[0] is heads[2] is heads[3] is None
    assert np.flatnonzero(~heads[1]).tolist() == list(range(300, 300 + len(shared) - 39))
