"""Induced sorting against plain sorting of all suffixes."""

import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from paneltide.llm.induced import DiskQueue, sort_suffixes


def brute(groups, cap):
    out = []
    for strings in groups:
        suffixes = sorted((tuple(s[i:]), k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        shared = [0]
        for (a, _, _), (b, _, _) in zip(suffixes, suffixes[1:]):
            n = 0
            while n < min(len(a), len(b), cap) and a[n] == b[n]:
                n += 1
            shared.append(n)
        out.append(([x[0][:cap] for x in suffixes], shared))
    return out


def induced(groups, cap, queue, names):
    symbols, group, base, owner = [], [], [], []
    for g, strings in enumerate(groups):
        base.append(len(symbols))
        for s in strings:
            for i in range(len(s) + 1):
                owner.append(tuple(s[i:]))
            symbols += [*s, 0]
        group += [g] * (len(symbols) - len(group))
    places, common = sort_suffixes(np.array(symbols, np.int32), np.array(group), np.array(base), cap, queue, names)
    out = []
    for a, b in zip(base, [*base[1:], len(symbols)]):
        assert sorted(places[a:b]) == list(range(a, b))
        out.append(([owner[p][:cap] for p in places[a:b]], common[a:b].tolist()))
    return out


strings = st.lists(st.one_of(st.lists(st.integers(1, 3), max_size=30), st.lists(st.integers(1, 2), max_size=12).map(lambda x: x * 5),
                             st.lists(st.integers(1, 2000), max_size=8)), min_size=1, max_size=5)


@settings(max_examples=400, deadline=None)
@given(st.lists(strings, min_size=1, max_size=4), st.sampled_from([4, 100]), st.sampled_from([3, 10_000]), st.sampled_from([2, 256]))
def test_sorts_like_brute_force(tmp_path_factory, groups, cap, limit, names):
    folder = str(tmp_path_factory.getbasetemp())
    made = []

    def queue(keys):
        made.append(DiskQueue(keys, limit, folder + "/spill"))
        return made[-1]

    assert induced(groups, cap, queue, names) == brute(groups, cap)
    assert all(not q.files for q in made)
    assert not os.path.isdir(folder + "/spill") or not os.listdir(folder + "/spill")


def test_queue_keeps_order_on_disk(tmp_path):
    q = DiskQueue(5_000, 50, str(tmp_path / "spill"))
    rng = np.random.default_rng(3)
    rows = np.stack((rng.integers(0, 5_000, 3_000), np.arange(3_000), np.zeros(3_000)), axis=1).astype(np.int32)
    for part in np.array_split(rows, 60):
        q.push(part)
    assert q.spilled > 2_000 and os.listdir(tmp_path / "spill")
    for key in range(5_000):
        own = rows[rows[:, 0] == key]
        got = q.pop(key)
        assert (got is None and not len(own)) or (got == own).all()
        if key == 70:
            q.push(np.array([[70, -1, 0]], np.int32))
            assert q.pop(70).tolist() == [[70, -1, 0]]
    q.close()
    assert not os.listdir(tmp_path / "spill")
