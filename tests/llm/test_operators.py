"""Operators on planted cases, odd rows, empty tables and clashing columns."""

import importlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from paneltide.llm import decontam, langid, neardup, packing, phrases, pii, quality, secrets, textscan, toxicity, warc
from paneltide.llm.components import components
from paneltide.llm.queries import PIECES, RANKS

from .conftest import LONG, ODD


def words(n, salt="w", start=0):
    return " ".join(f"{salt}{i}" for i in range(start, start + n))


# --- text scan

def test_words_match_split():
    import pyarrow as pa
    rows = [None, "", " a  b\tc ", "x", "é f", "end ", LONG]
    for lo, hi, w in textscan.word_batches(pa.array(rows), textscan.SPACE):
        for r in range(lo, hi):
            want = (rows[r] or "").encode().split()
            a, b = w.first[r - lo], w.first[r - lo + 1]
            assert w.text(a, b) == b" ".join(want) and b - a == len(want)
    _, _, one = next(textscan.word_batches(pa.array(["ab cd ab"]), textscan.SPACE))
    assert one.hash[0] == one.hash[2] != one.hash[1]
    many = [f"{'long' * (i % 40)}{i}" for i in range(20_000)] + ["thines", "thinen", "thinens", "nthines"]
    _, _, w = next(textscan.word_batches(pa.array([" ".join(many)]), textscan.SPACE))
    assert len(set(w.hash.tolist())) == len(set(many)) and len({h & 0xFFFF for h in w.hash.tolist()}) > 15_000


# --- toxicity

def test_toxicity_learns_a_word(make_docs, spark):
    docs = make_docs([(i, words(40, start=i) + (" vile" if i % 3 == 0 else "")) for i in range(300)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.i: r.score for r in toxicity.score(docs, model).select(F.col("row.doc_id").alias("i"), "score").collect()}
    assert all((got[i] > 0.5) == (i % 3 == 0) for i in range(200, 300))
    assert 0 < len(model[0]) < 2_000


def test_toxicity_odd_rows(odd_docs, wide_docs, no_docs, labels):
    model = toxicity.fit(odd_docs, labels)
    assert toxicity.score(wide_docs, model).filter("score between 0 and 1").count() == len(ODD)
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.fit(no_docs, labels)
    assert toxicity.score(odd_docs, none).agg(F.max("score")).first()[0] == 0


# --- packing

def test_best_fit_decreasing_is_tight():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 700, 3000).tolist()
    windows = packing.best_fit_decreasing(sizes, 2048)
    assert sorted(i for w in windows for i in w) == list(range(3000))
    assert all(sum(sizes[i] for i in w) <= 2048 for w in windows)
    assert len(windows) <= sum(sizes) / 2048 * 1.01 + 1


def test_tightest_window():
    tree = packing.CapacityTree(10)
    for c in (3, 7, 9):
        tree.add(c, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 8, 10)] == [3, 3, 7, 9, None]


def test_encoder_matches_tokenizer():
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.Encoder(packing.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    for t in ["", "a", " a", "a ", "a  b", "a \n b", "don't we'll", "tab\tb \t c", "é è x 　y", "1 23  4", "\x1c a \x1c", *[t for _, t in ODD if t]]:
        assert own.encode(t).tolist() == coder.encode(t, add_special_tokens=False).ids, repr(t[:30])


def pack(df):
    return packing.pack(df, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, block_tokens=20_000)


def test_packing_odd_rows(odd_docs, wide_docs, no_docs):
    rows = pack(wide_docs.repartition(3)).collect()
    assert sum(r.length for r in rows if r.start == 0) > 0
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert sum(r.start == 0 for r in rows) == len(ODD)
    assert sum(r.doc_tokens == 1 for r in rows) == 3          # null and empty texts: the end id
    assert "text" not in rows[0].row.asDict() and len(rows[0].ids) == 4 * rows[0].length
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pack(no_docs).count() == 0
    assert sum(r.length for r in pack(odd_docs).collect()) == sum(r.length for r in rows)


# --- secrets

def test_models_add_random_strings(make_docs):
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    blob = lambda n: "".join(rng.choice(letters, n))
    rows = [(i, f"some ordinary words about retitioning the configuration password={blob(20)} and more_of_the_same plain talk") for i in range(300)]
    secret = blob(40)
    rows += [(1000, f"here {secret} stands"), (1001, "internationalisation_of_the_configuration_management"), (1002, "token=short then")]
    docs = make_docs(rows)
    got = {r.doc_id: r for r in secrets.find(docs, secrets.train(docs)).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1000].spans] == [("markov", 5, 45)]
    assert not got[1001].spans and not got[1002].spans
    assert [s.kind for s in got[0].spans] == ["assign"]
    fixed = {r.doc_id: r.text for r in secrets.redact(docs, secrets.train(docs)).collect()}
    assert fixed[1000] == "here [SECRET] stands" and fixed[1001] == rows[301][1]


def test_secret_positions_are_code_points(make_docs):
    t = "\U0001F600é token = \"deadbeefdeadbeefdeadbeefdeadbeef\" x password=secret:abcdefghij PASSWD:'12345678' " + "AKIA" + "A" * 12
    r = secrets.find(make_docs([(1, t), (2, (t + " ") * 200)]), None).orderBy("doc_id").collect()
    from .test_queries import base_spans, span_text
    assert [",".join(f"{s.kind}:{s.start}:{s.end}" for s in x.base) for x in r] == [span_text(base_spans(t)), span_text(base_spans((t + " ") * 200))]


def test_secrets_odd_rows(odd_docs, wide_docs, no_docs):
    assert secrets.train(no_docs) is None
    assert secrets.find(odd_docs, secrets.train(odd_docs)).filter("size(spans) > 0").count() <= 1
    out = secrets.redact(wide_docs, None)
    assert out.columns == wide_docs.columns and sorted(map(str, out.collect())) == sorted(map(str, wide_docs.collect()))
    assert secrets.redact(no_docs, None).count() == 0


# --- near duplicates

def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (52, 51), (7, 7), (50, 51)], "u int, v int")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 50: 50, 51: 50, 52: 50}
    assert components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_components_write_few_small_tables(spark, monkeypatch):
    """Stars take one round or none; a small graph is one file a round, even
    where shuffle partitions are not coalesced."""
    module, tables = importlib.import_module("paneltide.llm.components"), []
    store = module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: tables.append(store(df, name)) or tables[-1])
    monkeypatch.setattr(module, "FILE_ROWS", 50)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for edges, want, most in (([(i, i // 10 * 10) for i in range(40)] + [(3, 0)], {i: i // 10 * 10 for i in range(40)}, 1),
                                  ([(i // 10 * 10, i) for i in range(40)], {i: i // 10 * 10 for i in range(40)}, 2),
                                  ([(1, 0), (2, 0), (2, 1), (3, 1)], dict.fromkeys(range(4), 0), 3),
                                  ([(i + 1, i) for i in range(40)], dict.fromkeys(range(41), 0), 9)):
            tables.clear()
            got = [tuple(r) for r in components(spark.createDataFrame(edges, "u int, v int"), most=len(edges)).collect()]
            assert dict(got) == want and len(got) == len(want)
            assert len(tables) <= most and all(len(t.inputFiles()) <= 1 for t in tables)
        edges = spark.range(1, 200).selectExpr("id AS u", "id - 1 AS v")
        assert {r.component for r in components(edges).collect()} == {0}
        assert 2 <= len(tables[-1].inputFiles()) <= 4          # 199 edges
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(120):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "u int, v int")).collect()]
    assert dict(got) == label and len(got) == len(label)


def family(n, seed, size=200, edits=2):
    rng = np.random.default_rng(seed)
    base = words(size, f"f{seed}x").split()
    for k in range(n):
        w = list(base)
        for j in rng.choice(size, edits, replace=False):
            w[j] = f"edit{seed}x{k}x{j}"
        yield " ".join(w)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 20_000, "hubs": 3}])
def test_near_duplicate_families(make_docs, options):
    rows = [(i, t) for i, t in enumerate(family(120, 1, edits=1))]
    rows += [(1000 + i, t) for i, t in enumerate(family(5, 2))] + [(2000 + i, words(150, f"s{i}x")) for i in range(60)]
    rows += [(3000, rows[0][1]), (3001, rows[0][1])]
    got = {r.id: r for r in neardup.classes(make_docs(rows), **options).collect()}
    assert {got[i].class_id for i in [*range(120), 3000, 3001]} == {0}
    assert {got[1000 + i].class_id for i in range(5)} == {1000}
    assert all(got[2000 + i].class_size == 1 for i in range(60))
    assert sum(r.first for r in got.values()) == 62


def drifting(n, seed, size=200, step=10):
    """Versions of which each keeps all but ``step`` words of the one before."""
    w = words(size, f"d{seed}x").split()
    for k in range(n):
        yield " ".join(w)
        w[k * step % size:k * step % size + step] = [f"d{seed}v{k}x{j}" for j in range(step)]


def exact_shares(texts):
    """Shingles and the share of the texts that hold each."""
    grams = np.concatenate([neardup.bags(w)[1] for t in texts for _, _, w in textscan.word_batches(pa.array([t]), textscan.SPACE, lower=True)])
    kinds, n = np.unique(grams, return_counts=True)
    return kinds, n / len(texts)


def test_weights_follow_exact_document_frequencies(make_docs):
    """Weights depend on the share of documents alone: ten times the documents,
    the same weights."""
    texts = [f"{words(40, f'own{i}x')} {words(20, f'tenth{i % 10}x')} {words(20, 'all')}" for i in range(400)]
    kinds, share = exact_shares(texts)
    want = 1 + np.log(np.clip(share, neardup.RARE, 1)) / np.log(neardup.RARE)
    for times in (1, 10):
        idf = neardup.document_frequencies(make_docs(list(enumerate(texts * times))).repartition(3))
        got = neardup.weights(kinds, np.ones(len(kinds)), idf)
        assert np.mean(np.abs(got - want) < 1e-5) > 0.999 and (got <= want + 1e-5).all()
    assert {1.0, 2.0} <= set(np.round(got, 5).tolist()) and len(set(np.round(got, 4).tolist())) >= 3
    assert (neardup.document_frequencies(make_docs([])) >= 1).all()


def brute_classes(texts):
    """Least position of each text's class, over all pairs that share a band."""
    kinds, share = exact_shares(texts)
    idf = np.ones((neardup.DEPTH, neardup.SLOTS), np.float32)
    for k, slot in enumerate(neardup._slots(kinds)):
        idf[k][slot] = 1 + np.log(np.clip(share, neardup.RARE, 1)) / np.log(neardup.RARE)
    own = neardup.Bags(pa.array(texts), idf)
    sig = []
    for _, _, w in textscan.word_batches(pa.array(texts), textscan.SPACE, lower=True):
        row, gram, count = neardup.bags(w)
        sig.append(neardup.signatures(row, gram, neardup.weights(gram, count, idf), int(row.max()) + 1))
    sig, label = np.concatenate(sig), np.arange(len(texts))
    for i in range(1, len(texts)):
        mates = np.flatnonzero((sig[:i] == sig[i]).any(axis=1))
        for j in mates[own.similarities(i, mates) >= neardup.THRESHOLD] if len(mates) else ():
            label[np.isin(label, (label[i], label[j]))] = min(label[i], label[j])
    return label.tolist()


def test_bags_of_a_block_hold_little_beside_the_text(monkeypatch):
    """Bags are made of a small part of the text at a time, here as in the scans
    that share the pieces; a block's take 14 bytes for a byte of text (27 before)."""
    rng, seen, made = np.random.default_rng(5), [], neardup.bags
    monkeypatch.setattr(neardup, "bags", lambda w, *a: seen.append(len(w.buf)) or made(w, *a))
    texts = pa.array([" ".join(f"t{k}" for k in rng.integers(0, 10_000, 300)) for _ in range(2_000)])
    idf = np.ones((neardup.DEPTH, neardup.SLOTS), np.float32)
    tracemalloc.start()
    own = neardup.Bags(texts, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(seen) == sum(len(t.as_py()) for t in texts) > 3_000_000
    assert max(seen) <= 512 << 10 and peak < 19 * sum(seen)
    assert own.first[-1] == 2_000 * 296 == len(own.column) == len(own.weight)
    seen.clear()
    assert [(hi - lo, len(w)) for lo, hi, w, _ in neardup.bag_pieces(pa.array(["a b", texts[0].as_py() * 400, None]))] == [(1, 2), (1, 300 * 400 - 399), (1, 0)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 6_000, "hubs": 20}])
def test_drifting_family_matches_brute_force(make_docs, options):
    texts = [t for s in range(3) for t in drifting(60, s)]
    got = {r.id: r.class_id for r in neardup.classes(make_docs(list(enumerate(texts))), **options).collect()}
    want = brute_classes(texts)
    assert len(set(want)) < 30 and [got[i] for i in range(len(texts))] == want


def test_bucket_tasks_are_bounded_and_whole(spark):
    unit = lambda i: i.to_bytes(16, "big")
    # bucket 1: 300 classes; bucket 2: a class of 200 and 40 others; bucket 3: small; bucket 4: one class
    buckets = {1: list(range(300)), 2: [500] * 200 + list(range(600, 640)), 3: [700, 701, 701], 4: [800] * 50}
    rows = [(unit(1000 * h + k), 1000 * h + k, 100, [h], unit(c), 0, h) for h, own in buckets.items() for k, c in enumerate(own)]
    table = spark.createDataFrame(rows, "unit binary, rk long, size long, bands array<long>, label binary, at int, hash long")
    tasks = {}
    for r in neardup._bucket_tasks(table, 2_000).collect():
        tasks.setdefault((r.hash, r.p, r.q), []).append(r)
    assert max(len(own) for own in tasks.values()) <= 60          # of 20 on average
    met = {}
    for own in tasks.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                if not a.apart or a.part != b.part:
                    pair = frozenset((a.rk, b.rk))
                    met[pair] = met.get(pair, 0) + 1
    for h, own in buckets.items():
        for i, c in enumerate(own):
            assert all(met[frozenset((1000 * h + i, 1000 * h + j))] == 1 for j in range(i) if own[j] != c)
    assert not any(h == 4 for h, _, _ in tasks)


def test_near_duplicates_odd_rows(odd_docs, wide_docs, no_docs):
    rows = neardup.classes(odd_docs).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
    assert {r.class_id for r in by[5] + by[6]} == {5} and by[4][0].class_size == 2
    assert by[1][0].class_size == by[2][0].class_size == 1
    kept = neardup.keep_first(wide_docs)
    assert kept.columns == wide_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 5 in ids and 6 not in ids and {1, 2, 3} <= set(ids) and ids.count(None) == 2
    assert neardup.keep_first(no_docs).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    gram = np.sort(rng.integers(0, 1 << 63, 600).astype(np.uint64))
    w = rng.uniform(0.5, 3, 600).astype(np.float32)
    a, b = slice(0, 500), slice(100, 600)
    true = w[100:500].sum() / w.sum()
    sig = [neardup.signatures(np.zeros(500, int), gram[s], w[s], 1, bands=400, rows=1)[0] for s in (a, b)]
    assert abs(np.mean(sig[0] == sig[1]) - true) < 0.08


def test_least_is_the_first_of_each_span():
    rng = np.random.default_rng(5)
    for span in (1, 2, 7, 15):
        values = rng.integers(0, 9, 200).astype(np.uint64)
        value, at = textscan.least(values, span)
        want = [int(np.argmin(values[i:i + span])) + i for i in range(200 - span + 1)]
        assert at.tolist() == want and value.tolist() == values[want].tolist()


def test_shard_streams_only_fragments_that_may_hold_phrases(monkeypatch):
    streamed = []

    class Automaton:
        def __init__(self, *args):
            self.own = made(*args)
            self.add_word, self.make_automaton = self.own.add_word, self.own.make_automaton

        def iter(self, words):
            streamed.append(words)
            return self.own.iter(words)

    made = phrases.ahocorasick.Automaton
    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Automaton)
    words = lambda *w: np.array(w, "<u4").tobytes()
    rows = [(1, 10, 7, 0, words(1, 2, 3), None), (2, 10, 7, 5, words(4, 5, 6, 7), None), (2, 11, 8, 0, words(3, 4, 5, 6), None),
            (3, 10, 7, 9, words(7, 8, 9), None), (3, 12, 9, 9, words(9, 8, 9), None)]
    assert phrases.Shard(3).locate(rows, None) == [(8, 1, 3)]
    assert streamed == [(4, 5, 6, 7), (3, 4, 5, 6)]


# --- quality

def test_quality_odd_rows(odd_docs, wide_docs, no_docs, labels):
    model = quality.fit(odd_docs, labels)
    rows = quality.judge(quality.measures(odd_docs, model)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by[1].q.n_words == 0 and by[1].base_failed and by[1].q.score is None
    assert by[10].q.n_repeat_words == 78 and by[10].base_failed
    assert quality.measures(no_docs, model).count() == 0
    assert quality.fit(no_docs, labels) is None
    assert quality.judge(quality.measures(odd_docs, None)).filter("kept").count() == sum(not r.base_failed for r in rows)
    assert quality.measures(wide_docs.drop("q"), model).count() == len(ODD)


def test_quality_learns_from_all_labelled_documents(spark):
    """Where every document is trusted, target and raw counts are the same."""
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some"), F.col("id"), F.col("id") * 7).alias("text"))
    model = quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert not model.ratios.any() and model.floor == 0


def test_quality_floor_is_the_quantile_of_all_trusted(make_docs, spark):
    docs = make_docs([(i, " ".join(f"w{(i * k) % 53}" for k in range(1, 4 + i % 30))) for i in range(3_000)] + [(6, ""), (7, None), (9, "w1 w2 w2")])
    labels = spark.range(3_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("quality"))
    model = quality.fit(docs, labels, spared=0.1)
    scores = [r.q.score for r in quality.measures(docs, model).collect() if r.doc_id % 3 == 0 and r.q.score is not None]
    assert len(scores) == 1_001 and model.ratios.any() and abs(model.floor - np.quantile(scores, 0.1)) < 1e-12


# --- pii

def pseudo(make_docs, texts, key="k"):
    return [r.text for r in pii.pseudonymise(make_docs(list(enumerate(texts))), key=key).orderBy("doc_id").collect()]


def test_pii_formats_and_links(make_docs):
    card = "4012888888881881"
    texts = [f"call +1 (456) 555-2186 or 456-555-2186. card {card}, {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}.",
             f"born 1999-02-28, not 1999-02-30; at 10.0.0.256 no, 192.168.10.7 yes. {card} joe.doe+x@mail.example.com",
             "4012888888881882 is no card", "31/12/1999 and 12/31/1999 and 01.02.2003", None, ""]
    a, b, c, d, e, f = pseudo(make_docs, texts)
    assert c == texts[2] and e is None and f == ""
    new = re.search(r"card (\d{16}), (\d{4}) (\d{4}) (\d{4}) (\d{4})\.", a)
    assert new[1] == "".join(new.groups()[1:]) != card and new[1] in b
    assert sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(new[1]))) % 10 == 0
    phones = re.search(r"call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})\.", a)
    assert phones.groups()[:3] == phones.groups()[3:] != ("456", "555", "2186")
    assert "1999-02-30" in b and "10.0.0.256" in b and "192.168.10.7" not in b and "joe" not in b and "@mail.example.com" in b
    assert re.search(r"born (19|20)\d\d-\d\d-\d\d,", b) and "1999-02-28" not in b
    assert re.fullmatch(r"\d\d/\d\d/\d{4} and \d\d/\d\d/\d{4} and \d\d\.\d\d\.\d{4}", d)
    assert pseudo(make_docs, texts, "other")[0] != a


def test_feistel_is_a_permutation(spark):
    got = spark.range(1000).select(pii.digits(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("x")).collect()
    assert {r.x for r in got} == {f"{i:03d}" for i in range(1000)}


def test_dates_are_a_permutation(spark):
    days = spark.range(5000).select(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    got = days.select(pii._date(F.col("d"), "k").alias("x")).collect()
    assert len({r.x for r in got}) == 5000 and all("1900-01-01" <= r.x <= "2099-12-31" for r in got)


def test_slash_dates_are_a_permutation(spark):
    """Different slash dates get different ones, each of its own reading."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    days = spark.range(2000).select(F.explode(F.array(F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "dd/MM/yyyy"))).alias("d")).distinct()
    got = {r.d: r.x for r in days.select("d", pii._date(F.col("d"), "k").alias("x")).collect()}
    assert len(set(got.values())) == len(got) and None not in got.values()
    assert all((int(d[:2]) > 12) == (int(x[:2]) > 12) and len(x) == 10 for d, x in got.items())
    assert any(d != x for d, x in got.items())


def test_pii_odd_rows(odd_docs, wide_docs, no_docs):
    out = pii.pseudonymise(wide_docs, key="k")
    assert {(r.doc_id, r.text) for r in out.collect()} == {(i, t) for i, t in ODD}
    assert pii.pseudonymise(no_docs, key="k").count() == 0


# --- substring dedup

def brute_repeats(rows, n=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = t.split()
        gone = set()
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            if k in seen:
                gone |= set(range(s, s + n))
            seen.add(k)
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 2, "shard_fragments": 5}])
def test_repeats_match_brute_force(make_docs, options):
    rng = np.random.default_rng(7)
    passages = [words(int(rng.integers(15, 90)), f"p{k}x") for k in range(12)]
    rows = [(i, " ".join(passages[rng.integers(12)] if rng.random() < 0.5 else words(int(rng.integers(1, 30)), f"u{i}x{k}x") for k in range(8)))
            for i in range(80)]
    rows += [(100, "a " * 100), (101, "a " * 50 + "b " * 30), (102, words(19, "p0x")), (103, ""), (104, rows[3][1])]
    got = {r.i: (r.n_words, r.n_removed, r.kept) for r in
           phrases.remove_repeats(make_docs(rows), **options).select(F.col("row.doc_id").alias("i"), "n_words", "n_removed", "kept").collect()}
    assert got == brute_repeats(rows)


def test_repeats_odd_rows(odd_docs, wide_docs, no_docs):
    rows = phrases.remove_repeats(wide_docs).collect()
    by = {r.row.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by[1].n_words == 0 and by[1].kept == ""
    assert by[6].n_removed == by[6].n_words == 60_000 and 0 < by[5].n_removed < 60_000
    assert phrases.remove_repeats(no_docs).count() == 0
    twice = odd_docs.filter("doc_id = 10").unionAll(odd_docs.filter("doc_id = 10"))
    a, b = phrases.remove_repeats(twice).collect()
    assert a.n_removed == b.n_removed < a.n_words


def test_repeated_rows_are_read_once(make_docs, monkeypatch):
    rows = [(7, words(80, "r"))] * 400 + [(8, words(60, "r", 20)), (9, words(40, "q"))]
    docs = make_docs(rows).repartition(5)
    most = {}

    def watch(module, name, column):
        inner = getattr(module, name)

        def outer(df, *args):
            most[name] = df.groupBy("rk").agg(column.alias("size")).agg(F.max("size")).first()[0]
            return inner(df, *args)
        monkeypatch.setattr(module, name, outer)

    watch(phrases, "_fragments", F.max(F.size("runs")))
    watch(phrases, "_ranges", F.sum(F.lit(1) + F.coalesce(F.length("more") / 20, F.lit(0))))
    got = phrases.remove_repeats(docs).collect()
    assert most["_fragments"] <= 80 and most["_ranges"] <= 5 * 80        # at most once a task
    assert Counter((r.row.doc_id, r.n_removed) for r in got) == {(7, 0): 400, (8, 60): 1, (9, 0): 1}
    watch(neardup, "_verify", F.count("*"))
    assert {r.class_size for r in neardup.classes(make_docs([*rows, (10, words(79, "r"))])).collect() if r.id in (7, 10)} == {401}
    assert most["_verify"] == 1


# --- warc

def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{words(50, f'h{i % 7}x')}</p>") for i in range(40)]
    rows += [(100, None, None), (101, "u\r\nInjected: 1", ""), (None, "http://n", "lone"), (102, "é", "é" * 9000), (102, "é", "é" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=2_000, sample_bytes=1_000)
    assert manifest.count() > 3
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page, []).append(r)
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == body and j is not None]
        for r in by[None if i is None else str(i)]:
            assert r.payload_bytes == len(body) and r.payload_digest == warc.base32_sha1(body)
            head = max(same, default=None)
            assert (r.record_type, r.refers_to) == (("response", None) if head in (i, None) else ("revisit", str(head)))
            assert bytes(r.payload) == (body if r.record_type == "response" else b"")
    assert by["101"][0].url == "u%0D%0AInjected:%201"


def test_warc_rejects_damage():
    good = warc.record("1", "http://x", b"<p>hello</p>", None)
    assert warc.parse(good)["payload"] == b"<p>hello</p>"
    for bad in (good.replace(b"hello", b"jello"), good[:-1], good.replace(b"WARC-Date: ", b"WARC-Dated "), good.replace(b"WARC/1.1", b"WARC/9"),
                good.replace(b"WARC-Record-ID", b"X-Record")):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_warc_ids_of_any_text(spark):
    ids = ["a>b", "c\r\nWARC-Type: x", "é %41 ü", "plain"]
    pages = spark.createDataFrame([(i, None, "same" if k < 2 else str(k)) for k, i in enumerate(ids)], "page_id string, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.round_trip(pages).collect()}
    assert got == {"a>b": ids[1], ids[1]: None, ids[2]: None, "plain": None}


def test_warc_reads_with_a_task_per_archive(spark):
    rng = np.random.default_rng(1)
    pages = spark.createDataFrame([(i, "u", rng.bytes(300).hex()) for i in range(400)], "page_id long, url string, html string").repartition(2)
    from paneltide.llm.common import shared_folder
    manifest = warc.write_archives(pages, shared_folder(spark, "warc"), archive_bytes=40_000, sample_bytes=5_000)
    n = manifest.count()
    read = warc.read_archives(manifest).withColumn("task", F.spark_partition_id())
    assert n >= 5 and read.select("task").distinct().count() > n // 3 and read.count() == 400


def test_warc_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- decontamination

def test_decontamination_rule_and_blocks(make_docs, spark):
    item = words(40, "b")
    bench = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None)], "item_id long, text string")
    rows = [(1, words(300, "c") + " " + item), (2, words(400, "c") + " B0, B1! " + words(12, "b", 2)), (3, words(50, "c")), (4, "a TINY-item here"),
            (5, words(12, "b")), (6, words(13, "B"))]
    for options in ({}, {"block_bytes": 1_000}):
        got = {r.row.doc_id: r for r in decontam.verdicts(make_docs(rows), bench, **options).collect()}
        assert [(got[i].n_hit, got[i].contaminated, got[i]["items"]) for i in range(1, 7)] == [
            (40, True, [1]), (14, False, [1]), (0, False, []), (2, True, [2]), (0, False, []), (13, True, [1])]
    left = decontam.remove_contaminated(make_docs(rows), bench)
    assert {r.doc_id for r in left.collect()} == {2, 3, 5} and left.columns == make_docs(rows).columns
    cut = {r.doc_id: r.text for r in decontam.remove_spans(make_docs(rows), bench).collect()}
    assert cut[4] == "a  here" and cut[3] == rows[2][1] and "b5" not in cut[1] and cut[1].startswith("c0 c1")


def test_items_of_hot_windows(make_docs, spark):
    """A window of very many items reaches the driver and the documents once."""
    bench = spark.createDataFrame([(i, words(13, "h")) for i in range(3_000)] + [(9_999, words(13, "q"))], "item_id long, text string")
    shared = words(13, "h")
    rows = [(i, f"{words(5, 'x')} {shared} {shared}") for i in range(40)] + [(50, words(13, "q") + " tail"), (51, "none")]
    got = {r.row.doc_id: r for r in decontam.verdicts(make_docs(rows), bench).collect()}
    assert all(len(got[i]["items"]) == 3_000 and got[i].n_hit == 26 for i in range(40))
    assert got[50]["items"] == [9_999] and got[51]["items"] == [] and len(got) == 42
    assert {len(r.windows) for r in decontam.annotate(make_docs(rows), bench).collect()} == {0, 1}


def test_decontamination_odd_rows(odd_docs, wide_docs, no_docs, benchmark):
    rows = decontam.verdicts(wide_docs, benchmark).collect()
    by = {r.row.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by[1].n_words == 0 and not by[1].contaminated and by[10].contaminated and by[10]["items"] == [2]
    assert by[5].n_hit > 0 and by[5]["items"] == []           # the item without an id hits, unnamed
    assert decontam.verdicts(no_docs, benchmark).count() == 0
    assert decontam.remove_contaminated(odd_docs, benchmark.limit(0)).count() == len(ODD)


# --- language identification

def test_forward_sums_all_segmentations():
    vocabulary = langid.Vocabulary(["a", "b", "ab", "ba", "aba"])
    table = np.zeros((5, 1))
    p = {"a": 0.2, "b": 0.1, "ab": 0.3, "ba": 0.25, "aba": 0.15}
    for k, v in p.items():
        table[np.searchsorted(vocabulary.hashes, np.uint64(langid.Vocabulary._hash(k)))] = v

    def brute(s):
        return 1.0 if not s else sum(p[s[:n]] * brute(s[n:]) for n in (1, 2, 3) if s[:n] in p and n <= len(s))
    for s in ("a", "ab", "abab", "babaab"):
        assert np.isclose(langid.forward(vocabulary, [s], table)[0, 0], np.log(brute(s)))
    counts = langid.expected(vocabulary, ["aba"], np.array([2.0]), table)
    assert np.isclose((counts * np.array([len(k) for k in sorted(p, key=lambda k: langid.Vocabulary._hash(k))])).sum(), 6.0)


def test_words_are_scored_whole():
    """A word of 200 characters, and its expected pieces, against plain sums over
    all segmentations in exact arithmetic."""
    from fractions import Fraction
    rng = np.random.default_rng(6)
    pieces = ["a", "b", "c", "ab", "bca", "cabcab", "abcabcabcabcabcabcabcabcabcabcabc", "▁a", "▁"]
    vocabulary = langid.Vocabulary(pieces)
    assert vocabulary.size == len(pieces) and vocabulary.longest == 33
    p = {x: Fraction(int(rng.integers(1, 9)), 1000) for x in pieces}
    table = np.zeros((vocabulary.size, 1))
    for x, v in p.items():
        table[np.searchsorted(vocabulary.hashes, np.uint64(langid.Vocabulary._hash(x)))] = float(v)
    word = "▁" + "abc" * 66 + "z"
    assert len(word) == 200
    n = len(word)
    fore, back = [Fraction(1)] + [Fraction(0)] * n, [Fraction(0)] * n + [Fraction(1)]
    edge = lambda i, j: p.get(word[i:j], Fraction(1, 10 ** 9) if j - i == 1 else Fraction(0))
    for j in range(1, n + 1):
        fore[j] = sum(fore[i] * edge(i, j) for i in range(max(0, j - 33), j))
    for i in range(n - 1, -1, -1):
        back[i] = sum(edge(i, j) * back[j] for j in range(i + 1, min(n, i + 33) + 1))
    log = lambda f: np.log(float(f.numerator >> f.numerator.bit_length() - 60)) + (f.numerator.bit_length() - 60) * np.log(2) - (
        np.log(float(f.denominator >> f.denominator.bit_length() - 60)) + (f.denominator.bit_length() - 60) * np.log(2))
    assert np.isclose(langid.forward(vocabulary, [word], table)[0, 0], log(fore[n]), rtol=1e-12)
    assert np.isclose(langid.score_words(vocabulary, [word[1:]], table)[0, 0], log(fore[n]), rtol=1e-12)
    got = langid.expected(vocabulary, [word], np.array([1.0]), table)
    for x in pieces:
        uses = sum(fore[i] * p[x] * back[i + len(x)] / fore[n] for i in range(n - len(x) + 1) if word.startswith(x, i))
        assert np.isclose(got[np.searchsorted(vocabulary.hashes, np.uint64(langid.Vocabulary._hash(x)))], float(uses))


def test_language_odd_rows(odd_docs, no_docs, make_docs):
    pieces = langid.read_pieces(public_tokenizers.path(PIECES))
    model = langid.fit(odd_docs, pieces)
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd_docs, pieces, model).collect()}
    assert got[1] == got[2] == got[3] == got[9] == ("und", 0.0) and got[4] == ("en", 1.0)
    assert langid.predict(no_docs, pieces, model).count() == 0
    none = langid.fit(no_docs, pieces)
    assert {r.lang_pred for r in langid.predict(odd_docs, pieces, none).collect()} == {"und"}


# --- pipeline

def test_pipeline_stages(spark, make_docs, tmp_path):
    from pyspark.sql import SparkSession
    assert isinstance(spark, SparkSession)
    rng = np.random.default_rng(11)
    secret = "password=" + "".join(rng.choice(list("abcdefghjkmnpqrstuvwxyz23456789"), 20))
    item = words(30, "bench")
    rows = [(i, words(60, f"d{i}x") + (" vile" if i % 4 == 0 else "")) for i in range(200)]
    rows += [(300, rows[1][1]), (301, rows[2][1] + " more"), (302, words(50, "z") + " " + item), (303, words(50, "y") + " " + secret + " end"),
             (304, None), (305, "")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
    clean = {i for i in range(200) if i % 4} | {300, 301, 302, 303, 304, 305}
    assert kept["toxicity"].keys() == clean
    assert kept["near_duplicates"].keys() == clean - {300, 301}
    assert kept["decontamination"].keys() == clean - {300, 301, 302}
    assert kept["secrets"].keys() == clean - {300, 301, 302}
    assert secret not in kept["secrets"][303].text and kept["secrets"][303].text.endswith("[SECRET] end")
    assert kept["secrets"][1].text == rows[1][1]
    assert {r.doc_id for r in kept["packing"]} == clean - {300, 301, 302}
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in kept["packing"])
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "ids_crc32").collect()}
