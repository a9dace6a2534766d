"""Tokenizer alignment against a plain pass over all texts."""

import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from paneltide.llm import crosstok
from paneltide.llm.queries import PIECES, QUERIES, RANKS

from .conftest import ODD

PATHS = public_tokenizers.path(RANKS), public_tokenizers.PATTERN, public_tokenizers.path(PIECES)
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_level():
    """The bytes behind the printable characters of a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[2]), byte_level()


def tokens(text, coders):
    a, b, table = coders
    if not text:
        return [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    one = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    want = (" " + text).encode()
    return (one, two) if b"".join(x for _, x in one) == want == b"".join(x for _, x in two) else ([], [])


def brute(rows, coders):
    """Rows of measures by doc_id and text, tokenising every document whole."""
    held, per, highest = [], Counter(), {}
    for key, text in rows:
        one, two = tokens(text, coders)
        links, groups, i, j, at_a, at_b = [], [], 0, 0, 0, 0
        group = ([], [])
        while i < len(one):
            links.append((one[i][0], two[j][0]))
            end_a, end_b = at_a + len(one[i][1]), at_b + len(two[j][1])
            if end_a <= end_b:
                group[0].append(one[i][0])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                group[1].append(two[j][0])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(group)
                group = ([], [])
        per.update(set(links))
        held.append((key, one, two, groups, links))
    for (a, _), n in per.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for key, one, two, groups, links in held:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((key, len(one), len(two), len(groups), len(links), sum(per[x] == highest[x[0]] for x in links), sum(per[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if one else ""))
    return out


HARD = ["", None, " ", "  lead", "trail ", "a  b   c", "tab\tand\nline \n next", "<|endoftext|> <s> </s> <unk> <0x41>", "un▁mark", "\x00nul\x1c x",
        "日本語 テキスト 😀😀 ①", "don't we'll 's", "é ﬁ ß", " nbsp　wide x", "same text", "same text", "same text", "x" * 3000]


def test_matches_brute_force(make_docs, coders):
    rows = [(i, t) for i, t in enumerate(HARD)]
    got = crosstok.align_corpus(make_docs(rows), *PATHS, buckets=3, task_bytes=64)
    assert Counter((r.row.doc_id, *(r[c] for c in NAMES)) for r in got.collect()) == Counter(brute(rows, coders))


def test_forgetful_aligner_agrees(coders):
    v = crosstok.Vocabularies(crosstok.read_ranks(PATHS[0]), PATHS[1], open(PATHS[2], "rb").read())
    assert v.apart
    texts = [t for t in HARD if t] * 2
    whole = crosstok.Aligner(v).texts(texts)
    one = crosstok.Aligner(v, remember=2)
    each = [one.texts([t]) for t in texts]
    assert [d for _, d, _ in each for d in d] == whole[1]
    assert sum(len(x[2][0]) for x in each) == len(whole[2][0])


def test_odd_rows(odd_docs, wide_docs, no_docs, coders):
    want = Counter(x for x in brute(ODD, coders))
    for df in (odd_docs, wide_docs):
        rows = crosstok.align_corpus(df, *PATHS).collect()
        assert set(rows[0].row.asDict()) == set(df.columns) - {"text"}
        assert Counter((r.row.doc_id, *(r[c] for c in NAMES)) for r in rows) == want
    assert crosstok.align_corpus(no_docs, *PATHS).count() == 0


def test_query_matches_brute_force(spark, coders):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.execute(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()
    got = QUERIES["op11_token_alignment"](spark, sf)
    assert got.columns == ["doc_id", *NAMES]
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows, coders))
