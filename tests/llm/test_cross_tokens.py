"""Cross-tokenizer alignment against brute force over both libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dugout.llm import cross_tokens
from dugout.llm.tokens import byte_letters, default_tokenizer


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=cross_tokens.default_pieces())


def tokens(libraries, text):
    a, b = libraries
    if not text:
        return [], []
    letters = byte_letters()
    one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        two.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (one, two) if b"".join(x for _, x in one) == raw == b"".join(x for _, x in two) else ([], [])


def by_force(libraries, docs):
    found, count = [], Counter()
    for doc_id, text in docs:
        one, two = tokens(libraries, text)
        ends = []
        for side in (one, two):
            at, own = 0, {}
            for n, (i, raw) in enumerate(side):
                at += len(raw)
                own[at] = n
            ends.append(own)
        links, groups, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            a, b = ends[0][end] + 1, ends[1][end] + 1
            groups.append(",".join(str(x) for x, _ in one[i:a]) + "|" + ",".join(str(x) for x, _ in two[j:b]))
            links.append((one[a - 1][0], two[b - 1][0]))
            i, j = a, b
        count.update(links)
        found.append((doc_id, len(one), len(two), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(d, a, b, len(k), len(k), sum(count[x] == best[x[1]] for x in k), sum(count[x] for x in k), g) for d, a, b, k, g in found]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_merge_path(piece):
    """Pieces of any size give all shared ends, those on a boundary too."""
    r = random.Random(piece)
    for n in [0, 1, 2, 5, 40, 300]:
        a = np.array(sorted(r.sample(range(1, 500), n)), np.int64)
        b = np.array(sorted(r.sample(range(1, 500), r.randint(0, n))), np.int64)
        i, j = cross_tokens.shared_ends(a, b, piece)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        at_a, at_b = cross_tokens.cuts(a, b, piece)
        assert (np.diff(at_a + at_b) <= piece).all() and at_a[-1] == len(a) and at_b[-1] == len(b)


@pytest.mark.parametrize("block_links", [1 << 22, 50])
def test_given_documents(given, rows, libraries, block_links):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    same(rows(cross_tokens.judged(given("documents"), block_links=block_links)), by_force(libraries, docs))


def test_odd_documents(odd_docs, no_docs, odd_rows, rows, make, libraries, monkeypatch):
    docs = [(i, t) for i, t, _ in odd_rows]
    same(rows(cross_tokens.judged(odd_docs)), by_force(libraries, docs))
    assert cross_tokens.judged(no_docs).count() == 0
    more = [(1, "▁ is not a space"), (2, "  two  spaces "), (3, "<s> </s> <unk> <0x41>"), (4, "a\nb\tc\r\n"), (5, "😀 emoji <|endoftext|><|endoftext|>"), (6, " "), (6, " "), (7, "ﬁ ﬀ ½   　 x")]
    same(rows(cross_tokens.judged(make(more, "doc_id long, text string"))), by_force(libraries, more))


def test_pair_counts(given, rows):
    """Totals of the pair table are those of the documents."""
    found = cross_tokens.aligned(given("documents"))
    pairs, marked = cross_tokens.pair_counts(found)
    assert marked.agg({"count": "sum"}).first()[0] == found.agg({"n_groups": "sum"}).first()[0]
    assert marked.where("best").select("b_id").distinct().count() == marked.select("b_id").distinct().count()
    assert pairs.count() == pairs.distinct().count()
