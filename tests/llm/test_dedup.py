"""Exact and near de-duplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dugout.llm import bloom, exact_dedup, hyperminhash
from dugout.llm.components import components


def exact_brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def near_brute(rows, width, percent=80):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append(frozenset(zip(*(w[i:] for i in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else []))
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((d, len(sets[i]), smallest[top(i)], smallest[top(i)] == d) for i, (d, _) in enumerate(rows)), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("max_slots", [bloom.MAX_SLOTS, 1 << 16])
def test_exact_odd(odd_docs, odd_rows, max_slots):
    assert collected(exact_dedup.decisions(odd_docs, max_slots=max_slots)) == exact_brute([r[:2] for r in odd_rows])


def test_exact_given(given):
    docs = given("documents")
    assert collected(exact_dedup.decisions(docs)) == exact_brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_exact_empty(no_docs):
    assert exact_dedup.decisions(no_docs).collect() == []
    assert exact_dedup.kept_rows(no_docs).collect() == []


def test_exact_kept_rows(odd_docs):
    kept = exact_dedup.kept_rows(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r[0], (r[1] or "")[:9]) for r in kept.collect() if r[0] is not None) == [(0, "The quick"), (1, ""), (3, " \t\n "), (4, "the  QUIC"), (6, "word0 tai"), (7, "word0 tai"), (8, "one"), (9, "two words"), (10, "日本語の文章です。"), (11, "12345 !!!"), (12, "Der schne")]
    assert [r[1] for r in kept.collect() if r[0] is None] == ["nobody else has this"]


def test_filter_never_misses(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63, 5000)
    rows = [(int(k),) for k in [*keys, *keys[:500], *keys[:100]]] + [(None,)]
    df = spark.createDataFrame(rows, "k long").repartition(7)
    slots = bloom.slots_for(len(rows))
    twice = np.frombuffer(bloom.build(df, slots, repeats=True).value, np.uint8)
    once = np.frombuffer(bloom.build(df, slots, repeats=False).value, np.uint8)
    assert bloom.lookup(twice, keys[:500]).all() and bloom.lookup(once, keys).all()
    assert bloom.lookup(twice, keys[500:]).mean() < 0.2


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {v: v for e in edges for v in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    want = {(v, top(v)) for a, b in edges if a != b for v in (a, b)}
    assert {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("width", [2, 5])
def test_near_odd(odd_docs, odd_rows, width):
    assert collected(hyperminhash.groups(odd_docs, words_each=width)) == near_brute([r[:2] for r in odd_rows], width)


def test_near_chains_and_small_sets(make):
    """Families of drifting copies, where a bucket's first member is not linked with all others, and tiny texts."""
    rng = random.Random(5)
    rows = []
    for _ in range(3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(40):
            words[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    for _ in range(120):
        rows.append((len(rows), " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 7)))))
    assert collected(hyperminhash.groups(make(rows, "doc_id long, text string"), words_each=2)) == near_brute(rows, 2)


def test_near_given(given):
    docs = given("documents")
    assert collected(hyperminhash.groups(docs, words_each=2)) == near_brute([tuple(r) for r in docs.select("doc_id", "text").collect()], 2)


def test_near_empty(no_docs):
    assert hyperminhash.groups(no_docs).collect() == []
    assert hyperminhash.kept_rows(no_docs).collect() == []


def test_estimates_follow_jaccard():
    rng = np.random.default_rng(6)
    for j in (0.0, 0.5, 0.8, 0.95):
        got = []
        for _ in range(40):
            n = 600
            both = round(2 * n * j / (1 + j))
            x = np.sort(rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64))
            pick = rng.permutation(len(x))
            a, b = np.sort(x[pick[:n]]), np.sort(x[pick[n - both :]])
            got.append(float(hyperminhash.estimate(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None])[0]))
        assert abs(np.mean(got) - j) < 0.02
