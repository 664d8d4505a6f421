"""Decontamination and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import decontaminate, importance
from dugout.llm.words import TABLE, joined

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def hits(docs, items, window=10, coverage=1.0):
    """(words, hit places, items) of each document, by comparing all windows."""
    windows = {}
    for item, text in items:
        w = words_of(text)
        k = min(window, max(1, math.ceil(coverage * len(w))))
        for i in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for _, text in docs:
        w, places, found = words_of(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[i : i + k]))) is not None:
                    places |= set(range(i, i + k))
                    found |= {str(x) for x in own if x is not None}
        out.append((len(w), places, sorted(found)))
    return out


def judged_by_force(docs, items, **how):
    return [(d, n, len(p), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(p)) for (d, _), (n, p, i) in zip(docs, hits(docs, items, **how))]


def little_texts(seed, n, least=0, most=60, letters="abc"):
    r = random.Random(seed)
    return [" ".join(r.choice(letters) for _ in range(r.randint(least, most))) for _ in range(n)]


@pytest.mark.parametrize("window, coverage, words_each", [(10, 1.0, 1 << 17), (4, 1.0, 50), (6, 0.5, 30), (3, 0.34, 1 << 17)])
def test_matches_small_alphabet(spark, make, rows, window, coverage, words_each):
    """Few different words: many overlapping matches, items inside items, several automata."""
    items = [(i % 17 if i % 5 else None, t) for i, t in enumerate(little_texts(1, 30, 0, 14))] + [(3, "b"), (4, "a a"), (99, None), (5, "!?")]
    docs = list(enumerate(little_texts(2, 60))) + [(100, None), (101, ""), (None, "a b c a"), (7, "b")]
    how = {"window": window, "coverage": coverage}
    got = decontaminate.matches(make(docs, "doc_id long, text string"), make(items, "item_id long, text string"), words_each=words_each, **how)
    want = [(d, n, len(p), i) for (d, _), (n, p, i) in zip(docs, hits(docs, items, **how))]
    assert sorted(map(repr, rows(got, "doc_id", "n_words", "n_hit", "items"))) == sorted(map(repr, want))


def test_matches_long_item(spark, make, rows, monkeypatch):
    """An item cut into segments loses no window."""
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 32)
    item = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(item[i : i + 10])) for i in range(0, 291, 7)] + [(1000, " ".join(item)), (1001, " ".join(item[:9]))]
    got = decontaminate.judged(make(docs, "doc_id long, text string"), make([(1, " ".join(item))], "item_id long, text string"))
    assert rows(got) == sorted(judged_by_force(docs, [(1, " ".join(item))]))


def test_decontaminate_odd_and_given(spark, make, rows, odd_docs, no_docs, odd_rows, given):
    items = [(1, "QUICK brown, fox jumps over the lazy dog and runs away!"), (2, "one"), (2, "one"), (None, "two words"), (3, "日本語の文章です")]
    table = make(items, "item_id long, text string")
    docs = [(i, t) for i, t, _ in odd_rows]
    assert sorted(map(repr, rows(decontaminate.judged(odd_docs, table)))) == sorted(map(repr, judged_by_force(docs, items)))
    none = make([], "item_id long, text string")
    assert decontaminate.judged(no_docs, table).count() == 0 and decontaminate.judged(no_docs, none).count() == 0
    assert {r["n_hit"] for r in decontaminate.judged(odd_docs, none).collect()} == {0}
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    items = [(r["item_id"], r["text"]) for r in given("benchmark").collect()]
    got = rows(decontaminate.judged(given("documents"), given("benchmark")))
    assert got == sorted(judged_by_force(docs, items)) and any(r[5] for r in got)


def test_cleaned(spark, make, rows, odd_docs, no_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    filler = " ".join(f"f{i}" for i in range(40))
    docs = make([(1, f"Ünï {filler}, [Alpha-beta gamma delta epsilon zeta eta theta iota kappa LAMBDA]. End"), (2, item), (3, filler), (4, None), (None, f"{filler}")], "doc_id long, text string")
    out = decontaminate.cleaned(docs, make([(1, item)], "item_id long, text string"))
    assert out.columns == docs.columns
    assert rows(out, "doc_id", "text") == sorted([(1, f"Ünï {filler}, []. End"), (3, filler), (4, None), (None, filler)], key=lambda r: (r[0] is not None, r[0] or 0))
    assert decontaminate.cleaned(no_docs, make([(1, item)], "item_id long, text string")).count() == 0


def ngrams(text):
    w = words_of(text)
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def scores_by_force(docs, target, buckets=10_000, percent=5, least_words=20, seed=42):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for have, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            have.update(map(bucket, ngrams(text)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * float(big_s + buckets) / ((s[b] + 1.0) * float(big_t + buckets))))
    out, enough = [], []
    for doc_id, text in docs:
        w, f = ngrams(text)
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, len(w)])
        if len(w) >= least_words:
            enough.append(out[-1])
    enough.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(enough[: percent * len(enough) // 100], 1):
        r[4] = rank
    return [tuple(r) for r in out]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 511, 512, 513, 514, 515, 516, 1024, 1025, 2600])
def test_folded_crc(size):
    data = bytes(random.Random(size).randrange(256) for _ in range(size))
    assert importance.folded(data) == zlib.crc32(data)


def test_block_features():
    """CRC of every feature of several parts, with words longer than the table and shared words at block ends."""
    texts = ["a bc def", "x", None, "", "long " + "q" * 700 + " tail " + "r" * 300 + " " + "s" * 300 + " end", "Ünï日本 Text"] + little_texts(3, 40, 0, 900, ["ab", "c", "def"])
    for size in (1, 64, 1 << 17):
        old, importance.BLOCK_BYTES = importance.BLOCK_BYTES, size
        try:
            got = [Counter() for _ in texts]
            for block in importance._blocks(iter(texts)):
                crc, place = block.features()
                for c, p in zip(crc.tolist(), place.tolist()):
                    got[block.rows[p]][c] += 1
        finally:
            importance.BLOCK_BYTES = old
        assert got == [Counter(zlib.crc32(f.encode()) for f in ngrams(t)[1]) for t in texts]


def test_words():
    text = "Az09 _x\x00é\x7f日本-B c"
    assert joined(text).decode().split(" ") == words_of(text) and len(TABLE) == 256


def test_scores_given(given, rows):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    target = [r["text"] for r in given("benchmark").collect()]
    got = rows(importance.scores(given("documents"), given("benchmark")))
    same(got, scores_by_force(docs, target))
    assert sum(r[4] is not None for r in got) > 0


def test_scores_odd(spark, make, odd_docs, no_docs, odd_rows, rows):
    target = make([("the quick brown fox",), (None,), ("",)], "text string")
    docs = [(i, t) for i, t, _ in odd_rows]
    how = {"percent": 60, "least_words": 2, "buckets": 97}
    same(rows(importance.scores(odd_docs, target, **how)), scores_by_force(docs, ["the quick brown fox"], **how))
    assert importance.scores(no_docs, target).count() == 0
    nothing = make([], "text string")
    same(rows(importance.scores(odd_docs, nothing)), scores_by_force(docs, []))


def test_ranks_with_ties(spark, make, rows):
    """A third of all rows is one repeated row; ranks are gapless and in order."""
    docs = [(7, "same words again and again")] * 100 + [(i, f"other words number {i}") for i in range(200)] + [(None, "same words again and again")] * 3
    table = make(docs, "doc_id long, text string").repartition(7)
    how = {"percent": 50, "least_words": 1}
    same(rows(importance.scores(table, make([("words",)], "text string"), **how)), scores_by_force(docs, ["words"], **how))


def test_resampled(spark, make, rows, odd_docs):
    target = make([("the quick brown fox",)], "text string")
    how = {"percent": 50, "least_words": 1}
    drawn = importance.resampled(odd_docs, target, **how)
    want = importance.scores(odd_docs, target, **how).where("rank is not null")
    assert drawn.columns == odd_docs.columns
    assert rows(drawn.select("doc_id")) == rows(want.select("doc_id")) and drawn.count() == np.floor(0.5 * importance.scores(odd_docs, target, **how).where(F.col("n_words") >= 1).count())
