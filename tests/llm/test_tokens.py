"""Encoding, chunk reuse, packing and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from dugout.llm import bpe_chunks, dac, packing
from dugout.llm.tokens import default_tokenizer, encoder

MARKS = ["a", "b", "Z", " ", "  ", "\n", "\t", "'s", "'ll", "9", "½", "!", "…", "é", "ß", "中", "文", " ", "　", "\x1c", "\x85", " ", "<|endoftext|>", "<|endo", "😀", "‍", "é", "٣", "ª", "²", "\r\n", " the", "tion"]


def random_texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(MARKS, k=rng.randrange(most))) for _ in range(n)]


def test_encoder_equals_library(library):
    enc = encoder(default_tokenizer())
    for text in random_texts(1, 4000, 16):
        ids = library.encode(text, add_special_tokens=False).ids
        assert enc.ids(text).tolist() == ids, text
        assert enc.text_bytes(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False).encode(), text


def test_decoder_of_any_ids(library):
    enc, rng = encoder(default_tokenizer()), np.random.default_rng(2)
    for _ in range(500):
        ids = rng.integers(0, 50_257, 12)
        assert enc.text_bytes(ids) == library.decode(ids.tolist(), skip_special_tokens=False).encode()


def test_chunks_rejoin_exactly(plain_ids):
    """Pieces cut anywhere, each encoded alone, are repaired to the ids of the whole."""
    enc, rng = encoder(default_tokenizer()), random.Random(3)
    joiner = bpe_chunks.Joiner(enc)
    for text in [*random_texts(4, 400, 60), "x" * 900, "tion tion " * 90, "中文" * 200]:
        cuts = sorted(rng.sample(range(len(text) + 1), min(6, len(text))))
        joiner.clear()
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            joiner.add(enc.ids(text[a:b]))
        assert joiner.ids[: joiner.n].tolist() == plain_ids(text), text


def test_chunks_are_content_defined():
    rng = random.Random(5)
    shared = " ".join(f"w{rng.randrange(10**5)}" for _ in range(2000))
    one, two = bpe_chunks.chunks(("start é " + shared).encode()), bpe_chunks.chunks(("quite another beginning " + shared + " end").encode())
    assert b"".join(one).decode() == "start é " + shared
    assert len(set(one) & set(two)) > 0.9 * len(one)
    assert all(c.decode() for c in bpe_chunks.chunks(("é中" * 9000).encode()))


def digests(rows, plain_ids, library):
    out = []
    for i, t in rows:
        ids = plain_ids(t)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_bpe_round_trip(odd_docs, odd_rows, plain_ids, library):
    assert sorted((tuple(r) for r in bpe_chunks.round_trip(odd_docs).collect()), key=str) == digests([r[:2] for r in odd_rows], plain_ids, library)


def test_bpe_round_trip_given(given, plain_ids, library):
    docs = given("documents")
    assert sorted((tuple(r) for r in bpe_chunks.round_trip(docs).collect()), key=str) == digests([tuple(r) for r in docs.select("doc_id", "text").collect()], plain_ids, library)


def test_bpe_empty(no_docs):
    assert bpe_chunks.round_trip(no_docs).collect() == []


def check_pieces(pieces, rows, plain_ids):
    want = sorted((i, tuple([*plain_ids(t), packing.END_ID])) for i, t in rows)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == members[0]["tier"] <= 1024 and at & (at - 1) == 0  # no padding at all
    docs = {}
    for i, ids in want:
        docs.setdefault((i, len(ids)), []).append(ids)
    covered = {}
    for p in pieces:
        key = (p["doc_id"], p["doc_tokens"])
        crcs = {zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for ids in docs[key]}
        assert p["ids_crc32"] in crcs
        covered[key] = covered.get(key, 0) + p["length"]
    assert covered == {k: k[1] * len(v) for k, v in docs.items()}


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_packing(odd_docs, odd_rows, plain_ids, block):
    rows = [r[:2] for r in odd_rows if r[0] is not None]
    check_pieces(packing.pack(odd_docs.where("doc_id is not null"), block_tokens=block, step_tokens=2048).collect(), rows, plain_ids)


def test_packing_given(given, plain_ids):
    docs = given("documents")
    pieces = packing.pack(docs).collect()
    check_pieces(pieces, [tuple(r) for r in docs.select("doc_id", "text").collect()], plain_ids)
    steps = {}
    for p in pieces:
        steps[p["step_group"]] = steps.get(p["step_group"], 0) + p["length"]
    assert max(steps.values()) <= 1 << 15


def test_packing_null_ids_and_empty(odd_docs, no_docs):
    assert packing.pack(odd_docs.where("doc_id is null")).select("doc_id").distinct().collect()[0][0] is None
    assert packing.pack(no_docs).collect() == []


def test_windows_route_to_the_smallest_tier():
    pool = packing.Pool()
    for i, n in enumerate((700, 300, 300, 100, 20, 5)):
        pool.add(n, i, 0)
    made = list(packing.windows(pool, True))
    assert sum(size for size, _ in made) == 1425
    assert made[0][0] == 1024 and made[0][1][0][0] == 700 and made[0][1][1][0] == 300


def test_codes_give_any_token():
    rng = np.random.default_rng(8)
    for n in (1, 8, 511, 512, 513, 5000):
        for most in (3, 256, 50_257, 1 << 20):
            ids = rng.integers(0, most, n).astype(np.uint32)
            data = dac.packed(ids)
            segment = dac.Segment(lambda at, size, data=data: data[at : at + size])
            assert (segment.tokens(0, n) == ids).all()
            for i in rng.integers(0, n, 10).tolist():
                assert segment.token(i) == ids[i]
                low = int(rng.integers(0, i + 1))
                assert (segment.tokens(low, i + 1) == ids[low : i + 1]).all()


def check_files(got, rows, plain_ids):
    """Documents in ascending order of their ids, null first, without gaps; ties in any order."""
    ids = [(i, [*plain_ids(t), dac.END_ID]) for i, t in rows]
    want = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids]
    assert sorted(((r[0], r[2], r[3]) for r in got), key=str) == sorted(want, key=str)
    at = 0
    in_order = sorted(got, key=lambda r: r[1])
    for _, start, n, _ in in_order:
        assert start == at
        at += n
    keys = [(r[0] is not None, r[0] or 0) for r in in_order]
    assert keys == sorted(keys)


@pytest.mark.parametrize("block", [dac.BLOCK, 3])
def test_token_files(odd_docs, odd_rows, plain_ids, monkeypatch, block):
    monkeypatch.setattr(dac, "BLOCK", block)
    check_files([tuple(r) for r in dac.round_trip(odd_docs).collect()], [r[:2] for r in odd_rows], plain_ids)


def test_token_files_tell_their_documents(spark, make, plain_ids):
    """Many rows of one id and many without an id are dealt over several files; what comes back is in the files."""
    rows = [(7, f"text {i % 5}") for i in range(300)] + [(None, f"none {i}") for i in range(300)] + [(i, "x") for i in range(100)]
    root, files = dac.write(make(rows, "doc_id long, text string").repartition(5))
    check_files([tuple(r) for r in dac.read(root, files).collect()], rows, plain_ids)
    assert files.columns == ["file_no", "file"] and files.count() > 1
    sizes = [b - a for (_, a, _), (_, b, _) in zip(dac.layout(root, files), dac.layout(root, files)[1:])]
    assert max(sizes) < 2 * sum(len(plain_ids(t)) + 1 for _, t in rows) / 3


def test_token_files_given(given, plain_ids):
    docs = given("documents")
    root, index = dac.write(docs)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check_files([tuple(r) for r in dac.read(root, index).collect()], rows, plain_ids)
    whole = [i for _, t in sorted(rows) for i in [*plain_ids(t), dac.END_ID]]
    for at in (0, 17, len(whole) // 2, len(whole) - 1):
        assert dac.token_at(root, index, at) == whole[at]
    with pytest.raises(IndexError):
        dac.token_at(root, index, len(whole))


def test_token_files_empty(no_docs):
    assert dac.round_trip(no_docs).collect() == []
