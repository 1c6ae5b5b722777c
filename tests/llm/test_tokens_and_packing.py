import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from labelnet.llm import id_coder, packing, tokens

from .fixture import empty, frame, rows

BYTE, WORD = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("word_bpe_49k.json")


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,lead", [(BYTE, True), (WORD, False)])
def test_word_cache_gives_the_librarys_ids(path, lead):
    texts = [r[1] for r in rows()] + [" ", "  a", "a  b", "a   b\n\n c", " a", "a ", "x\n y", "x \ny", "I'll ' s", "é a ̈x",
                                      "ΑΣ Σ İ", "\x1c a\x1d b \x85 c", "tab\t\tz",
                                      "hello <|endoftext|> world", "a<|ENDOFTEXT|>b", "<|startoftext|>x <|endoftext|>", "<|endof text|> <|"]
    one, want = library(path), []
    cache = tokens.WordCache(path, lead, max_words=50)       # small: it forgets in between
    for _ in range(2):
        ids, offs = cache.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[offs[i]:offs[i + 1]].tolist() == one(t), t
    ids, offs = cache.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and offs.tolist() == [0]


def test_knapsack_is_the_best_filling():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lens = np.unique(rng.integers(1, 12, 5))
        price = rng.random(len(lens))
        best = np.zeros(21)
        for c in range(1, 21):
            best[c] = max([best[c - 1]] + [best[c - n] + p for n, p in zip(lens, price) if n <= c])
        value, counts = packing.best_filling(price, lens, 20)
        assert abs(value - best[20]) < 1e-9 and abs(counts @ price - value) < 1e-9 and counts @ lens <= 20


def test_linear_program_reaches_its_bound():
    lens, need = np.array([3, 5, 7, 16]), np.array([40.0, 30.0, 20.0, 4.0])
    got = packing.solve(lens, need, 32, 0.0)
    assert all(c @ lens <= 32 for c, _ in got)
    assert np.allclose(sum(c * x for c, x in got), need)
    assert sum(x for _, x in got) <= 1.05 * (lens @ need) / 32


@pytest.mark.parametrize("size,bins", [(1024, 64), (32, 8)])
def test_packing_puts_every_id_in_one_piece_without_padding(spark, size, bins):
    out = packing.pack(frame(spark), BYTE, size=size, bins=bins).collect()
    one = library(BYTE)
    want = sorted((-1 if r[0] is None else r[0], zlib.crc32(np.array(one(r[1]) + [0], "<u4").tobytes())) for r in rows())
    by = {}
    for r in rows():
        by.setdefault(r[0], []).append(np.array(one(r[1]) + [0], "<u4"))
    for d, docs in by.items():
        mine = [r for r in out if r.doc_id == d]
        assert sum(r.length for r in mine) == sum(map(len, docs))
        for r in mine:
            assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in docs)
        if len(docs) == 1:
            at = 0
            for r in sorted(mine, key=lambda r: r.start):
                assert r.start == at
                at += r.length
    assert len(want) == len(rows())
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == size or (at < size and at & (at - 1) == 0)


def test_packing_of_nothing(spark):
    assert packing.pack(empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("n,high", [(0, 9), (1, 9), (2047, 5), (2048, 49408), (2049, 300), (9000, 2)])
def test_coder_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    f0 = id_coder.order0(ids, 49408)
    assert f0.min() >= 1 and f0.sum() == id_coder.TOTAL0
    crcs, parts = id_coder.encode(ids, f0)
    assert np.array_equal(id_coder.decode(n, f0, crcs, parts), ids)
    if n > 2048:                                             # repeats cost little, and damage is found
        assert sum(map(len, parts)) < n * 2
        bad = [bytes([parts[0][0] ^ 255]) + parts[0][1:]] + parts[1:]
        with pytest.raises((ValueError, IndexError)):
            id_coder.decode(n, f0, crcs, bad)


def test_coder_learns_within_a_block():
    """Ids with followers that come up again only after some 800 others: blocks of 512 ids never see one twice."""
    rng = np.random.default_rng(0)
    ids = np.concatenate([np.tile(rng.permutation(49408)[:800], 10) for _ in range(8)]).astype(np.uint32)
    f0 = id_coder.order0(ids, 49408)
    crcs, parts = id_coder.encode(ids, f0)
    assert np.array_equal(id_coder.decode(len(ids), f0, crcs, parts), ids)
    assert sum(map(len, parts)) < 1.2 * len(ids)


def test_token_files(spark):
    out = id_coder.round_trip(frame(spark), WORD).collect()
    one = library(WORD)
    want = sorted(((r[0] is not None, r[0] or 0), r[1] is not None, r[1] or "") for r in rows())
    at = 0
    for (key, _, text), r in zip(want, sorted(out, key=lambda r: r.start)):
        ids = np.array(one(text) + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key[1] if key[0] else None, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert id_coder.round_trip(empty(spark), WORD).count() == 0
