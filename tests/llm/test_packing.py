"""Token pieces and their packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import corpus, documents, odd  # noqa: F401

from commutewell.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_rank_file_gives_the_ids_of_the_tokenizer(tokenizer):
    rng, encode = random.Random(3), packing.encoder()
    parts = ["a", "b", " ", "\n", "\t", "<|endoftext|>", "é", "ß", "😀", "1", "23", "'s", "  ", "!", "...", "中", "Hello", "it's", "<|"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert packing.token_ids(encode, text).tolist() == want


@pytest.mark.parametrize(("n", "want"), [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (19, [(0, 3), (3, 8), (11, 8)])])
def test_only_longer_documents_are_cut(n, want):
    assert packing.cuts(n, 8) == want


def check(docs, rows, capacity=32):
    got = packing.pack(docs, capacity=capacity, block_items=40).collect()
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    tokens = sum(r.length for r in got)
    encode = packing.encoder()
    ids = {(i, t): packing.token_ids(encode, t) for i, t in rows}
    assert tokens == sum(len(ids[i, t]) for i, t in rows)
    for i, t in rows:
        if i is not None and [x for x, _ in rows].count(i) == 1:
            mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
            assert mine == [
                (k, a, n, zlib.crc32(ids[i, t][a : a + n].astype("<u4").tobytes())) for k, (a, n) in enumerate(packing.cuts(len(ids[i, t]), capacity))
            ]
    return len(places), -(-tokens // capacity)


def test_every_piece_has_its_place(documents, corpus):
    used, least = check(documents([(i, t, None, None, None) for i, t in corpus]), corpus)
    assert used <= 1.01 * least


def test_odd_rows_and_empty_table(odd):
    check(odd, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack(odd.limit(0)).count() == 0


def test_breeding_improves_on_best_fit_and_loses_nothing():
    rng = random.Random(2)
    sizes = [rng.randint(600, 1100) for _ in range(800)]
    first = packing.founders(sizes, 2048, rng)
    last = packing.bred(first, sizes, 2048, rng)
    assert len(last[0]) <= len(first[0])
    for bins in last:
        assert sorted(i for b in bins for i in b) == list(range(800))
        assert max(sum(sizes[i] for i in b) for b in bins) <= 2048


def test_crossover_injects_whole_bins():
    rng = random.Random(1)
    sizes = list(np.random.default_rng(1).integers(1, 50, 60))
    a = packing.best_fit(range(60), sizes, [], 64)
    b = packing.best_fit(range(59, -1, -1), sizes, [], 64)
    child = packing.crossover(a, b, sizes, 64, rng)
    assert sorted(i for bin_ in child for i in bin_) == list(range(60))
    assert any(set(x) <= set(y) for x in b for y in child)
