"""Sorting and anchors of the substring dedup: many small groups without Python steps, long prefixes by tries."""

import random

import numpy as np
import pytest

from loamgrid.llm import deepshallow, substring


def _sorted(texts, lead):
    buffer, length = np.frombuffer(b"".join(texts) + bytes(8), np.uint8), np.array([len(t) for t in texts])
    order, new = deepshallow.sort(buffer, np.cumsum(length) - length, length, np.array(lead, np.uint64))
    got = [(int(lead[i]), texts[i]) for i in order]
    assert got == sorted(zip(lead, texts, strict=True))
    assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


@pytest.mark.parametrize("bits", [24, 2])
def test_small_groups_take_no_trie(monkeypatch, bits):
    def refused(self, text, item):
        raise AssertionError("a trie for strings of 50 bytes")

    monkeypatch.setattr(deepshallow.Blind, "add", refused)
    monkeypatch.setattr(deepshallow, "GROUP_BITS", bits, raising=False)
    r = random.Random(5)
    stems = [bytes(r.choice(b"ab\0") for _ in range(44)) for _ in range(40)]
    texts = [r.choice(stems) + bytes(r.choice(b"ab\0") for _ in range(6)) for _ in range(900)]
    _sorted(texts, [r.randrange(3) for _ in texts])


def test_long_prefixes_and_strings_that_end_in_zeros():
    r = random.Random(6)
    stem = bytes(r.choice(b"ab\0") for _ in range(200))
    texts = [stem[: r.choice([0, 3, 24, 25, 30, 95, 96, 97, 100, 101, 199])] + bytes(r.choice(b"a\0") for _ in range(r.randint(0, 5))) for _ in range(600)]
    _sorted(texts, [r.randrange(2) for _ in texts])


def test_every_string_has_the_run_of_its_anchor():
    r = random.Random(7)
    texts = [bytes(r.choice(b"ab") for _ in range(n)) for n in (0, 49, 50, 0, 51, 300, 20, 120)] + [b"a" * 130, b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, first, last, h = substring.anchor_runs(np.frombuffer(b"".join(texts), np.uint8), offsets)
    places = [(d, p) for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist(), strict=True) for p in range(a, b + 1)]
    assert places == [(d, offsets[d] + p) for d, t in enumerate(texts) for p in range(len(t) - substring.LENGTH + 1)]
    hashes = {}
    for d, a, b, x in zip(doc.tolist(), first.tolist(), last.tolist(), h.tolist(), strict=True):
        for p in range(a - offsets[d], b + 1 - offsets[d]):
            assert hashes.setdefault(texts[d][p : p + substring.LENGTH], x) == x


def test_buckets_follow_the_order_of_hashes():
    h = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    for buckets in (1, 3, 4000):
        bucket = substring.bucket_of(h, buckets)
        assert (np.diff(bucket) >= 0).all() and bucket.min() == 0 and bucket.max() == buckets - 1 and np.unique(bucket).size > buckets / 2
