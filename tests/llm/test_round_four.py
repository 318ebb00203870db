"""Findings of round three, text operators."""

import cProfile
import pstats
import random
import re

import numpy as np
import public_tokenizers
import pytest

from loamgrid.llm import bpe, toxicity


def test_toxicity_learns_every_run_of_its_sample(spark):
    r = random.Random(4)
    rows = [("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=60_000)), i % 2, False) for i in range(20)]
    runs, counts = toxicity._counts(spark.createDataFrame(rows, "text string, toxic int, unseen boolean"))
    letters = [np.concatenate([np.zeros(5, np.int64), np.frombuffer(t.encode(), np.uint8).astype(np.int64) - 96]) for t, *_ in rows]
    own = np.unique(np.concatenate([sum(x[1 + j : len(x) - 4 + j] << 6 * (4 - j) for j in range(5)) for x in letters]))
    assert len(own) > 1 << 20 and np.array_equal(runs, own)
    logs, histories, backs = toxicity.log_models(runs, counts)
    model = toxicity.Models(runs.astype(np.int32), (logs[1] - logs[0]).astype(np.float32), histories.astype(np.int32), (backs[1] - backs[0]).astype(np.float32))
    asked = np.concatenate([model.runs[::1000], model.runs[::1000] ^ 63, np.arange(0, 1 << 30, 1 << 20, dtype=np.int32)])
    ratio, back = dict(zip(model.runs.tolist(), model.ratio.tolist(), strict=True)), dict(zip(model.histories.tolist(), model.back.tolist(), strict=True))
    assert toxicity._Lookup(model)[asked].tolist() == [ratio.get(x, back.get(x >> 6, 0.0)) for x in asked.tolist()]


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return bpe.Codec(f.read())


def test_bpe_new_words_are_walked_together(codec):
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("aeiourstln", k=r.randint(4, 14))) + r.choice(["", ",", ".%%%"]) for _ in range(1000)) for _ in range(20)]
    codec.forget()
    profile = cProfile.Profile()
    got = profile.runcall(codec.encode, texts)
    assert pstats.Stats(profile).total_calls < 3 * 20_000  # the walk of one word after the other made over 20 calls a word
    assert got == [x.ids for x in codec.library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("wide", [1, 6, 64])
def test_bpe_both_walks_and_odd_words(codec, monkeypatch, wide):
    monkeypatch.setattr(bpe, "WIDE", wide)
    r = random.Random(wide)
    letters = ["a", "e", "n", "t", "h", "s", "'", "\u00e9", "\u4e2d", "\U0001f600", "1", "\u0661", "\0", ".", "-", "\uffff", "\u0378"]
    texts = ["".join(r.choice([*letters[:6], r.choice(letters), r.choice([" ", ""])]) for _ in range(r.randint(0, 90))) for _ in range(3000)]
    texts += ["", "\uffff", "\uffffbc", "x" * 63 + " " + "x" * 64 + " " + "x" * 65, "<|endoftext|>\uffffb<|startoftext|>", "ab\0 ab ab\0\0", "\u4e2d" * 40, "\u2003\x85\u3000a\xa0b", "\x1c\x1d"]
    for part in (texts[::2], texts[1::2], texts):
        codec.forget()
        assert codec.encode(part) == [x.ids for x in codec.library.encode_batch(part, add_special_tokens=False)]
    assert codec.encode([]) == []


def test_bpe_words_are_split_as_the_pattern_says():
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00e9]+|[0-9]|[^\sa-z\u00e90-9]+")
    r = random.Random(2)
    for letters in ("'stremvld ", "''sl1. ", "'\u00e9lve-2 "):
        for _ in range(3000):
            text = "".join(r.choices(letters, k=r.randint(0, 12)))
            data, starts, ends = bpe.pieces(text)
            assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == pattern.findall(text)


def test_bpe_pairs_that_share_a_place_are_worked_out_again(codec, monkeypatch):
    monkeypatch.setattr(bpe, "PAIRS", 4)
    r = random.Random(9)
    texts = [" ".join("".join(r.choices("aeinrst", k=r.randint(2, 12))) for _ in range(50)) for _ in range(20)]
    codec.forget()
    assert codec.encode(texts) == [x.ids for x in codec.library.encode_batch(texts, add_special_tokens=False)]
