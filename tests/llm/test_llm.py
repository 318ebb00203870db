"""Every text operator against a brute-force version on small fixtures with nulls, empties, ties, repetitions and clashing columns."""

import collections
import hashlib
import html
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loamgrid.llm import bpe, chat, common, deepshallow, extract, fingerprint, jaccard, langid, maxscore, mixing, queries, substring, toxicity

WORD = re.compile(r"[^\x20\t-\r]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, chunk int, bucket int, h int"


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source) with further columns whose names operators use inside."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "x", 1, 2, 3) for r in rows], DOCS).repartition(3)


def corpus(seed=3, n=60):
    """Texts of few words with copies, near copies, shared passages, long and empty ones, nulls and a repeated id."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéü") for _ in range(r.randint(1, 7))) for _ in range(60)]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = text(30)
    base = text(120)
    rows = []
    for i in range(n):
        kind = i % 10
        body = text(r.randint(1, 80))
        if kind == 1:
            body = body + "\n" + passage + " " + text(5)
        if kind == 2:
            body = base
        if kind == 3:
            words = base.split(" ")
            words[r.randrange(120)] = "zzz"
            body = " ".join(words)
        if kind == 4:
            body = passage.upper() if r.random() < 0.5 else passage
        rows.append((i, body, "ab"[i % 2], f"s{i % 4}" if i % 7 else None))
    rows += [(100, None, None, None), (101, "", "a", "s0"), (102, " \n\t ", "a", "s0"), (103, "x" * 5000, "a", "s1"), (103, "other text of a repeated id", "a", "s1"), (104, " ".join(["one"] * 900), "b", "s2"), (105, "one two", "b", "s9")]
    return rows


def sets_of(rows, width):
    out = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append(frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    return out


# --- shared parts ----------------------------------------------------------------------------------------------------


def test_words_and_hashes_follow_the_pattern():
    texts = ["a b", "", None, "  x\n\ty ", "éé ü", "a b", " ", "long" * 999]
    data, offsets = common.utf8(pa.array(texts))
    starts, ends, bounds = common.words(data, offsets)
    raw = data.tobytes()
    got = [[raw[starts[k] : ends[k]].decode() for k in range(bounds[i], bounds[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h = common.range_hashes(data, starts, ends)
    flat = [w for x in got for w in x]
    assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def test_chunks_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 700, 3, 3)] + [None])], ["text"])
    parts = list(common.chunks(batch, "text", limit=6))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist() and len(parts) > 2


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)]
    up = {x: {x} for e in edges for x in e}
    for a, b in edges:
        whole = up[a] | up[b]
        for x in whole:
            up[x] = whole
    got = {x.node: x.component for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(v) for x, v in up.items() if len(v) > 1}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_deep_shallow_sort(seed):
    r = random.Random(seed)
    stem = bytes(r.choice(b"ab\0") for _ in range(60))
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(80)] + [stem[: r.randint(20, 60)] + bytes(r.choice(b"a\0") for _ in range(r.randint(0, 4))) for _ in range(120)]
    buffer = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    length = np.array([len(t) for t in texts])
    lead = np.array([r.randrange(2) for _ in texts], np.uint64)
    order, new = deepshallow.sort(buffer, np.cumsum(length) - length, length, lead)
    got = [(int(lead[i]), texts[i]) for i in order]
    keys = list(zip(lead.tolist(), texts, strict=True))
    assert got == sorted(keys)
    assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


# --- 1 chat ----------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_TURNS", 3)
    bad = ["</s>[INST] ok [/INST]", "a\\b\\-c\\\\", "[\\-INST]", None, "", "<<SYS>>é\n</s>", "<s" + "<s>>", "x" * 3000]
    rows = [(c, t, r, bad[(c + 3 * t) % len(bad)], 9) for c in range(6) for t, r in enumerate(["system", "user", "assistant", None, "assistant", "user", "assistant"][: c + 2])] + [(2, 1, "user", "tie", 9), (2, 1, "user", "tie", 9), (None, 0, "user", "n", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int").repartition(4)
    want = collections.defaultdict(list)
    for c, _, r, t, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or "", x[2] is not None, x[3] is not None, x[3] or "")):
        want[c].append((r or "", t or ""))
    got = {x.conv_id: x for x in chat.read_back(chat.format_chats(df)).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    pieces = chat.format_chats(df).collect()
    assert all(not any(m in chat.parse(p.formatted)[0][1] and m not in "".join(b or "" for b in bad) for m in chat.CONTROL) for p in pieces)
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


# --- 2 toxicity ------------------------------------------------------------------------------------------------------


def toxic_docs(seed, n=900):
    r = random.Random(seed)
    plain = ["".join(r.choice("aeiounst") for _ in range(r.randint(2, 5))) for _ in range(300)]
    vile = ["vileword", "nastyword", "foulword"]
    rows, marks = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(10, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(2 + len(words) // 20):
                words.insert(r.randrange(len(words)), r.choice(vile))
        rows.append((i, " ".join(words), "a", "s"))
        marks.append((i, int(bad)))
    return rows, marks


def test_toxicity_on_held_out_texts(spark):
    rows, marks = toxic_docs(1)
    rows += [(5000, None, None, None), (5001, "", "a", "s"), (5002, "!!!", "a", "s"), (5003, rows[0][1], "a", "s")]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([*marks, (5000, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training(docs, labels))
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got.values())
    held = [(got[i].predicted, y) for i, y in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in marks)
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert got[0].score == got[5003].score
    again = toxicity.fit(toxicity.training(docs.repartition(7), labels))
    assert np.allclose(again.ratio, model.ratio) and np.allclose(again.weights, model.weights)


def test_kneser_ney_against_dictionaries():
    r = random.Random(4)
    texts = ["".join(r.choice("ab cé1") for _ in range(r.randint(0, 60))) for _ in range(40)] + ["", "aaaa", "zz top"]
    toxic = [i % 3 == 0 for i in range(len(texts))]
    letters = lambda t: [int(x) for x in toxicity.LETTER[np.frombuffer(t.encode(), np.uint8)]]
    have = [collections.Counter(), collections.Counter()]
    for t, bad in zip(texts, toxic, strict=True):
        own = [0] * toxicity.GRAM + letters(t)
        runs = [tuple(own[i - toxicity.GRAM + 1 : i + 1]) for i in range(toxicity.GRAM, len(own)) if own[i] or own[i - 1]]
        have[bad].update(set(runs))
        got, _ = toxicity.grams(pa.array([t]))
        assert got.tolist() == [sum(x << 6 * (toxicity.GRAM - 1 - k) for k, x in enumerate(run)) for run in runs]
    continuation = [None] * toxicity.GRAM
    longer = set(have[0]) | set(have[1])
    continuation[-1] = {run: sum(run in x for x in have) for run in longer}
    for k in range(toxicity.GRAM - 1, 0, -1):
        continuation[k - 1] = collections.Counter(run[1:] for run in longer)
        longer = set(continuation[k - 1])
    d = toxicity.DISCOUNT

    def discounted(counts, history, letter, lower):
        after = {run[-1]: n for run, n in counts.items() if run[:-1] == history and n}
        total = sum(after.values())
        return (max(after.get(letter, 0) - d, 0) + d * len(after) * lower) / total if total else lower

    def shared(history, letter):
        return discounted(continuation[len(history)], history, letter, shared(history[1:], letter) if history else 1 / toxicity.SYMBOLS)

    p = lambda c, history, letter: discounted(have[c], history, letter, shared(history, letter))
    number = lambda run: sum(x << 6 * (len(run) - 1 - k) for k, x in enumerate(run))
    runs = sorted(continuation[-1], key=number)
    counts = np.array([[x[run] for run in runs] for x in have])
    logs, histories, backs = toxicity.log_models(np.array([number(x) for x in runs]), counts)
    for c in (0, 1):
        assert np.exp(logs[c]).tolist() == pytest.approx([p(c, x[:-1], x[-1]) for x in runs])
    for history in r.sample([x[:-1] for x in runs], 8) + [(0, 0, 0, 63)]:
        for c in (0, 1):
            assert sum(p(c, history, x) for x in range(toxicity.SYMBOLS)) == pytest.approx(1)
        if number(history) in histories:  # a letter that no class has after a history: the shared backoff cancels
            at = int(np.searchsorted(histories, number(history)))
            assert np.exp(backs[1, at] - backs[0, at]) == pytest.approx(p(1, history, 62) / p(0, history, 62))
    model = toxicity.Models(np.array([number(x) for x in runs], np.int32), (logs[1] - logs[0]).astype(np.float32), histories.astype(np.int32), (backs[1] - backs[0]).astype(np.float32))
    for t in ["ab c1", "unseen zz", "a" * 5000]:
        own = [0] * toxicity.GRAM + letters(t)
        events = [own[i - toxicity.GRAM + 1 : i + 1] for i in range(toxicity.GRAM, len(own)) if own[i] or own[i - 1]]
        mean = np.mean([np.log(p(1, tuple(x[:-1]), x[-1])) - np.log(p(0, tuple(x[:-1]), x[-1])) for x in events[:200]])
        assert toxicity.evidence(model, pa.array([t[: len(events[:200])]]))[0, 0] == pytest.approx(mean, abs=1e-4)


def test_toxicity_without_a_class(spark):
    docs = docs_of(spark, [(1, "a b", "a", "s")])
    assert toxicity.fit(toxicity.training(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))) is None
    assert toxicity.score(docs, None).first().score == 0.0
    assert toxicity.score(docs.limit(0), None).count() == 0


# --- 3 mixing --------------------------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 200, "b": 250 / 3, None: 500 / 3})
    assert mixing.targets({}) == {} and mixing.targets({"a": 0, "b": 10}) == {"a": 0, "b": 15}


def test_mixing(spark):
    rows = [(i, " ".join("w" * (1 + i % 30)), None, f"s{i % 5}" if i % 11 else None) for i in range(600)] + [(900, None, None, "s0"), (901, "", None, "s0")]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs, F.array("source")).collect()
    assert sorted(x.doc_id for x in got) == sorted(r[0] for r in rows)
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    by = collections.defaultdict(int)
    for i, _, _, s in rows:
        by[s] += size[i]
    want = mixing.targets(dict(by))
    taken = collections.defaultdict(int)
    source = {r[0]: r[3] for r in rows}
    for x in got:
        assert x["size"] == size[x.doc_id] and x.source_size == by[source[x.doc_id]] and x.target == pytest.approx(want[source[x.doc_id]])
        assert x.taken in (0, x["size"], 2 * x["size"])
        taken[source[x.doc_id]] += x.taken
    assert all(abs(taken[s] - want[s]) <= 30 for s in want)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(9), F.array("source")).collect()))
    assert mixing.mix(docs.limit(0), F.array("source")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_routes_cost_the_least(seed):
    """Every way to share a few words of overlapping patterns among the sources, against the flow."""
    import itertools
    import json

    r = random.Random(seed)
    patterns = {p: r.randint(1, 3) for p in ('["a"]', '["a","b"]', '["b"]')}
    quotas = {"a": float(r.randint(0, 6)), "b": float(r.randint(0, 6))}
    rows = mixing.route(patterns, quotas)
    given, own = collections.Counter(), collections.Counter()
    for pattern, k, source, words in rows:
        assert source in json.loads(pattern) and 0 <= words
        given[pattern, k] += words
        own[source] += words
    assert all(given[p, k] <= patterns[p] for p in patterns for k in (0, 1)) and all(own[x] <= quotas[x] for x in quotas)
    best = None
    choices = [range(2 * patterns['["a"]'] + 1), range(2 * patterns['["a","b"]'] + 1), range(2 * patterns['["a","b"]'] + 1), range(2 * patterns['["b"]'] + 1)]
    for a, ab_a, ab_b, b in itertools.product(*choices):
        use = {'["a"]': a, '["a","b"]': ab_a + ab_b, '["b"]': b}
        if any(use[p] > 2 * patterns[p] for p in use) or a + ab_a > quotas["a"] or b + ab_b > quotas["b"]:
            continue
        cost = sum(max(use[p] - patterns[p], 0) for p in use)
        best = min(best or (0, 0), (-sum(use.values()), cost))
    assert (-sum(given.values()), sum(n for (_, k), n in given.items() if k)) == best


def test_which_documents_are_taken(spark):
    """Documents in the order of their seeded hash, as often as their middle lies below what each pass gives."""
    rows = [(i, " ".join("w" * (1 + i % 9)), None, f"s{i % 3}") for i in range(120)]
    got = mixing.mix(docs_of(spark, rows), F.array("source")).collect()
    hashed = {x.doc_id: x.h for x in spark.createDataFrame([(i, f'["{s}"]', len(t.split())) for i, t, _, s in rows], "doc_id long, pattern string, size long").select("doc_id", F.xxhash64(F.lit(17), "doc_id", "pattern", "size").alias("h")).collect()}
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    quotas = mixing.targets(dict(sizes))
    for source in sizes:
        room = [min(sizes[source], round(quotas[source])), max(0, round(quotas[source]) - sizes[source])]
        order = sorted((hashed[i] % mixing.SLICES, hashed[i], i, len(t.split())) for i, t, _, s in rows if s == source)
        at = 0
        for *_, i, n in order:
            middle = at + n - n / 2
            at += n
            assert [x.passes for x in got if x.doc_id == i] == [sum(middle < k for k in room)]


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, None, None) for i in range(300)]
    docs = docs_of(spark, rows)
    member = F.when(F.col("doc_id") < 100, F.array(F.lit("a"))).when(F.col("doc_id") < 200, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b")))
    got = mixing.mix(docs, member, weights=(1,), share=0.75, repeats=2).collect()
    assert sum(x.taken for x in got) == pytest.approx(0.75 * 4000, abs=10) and max(x.passes for x in got) <= 2
    assert [r for r in mixing.route({'["a"]': 10}, {"a": 15.0}) if r[3]] == [('["a"]', 0, "a", 10), ('["a"]', 1, "a", 5)]


# --- 4 fingerprints ----------------------------------------------------------------------------------------------------


def test_followed(spark):
    rows = [r for r in corpus() if r[0] != 103] + [(-5, "é" * 7 + " first one here", "a", "s"), (999, "the last text has quite a few words in it", "a", "s")]
    docs = docs_of(spark, [*rows, (None, "no id", "a", "s")])
    rows = sorted((r[0], r[1] or "") for r in rows)
    got = {x.doc_id: x for x in fingerprint.followed(docs).collect()}
    assert set(got) == {i for i, _ in rows} | {None} and got[None].edited_sha256 == hashlib.sha256(("no " + rows[0][1][:2]).encode()).hexdigest()
    rows.append((None, "no id"))
    single = {x.doc_id: x.fingerprint for x in fingerprint.fingerprints(docs).collect()}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        kept = lambda f: {f[j : j + 16] for j in range(0, len(f), 16)}
        a, b, c = kept(got[i].fingerprint), kept(got[i].edited_fingerprint), kept(single[rows[(k + 1) % len(rows)][0]])
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert got[i].near_edited == pytest.approx(like(a, b)) and got[i].near_next == pytest.approx(like(a, c))
        assert got[i].fingerprint == single[i]
    texts = dict(rows)
    assert all((got[i].fingerprint == got[j].fingerprint) for i in texts for j in texts if texts[i] == texts[j])
    assert fingerprint.followed(docs.limit(0)).count() == 0
    alone = fingerprint.followed(docs_of(spark, [(1, "abcd", "a", "s")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_followed_keeps_rows_without_id_and_repeated_ones(spark):
    rows = [(2, "b two words"), (2, "a two words"), (2, "b two words"), (None, "z none"), (None, "y none"), (1, None), ((1 << 63) - 1, "the largest id")]
    got = sorted((x.doc_id is None, x.doc_id or 0, x.edited_sha256) for x in fingerprint.followed(docs_of(spark, [(i, t, "a", "s") for i, t in rows])).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    want = [(i is None, i or 0, hashlib.sha256((t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2]).encode()).hexdigest()) for k, ((i, _), t) in enumerate(zip(order, texts, strict=True))]
    assert got == sorted(want)


def test_fingerprints_against_sets(spark):
    """Which five-word runs a sketch keeps, by hashing each run on its own."""
    rows = [(i, t, *x) for i, (_, t, *x) in enumerate(corpus(n=60))]
    got = {x.doc_id: x.fingerprint for x in fingerprint.fingerprints(docs_of(spark, rows)).collect()}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        runs = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        own = sorted({int(common.text_shingles(pa.array([x]), 5)[0][0]) for x in runs})
        assert len(own) == len(runs)
        kept = [h for h in own if h < 1 << 62] or own[:1]
        assert got[i] == "".join(f"{h:016x}" for h in kept)


def test_merge_is_the_union(spark):
    texts = [(1, "a b c d e f g h", None, None), (2, "q r s t u v w x y z", None, None)]
    f = {x.doc_id: x.fingerprint for x in fingerprint.fingerprints(docs_of(spark, texts)).collect()}
    assert fingerprint.merge([f[1], f[1]]) == f[1] and fingerprint.merge([f[1], ""]) == f[1]
    value, _ = common.text_shingles(pa.array([t for _, t, *_ in texts]), 5)
    below = sorted(f"{v:016x}" for v in set(value.tolist()) if v < int(fingerprint.THRESHOLD))
    assert fingerprint.merge([f[1], f[2]]) == "".join(below) or not below


# --- 5 Jaccard join ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("rule", [jaccard.Rule(), jaccard.Rule(5, 80, 100), jaccard.Rule(2, 50, 100)])
@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join(spark, rule, small, monkeypatch):
    if small:
        for name, value in (("LEAF", 3), ("FANOUT", 2), ("STEP", 32), ("TILE", 3), ("TILE_SHINGLES", 200)):
            monkeypatch.setattr(jaccard, name, value)
    rows = corpus(n=120)
    own = sets_of(rows, rule.width)
    component = list(range(len(rows)))
    for _ in range(len(rows)):
        for a in range(len(rows)):
            for b in range(len(rows)):
                if own[a] and own[b] and rule.den * len(own[a] & own[b]) >= rule.num * len(own[a] | own[b]):
                    component[a] = component[b] = min(component[a], component[b])
        break
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if own[a] and own[b] and rule.den * len(own[a] & own[b]) >= rule.num * len(own[a] | own[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    smallest = {}
    for k, r in enumerate(rows):
        smallest[component[k]] = min(smallest.get(component[k], r[0]), r[0])
    want = sorted((r[0], len(own[k]), smallest[component[k]]) for k, r in enumerate(rows))
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in jaccard.join(docs_of(spark, rows), rule).collect())
    assert got == want


@pytest.mark.parametrize("tile", [3, 4096])
def test_jaccard_links(spark, tile, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = [r for r in corpus(n=120) if r[0] != 103]
    rule = jaccard.Rule(2, 50, 100)
    first = {}
    for r, own in zip(rows, sets_of(rows, 2), strict=True):
        if own:
            first[own] = min(first.get(own, r[0]), r[0])
    want = sorted((min(first[a], first[b]), max(first[a], first[b]), len(a & b)) for a in first for b in first if first[a] < first[b] and 2 * len(a & b) >= len(a | b))
    assert sorted(tuple(x) for x in jaccard.links(docs_of(spark, rows), rule).collect()) == want and want


def test_jaccard_edges(spark):
    docs = docs_of(spark, [(1, None, "a", "s"), (2, "", "a", "s"), (None, "a b c d e", "a", "s"), (4, "A b C d e", "a", "s")])
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.join(docs).collect()}
    assert got == {1: (0, 1), 2: (0, 2), None: (2, 4), 4: (2, 4)}
    assert jaccard.join(docs.limit(0)).count() == 0


def test_jaccard_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(103, a), (103, b), (50, a + " x"), (40, b + " x"), (200, "y " + a), (None, "z " + b), (None, "z " + b), (None, a + " n"), (None, "only here and nowhere else at all")]
    got = sorted((x.doc_id is None, x.doc_id or 0, x.component_id or 0) for x in jaccard.join(docs_of(spark, [(*r, None, None) for r in rows])).collect())
    assert got == [(False, 40, 40), (False, 50, 50), (False, 103, 40), (False, 103, 50), (False, 200, 50), (True, 0, 0), (True, 0, 40), (True, 0, 40), (True, 0, 50)]


@pytest.mark.parametrize("leaf, fanout, step", [(16, 16, 1 << 18), (3, 2, 32)])
def test_tree_joins_all_pairs_of_a_key(leaf, fanout, step, monkeypatch):
    for name, value in (("LEAF", leaf), ("FANOUT", fanout), ("STEP", step)):
        monkeypatch.setattr(jaccard, name, value)
    r = np.random.Generator(np.random.PCG64(5))
    base = r.integers(0, 1 << 63, 120, dtype=np.uint64)
    values = [np.unique(np.concatenate([r.choice(base, n, replace=False), r.integers(0, 1 << 63, 3, dtype=np.uint64)])) for n in r.integers(5, 115, 90)]
    rule, n = jaccard.Rule(4, 70, 100), np.array([len(v) for v in values])
    who = np.repeat(np.arange(90), 3)
    keys = r.integers(0, 12, len(who)).astype(np.uint64)
    points = np.stack([jaccard.point(v, 32) for v in values]).astype(np.int32)
    found = set()
    for a, b in jaccard.Tree(points[who], n[who], keys).pairs(rule, who, np.arange(90)):
        found |= {(min(p), max(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    near = lambda i, j: rule.enough(np.minimum(points[i], points[j]).sum(), n[i], n[j]) and n[i] * 100 >= n[j] * 70 and n[j] * 100 >= n[i] * 70
    own = {i: set(keys[who == i].tolist()) for i in range(90)}
    assert found == {(i, j) for i in range(90) for j in range(i + 1, 90) if own[i] & own[j] and near(i, j)} and found
    root = jaccard._edges_in(keys, who, [jaccard.point(v, 64).astype(np.int32) for v in values], n, rule)
    for i, j in found:
        if rule.enough(len(np.intersect1d(values[i], values[j])), n[i], n[j]):
            assert root[i] == root[j]


def test_tree_loses_no_pair():
    r = np.random.Generator(np.random.PCG64(1))
    base = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    values = [np.unique(np.concatenate([r.choice(base, n, replace=False), r.integers(0, 1 << 63, 5, dtype=np.uint64)])) for n in r.integers(5, 190, 150)]
    n = np.array([len(v) for v in values])
    rule = jaccard.Rule(4, 60, 100)
    tree = jaccard.Tree(np.stack([jaccard.point(v, 32) for v in values]), n)
    for i, v in enumerate(values):
        near = set(tree.near(tree.points[i], int(n[i]), rule).tolist())
        assert {j for j, w in enumerate(values) if rule.enough(len(np.intersect1d(v, w)), n[i], n[j])} <= near


# --- 6 html ----------------------------------------------------------------------------------------------------------


def test_article_text(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header>H</header><nav><ul><li>m</li></ul></nav><div class='ad'>Buy</div>"
        "<article><h1>Big &amp; small</h1><p>One\n two<br>three <b>four</b></p><p>&lt;x&gt; &copy;</p><div class='comments'><p>no</p></div><form><p>f</p></form></article><aside>s</aside><footer>F</footer></body></html>"
    )
    rows = [(1, "http://a.com/x/1", page), (2, "http://a.com/x/2", page), (3, None, None), (4, "odd", "plain <b>text"), (5, "http://b.com/", ""), (1, "http://a.com/x/1", page)]
    got = sorted((x.page_id, x.text, x.n_chars) for x in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    body = "Big & small\nOne two three four\n<x> ©"
    assert got == [(1, body, len(body)), (1, body, len(body)), (2, body, len(body)), (3, "", 0), (4, "plain text", 10), (5, "", 0)]
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_unmarked_templates_are_differenced(spark):
    make = lambda i: f"<div>Site name</div><div>Story number {i} is told</div><p>Only {i}</p><div>Imprint and terms</div>"
    rows = [(i, f"http://h{i % 3}.com/s/{i}", make(i)) for i in range(40)]
    got = {x.page_id: x.text for x in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == {i: f"Story number {i} is told\nOnly {i}" for i in range(40)}


PAGES = "page_id long, url string, html string"


def texts_of(spark, rows, n=5):
    return {x.page_id: x.text for x in extract.extract(spark.createDataFrame(rows, PAGES).repartition(n)).collect()}


@pytest.mark.parametrize("inside", ["{}", "<main>{}</main>", "<div id=content>{}</div>", "<div role='main'><div>{}</div></div>"])
def test_copied_pages_without_article(spark, inside):
    page = lambda *story: "<div>Site name</div>" + inside.format("".join(f"<p>{x}</p>" for x in story)) + "<div>Imprint and terms</div>"
    told = lambda i: (f"Story number {i} begins here and goes on", f"It ends with {i}")
    rows = [(i, f"http://h.com/s/{i:03}", page(*told(i))) for i in range(30)]
    rows += [(100 + i, f"http://h.com/s/007/copy{i:02}", page(*told(7))) for i in range(25)] + [(7, "http://h.com/s/007", page(*told(7)))]  # copies and a repeated row
    long = [f"Paragraph {k} of a long story with many words" for k in range(12)]
    rows += [(200 + i, f"http://h.com/t/{i}", page(*long, f"Edited {i}")) for i in range(3)]  # near copies
    quote = "A sentence that two stories quote"
    rows += [(300, "http://h.com/u/1", page("One story", quote)), (301, "http://h.com/u/2", page("Another story", quote)), (302, "http://h.com/u/3", page("A third"))]
    want = {i: "\n".join(told(i)) for i in range(30)} | {100 + i: "\n".join(told(7)) for i in range(25)} | {200 + i: "\n".join([*long, f"Edited {i}"]) for i in range(3)}
    want |= {300: f"One story\n{quote}", 301: f"Another story\n{quote}", 302: "A third"}
    assert texts_of(spark, rows) == want


def core(lines, own):
    return [x for x, k in zip(lines, own, strict=True) if k != "2"]


def brute_text(rows, k):
    """Text of row k by looking at all pages of the host."""
    lines, own = rows[k][3], rows[k][4]
    near = []
    for side, step in ((range(k - 1, -1, -1), -1), (range(k + 1, len(rows)), 1)):
        seen = [core(lines, own)]
        for j in side:
            if rows[j][0] != rows[k][0] or len(seen) > extract.WINDOW:
                break
            content = core(rows[j][3], rows[j][4])
            if content in seen:
                continue
            seen.append(content)
            shared = extract.shared_lines(lines, rows[j][3])
            if not extract.alike(lines, own, rows[j][3], rows[j][4], shared):
                near.append((-len(os.path.commonprefix([rows[j][1], rows[k][1]])), step, shared))
                break
    near.sort(key=lambda x: x[:2])
    gone = near[0][2] if near else set()
    gone = gone & near[1][2] if len(near) == 2 and gone & near[1][2] else gone
    return "\n".join(x for i, x in enumerate(lines) if own[i] == "1" or own[i] == "0" and i not in gone)


@pytest.mark.parametrize("seed, window", [(0, 8), (1, 2), (2, 1)])
def test_pairs_do_not_depend_on_runs(spark, seed, window, monkeypatch):
    monkeypatch.setattr(extract, "WINDOW", window)  # forked workers see it only where they start anew
    r = random.Random(seed)
    host = [(f"h{r.choice('abb')}", f"/{r.choice('xy')}/{r.randrange(60)}") for _ in range(150)]
    rows = []
    for i, (h, path) in enumerate(host):
        story = [f"{r.choice('pq')} tells {k}" for k in range(12)] if r.random() < 0.8 else [f"own {i} {k}" for k in range(r.randrange(3))]
        rows.append((i, f"http://{h}{path}", f"<nav>{r.choice('mn')}</nav>" + "".join(f"<p>{x}</p>" for x in ["Top", *(["pppp"] * 12 if r.random() < 0.5 else story), "End"])))
    cut_up = sorted((h, path, i, *extract.blocks(rows[i][2])) for i, (h, path) in enumerate(host))
    cut_up = [(h, f"{h}\n{path}", i, lines, own) for h, path, i, lines, own in cut_up]
    if window == 8:
        assert texts_of(spark, rows) == {x[2]: brute_text(cut_up, k) for k, x in enumerate(cut_up)}
    near, got = {}, {}
    for h, key, i, lines, own in cut_up:
        got |= {x[0]: x[2] for x in near.setdefault(h, extract._Neighbours()).add(extract.Page(key, hash(tuple(core(lines, own))), lines, own, (i, "")))}
    got |= {x[0]: x[2] for n in near.values() for x in n.end()}
    assert got == {x[2]: brute_text(cut_up, k) for k, x in enumerate(cut_up)}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><div class='post has-sidebar'>A</div><div class='layout-no-sidebar'>B</div><h2 id='search'>C</h2><section id='related-work'>D</section><section id=related>E</section></article>", "A|B|C|D|E"),
        ("<div class='post has-sidebar'><h2 class=header>A</h2><p>B</p></div>", "A|B"),
        ("<p>See <a href='/hidden-treasures'>these</a>, <a title='a hidden gem' data-id='share'>those</a> and <a data-class=ad aria-label='x hidden'>more</a></p>", "See these, those and more"),
        ("<main><div data-role=navigation title='style=display:none'>A</div><p class=notice>B <span class=share>C</span></p><div class='header'><h1>D</h1></div></main>", "A|B C|D"),
        ("<div><p class='notice'>no<p>A<p>B</div><p>C", "A|B|C"),
        ("<div><p class='notice'>no</div>A", "A"),
        ("<ul><li class=ad>no<li>A<ul><li class=share>no</ul>B<li>C</ul>D", "A|B|C|D"),
        ("<table><tr><td class=sidebar>no<td>A<tr><td class=ads>no</table>B", "A|B"),
        ("<head><meta charset=utf-8><title>t</title><body><p>A", "A"),
        ("<article><div class=ad>no<p>no</article><p>A</p>", "A"),
        ("<div class='sidebar left'><div>no</div>no</div><div class='site-header'>no</div><div id=cookie-banner>no</div><ul class='main-nav'><li>no</ul><div class='ad-slot-3'>no</div><span class=ads>no</span><p hidden>no</p><p aria-hidden=true>no<p style='DISPLAY : none'>no<p>A", "A"),
        ("<article><p>A</p><div id='comments'>no</div><ul class=share-buttons><li>no</ul><div class='related posts'>no</div><p>B</p></article>", "A|B"),
        ("<nav><ul><li>no<li>no</ul><p>no</nav>A<form><table><tr><td>no</form>B", "A|B"),
        ("<div class=related><article>no</div>A", "A"),
    ],
)
def test_only_containers_of_a_role_are_left_out(page, text):
    assert "|".join(core(*extract.blocks(page))) == text


def test_what_stands_in_a_line_of_text():
    page = '<article><p>In the <span class="share-price">42</span> share of <math>x+1</math> growth</p></article>'
    assert extract.blocks(page) == (["In the 42 share of x+1 growth"], "1")
    assert extract.blocks("<nav>a<ul><li>b</ul></nav><p>c<button>d</button>e<script>f</script>") == (["a", "b", "c", "d", "e"], "22020")


def test_lines_that_differencing_deletes(spark, data):
    page = lambda i, menu: f"<nav><p>Home</p><p>{menu}</p></nav><p>Our site</p><div class=content><p>Story {i}</p></div>"
    rows = [(i, f"http://h.com/{i:02}", page(i, f"Only here {i}")) for i in range(12)] + [(50 + i, f"http://h.com/03/{i}", page(3, f"Copy menu {i}")) for i in range(4)]
    got = {x.page_id: x for x in extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all((x.text, x.n_shared, x.n_named) == (f"Story {i if i < 50 else 3}", 2, 1) for i, x in got.items()) and len(got) == 16
    total = queries.op6_html_extraction(spark, data).agg(F.sum("n_shared"), F.sum("n_named")).first()
    assert total[0] > 0 and total[1] > 0


def test_many_pages_of_one_url(spark, monkeypatch):
    monkeypatch.setattr(extract, "RUN_BYTES", 400)
    make = lambda i: f"<div>Site name</div><div>Story {i} is told</div><div>Imprint</div>"
    rows = [(i, None if i % 2 else "http://h.com/same", make(i)) for i in range(80)] + [(None, None, make(99))]
    clashing = spark.createDataFrame([(*r, 7, "x", 1.5) for r in rows], PAGES + ", _run int, lines string, own double")
    got = {x.page_id: x.text for x in extract.extract(clashing).collect()}
    assert got == {i: f"Story {99 if i is None else i} is told" for i, *_ in rows}


def test_long_pages():
    a = [f"line {i % 700}" for i in range(3000)]
    b = a[:1000] + ["new"] * 50 + a[1100:]
    found = sorted(extract.shared_lines(a, b))
    rest = iter(b)
    assert len(found) >= 2900 and all(any(y == a[i] for y in rest) for i in found)


@pytest.mark.parametrize("seed", range(30))
def test_longest_common_subsequence(seed):
    r = random.Random(seed)
    a, b = [[r.choice("abcd") for _ in range(r.randint(0, 12))] for _ in range(2)]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = sorted(extract.shared_lines(a, b))
    rest = iter(b)
    assert len(found) == table[-1][-1] and all(any(y == a[i] for y in rest) for i in found)


@pytest.mark.parametrize("bit", ["<a ", '<a x="', "<a x='", "<", "</", "<!", "<!--", "<script ", "<a", "<a\t", "<title>", "<p class=", "<p <!", '<a "<a \'', "&amp", "<p>", "<div class='ad'>", "</p>"])
def test_broken_markup_is_read_in_linear_time(bit):
    page = "<p>first</p>" + bit * (1_000_000 // len(bit))
    start = time.perf_counter()
    lines, _ = extract.blocks(page)
    assert lines[0].startswith("first") and time.perf_counter() - start < 10


def test_pages_of_the_table(spark, data):
    rows = spark.read.parquet(f"{data}/pages.parquet").collect()
    got = {x.page_id: x.text for x in queries.op6_html_extraction(spark, data).collect()}
    for r in rows:
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>|<br>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)


def test_toxicity_models_are_bounded(spark):
    r = random.Random(3)
    rows = [("".join(r.choice("abcde ") for _ in range(r.randint(0, 60))), r.randint(0, 1), False) for _ in range(80)]
    labelled = spark.createDataFrame(rows, "text string, toxic int, unseen boolean")
    every, counts = toxicity._counts(labelled)
    for most in (0, 5, 50, len(every)):
        runs, n = toxicity._counts(labelled, most)
        assert len(runs) <= most and (np.diff(runs) > 0).all()
        least = n.sum(axis=0).min() if len(runs) else None
        assert len(runs) == (0 if least is None else (counts.sum(axis=0) >= least).sum())
        lower = [t for t in counts.sum(axis=0).tolist() if least is not None and t < least]
        assert not lower or (counts.sum(axis=0) >= max(lower)).sum() > most


# --- 7 top-k ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims, n", [(3, 40), (64, 300), (5, 4)])
def test_top_k(spark, dims, n, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK", 5)
    r = random.Random(dims)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, r.uniform(-1, 1)]) for _ in range(dims)], 1) for i in range(n)]
    odd = [(1000, None, 1), (1050, [None] * dims, 1), (1100, [float("nan")] * dims, 1), (1150, [float("inf")] * dims, 1), (1200, [], 1), (7, rows[-1][1], 1), (0, rows[-1][1], 1), (0, rows[0][1], 1), (0, rows[0][1], 1)]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int").repartition(3)
    floor = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in [*rows, *odd[-4:]]]
    want = []
    for q, v in floor:
        if q % 50 == 0:
            others = list(floor)
            others.remove((q, v))  # the query's own row, and none of another with its id
            best = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in others)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    got = [tuple(x) for x in maxscore.top_k(vectors, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(want)
    assert maxscore.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("seed, largest, kind", [(1, 1000, np.float64), (2, 10**6, np.float64), (3, 10**8, np.int64), (4, 6 * 10**8, np.int64)])
def test_search_is_exact(seed, largest, kind):
    r = random.Random(seed)
    for dims in (1, 7, 20):
        close = r.randint(-largest, largest)
        rows = [[r.choice([close, close + 1, r.randint(-largest, largest)]) for _ in range(dims)] for _ in range(60)]
        ids = [r.randrange(50) for _ in rows]
        matrix, own = np.array(rows, np.int64), np.array(ids, np.int64)
        for floors in (None, maxscore.first_floors(matrix[:20], 4)):
            found = maxscore.search(own, np.ascontiguousarray(matrix.T), own[:20], matrix[:20], 4, floors)
            product = lambda v, w: sum(x * y for x, y in zip(v, w, strict=True))
            want = [(at, i, s, i == ids[at] and s == product(v, v)) for at, v in enumerate(rows[:20]) for s, i in sorted(((product(v, w), i) for i, w in zip(ids, rows, strict=True)), key=lambda x: (-x[0], x[1]))[:4]]
            assert list(zip(*(x.tolist() for x in found), strict=True)) == want
    assert maxscore.kind_for(np.array([[largest]] * 2), np.array([[largest]])) is kind
    assert maxscore.kind_for(np.array([[largest] * 20]), np.array([[largest] * 20])) is (object if seed == 4 else kind)


def test_top_k_of_large_and_mixed_vectors(spark):
    r = random.Random(9)
    rows = [(i, [r.uniform(-(10**6), 10**6) for _ in range(3 + i % 2 * 5)]) for i in range(130)]
    steps = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    want = []
    for q, v in steps:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in steps if i != q and len(w) == len(v))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    frame = lambda x: spark.createDataFrame(x, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in maxscore.top_k(frame(rows), F.col("vec_id") % 50 == 0).collect()) == sorted(want)
    for bad in (1e17, 1e12):  # a component, then a score, that no long integer holds
        with pytest.raises(Exception, match="too large"):
            maxscore.top_k(frame([(0, [bad]), (1, [bad])]), F.col("vec_id") % 50 == 0).collect()


# --- 8 BPE -----------------------------------------------------------------------------------------------------------

PATH = "/opt/tokenizers/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def same(codec, library, texts):
    want = library.encode_batch(texts, add_special_tokens=False)
    got = codec.encode(texts)
    assert [g for g in got] == [w.ids for w in want]
    assert [codec.decode(g) for g in got] == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_bpe_every_character(codec, library):
    same(codec, library, [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000])


def test_bpe_random_and_special(codec, library):
    r = random.Random(1)
    letters = "aaaabbcdeeeehhiiinnnoorrsttttu'.- é1\n"
    same(codec, library, ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(5000)])
    same(codec, library, ["", " ", "<|endoftext|>", "x<|startoftext|><|endoftext|>y<|ENDOFTEXT|>", "ΑΣ ΣΑΣ", "İ", "word" * 3000, "\x1c \x1f a"])


def test_bpe_cache_starts_anew(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    same(codec, library, ["one two three four five six seven eight nine ten eleven twelve"] * 3)
    same(codec, library, ["thirteen fourteen", "fifteen sixteen seventeen eighteen nineteen twenty"])


def test_bpe_documents(spark, library):
    rows = corpus()
    got = sorted((x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in bpe.digest(docs_of(spark, rows), PATH).collect())
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert {x.doc_id for x in bpe.encode(docs_of(spark, rows), PATH).filter("size(token_ids) = 0").collect()} >= {100, 101, 102}
    assert bpe.digest(docs_of(spark, rows).limit(0), PATH).count() == 0


# --- 9 substring dedup -------------------------------------------------------------------------------------------------


def brute_removed(rows):
    first, out = {}, []
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("tiny", [False, True])
def test_substring_dedup(spark, seed, tiny, monkeypatch):
    if tiny:
        for name, value in (("CHUNK_TEXT", 2000), ("BUCKET_TEXT", 3000), ("SLICE", 1000), ("RUN_BYTES", 700)):
            monkeypatch.setattr(substring, name, value)
    rows = corpus(seed, 90)
    r = random.Random(seed)
    rows += [(200 + i, "".join(r.choice("ab") for _ in range(200)), None, None) for i in range(20)] + [(300, "ab" * 200, None, None), (301, "ba" * 200, None, None), (302, "e" * 49, None, None), (303, "e" * 51, None, None), (304, "e" * 50, None, None)]
    got = sorted(tuple(x) for x in substring.digest(docs_of(spark, rows)).collect())
    assert got == brute_removed(rows)


def test_substring_edges(spark):
    same_text = "q" * 30 + "some sixty bytes of text that stand in several documents here"
    rows = [(None, same_text, "a", "s"), (5, same_text, "a", "s"), (5, same_text, "a", "s"), (6, None, "a", "s"), (7, "", "a", "s")]
    got = {(x.doc_id, x.n_removed) for x in substring.digest(docs_of(spark, rows)).collect()}
    assert got == {(None, 0), (5, 0), (6, 0), (7, 0)}
    assert substring.digest(docs_of(spark, rows).limit(0)).count() == 0
    kept = {x.doc_id: (x.text, x.lang, x.n_chars) for x in substring.kept_texts(docs_of(spark, [(1, "é" * 60, "a", "s"), (2, "x" + "é" * 60 + "y", "b", "s"), (3, None, "c", "s")])).collect()}
    assert kept == {1: ("é" * 60, "a", 60), 2: ("xy", "b", 2), 3: (None, "c", 0)}
    clashing = docs_of(spark, rows).withColumns({"_chunk": F.lit("mine"), "_chunk_": F.lit(7)})
    assert {(x._chunk, x._chunk_) for x in substring.kept_texts(clashing).collect()} == {("mine", 7)}


def test_substring_ids_that_repeat_in_many_rows(spark, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_TEXT", 500)
    r = random.Random(6)
    shared = "".join(r.choice("abcdef") for _ in range(80))
    rows = [(5, "".join(r.choice("xyz") for _ in range(60)) + shared, None, None) for _ in range(30)] + [(9, "z" + shared + "z", None, None), (4, shared[:60], None, None)]
    rows += [(None, shared + str(i), None, None) for i in range(30)]
    got = sorted(tuple(x) for x in substring.digest(docs_of(spark, rows)).filter("doc_id is not null").collect())
    first = {}
    for i, t, *_ in rows:
        for k in range(len(t) - 49):
            if i is not None:
                first[t[k : k + 50]] = min(first.get(t[k : k + 50], i), i)
    want = []
    for i, t, *_ in rows:
        if i is not None:
            gone = {j for k in range(len(t) - 49) if first[t[k : k + 50]] < i for j in range(k, k + 50)}
            kept = "".join(x for j, x in enumerate(t) if j not in gone)
            want.append((i, len(t), len(gone), sum(j - 1 not in gone for j in gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert got == sorted(want)


# --- 10 language ID ----------------------------------------------------------------------------------------------------


def spoken(n=400):
    r = random.Random(4)
    parts = {"xx": ["tha", "ing", "ter", "oun"], "yy": ["éau", "oix", "que", "lle"], "zz": ["sch", "ung", "ich", "keit"]}
    return [(i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 60))), lang, "s") for i in range(n) for lang in [list(parts)[i % 3]]]


def test_language_on_held_out_texts(spark):
    rows = [*spoken(), (9000, None, "xx", "s"), (9001, "", None, "s"), (9002, "12 !? 3", "yy", "s"), (9003, "漢字" * 60, None, "s"), (9004, "tha", None, "s")]
    docs = docs_of(spark, rows)
    model = langid.fit(langid.training(docs), per_lang=60)
    got = {x.doc_id: x for x in langid.predict(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got.values())
    held = [got[i].lang_pred == lang for i, _, lang, _ in rows[:400] if got[i].held_out]
    assert sum(held) / len(held) > 0.99
    assert [got[i].lang_pred for i in (9000, 9001, 9002)] == ["und"] * 3 and got[9003].lang_pred in model.langs and got[9003].rejected
    stay = {x.doc_id for x in langid.keep_known(docs, model).collect()}
    assert stay == {r[0] for r in rows} - {9000, 9001, 9002, 9003}
    again = langid.fit(langid.training(docs.repartition(7)), per_lang=60)
    assert np.allclose(again.matrix, model.matrix)


def test_language_without_training(spark):
    docs = docs_of(spark, [(1, "abc", None, "s")])
    model = langid.fit(langid.training(docs))
    assert tuple(langid.predict(docs, model).select("lang_pred", "score", "rejected").first()) == ("und", 0.0, True)
    assert langid.keep_known(docs, model).count() == 1
    assert langid.predict(docs.limit(0), model).count() == 0


def test_language_against_plain_counting(spark):
    rows = spoken(90) + [(700, "tha tha", None, "s"), (701, None, None, "s"), (702, "tha " * 20000, None, "s")]
    docs = docs_of(spark, rows)
    model = langid.fit(langid.training(docs), per_lang=10_000, clusters=2)
    codes = langid._codes

    def vector(text):
        own = [int(x) for x in langid._letters[np.frombuffer((text or "").lower().encode(), np.uint8)]]
        tf = collections.Counter()
        for width, table in ((3, codes[:3]), (2, codes[3:])):
            for k in range(len(own) - width + 1):
                run = own[k : k + width]
                if run[:2] != [32, 32]:
                    slot = 0
                    for j, x in enumerate(run):
                        slot ^= int(table[j][x])
                    tf[slot] += 1
        return tf

    learned = [(lang, vector(t)) for i, t, lang, _ in rows if t is not None and lang and zlib.crc32(str(i).encode()) % 5]
    df = collections.Counter(slot for _, v in learned for slot in v)
    idf = {slot: np.log((1 + len(learned)) / (1 + df[slot])) + 1 for slot in range(langid.DIMS)}
    assert model.idf.tolist() == pytest.approx([idf[k] for k in range(langid.DIMS)], rel=1e-5)
    got = {x.doc_id: x for x in langid.predict(docs, model).collect()}
    for i, t, *_ in rows:
        own = {k: np.log1p(n) * idf[k] for k, n in vector(t).items()}
        norm = np.sqrt(sum(x * x for x in own.values())) or 1
        cosine = [sum(x / norm * float(center[k]) for k, x in own.items()) for center in model.matrix]
        if t is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        else:
            assert got[i].score == pytest.approx(max(cosine), abs=1e-4) and got[i].lang_pred == model.langs[model.owner[int(np.argmax(cosine))]]


def test_language_ties_go_to_the_first(spark):
    row = np.ones((1, langid.DIMS), np.float32) / np.sqrt(langid.DIMS)
    model = langid.Centroids(["aa", "bb"], np.array([0, 1]), np.ones(langid.DIMS, np.float32), np.concatenate([row, row]), 0.0)
    assert langid.label(model, pa.array(["some text"]))[0] == ["aa"]


# --- registry and pipeline ---------------------------------------------------------------------------------------------


def test_queries_are_registered():
    names = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES)
    assert names == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES) and all(isinstance(x, str) for x in queries.ORACLES.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, data, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    df = queries.QUERIES[name](spark, data)
    twin = con.sql(queries.ORACLES[name])
    order = [df.columns.index(c) for c in twin.columns]
    assert len(order) == len(df.columns)
    assert sorted(tuple(r[i] for i in order) for r in df.collect()) == sorted(twin.fetchall())


def test_pipeline_stages(spark, library, tmp_path):
    import corpus_pipeline

    rows = spoken(200)
    r = random.Random(8)
    rows += [(300 + i, rows[i][1], rows[i][2], "s2") for i in range(0, 40, 4)]
    passage = "".join(r.choice("thaingter ") for _ in range(120))
    rows += [(400 + i, spoken()[i + 200][1] + " " + passage, "xx", "s1") for i in range(8)] + [(500, None, None, "s1"), (501, "漢字漢字" * 30, None, "s1")]
    docs_of(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    now = docs
    kept = [now]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = common.cut(stage(spark, now, str(tmp_path)))
        assert now.columns == docs.columns
        kept.append(now)
    lang, near, cut_, mixed = [{x.doc_id: x.text for x in k.collect()} for k in kept[1:]]
    assert set(lang) == {x[0] for x in rows} - {500, 501}
    own = dict(zip([x[0] for x in rows], sets_of(rows, 5), strict=True))
    link = lambda a, b: own[a] and own[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])
    assert all(any(link(a, b) for b in lang if b < a) for a in set(lang) - set(near)) and not any(link(a, b) for a in near for b in near if a < b)
    assert set(cut_) == set(near)
    want = {x[0]: x[2] for x in brute_removed([(i, t) for i, t in near.items()])}
    assert all(len(near[i].encode()) - len(cut_[i].encode()) == want[i] for i in near)
    assert set(mixed) <= set(cut_)
    out = corpus_pipeline.STAGES[-1][1](spark, kept[-1], str(tmp_path)).collect()
    assert len(out) == kept[-1].count()
    assert all(x.token_ids == library.encode(mixed[x.doc_id], add_special_tokens=False).ids for x in out)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(out)


def test_pipeline_rows_without_an_id_of_their_own(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(5)
    text = lambda n=40: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    a, b, c, d, e = (text() for _ in range(5))
    # id 5 holds a copy of id 1 and a text of its own; 7 holds one text twice; rows without an id: a copy of id 1, two copies of d, one e
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, a), (None, d), (None, d), (None, e), (9, ""), (9, ""), (None, None)]
    docs = common.cut(docs_of(spark, [(i, t, "x", "s") for i, t in rows]).select(*corpus_pipeline.COLUMNS))
    near = common.cut(corpus_pipeline.one_of_each_group(spark, docs, ""))
    order = lambda x: sorted(x, key=repr)
    assert near.columns == docs.columns
    assert order((x.doc_id, x.text) for x in near.collect()) == order([(1, a), (5, b), (7, c), (None, d), (None, e), (9, ""), (9, ""), (None, None)])
    # one source takes 1.5 of its words: every row with words comes once or twice, ids or not
    many = [(None if i % 3 == 0 else i // 4, text(10)) for i in range(120)] + [(3, a)] * 4
    mixed = corpus_pipeline.mixed_sources(spark, common.cut(docs_of(spark, [(i, t, "x", "s") for i, t in many]).select(*corpus_pipeline.COLUMNS)), "").collect()
    times = collections.Counter((x.doc_id, x.text) for x in mixed)
    want = collections.Counter(many)
    assert set(times) == set(want) and all(want[k] <= n <= 2 * want[k] for k, n in times.items())
    words = sum(len(t.split()) * n for (_, t), n in times.items())
    assert abs(words - 1.5 * sum(len(t.split()) for _, t in many)) <= 60


def test_unfinished_components_are_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.component for r in common.components(path).collect()} == {0}
    with pytest.raises(RuntimeError, match="round 1"):
        common.components(path, rounds=1)


def test_pipeline_stages_are_parquet(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rows = [(i, f"text {i}", "a", "s") for i in range(5)]
    docs_of(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(k, lambda spark, docs, sf_dir: seen.append(docs.inputFiles()) or docs) for k in ("one", "two", "three")])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 5
    assert ["documents.parquet" in x[0] for x in seen] == [True, False, False] and all("/pipeline-" in f and f.endswith(".parquet") for x in seen[1:] for f in x)
