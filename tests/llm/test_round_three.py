"""Operators 11 to 13 against brute force: every audit, plain slicing, every window."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loamgrid.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


# --- 11: conversation repair ------------------------------------------------------------------------------------------


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        a, b, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        hit = zlib.crc32(f"{a}:{b}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def every_audit(rows, faults):
    """The cheapest, ASCII-least audit by trying all of them, with its repaired turns."""
    best = None

    def go(i, said, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        roles = "".join(r[:1] or "-" for r, _ in said)
        if not re.fullmatch("s?((ua)*u?)?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found = (cost, audit, said)
            best = found if best is None or found[:2] < best[:2] else best
        if len(audit) - i < 2 + audit.count("K") + audit.count("R") and len(audit) < 2 * len(rows) + 3:
            for r in ("user", "assistant"):
                go(i, [*said, (r, "")], cost + 2, audit + "I")
        if i < len(rows):
            role, text = rows[i]
            go(i + 1, said, cost + 3, audit + "D")
            if faults[i] in (0, 3):
                extra = faults[i] == 3
                go(i + 1, [*said, (role, text)], cost + extra, audit + "K")
                for r in ("user", "assistant"):
                    go(i + 1, [*said, (r, text)], cost + 2 + extra, audit + "R")

    go(0, [], 0, "")
    return best


def expected(original, rows):
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, seen = [], set()
        for _, _, role, text in mine:
            bare = text.strip(SPACE)
            faults.append(1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3)
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, said = every_audit([r[2:] for r in mine], faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha)
    return out


def some_turns(seed, convs=40, most=6):
    r = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(r.randint(1, most)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "user"])
            text = r.choice(["Yes.", "No!", "a b", " \t", "", None, "Why? ", "öl.", f"t{turn}."])
            rows.append((conv, r.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


def results(df):
    found = df.collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in repair.NAMES[1:]) for r in found}


@pytest.mark.parametrize("limits", [{}, {"held_rows": 2, "segment": 2, "partition_bytes": 40}, {"held_rows": 3, "segment": 1}])
def test_repair_equals_trying_every_audit(spark, limits):
    rows = some_turns(3)
    df = spark.createDataFrame(rows, TURNS).withColumn("extra", F.lit(1)).withColumn("seq", F.lit(2))
    assert results(repair.repair(repair.damage(df), **limits)) == expected(rows, damaged(rows))


def test_repair_of_a_long_conversation_in_segments_equals_one_piece(spark):
    r = random.Random(5)
    rows = [(7, i, r.choice(["user", "assistant", "system", "user"]), r.choice(["a.", "b", f"{i}.", ""])) for i in range(3000)] + [(7, 5, "user", "same.")] * 500
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    assert results(repair.repair(df)) == results(repair.repair(df, held_rows=50, segment=17, partition_bytes=1000))


def test_repair_edges(spark):
    assert repair.repair(spark.createDataFrame([], TURNS)).count() == 0
    assert repair.repair(repair.damage(spark.createDataFrame([], TURNS))).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = results(repair.repair(repair.damage(spark.createDataFrame([(dropped, 0, "user", "Hi.")], TURNS))))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    long = "x" * 3_000_000 + "."
    got = results(repair.repair(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], TURNS)))
    assert got[1] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest())


def test_codes_compare_like_audits():
    for a, b in itertools.product(itertools.product(repair.CODES, repeat=2), repeat=2):
        assert (a < b) == ("".join(a) < "".join(b))


# --- 12: fill in middle -----------------------------------------------------------------------------------------------


def formed(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "plain" if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    output = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    plain = form == "plain"
    return (doc_id, n, form, None if plain else lo, None if plain else hi - lo, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def some_texts(seed, count):
    r = random.Random(seed)
    bits = ["a", "bc ", "é", "ß\n", "漢字", "𝄞", "<", "<P", "S>", "<M", ">", "\x00", "x" * 70]
    texts = ["".join(r.choice(bits) for _ in range(r.choice([0, 1, 3, 20, 90]))) for _ in range(count)]
    return [*texts, None, "", "<M>", "<P>", "a<S>b", "<", "漢", "é" * 400, "𝄞" * 33 + "<P>"]


@pytest.mark.parametrize("limits", [{}, {"whole_bytes": 6, "slice_bytes": 5}, {"whole_bytes": 0, "slice_bytes": 1}, {"whole_bytes": 100, "slice_bytes": 64}])
def test_fill_in_middle_equals_plain_slicing(spark, limits):
    from loamgrid.llm import fim

    rows = [(i, t) for i, t in enumerate(some_texts(1, 60))] + [(None, "no id"), (3, "again"), (3, "again"), (-5, "below")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "h1": F.lit("x"), "slice": F.lit(0)})
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in fim.fill_in_middle(df, **limits).select(*fim.NAMES).collect()), key=key) == sorted((formed(*r) for r in rows), key=key)
    assert {formed(*r)[2] for r in rows} == {"plain", "psm", "spm"}


def test_fill_in_middle_edges(spark):
    from loamgrid.llm import fim

    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = "ab𝄞" * 700_000
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    for limits in ({}, {"whole_bytes": 1 << 20, "slice_bytes": (1 << 17) + 1}):
        assert [tuple(r) for r in fim.fill_in_middle(df, **limits).collect()] == [formed(1, long)]
    assert {r.doc_id: r.output for r in fim.outputs(df.union(df.selectExpr("2L", "'<P>'"))).collect()}[2] == "<P>"


def test_automaton_composes(spark):
    import numpy as np

    from loamgrid.llm import fim

    machine = fim.Automaton()
    data = np.frombuffer("".join(x or "" for x in some_texts(9, 80)).encode(), np.uint8)
    whole = fim.Scan(machine, data, np.array([0, len(data)]), np.zeros(1, np.int64))
    ends, units, marks = whole.functions()
    text = data.tobytes().decode()
    assert whole.n[0] == units[0] == len(text) and whole.marks[0] == marks[0] == sum(text.count(m.decode()) for m in fim.MARKS)
    a, b = (fim.Scan(machine, x, np.array([0, len(x)])).functions() for x in (data[:301], data[301:]))
    assert (b[0][a[0]] == ends).all() and (a[1] + b[1][a[0]] == units).all() and (a[2] + b[2][a[0]] == marks).all()


# --- 13: substring dedup over words -----------------------------------------------------------------------------------


def every_window(rows, k):
    first, out = {}, []
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - k + 1 if i is not None else 0):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, i), i)
    for i, w in split:
        gone = set()
        for a in range(len(w) - k + 1 if i is not None else 0):
            if first[tuple(w[a : a + k])] < i:
                gone.update(range(a, a + k))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"chunk_text": 200, "shard_text": 300}])
def test_word_windows_equal_brute_force(spark, limits, monkeypatch):
    from loamgrid.llm import countmin

    r = random.Random(2)
    passages = [[r.choice("abcdé") * r.randint(1, 2) for _ in range(r.randint(3, 12))] for _ in range(12)]
    rows = [(i, r.choice([" ", "\n", "\t "]).join(x for _ in range(r.randint(0, 5)) for x in r.choice(passages))) for i in range(150)]
    rows += [(3, "a b c d e f g"), (3, "a b c d e f g"), (None, rows[5][1]), (None, None), (200, None), (201, ""), (202, rows[9][1]), (-4, rows[9][1]), (202, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit("x"), "copies": F.lit(9), "order": F.lit(0)})
    for k in (3, 5):
        got = [tuple(x) for x in countmin.digest(df, window=k, **limits).collect()]
        assert sorted(got, key=repr) == sorted(every_window(rows, k), key=repr)


def test_full_sketches_lose_nothing(spark):
    """With counters far too few every window is estimated repeated; the exact pass decides all the same."""
    import numpy as np

    from loamgrid.llm import countmin

    h = np.arange(1, 4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    slots = [np.unique(countmin.counters(h, j), return_counts=True) for j in range(countmin.DEPTH)]
    alone = countmin.added([([s for s, _ in slots], [c > 1 for _, c in slots])])
    twice = countmin.added([([s for s, _ in slots], [c > 1 for _, c in slots])] * 2)
    assert sum(x.sum() for x in alone[0]) < 40 and all(x.all() for answer in twice for x in answer)
    steps = np.array([0, 1, 65534, 65535, 65536, 131070, 131071, 1 << 22])
    assert (countmin.slots_of(countmin.gaps(steps)) == steps).all()


def test_word_windows_edges(spark):
    from loamgrid.llm import countmin

    assert countmin.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(2, "x " + long), (1, long + " y"), (9, " ".join(["w"] * 200)), (8, " ".join(["w"] * 60))], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed) for r in countmin.digest(df).collect()} == {1: (300_001, 0), 2: (300_001, 300_000), 8: (60, 0), 9: (200, 200)}
    assert {r.doc_id: r.text for r in countmin.kept_texts(df).collect()}[2] == "x"


# --- pipeline -----------------------------------------------------------------------------------------------------------------


def test_pipeline_of_empty_tables_and_extra_columns(spark, tmp_path):
    import os

    import corpus_pipeline
    from loamgrid.session import shared_dir

    kinds = "doc_id long, text string, lang string, source string, n_chars long, _key string, _nth string, component_id long, size long"
    words = "the of and to in is that it was for on are as with his they at be this have".split()
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(words) for _ in range(30)), "en", "s", 1, "k", "n", 7, None) for i in range(40)]
    for name, table in (("empty", []), ("extra", rows)):
        spark.createDataFrame(table, kinds).write.parquet(str(tmp_path / name / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path / "extra"))
    assert out.count() > 0 and "_key" not in out.columns and "component_id" not in out.columns
    shared = shared_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(shared) if f.startswith("pipeline-")]
