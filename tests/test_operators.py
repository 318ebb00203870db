"""Literal-row tests of single operators."""

import csv
import datetime
import hashlib
import io
import itertools
import json
import random
import time
import unicodedata
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from loamgrid.functions import text as T
from loamgrid.functions import unicode as U
from loamgrid.operators import aggregates as A
from loamgrid.operators import audit
from loamgrid.operators import classify as K
from loamgrid.operators import contracts as V
from loamgrid.operators import corpus as C
from loamgrid.operators import gates as G
from loamgrid.operators import graph, nested, pricing, promotion, records
from loamgrid.operators import relational as R
from loamgrid.operators import solver as S
from loamgrid.operators.flow import Network
from loamgrid.plans import api
from loamgrid.sources import anchors, files, readers, sinks
from loamgrid.streaming import releases


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# --- text ----------------------------------------------------------------------------------------------------------


def test_normalizers_differ_on_accents(spark):
    df = spark.createDataFrame([("Ûthar  the-Destined &amp; Co",)], "t string")
    strip, keep, name, overlap = df.select(T.norm_strip("t"), T.norm_keep("t"), T.name_norm("t"), T.overlap_normalize("t")).first()
    assert strip == "uthar the destined amp co"
    assert keep == "u thar the destined amp co"
    assert name == "uthar the destined amp co"
    assert overlap == "ûthar the destined co"


def test_exact_normalizers(spark):
    df = spark.createDataFrame([("Straße Ûthar",), (None,)], "t string")
    rows = df.select(T.exact("norm_strip")("t").alias("a"), T.exact("norm_keep")("t").alias("b"), T.exact("name_norm")("t").alias("c"), T.exact("overlap_normalize")("t").alias("d")).collect()
    assert tuple(rows[0]) == ("strasse uthar", "strasse u thar", "strasse uthar", "strasse ûthar")
    assert tuple(rows[1]) == (None,) * 4


def test_fingerprint_normalize(spark):
    df = spark.createDataFrame([("  A–b  c \n\n 12 \nso­ft\r\n",)], "t string")
    assert df.select(T.fingerprint_normalize("t")).first()[0] == "A-b c\nsoft"


def test_labels_slugs_and_keys(spark):
    df = spark.createDataFrame([("• Élan \t vital …", "", None)], "a string, b string, c string")
    row = df.select(T.clean_short_label("a"), T.slug("a"), T.slug("b"), T.composite_key("a", "b", "c"), T.text_hash("b"), T.model_count(F.lit("10 models")), T.model_count(F.lit("none"))).first()
    assert row[0] == "Élan vital ..." and row[1] == "elan-vital" and row[2] == "section" and row[3].endswith(":_:_") and row[4] is None and row[5] == 10 and row[6] is None


def test_references_dates_and_tokens(spark):
    df = spark.createDataFrame([("See 01.02 and 11.10. Updated 3 March 2026 x 2026-04-05", "01.02", "1.02")], "t string, r string, q string")
    refs, yes, no, near, gone, tokens = df.select(T.rule_refs("t"), T.mentions("t", "r"), T.mentions("t", "q"), T.date_near("t", "Updated"), T.date_near("t", "absent"), T.canonical_tokens(F.lit("Don’t stop-it 3"))).first()
    assert refs == ["01.02", "11.10"] and yes and not no and near == datetime.date(2026, 3, 3) and gone is None and tokens == ["don't", "stop", "it", "3"]


def test_normalizers_are_idempotent(spark):
    r = random.Random(7)
    letters = "aB éÜß-–’'.,;<b>&amp;  \t\n0129"
    df = spark.createDataFrame([("".join(r.choice(letters) for _ in range(r.randint(0, 40))),) for _ in range(300)], "t string")
    for norm in (T.norm_strip, T.norm_keep, T.name_norm, T.overlap_normalize, T.fingerprint_normalize, T.legacy_norm, T.clean_short_label):
        assert df.select(norm("t").alias("x")).filter(~norm("x").eqNullSafe(F.col("x"))).count() == 0, norm.__name__


def test_shingles(spark):
    assert one(spark, T.shingles(F.lit("a b c d"), 3))[0] == ["a b c", "b c d"]
    assert one(spark, T.shingles(F.lit("a b"), 3))[0] == []


# --- relational ----------------------------------------------------------------------------------------------------


def test_interval_forms(spark):
    bands = pricing.parse_bands(spark.createDataFrame([("[1,2]",), (" [3,)",)], "range string"))
    assert [(r.lo, r.hi) for r in bands.orderBy("lo").collect()] == [(1, 2), (3, None)]
    with pytest.raises(Exception, match="unsupported range"):
        pricing.parse_bands(spark.createDataFrame([("(1,2)",)], "range string")).collect()


def test_first_band_decides_even_without_the_size(spark):
    rows = spark.createDataFrame([(1, "u", 5, 1), (2, "u", 10, 1), (3, "u", 5, 4)], "row_id int, unit string, models int, copy_no int")
    bands = pricing.parse_bands(spark.createDataFrame([("u", 0, "[1,2]", 5, 50), ("u", 1, "[1,)", 10, 90)], "unit string, band_no int, range string, models int, points int"))
    assert {r.row_id: r.points for r in pricing.price(rows, bands, "unit", "models").collect()} == {1: 50, 2: None, 3: None}


def test_value_changes_match_null_key_parts(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, d string, v int")
    new = spark.createDataFrame([("a", None, 4), ("b", "x", 2)], "k string, d string, v int")
    assert [tuple(r) for r in R.value_changes(old, new, ["k", "d"], "v").collect()] == [("a", None, 1, 4, 3)]


def test_fingerprint_fallback_needs_blank_group(spark):
    live = spark.createDataFrame([(1, "x", "h")], "id int, group string, hash string")
    want = spark.createDataFrame([(1, "", "h"), (1, "y", "h"), (1, "x", "g"), (2, "", "h")], "id int, group string, hash string")
    got = {(r.id, r.group, r.hash): r.status for r in R.fingerprint_status(want, live).collect()}
    assert got == {(1, "", "h"): "MATCH", (1, "y", "h"): "MISSING_LIVE", (1, "x", "g"): "DRIFT", (2, "", "h"): "MISSING_LIVE"}


def test_hosts_and_keys(spark):
    df = spark.createDataFrame([("https://a.example.com/x",), ("https://badexample.com",), ("http://example.com",), ("nonsense",), (None,)], "u string")
    assert [r[0] for r in df.select(R.trusted_host("u", "example.com")).collect()] == [True, False, False, False, False]
    keys = spark.createDataFrame([("ok-1.0",), ("../x",), ("a..b",)], "k string")
    assert [r[0] for r in keys.select(R.safe_key("k")).collect()] == [True, False, False]


def test_labels_need_exactly_one_line(spark):
    labels = spark.createDataFrame([(1, "A"), (1, "B"), (1, "C")], "page int, label string")
    lines = spark.createDataFrame([(1, 1, "A"), (1, 2, "B"), (1, 3, "B")], "page int, line int, clean string")
    got = {r.label: (r.line, r.state) for r in R.labels_to_lines(labels, lines, ["page"]).collect()}
    assert got == {"A": (1, "RESOLVED"), "B": (None, "HEADING_LINE_RECOVERY_GAP"), "C": (None, "HEADING_LINE_RECOVERY_GAP")}


def test_characteristics_last_wins(spark):
    df = spark.createDataFrame([([("M", "6"), (None, "x"), ("M", "7")],)], "p array<struct<name:string,value:string>>")
    assert df.select(R.characteristics("p")).first()[0] == {"M": "7"}


def test_forbidden_fields(spark):
    schema = spark.createDataFrame([], "a struct<text:string>, b array<struct<text:int>>").schema
    assert R.forbidden_fields(schema, {"text"}) == ["a.text", "b[].text"]


# --- corpus --------------------------------------------------------------------------------------------------------


def test_lines_and_paragraphs(spark):
    pages = spark.createDataFrame([(1, "a\r\nbb\n\nccc\n")], "page int, text string")
    lines = C.lines(pages, ["page"])
    assert [(r.line, r.text, r.char_start, r.char_end) for r in lines.orderBy("line").collect()] == [(1, "a", 0, 1), (2, "bb", 3, 5), (3, "", 6, 6), (4, "ccc", 7, 10)]
    got = C.paragraphs(lines, ["page"], C.is_blank("text")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.line_start, r.line_end, r.char_start, r.char_end) for r in got] == [(1, 1, 2, 0, 5), (2, 4, 4, 7, 10)]


def test_sections(spark):
    s = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 1), (1, 4, 0)], "d int, ordinal int, depth int")
    got = {r.ordinal: (r.next_ordinal, r.children) for r in C.section_ends(s, ["d"]).collect()}
    assert got == {0: (4, 2), 1: (3, 1), 2: (3, 0), 3: (4, 0), 4: (None, 0)}


def test_overlap_passes(spark):
    units = spark.createDataFrame([("u1", "one two three four five six seven eight nine"), ("u2", "alpha beta gamma delta epsilon zeta eta theta"), ("u3", "a b c d e f")], "unit_key string, text string")
    pages = spark.createDataFrame([(1, 1, "zero one two three four five six seven eight nine ten"), (1, 2, "x alpha beta gamma delta epsilon zeta"), (1, 3, "eta theta y a b c d e f")], "doc_id int, page int, text string")
    hits = C.page_hits(units, pages)
    assert [tuple(r) for r in hits.collect()] == [("u1", 1, 1, 1)]
    assert [tuple(r) for r in C.page_pair_hits(units, pages, hits).collect()] == [("u2", 1, 2, 3)]
    assert {r.unit_key for r in C.page_pair_hits(units, pages, hits, strict=True).collect()} == {"u2", "u3"}


def test_outline(spark):
    df = spark.createDataFrame([(1, json.dumps([["A", 1, [["B", 2, []]]], ["C", 9, []]]))], "doc_id int, o string")
    rows = graph.flatten_outline(df, "doc_id", "o")
    assert [(r.ordinal, r.depth, r.title) for r in rows.orderBy("ordinal").collect()] == [(0, 0, "A"), (1, 1, "B"), (2, 0, "C")]
    assert C.outline_rows(rows, F.lit(5)).count() == 2


# --- classifiers ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, role, axis, gate",
    [
        ("A unit can move.", "PERMISSION", "PERMISSION", "PILOT_READY_DIRECT_MODAL"),
        ("If ready, a unit can move.", "MIXED", "PERMISSION", "PILOT_READY_CONDITIONAL_MODAL"),
        ("It must not move and may stay.", "MIXED", "MULTI_MODAL", "BLOCKED_PARENT_REVIEW"),
        ("It can't move.", "MIXED", "MULTI_MODAL", "BLOCKED_PARENT_REVIEW"),
        ("You must go. You must stop.", "OBLIGATION", "OBLIGATION", "BLOCKED_MODAL_MULTIPLICITY"),
        ("See also page 3", "REFERENCE_OR_CROSS_REFERENCE", "NONE", "BLOCKED_PARENT_REVIEW"),
        ("Nothing here", "UNCLASSIFIED", "NONE", "BLOCKED_PARENT_REVIEW"),
        ("Then it ends.", "PROCEDURE_OR_SEQUENCE", "NONE", "BLOCKED_NO_NORMATIVE_MODAL"),
        ("It can move; then it stops.", "MIXED", "PERMISSION", "BLOCKED_COMPLEX_SEMANTIC_AXES"),
        ("If near or when far it can move.", "MIXED", "PERMISSION", "BLOCKED_MULTIPLE_CONDITION_CUES"),
        ('"It can move."', "PERMISSION", "PERMISSION", "PILOT_READY_DIRECT_MODAL"),
        ("It can move (fast).", "PERMISSION", "PERMISSION", "BLOCKED_PARENTHETICAL_SCOPE"),
        ("It can move: fast.", "PERMISSION", "PERMISSION", "BLOCKED_COMPLEX_DELIMITERS"),
        ("It can move", "PERMISSION", "PERMISSION", "BLOCKED_SENTENCE_SHAPE"),
    ],
)
def test_paragraph_classes(spark, text, role, axis, gate):
    df = spark.createDataFrame([(text,)], "text string").withColumns(K.signal_columns()).withColumns(K.family_columns())
    r = df.withColumns(K.review()).select(K.role()[0], "modal_axis", K.readiness(F.lit(False), K.shape())).first()
    assert tuple(r) == (role, axis, gate)


def test_lists_and_steps(spark):
    df = spark.createDataFrame([("1. a\n2) b\n• x\n- y",), ("• only",)], "text string").withColumns(K.signal_columns())
    assert [(r.ORDERED_STEP, r.BULLET_LIKE) for r in df.collect()] == [(2, 2), (0, 0)]


def test_headings(spark):
    df = spark.createDataFrame([("CORE RULES",), ("The Big Red Fox",), ("an ordinary sentence here",), ("12",), ("Ends.",), ("1. Setup",)], "label string")
    assert [r[0] for r in df.select(K.heading_candidate()).collect()] == [True, True, False, False, False, True]


def test_modal_split_ranges(spark):
    p = spark.createDataFrame([(" Units  can fall back now.",)], "text string").select(K.split_modal().alias("p")).first().p
    assert (p.subject.text, p.subject.char_start, p.subject.char_end) == ("Units", 1, 6)
    assert (p.modal.char_start, p.modal.char_end) == (8, 11) and p.predicate.text == "fall back now." and p.predicate.char_start == 12


# --- gates ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "confirmed, scoped, applied, changed, release, state",
    [
        (True, True, True, True, None, "CURRENT_SCOPED_RECONCILED"),
        (True, False, None, True, None, "READY_FOR_GUARDED_REINGESTION"),
        (True, None, None, False, None, "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION"),
        (None, None, None, True, None, "UPCOMING_HOLD_NO_RELEASE_DATE"),
        (False, None, None, True, "2026-05-02", "PRE_RELEASE_HOLD"),
        (False, None, None, True, "2026-05-01", "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS"),
    ],
)
def test_transitions(spark, confirmed, scoped, applied, changed, release, state):
    df = spark.createDataFrame([(confirmed, scoped, applied, changed, release)], "c boolean, s boolean, a boolean, u boolean, r string")
    found, eligible = G.transition(F.col("c"), F.col("s"), F.col("a"), F.col("u"), F.to_date("r"), F.lit(datetime.date(2026, 5, 1)))
    got = df.select(found, eligible).first()
    assert tuple(got) == (state, state == "READY_FOR_GUARDED_REINGESTION")


def watch(**changes):
    base = {"status": "CHANGE_DETECTED", "baseline_snapshot": "2026-09-29", "github_sources": [], "official_sources": [], "wahapedia": {}, "change_summary": {}}
    return base | changes


def plans_of(spark, *reports):
    rows = promotion.plans(spark.createDataFrame([(i, json.dumps(r) if isinstance(r, dict) else r, "2026-10-20") for i, r in enumerate(reports)], "i int, report string, candidate_snapshot_date string"))
    return {r.i: r for r in rows.collect()}


def test_plans(spark):
    catalog = watch(wahapedia={"changed_files": [{"file": "Source.csv"}], "live_last_update": "new"})
    code = watch(github_sources=[{"source_id": "BSDATA_WH40K_11E", "changed": True, "live": "abc", "pinned": "old"}])
    rows = plans_of(spark, watch(status="NO_CHANGE"), catalog, code, watch(official_sources=[{"source_id": "GW_MFM", "changed": True, "state": "s"}]), watch(), catalog, "{", None)
    assert (rows[0].state, rows[0].promotion_state, rows[0].stages, rows[0].blockers) == ("NO_ACTION", "NOT_APPLICABLE", [], [])
    assert [s.id for s in rows[1].stages] == ["WAHAPEDIA_INGEST", "WAVE_B_RECONCILE", "WAVE_B_ROSTER_VIEWS", "WAHAPEDIA_SEMANTIC_AUDIT", "OFFICIAL_ASSET_AUDIT"] and not rows[1].blockers
    assert all(s.reason and s.source and s.automation for s in rows[1].stages) and rows[1].candidate_revisions.wahapedia.candidate_last_update == "new"
    assert [s.id for s in rows[2].stages] == ["WAVE_B_RECONCILE", "BSDATA_FALLBACK_REBUILD"] and rows[2].candidate_revisions.bsdata_wh40k_11e.candidate == "abc"
    assert [b.id for b in rows[3].blockers] == ["MFM_OFFICIAL_REVALIDATION_REQUIRED"] and rows[3].promotion_state == "BLOCKED_AUTHORITY_REVALIDATION" and rows[3].candidate_revisions.gw_mfm.state == "s"
    assert all([b.id for b in rows[i].blockers] == ["UNCLASSIFIED_WATCH_CHANGE"] for i in (4, 6, 7))
    assert rows[1].plan_id == rows[5].plan_id != rows[2].plan_id and rows[1].plan_id == f"REINGEST_{rows[1].plan_fingerprint[:12]}"


def test_refusals_fail_closed(spark):
    plan = {"plan_id": "P1", "plan_fingerprint": "f", "state": "CANDIDATE_REQUIRED", "blockers": [], "promotion": {"auto_promote": False}, "candidate_snapshot_date": "d", "changed_sources": ["BSDATA_WH40K_11E"], "candidate_revisions": {"bsdata_wh40k_11e": {"candidate": "abc"}}}
    report = {"plan_id": "P1", "plan_fingerprint": "f", "status": "PASS", "promotion_gate": "ELIGIBLE_FOR_REVIEWED_PROMOTION", "auto_promote": False, "forbidden_current_authority_mutations": []}
    cases = [(plan, report)] + [({k: v for k, v in plan.items() if k != gone}, report) for gone in plan] + [(plan, {k: v for k, v in report.items() if k != gone}) for gone in report]
    docs = [(i, *map(json.dumps, c), None, None, None, None, None, '{"commit_sha": "abc"}') for i, c in enumerate(cases)] + [(99, *map(json.dumps, cases[0]), None, None, None, None, None, None)]
    rows = promotion.refusals(spark.createDataFrame(docs, "i int, " + ", ".join(f"{d} string" for d in promotion.DOCUMENTS))).collect()
    assert {r.i: r.refusal is None for r in rows} == {r.i: r.i == 0 for r in rows}
    assert promotion.touched(spark.createDataFrame([(1, "sources/registry.json"), (1, "x"), (1, "sources/registry.json")], "k int, file string"), "k").count() == 1


def test_promotion_in_two_phases(spark, tmp_path):
    root = f"file://{tmp_path}/root"
    old, new = spark.range(5).toDF("k"), spark.range(7).toDF("k")
    with pytest.raises(promotion.Refused):
        promotion.roll_back(spark, root)
    assert promotion.promote(spark, root, "A", {"t": lambda: old, "u": lambda: new}, "d1") == "PROMOTED"
    broken = {"t": lambda: new, "u": lambda: new.select(F.raise_error(F.lit("stop")).alias("x"))}
    with pytest.raises(Exception, match="stop"):
        promotion.promote(spark, root, "B", broken, "d2")
    assert promotion.read_current(spark, root, "t").count() == 5 and not (tmp_path / "root/versions/B").exists()
    promotion.stage(spark, root, "C", {"t": lambda: new})
    again = {"t": lambda: (_ for _ in ()).throw(AssertionError("staged before"))}
    spark.range(1).toDF("k").write.mode("append").parquet(f"{root}/versions/C/t")
    with pytest.raises(promotion.Refused, match="manifest"):
        promotion.promote(spark, root, "C", again, "d3")
    assert promotion.current(spark, root)["version"] == "A"
    assert promotion.promote(spark, root, "D", {"t": lambda: new}, "d4") == "PROMOTED" and promotion.promote(spark, root, "D", again, "d5") == "ALREADY_CURRENT"
    assert promotion.read_current(spark, root, "t").count() == 7 and promotion.roll_back(spark, root) == "A" and promotion.read_current(spark, root, "t").count() == 5
    assert not [p for p in (tmp_path / "root").iterdir() if "current" in p.name and p.name not in ("current.json", ".current.json.crc")]
    for unsafe in ("../x", "", "a..b"):
        with pytest.raises(promotion.Refused):
            promotion.stage(spark, root, unsafe, {})


def test_allocations_equal_one_network_for_each_roster(spark):
    r = random.Random(8)
    pools = [(f"p{i}", r.choice("ABC"), r.choice(["DIRECT", "CONVERSION_REQUIRED"]), r.randint(1, 6), r.randint(0, 4), r.randint(0, 4), r.randint(1, 6)) for i in range(5)]
    demand = [(f"r{i}", u, r.randint(1, 3)) for i in range(40) for u in "ABC" if r.random() < 0.6]
    allow = {f"r{i}": i % 3 > 0 for i in range(40)}
    frames = spark.createDataFrame(demand, "roster_id string, unit string, models int"), spark.createDataFrame(pools, "pool_id string, unit string, mode string, max_from_pool int, ready int, buildable int, bodies int")
    got = S.allocations(*frames, spark.createDataFrame(list(allow.items()), "roster_id string, allow_conversion boolean")).collect()
    for i in allow:
        wanted = {u: n for k, u, n in sorted(demand) if k == i and any(p[1] == u for p in pools)}
        assert sorted(tuple(x)[1:] for x in got if x.roster_id == i) == sorted(S.allocate(wanted, sorted(p for p in pools if p[1] in wanted), allow[i])), i


# --- Unicode --------------------------------------------------------------------------------------------------------------


def test_every_assigned_code_point_as_in_the_character_database(spark):
    def plain(s):
        return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))

    chars = [chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co")]
    marks = [f"a{a}{b}" for a in "\u0301\u0327\u0323\u0345\u05b0" for b in "\u0301\u0327\u0323\u0315\u05bc"] + ["\u1100\u1161\u11a8", "\ufb01\u0301", "Ss\u00df\u1e9e", None, ""]
    rows = spark.createDataFrame([(c,) for c in [*chars, *marks]], "c string")
    got = rows.select("c", U.casefold("c").alias("f"), U.nfkc("c").alias("k"), U.nfkd("c").alias("d"), U.without_marks("c").alias("p")).collect()
    for r in got:
        want = (None,) * 4 if r.c is None else (r.c.casefold(), unicodedata.normalize("NFKC", r.c), unicodedata.normalize("NFKD", r.c), plain(r.c))
        assert (r.f, r.k, r.d, r.p) == want, r.c
    assert len(got) == len(chars) + len(marks)


def test_normalizers_equal_their_exact_forms(spark):
    texts = ["Ûthar’s ‘Straße’ &amp; Æther", "ΣΊΣΥΦΟΣ &lt;b&gt; ﬁne", "<i>Ａｂｃ</i>\u00ad１２", "İstanbul ǅ", "e\u0301te\u0301 &#233; &eacute; x", "plain TEXT 12", "", "漢字 カ゛", "&apos;t &amp;amp; &nbsp;z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name, form in (("norm_strip", T.norm_strip_decoded), ("norm_keep", T.norm_keep), ("name_norm", T.name_norm), ("overlap_normalize", T.overlap_normalize)):
        for r in df.select("t", form("t").alias("a"), T.exact(name)("t").alias("b")).collect():
            assert r.a == r.b, (name, r.t)


# --- solver --------------------------------------------------------------------------------------------------------


def brute_flow(capacity, cost, source, sink, nodes):
    """Greatest flow and least cost over all integer flows of a small graph."""
    edges = list(capacity)
    best = (0, 0)
    for amounts in itertools.product(*[range(capacity[e] + 1) for e in edges]):
        net = dict.fromkeys(nodes, 0)
        for (a, b), x in zip(edges, amounts, strict=True):
            net[a] -= x
            net[b] += x
        if all(net[n] == 0 for n in nodes if n not in (source, sink)):
            value, price = net[sink], sum(cost[e] * x for e, x in zip(edges, amounts, strict=True))
            if value > best[0] or value == best[0] and price < best[1]:
                best = (value, price)
    return best


def test_flow_is_optimal():
    r = random.Random(5)
    for _ in range(60):
        nodes = range(5)
        edges = r.sample([(a, b) for a in nodes for b in nodes if a != b and b != 0 and a != 4], 6)
        capacity, cost = {e: r.randint(0, 2) for e in edges}, {e: r.randint(0, 4) for e in edges}
        net = Network()
        net.node(0), net.node(4)
        numbers = {e: net.edge(*e, capacity[e], cost[e]) for e in edges}
        assert net.solve(0, 4) == brute_flow(capacity, cost, 0, 4, nodes)
        for n in (1, 2, 3):
            assert sum(net.flow(numbers[e]) for e in edges if e[1] == n) == sum(net.flow(numbers[e]) for e in edges if e[0] == n)


def test_ready_before_build_before_conversion():
    pools = [("p", "A", "DIRECT", 10, 2, 3, 5), ("q", "A", "CONVERSION_REQUIRED", 10, 5, 0, 5)]
    assert sorted(S.allocate({"A": 6}, pools, True)) == [("p", "A", "BUILD_REQUIRED", "DIRECT", 3), ("p", "A", "READY", "DIRECT", 2), ("q", "A", "READY", "CONVERSION_REQUIRED", 1)]
    assert sum(x[-1] for x in S.allocate({"A": 6}, pools, False)) == 5


def test_attachments_and_wargear(spark):
    pairs = spark.createDataFrame([("r", "1", "2"), ("r", "2", "1"), ("r", "1", "9")], "roster_id string, leader_ref string, bodyguard_ref string")
    units = spark.createDataFrame([("r", "1", "captain"), ("r", "2", "guard")], "roster_id string, id string, unit string")
    leads = spark.createDataFrame([("captain", "guard")], "leader string, bodyguard string")
    got = {(r.leader_ref, r.bodyguard_ref): (r.status, r.reason) for r in S.attachments(pairs, units, leads).collect()}
    assert got == {("1", "2"): ("PASS", None), ("2", "1"): ("FAIL", "NOT_ALLOWED"), ("1", "9"): ("FAIL", "UNKNOWN_REF")}
    items = spark.createDataFrame([("u", "axe", 2), ("u", "bow", 1)], "unit string, item string, quantity int")
    cost = {r.item: (r.points, r.status) for r in S.wargear_costs(items, spark.createDataFrame([("u", "axe", 5)], "unit string, item string, points int")).collect()}
    assert cost == {"axe": (10, "PASS"), "bow": (None, "FAIL")}


def test_transport_and_composition(spark):
    riders = spark.createDataFrame([("t", ["INFANTRY"], 5), ("t", ["INFANTRY", "TERMINATOR"], 3), ("v", ["MOUNTED"], 1)], "transport string, keywords array<string>, models int")
    profiles = spark.createDataFrame([("t", 11, ["INFANTRY"], ["JUMP"], {"TERMINATOR": 2}), ("v", 9, ["INFANTRY"], [], {})], "transport string, capacity int, requires_all array<string>, excludes array<string>, multipliers map<string,int>")
    assert {r.transport: (r.used, r.status) for r in G.transport(riders, profiles, "transport").collect()} == {"t": (11, "PASS"), "v": (1, "FAIL")}
    units = spark.createDataFrame([("r", ["ALLY"]), ("r", ["ALLY"]), ("r", ["BANNED"])], "roster string, keywords array<string>")
    rules = spark.createDataFrame([("cap", "ally_keyword_cap", "ALLY", 1), ("ban", "boolean_forbid", "BANNED", 0)], "rule string, kind string, keyword string, cap int")
    assert {r.rule: r.status for r in G.composition(units, rules, "roster").collect()} == {"cap": "FAIL", "ban": "FAIL"}


# Published rules of seven kinds of army, one transport and two battle sizes.
ALLY_CAPS = {"incursion": 500, "strike_force": 1000, "onslaught": 1500}
FACTION_RULES = [
    {"id": "world_eaters.blood_legions", "army_faction": "world_eaters", "kind": "ally_keyword_cap", "required_all": ["BLOOD LEGIONS"], "point_caps": ALLY_CAPS, "allied_warlord_forbidden": True},
    {"id": "genestealer_cults.final_day_star_children", "army_faction": "genestealer_cults", "detachment_required": "Final Day", "kind": "ally_keyword_cap", "required_all": ["TYRANIDS", "VANGUARD INVADER"], "excluded": ["AIRCRAFT", "BROODLORD", "GENESTEALERS"], "point_caps": ALLY_CAPS, "allied_warlord_forbidden": True},
    {"id": "imperial_knights.questor_forgepact_mechanicus_allies", "army_faction": "imperial_knights", "detachment_required": "Questor Forgepact", "kind": "ally_unit_name_cap", "allowed_source_faction": "adeptus_mechanicus", "allowed_units": ["Tech-Priest Dominus", "Tech-Priest Manipulus", "Skitarii Marshal", "Skitarii Rangers", "Skitarii Vanguard"], "point_cap": 500},
    {"id": "chaos_space_marines.renegade_warband_no_cults", "army_faction": "chaos_space_marines", "detachment_required": "Renegade Warband", "kind": "boolean_forbid", "roster_flag": "uses_cults_of_dark_gods", "forbidden_value": True},
    {"id": "adeptus_custodes.solar_spearhead_moritoi_ancients", "army_faction": "adeptus_custodes", "detachment_required": "Solar Spearhead", "kind": "keyword_grant_selection", "selection_field": "moritoi_ancients_unit_ids", "max_selected": 2, "required_all": ["ADEPTUS CUSTODES", "WALKER"], "grant": ["CHARACTER"], "warlord_allowed": True},
    {"id": "chaos_space_marines.pactbound_marks", "army_faction": "chaos_space_marines", "detachment_required": "Pactbound Zealots", "kind": "marks_of_chaos", "allowed_marks": ["KHORNE", "TZEENTCH", "NURGLE", "SLAANESH", "CHAOS UNDIVIDED"], "non_epic_heretic_astartes_requires_mark": True, "khorne_forbidden_for_psyker": True, "attached_units_must_share_mark": True, "transport_and_passengers_must_share_mark": True},
]
TRANSVECTOR = {"capacity": 11, "requires_all": ["ADEPTUS MECHANICUS", "INFANTRY"], "requires_any_groups": [["SKITARII", "TECH-PRIEST"]], "excludes": ["JUMP PACK", "KATAPHRON"], "space_multipliers": {}}
BATTLE_SIZES = [("incursion", 1000, 2, 2, 2, 3), ("strike_force", 2000, 3, 4, 3, None)]


def test_transport_groups(spark):
    p = TRANSVECTOR
    profiles = spark.createDataFrame([(k, p["capacity"], p["requires_all"], p["requires_any_groups"], p["excludes"], p["space_multipliers"]) for k in "abcd"], "transport string, capacity int, requires_all array<string>, requires_any_groups array<array<string>>, excludes array<string>, multipliers map<string,int>")
    base = p["requires_all"]
    riders = [("a", [*base, "SKITARII"], 5), ("a", [*base, "TECH-PRIEST"], 1), ("b", base, 5), ("c", [*base, "SKITARII"], 5), ("c", base, 1), ("d", [*base, "SKITARII"], 1), ("d", None, 1)]
    got = G.transport(spark.createDataFrame(riders, "transport string, keywords array<string>, models int"), profiles, "transport")
    assert {r.transport: r.status for r in got.collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL", "d": "FAIL"}


def test_faction_rules(spark):
    rules = FACTION_RULES
    names = [c.split()[0] for c in G.RULES.split(", ")]
    rules = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rules] + [("new", "world_eaters", None, "other", *[None] * (len(names) - 4))], G.RULES)
    rosters, units, want = [], [], {}

    def roster(rule, army, detachment, expected, rows, size="incursion", flags=None, selections=None):
        k = f"r{len(rosters)}"
        rosters.append((k, army, size, [detachment], flags or {}, selections or {}))
        for i, u in enumerate(rows):
            units.append((k, u.get("id", f"u{i}"), u.get("unit", "x"), u.get("faction", army), u.get("keywords", []), u.get("points", 100), u.get("warlord", False), u.get("mark"), u.get("attached_to"), u.get("transported_in")))
        want[k, rule] = expected

    blood = {"keywords": ["BLOOD LEGIONS"], "faction": "daemons", "points": 300}
    rule = "world_eaters.blood_legions"
    for expected, rows, size in (([], [blood], "incursion"), (["OVER_CAP"], [blood, blood], "incursion"), ([], [blood, blood], "strike_force"), (["ALLIED_WARLORD"], [blood | {"warlord": True}], "incursion"), (["CAP?"], [blood], "odd"), (["POINTS?"], [blood | {"points": None}], "incursion"), ([], [], "incursion")):
        roster(rule, "world_eaters", "any", expected, rows, size)
    vanguard = {"keywords": ["TYRANIDS", "VANGUARD INVADER"], "faction": "tyranids"}
    rule = "genestealer_cults.final_day_star_children"
    roster(rule, "genestealer_cults", "Final Day", [], [vanguard])
    roster(rule, "genestealer_cults", "Final Day", ["UNIT_NOT_ALLOWED"], [vanguard | {"keywords": [*vanguard["keywords"], "BROODLORD"]}])
    rule = "imperial_knights.questor_forgepact_mechanicus_allies"
    priest = {"unit": "Skitarii Marshal", "faction": "adeptus_mechanicus", "points": 260}
    roster(rule, "imperial_knights", "Questor Forgepact", [], [priest, {"points": 900}])
    roster(rule, "imperial_knights", "Questor Forgepact", ["OVER_CAP"], [priest, priest])
    roster(rule, "imperial_knights", "Questor Forgepact", ["UNIT_NOT_ALLOWED"], [priest | {"unit": "Kastelan Robots"}])
    rule = "chaos_space_marines.renegade_warband_no_cults"
    for value, expected in ((True, ["FORBIDDEN"]), (False, []), (None, ["FLAG?"])):
        roster(rule, "chaos_space_marines", "Renegade Warband", expected, [], flags={"uses_cults_of_dark_gods": value})
    rule = "adeptus_custodes.solar_spearhead_moritoi_ancients"
    walker = [{"id": x, "keywords": ["ADEPTUS CUSTODES", "WALKER"]} for x in "abc"] + [{"id": "d", "keywords": ["ADEPTUS CUSTODES"]}]
    for chosen, expected in ((["a", "b"], []), (["a", "b", "c"], ["TOO_MANY"]), (["d"], ["NOT_ELIGIBLE"]), (["z"], ["UNKNOWN_REF"]), ([], [])):
        roster(rule, "adeptus_custodes", "Solar Spearhead", expected, walker, selections={"moritoi_ancients_unit_ids": chosen})
    rule = "chaos_space_marines.pactbound_marks"
    legion = lambda i, mark, *more, **k: {"id": i, "keywords": ["HERETIC ASTARTES", *more], "mark": mark} | k
    for expected, rows in (
        ([], [legion("a", "KHORNE"), legion("b", None, "EPIC HERO", "KHORNE", attached_to="a")]),
        (["NO_MARK"], [legion("a", None)]),
        ([], [legion("a", None, "EPIC HERO")]),
        (["MARK_NOT_ALLOWED"], [legion("a", "MALAL")]),
        (["KHORNE_PSYKER"], [legion("a", "KHORNE", "PSYKER")]),
        (["ATTACHED_MARK"], [legion("a", "KHORNE"), legion("b", "NURGLE", attached_to="a")]),
        (["TRANSPORT_MARK"], [legion("a", "KHORNE"), legion("b", "NURGLE", transported_in="a")]),
        (["UNKNOWN_REF"], [legion("a", "KHORNE", attached_to="z")]),
    ):
        roster(rule, "chaos_space_marines", "Pactbound Zealots", expected, rows)
    roster("new", "world_eaters", "any", ["KIND?"], [])
    rosters = spark.createDataFrame(rosters, "roster_id string, army_faction string, battle_size string, detachments array<string>, flags map<string,boolean>, selections map<string,array<string>>")
    units = spark.createDataFrame(units, "roster_id string, id string, unit string, faction string, keywords array<string>, points int, warlord boolean, mark string, attached_to string, transported_in string")
    got = {(r.roster_id, r.rule): r for r in G.faction_rules(rosters, units, rules).collect()}
    assert {k: got[k].reasons for k in want} == want
    assert all(got[k].status == ("PASS" if not v else "UNKNOWN" if v[0].endswith("?") else "FAIL") for k, v in want.items())
    first = min(k for k, rule in want if "moritoi" in rule)
    assert {r.id: "CHARACTER" in r.keywords for r in G.granted(rosters, units, rules).filter(F.col("roster_id") == first).collect()} == {"a": True, "b": True, "c": False, "d": False}


def test_core_limits(spark):
    sizes = BATTLE_SIZES
    sizes = spark.createDataFrame(sizes, "battle_size string, points_limit int, detachment_points_limit int, enhancement_limit int, unit_limit int, lone_detachment int")
    rosters = [("ok", "incursion", [("A", 3)]), ("bad", "incursion", [("A", 1), ("A", 2)]), ("big", "strike_force", []), ("odd", "none", [])]
    units, gifts = [], []
    add = lambda k, i, unit, *words, points=100, role=None, to=None: units.append((k, i, unit, list(words), points, role, to))
    for i in range(4):
        add("ok", f"l{i}", "line", "BATTLELINE")
    add("ok", "c", "captain", "CHARACTER", role="LEADER", to="l0")
    add("ok", "s", "medic", "CHARACTER", role="SUPPORT", to="l0")
    gifts += [("ok", "c", "Blade", False, 20), ("ok", "s", "Oath", True, 10)]
    for i in range(3):
        add("bad", f"g{i}", "guard", points=400)
        add("bad", f"c{i}", "captain", "CHARACTER", role="LEADER", to="g0" if i < 2 else "z")
    add("bad", "e0", "hero", "EPIC HERO", "CHARACTER")
    add("bad", "e1", "hero", "EPIC HERO", "CHARACTER")
    add("bad", "s", "medic", "CHARACTER", role="SUPPORT")
    gifts += [("bad", "c0", "Blade", False, 20), ("bad", "c1", "Blade", False, 20), ("bad", "c0", "Cape", False, 5), ("bad", "e0", "Oath", True, 5), ("bad", "g1", "Oath", True, 5)]
    for i in range(4):
        add("big", f"c{i}", f"unit {i}", "CHARACTER", points=None if i else 5)
        gifts.append(("big", f"c{i}", "Oath", True, 5))
    units = spark.createDataFrame(units, "roster_id string, id string, unit string, keywords array<string>, points int, role string, attached_to string")
    gifts = spark.createDataFrame(gifts, "roster_id string, unit_ref string, enhancement string, upgrade boolean, points int")
    rosters = spark.createDataFrame(rosters, "roster_id string, battle_size string, detachments array<struct<name:string,cost:int>>")
    rows = G.core_limits(rosters, units, gifts, sizes).collect()
    off = sorted((r.roster_id, r.check, r.subject or "", r.value, r.cap, r.status) for r in rows if r.status != "PASS" and r.roster_id in ("ok", "bad"))
    assert off == [
        ("bad", "attachment", "g0", 2, 1, "FAIL"),
        ("bad", "attachment", "z", 1, 0, "FAIL"),
        ("bad", "detachment_points", "", 3, 2, "FAIL"),
        ("bad", "enhancement_bearer", "c0", 2, 1, "FAIL"),
        ("bad", "enhancement_bearer", "e0", 1, 0, "FAIL"),
        ("bad", "enhancement_bearer", "g1", 1, 0, "FAIL"),
        ("bad", "enhancement_copies", "Blade", 2, 1, "FAIL"),
        ("bad", "enhancements", "", 4, 2, "FAIL"),
        ("bad", "points", "", 1855, 1000, "FAIL"),
        ("bad", "same_detachment", "A", 2, 1, "FAIL"),
        ("bad", "support_attached", "s", 1, 0, "FAIL"),
        ("bad", "unit_copies", "captain", 3, 2, "FAIL"),
        ("bad", "unit_copies", "guard", 3, 2, "FAIL"),
        ("bad", "unit_copies", "hero", 2, 1, "FAIL"),
    ]
    rest = {(r.roster_id, r.check): (r.value, r.cap, r.status) for r in rows if r.subject is None or r.check == "enhancement_copies"}
    assert rest["big", "points"] == (None, 2000, "UNKNOWN") and rest["big", "enhancements"] == (1, 4, "PASS") and rest["big", "enhancement_copies"] == (4, 3, "FAIL")
    assert rest["odd", "points"] == (0, None, "UNKNOWN") and rest["ok", "detachment_points"] == (3, 3, "PASS")


# --- records, contracts, sources and sinks ---------------------------------------------------------------------------


NESTED = {
    "id": "e1", "name": "Guard", "type": "unit", "categoryLinks": [{"name": "Infantry"}, {"name": None}, {"x": 1}], "costs": [{"name": "pts", "value": 65}, {"value": 3}],
    "constraints": [{"field": "selections", "value": 2}], "profiles": [
        {"name": "Guard", "typeName": "Unit", "characteristics": [{"name": "M", "$text": "6"}, {"name": "M", "$text": "7"}, {"name": "T"}], "profiles": [{"name": "hidden", "typeName": "Unit"}]},
        {"name": "Aura", "typeName": "Abilities", "characteristics": [{"name": "Description", "$text": ""}, {"name": "Capacity", "$text": "ten"}]}, {"name": "Odd", "typeName": "Other"}],
    "entries": [[{"name": "Rifle", "type": "UNIT", "costs": [{"name": "pts", "value": "5"}, {"name": "pts", "value": "x"}], "profiles": [{"name": "Rifle", "typeName": "Ranged Weapons", "characteristics": [{"name": "A", "$text": "2"}]}] * 2}], {"deep": [[[{"name": "guard", "type": "Unit", "costs": [{"name": "pts", "value": 70}]}]]]}],
}


def test_typed_walks(spark):
    df = spark.createDataFrame([(1, json.dumps(NESTED)), (2, '{"name": "Guard", "costs": [{"name": "pts", "value": 5}], "profiles": 3}'), (3, "{"), (4, None), (5, '{"a": 1, "a": 2}')], "doc int, j string")
    df = df.withColumns({"path": F.lit("x"), "value": F.lit("Guard")})
    assert {(r.doc, r["name"]) for r in nested.typed_names(df, "doc", "j", "unit").collect()} == {(1, "Guard"), (1, "Rifle"), (1, "guard")}
    assert {r.doc: (r.costs, r.cost) for r in nested.named_costs(df, "doc", "j", F.col("value"), "pts").collect()} == {1: ([65, 70], None), 2: ([5], 5)}
    assert [r.doc for r in nested.holding(df, "doc", "j", F.lit("RIFLE")).collect()] == [1]
    got = {(r["class"], r["name"]): (r.characteristics and [tuple(c) for c in r.characteristics], r.text_sha256) for r in nested.profiles(df, "doc", "j").collect()}
    assert got == {("unit", "Guard"): ([("M", "7")], None), ("semantic", "Aura"): (None, hashlib.sha256(b"ten").hexdigest()), ("weapon", "Rifle"): ([("A", "2")], None)}
    rows = {r.doc: r for r in nested.entry_summaries(df, "doc", "j").collect()}
    assert set(rows) == {1, 2} and rows[1].categories == ["Infantry"] and [tuple(c) for c in rows[1].costs] == [("pts", "65")] and [tuple(c) for c in rows[1].constraints] == [("selections", None, None, "2")]
    assert len(rows[1].weapon_profiles) == 1 and rows[2].unit_profiles is None
    plan = nested.scalars(df, "doc", "j")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_walk_and_links(spark):
    df = spark.createDataFrame([(1, '{"a": [1, {"b": null}], "c": true}'), (2, "no json"), (3, None)], "id int, j string")
    assert [(r.id, r.path, r["name"], r.kind, r.value) for r in graph.walk_json(df, "id", "j").orderBy("path").collect()] == [(1, "$.a[0]", "a", "number", "1"), (1, "$.a[1].b", "b", "null", ""), (1, "$.c", "c", "boolean", "true")]
    entries = spark.createDataFrame([("c1", "e1", "axe", 5), ("c2", "e2", "axe", 7)], "catalog string, id string, name string, cost int")
    links = spark.createDataFrame([("c1", "l1", "e2")], "catalog string, link_id string, target_id string")
    assert {r.catalog: r.cost for r in graph.costs_of(links, entries, "axe").collect()} == {"c1": None, "c2": 7}
    assert graph.linked_entries(links, entries).count() == 1


def test_contract_summary(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "z")], "id int, s string")
    rows = V.report(V.unique(df, "ids", "id"), V.vocabulary(df, "vocabulary", "id", "s", ["a"]), V.same_rows(df, df, "same"))
    assert sorted((r.contract, r.subject) for r in rows.collect()) == [("ids", "1"), ("vocabulary", "2")]
    assert V.summary(rows).first().result == "FAIL"
    docs = spark.createDataFrame([("a", ["b", "x"]), ("b", [])], "id string, needs array<string>")
    assert [(r.subject, r.detail) for r in V.dependencies(docs, "d", "id", "needs").collect()] == [("a", "needs x")]
    left, right = spark.createDataFrame([(1, "a", 2)], "k int, x string, y int"), spark.createDataFrame([(1, "b", 2)], "k int, x string, y int")
    assert [r.detail for r in V.same_fields(left, right, "f", "k", ["x", "y"]).collect()] == ["x: a / b"]


def test_records(spark):
    docs = spark.createDataFrame([([("s1", "h1", None), ("s1", "h1", None)],)], "sheets array<struct<id:string,name_sha256:string,text_sha256:string>>")
    assert [tuple(r) for r in records.expected_hashes(docs, {"sheet": ("sheets", ["id"], ["name_sha256", "text_sha256"])}).collect()] == [("sheet", "s1", "name_sha256", "h1")]
    cov = spark.createDataFrame([({"a": 100, "b": 0},), ({"a": 0},)], "c map<string,int>")
    assert {r.dimension: (r.complete, r.missing) for r in records.dimension_counts(cov, "c", ["a", "b"]).collect()} == {"a": (1, 1), "b": (0, 2)}
    with pytest.raises(Exception, match="rows=2"):
        records.exactly_one(cov, F.lit(True), "row").collect()
    src = spark.createDataFrame([("x", "", "2026-01-01", "2025-01-01")], "id string, version string, updated string, checked string")
    assert sorted((r.id, r.problem) for r in records.freshness(src, ["x", "y"], F.lit("2026-06-01")).collect()) == [("x", "DATE_ORDER"), ("x", "MISSING_VERSION"), ("y", "MISSING_SOURCE")]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Id| Name |\n000000024| x |\n||\n", encoding="utf-8")
    df = readers.pipe_table(spark, str(tmp_path / "t.csv"), ["id", "name"])
    assert [tuple(r) for r in df.collect()] == [("000000024", "x")]
    with pytest.raises(ValueError, match="missing headers: cost"):
        readers.require_headers(df, ["cost"])
    sinks.snapshot(df, str(tmp_path / "s"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.snapshot(df, str(tmp_path / "s"))
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"a": 1}')
    (tmp_path / "j/b.json").write_text("{")
    assert [r.file.endswith("b.json") for r in readers.json_problems(spark, str(tmp_path / "j")).collect()] == [True]
    assert readers.json_directory(spark, str(tmp_path / "j/a.json"), "a int").first().a == 1
    assert sinks.report_json(df, str(tmp_path / "r.json")) == {"id": "000000024", "name": "x"}
    assert not sinks.or_failure(lambda: 1 / 0, str(tmp_path / "f"), "2026-01-01") and (tmp_path / "f.failure.json").exists()
    inventory = readers.file_inventory(spark, str(tmp_path / "j"), b"{")
    assert inventory.filter("magic_ok").count() == 2
    later = inventory.withColumn("bytes", F.when(F.col("file").endswith("a.json"), 99).otherwise(F.col("bytes")))
    assert [r.change for r in sinks.inventory_changes(inventory, later).collect()] == ["CHANGED"]
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in sinks.merge(old, new, "k").collect()) == [(1, "a", "x"), (2, "c", "y"), (3, "d", None)]


def test_retry():
    calls = []

    def fetch():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return b"x"

    waits = []
    assert readers.with_retry(fetch, sleep=waits.append) == b"x" and waits == [1, 2]


def test_files_are_streamed(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    bodies = {"a.pdf": b"%PDF-" + bytes(range(256)) * 20_000, "deep/b.bin": b"x" * 3_000_001, "empty": b"", "deep/_hidden": b"no"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        rows = {r.file.split("/", 1)[1].split(tmp_path.name + "/")[1]: r for r in readers.file_inventory(spark, path, b"%PDF-").collect()}
        assert {k: (r.bytes, r.sha256, r.magic_ok, r.error) for k, r in rows.items()} == {k: (len(b), hashlib.sha256(b).hexdigest(), b[:5] == b"%PDF-", None) for k, b in bodies.items() if "_" not in k}
    own = spark.read.format("binaryFile").load(f"{tmp_path}/a.pdf").select(F.sha2("content", 256)).first()[0]
    assert rows["a.pdf"].sha256 == own and rows["a.pdf"].modified is not None
    capped = {r.bytes: r.error for r in readers.file_inventory(spark, str(tmp_path / "deep"), most=10).collect()}
    assert list(capped.values()) == ["more than 10 bytes"] and next(iter(capped)) <= 1 << 20
    parts = sorted(tuple(r) for r in files.chunks(spark, str(tmp_path / "deep" / "b.bin")).selectExpr("chunk", "length(content)").collect())
    assert parts == [(0, 1 << 20), (1, 1 << 20), (2, 3_000_001 - (2 << 20))]
    (tmp_path / "none").mkdir()
    assert readers.file_inventory(spark, str(tmp_path / "none")).count() == 0


def test_files_that_fail_are_read_again():
    calls, waits = [], []

    class Breaking(io.BytesIO):
        def read(self, n=-1):
            if len(calls) < 3 and self.tell() > 4:
                raise OSError("gone")
            return super().read(n)

    def open_(path):
        calls.append(path)
        return Breaking(b"0123456789")

    got = files.digest("p", chunk=4, magic=b"012345", open_=open_, sleep=waits.append)
    assert got == (10, hashlib.sha256(b"0123456789").hexdigest(), True, None) and waits == [1, 2] and len(calls) == 3
    calls.clear()
    assert files.digest("p", attempts=2, open_=lambda _: (_ for _ in ()).throw(OSError("no")), sleep=waits.append)[3] == "OSError: no"


def test_pipe_tables_equal_the_standard_reader(spark, tmp_path):
    body = 'Id|Name|\n1|"a ""b"" c"|\n2|"x|y"|\n3|back\\slash \\" q|\n4|"two\nlines"|\n||\n5|"\\"|\n'
    (tmp_path / "t.csv").write_text(body, encoding="utf-8")
    want = [(r["Id"], r["Name"]) for r in csv.DictReader(io.StringIO(body), delimiter="|") if r["Id"]]
    assert [tuple(r) for r in readers.pipe_table(spark, str(tmp_path / "t.csv"), ["id"]).orderBy("id").collect()] == want


def test_json_problems_and_directories(spark, tmp_path):
    for name, body in {"good.json": '{"name": "a"}', "bad.json": "{broken", "empty.json": "", "sub/worse.json": "]", "note.txt": "{"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    assert {r.file.split("/")[-1] for r in readers.json_problems(spark, str(tmp_path)).collect()} == {"bad.json", "empty.json", "worse.json"}
    good = readers.json_directory(spark, f"{tmp_path}/*.json", "name string").filter("name is not null").collect()
    assert [(r.name, r.file.split("/")[-1]) for r in good] == [("a", "good.json")]


def test_links_of_pages(spark):
    df = spark.createDataFrame([(1, "https://a.com/b/", '<a href="c">x <b>y</b></a><a>none</a>'), (2, None, None)], "page_id long, url string, html string")
    assert [tuple(r) for r in readers.page_links(df).collect()] == [(1, "x y", "https://a.com/b/c")]


class PlainAnchors(HTMLParser):
    """Anchors as the standard parser has them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.href, self.words, self.found = None, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.href, self.words = dict(attrs).get("href"), []

    def handle_data(self, data):
        if self.href is not None:
            self.words.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.found.append((" ".join("".join(self.words).split()), urljoin("http://h/p/", self.href)))
            self.href = None


ANCHORS = [
    "<A CLASS='x' HREF='one.html' >One <B>big</B>\n step</A>", '<a title="a > b" href=two?x=1&amp;y=2>T&eacute;</a>', "<a href='#3'>a<img alt='>' src=x>b</a >", "<p>no<a>none</a>", '<a href="x"><a href="y">y</a></a>',
    "<!-- <a href='no'>no</a> --><a href=z/>z", "<script>if (a<b) '<a href=no>'</script>", '<a href="s"><script>var a;</script>t</a>', '<a href="1" href="2">twice</a>', "<a href>empty</a>", '<a href="">own</a>', "a < b <3 & <a href='q'>&lt;q&gt;</a>",
    "<!DOCTYPE html><a\nhref\n=\n'w'\n>w</a\n>", "<area href='no'>", '<a href="//other/x">o</a>', "<a href='mailto:a@b'>m</a>", "<a/href='k'>k</a>", "<style>a{}</style>",
]


def test_lenient_anchors_equal_the_standard_parser(spark):
    r = random.Random(4)
    rows = [(i, "http://h/p/", "".join(r.choice(ANCHORS) for _ in range(r.randint(0, 6)))) for i in range(300)] + [(1000 + i, "http://h/p/", a) for i, a in enumerate(ANCHORS)]
    got = {}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    for row in readers.page_links(df).collect():
        got.setdefault(row.page_id, []).append((row.text, row.url))
    for page_id, _, page in rows:
        parser = PlainAnchors()
        parser.feed(page)
        assert got.get(page_id, []) == parser.found, page


def test_unclosed_markup_is_read_once():
    for page in ("<a " * 350_000, '<a x="' * 200_000, "<!--" * 250_000, "</" * 500_000, "<a href='x'>" * 100_000, "<" * 1_000_000, "<a b=" * 200_000):
        start = time.perf_counter()
        assert list(anchors.anchors(page, None)) == []
        assert time.perf_counter() - start < 5
    assert list(anchors.anchors("<a href=http://[x>t</a>", "http://h/")) == [("t", "http://[x")]


def test_api(spark):
    assert api.keyword(spark.createDataFrame([("e", "k")], "entity string, keyword string"), spark.createDataFrame([("e", True)], "entity string, complete boolean"), "e", "z").first().answer == "ABSENT"
    strat = spark.createDataFrame([("Élan Vital", "Spear")], "name string, detachment string")
    assert api.stratagems(strat, "elan").count() == 1
    lead = spark.createDataFrame([("Shield-Captain", "Guard")], "leader string, bodyguard string")
    assert api.leaders(lead, "guard").count() == 1
    live = spark.createDataFrame([("d", "1", "h"), ("d", "2", "g"), ("d", "3", "x")], "kind string, identity string, hash string")
    want = spark.createDataFrame([("d", "1", "h"), ("d", "2", "h")], "kind string, identity string, hash string")
    assert {r.identity: r.state for r in api.semantics(want, live, "d").collect()} == {"1": "SNAPSHOT_MATCH", "2": "SOURCE_DRIFT", "3": "NO_SNAPSHOT_FINGERPRINT"}
    schema = "faction struct<slug:string>, units array<struct<name:string,groupTitle:string,pricing:array<struct<range:string,label:string,costs:array<struct<models:int,points:int,desc:string>>>>>>, detachments array<struct<name:string,dp:int,enhancements:array<struct<name:string,points:int>>>>"
    snap = spark.createDataFrame([(("k",), [("U", None, [("[1,)", "x", [(5, 90, None)])])], [("D", 2, [("E", 10)])])], schema)
    assert api.points(snap, "K", unit="u").first().points == 90
    assert api.points(snap, "k", detachment="d").first().enhancement == "E"
    assert api.points(snap, "k").first().units == 1


def test_stream_watch(spark, tmp_path):
    from loamgrid.streaming.watch import watch as stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"source_id":"s","pinned":"a","live":"b","relation":"ahead"}\n{"source_id":"t","pinned":"a","live":"a","relation":"identical"}\n')
    seen = []
    q = stream(spark, str(tmp_path / "in"), "source_id string, pinned string, live string, relation string", lambda df, _: seen.extend(r.source_id for r in df.collect()), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert seen == ["s"]


def test_schema_compiler(spark):
    df = spark.createDataFrame([("a", 5, None), (None, 50, ["x"])], "n string, v int, l array<string>")
    schema = {"required": ["n"], "properties": {"v": {"maximum": 10}, "l": {"minItems": 2}, "n": {"pattern": "^a$"}}}
    assert sorted((r.subject, r.detail) for r in V.schema_violations(df, "c", "v", schema).collect()) == [("50", "l.minItems"), ("50", "n.required"), ("50", "v.maximum")]


def test_bands_and_weights(spark):
    row = one(spark, A.sample_band("faction_games", F.lit(100)), A.sample_band("matchup_games", F.lit(99)), A.sample_band("expert_consensus", F.lit(1)))
    assert tuple(row) == ("ROBUST", "DIRECTIONAL", "WEAK")
    assert sum(A.COMPETITIVE.values()) == sum(A.PERSONAL.values()) == 100
    with pytest.raises(ValueError):
        A.evidence_score({"a": 50})


def test_rosters_whose_rows_are_numbered_alike(spark):
    units = spark.createDataFrame([(r, 1, "a", "U", 5) for r in "xyz"], "roster_id string, row_id long, id string, unit string, models int")
    bands = spark.createDataFrame([("U", 0, "[1,2]", 5, 10), ("U", 1, "[3,)", 5, 12)], "unit string, band_no int, range string, models int, points int")
    got = S.scoped_checks(units, spark.createDataFrame([("U",)], "unit string"), bands)
    assert sorted((r.roster_id, r.row_id, r.copy_no, r.points, r.status) for r in got.collect()) == [(r, 1, 1, 10, "PASS") for r in "xyz"]


def test_alias_lookup_with_repeated_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    catalog = spark.createDataFrame([("a", 2), ("a", 1), ("z", 9), ("z", 8)], "k string, v int")
    aliases = spark.createDataFrame([("b", "z"), ("b", "nowhere"), ("c", "nowhere")], "k string, alias string")
    got = sorted(tuple(r) for r in R.alias_lookup(rows, catalog, aliases, "k", "v").collect())
    assert got == [("a", 1, "DIRECT"), ("b", 8, "ALIAS"), ("b", 8, "ALIAS"), ("c", None, "UNRESOLVED")]


def test_rules_that_no_unit_meets(spark):
    units = spark.createDataFrame([("x", ["A"]), ("x", ["A"])], "roster string, keywords array<string>")
    rules = spark.createDataFrame([("cap", "ally_keyword_cap", "A", 2), ("none", "boolean_forbid", "B", None)], "rule string, kind string, keyword string, cap int")
    assert sorted(tuple(r) for r in G.composition(units, rules, "roster").collect()) == [("x", "cap", 2, "PASS"), ("x", "none", 0, "PASS")]


def test_closure_of_many_ways(spark):
    layers = [(f"{i}{a}", f"{i + 1}{b}") for i in range(30) for a in "pq" for b in "pq"]  # 2 ** 30 simple ways
    names = spark.createDataFrame([(f"{i}{a}",) for i in range(31) for a in "pq"], "name string")
    reach = G.closure(names, spark.createDataFrame([*layers, ("30p", "0p")], "parent string, child string"))
    assert reach.filter("profile = '0p'").count() == 61 and reach.filter("profile = '30q'").count() == 1


def test_literals_and_bounds(spark):
    got = spark.createDataFrame([("see a\\E.b9", "a\\E.b"), ("see a\\E.b", "a\\E.b")], "t string, r string").select(T.mentions("t", "r").alias("m")).collect()
    assert [r.m for r in got] == [False, True]
    with pytest.raises(ValueError):
        sinks.markdown(spark.range(3).toDF("n"), "t", most=2)


def _request(spark, **tables):
    kinds = {
        "rosters": "roster_id string, detachment string, points_limit int", "units": "roster_id string, row_id int, id string, unit string, models int", "wargear": "roster_id string, row_id int, item string, quantity int",
        "enhancements": "roster_id string, name string", "attachments": "roster_id string, leader_ref string, bodyguard_ref string",
    }
    rules = {
        "units": spark.createDataFrame([("elf",), ("orc",), ("orc",)], "unit string"),
        "bands": spark.createDataFrame([("elf", 0, "[1,1]", 5, 50), ("elf", 1, "[2,)", 5, 70)], "unit string, band_no int, range string, models int, points int"),
        "detachments": spark.createDataFrame([("wood",), ("twin",), ("twin",)], "detachment string"),
        "wargear": spark.createDataFrame([("elf", "bow", 5)], "unit string, item string, points int"),
        "enhancements": spark.createDataFrame([("wood", "cloak", 20), ("twin", "cloak", 1)], "detachment string, name string, points int"),
        "leads": spark.createDataFrame([("elf", "elf")], "leader string, bodyguard string"),
    }
    return {k: spark.createDataFrame(tables.get(k, []), v) for k, v in kinds.items()}, rules


def test_roster_checks(spark):
    requests, rules = _request(
        spark,
        rosters=[("ok", "wood", 145), ("tight", "wood", 144), ("twin", "twin", None), ("bare", None, 0), ("bad", "wood", None)],
        units=[(r, n, str(n), "elf", 5) for r in ("ok", "tight") for n in (1, 2)] + [("bad", 1, None, "elf", 5), ("bad", 2, "", "elf", 5), ("bad", 3, "a", "elf", 6), ("bad", 4, "a", "elf", 5), ("bad", 5, "b", "orc", 5), ("bad", 6, "c", None, 5)],
        wargear=[("ok", 2, "bow", None), ("tight", 1, "bow", 1), ("bad", 3, "bow", 2), ("bad", 3, "axe", 1), ("bad", 4, "bow", 1), ("bad", 5, "axe", 1)],
        enhancements=[("ok", "cloak"), ("tight", "cloak"), ("twin", "cloak"), ("bad", None)],
        attachments=[("ok", "1", "2"), ("bad", "a", "b")],
    )
    found = S.scoped_rows(requests, rules).filter("roster_id = 'bad'").select("check", "subject", "points", "status").collect()
    assert sorted(repr(tuple(r)) for r in found) == sorted(map(repr, [
        ("detachment_exists", "wood", None, "PASS"), ("unique_unit_id", None, None, "FAIL"), ("unique_unit_id", "", None, "FAIL"), ("unit_size_and_copy_tier", "a", None, "FAIL"), ("unique_unit_id", "a", None, "FAIL"),
        ("unit_exists", "b", None, "FAIL"), ("unit_exists", "c", None, "FAIL"), ("paid_wargear_cost", "bow", None, "PASS"), ("paid_wargear_cost", "axe", None, "FAIL"), ("enhancement_exists_in_detachment", None, None, "FAIL"),
        ("leader_relation", "a|b", None, "FAIL"),
    ]))
    physical = requests["rosters"].select("roster_id", F.expr("case when roster_id = 'ok' then 'INFEASIBLE_FROM_SNAPSHOT' else 'FEASIBLE_PROVISIONAL' end").alias("physical_state"))
    got = {r["roster_id"]: (r["unit_points"], r["enhancement_points"], r["failed"], r["scoped_legality"], r["status"]) for r in S.evaluate(requests, rules, physical).collect()}
    assert got == {
        "ok": (125, 20, 0, "PASS", "SCOPED_RULES_PASS_PHYSICAL_INFEASIBLE"), "tight": (125, 20, 1, "FAIL", "INVALID_SCOPED_RULES"), "twin": (0, 0, 2, "FAIL", "INVALID_SCOPED_RULES"),
        "bare": (0, 0, 1, "FAIL", "INVALID_SCOPED_RULES"), "bad": (0, 0, 9, "FAIL", "INVALID_SCOPED_RULES"),
    }


def test_roster_checks_of_nothing(spark):
    requests, rules = _request(spark)
    assert S.evaluate(requests, rules, spark.createDataFrame([], "roster_id string, physical_state string")).collect() == []


def test_every_release_state_has_an_action(spark):
    states = spark.createDataFrame([(s,) for s in [*G.WATCH, "other", None]], "s string")
    got = {r["s"]: r["a"] for r in states.select("s", G.transition_action(F.col("s")).alias("a")).collect()}
    assert got == {**G.ACTION, "other": None, None: None} and set(G.ACTION) == set(G.WATCH)


def test_passed_dimension(spark):
    documents = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "id string, o int, v string")
    report = lambda *states: spark.createDataFrame([(s,) for s in states], "status string")
    assert sorted(r["v"] for r in records.passed(documents, report("PASS"), "id", "o").collect()) == ["y", "z"]
    for states in ((), ("FAIL",), (None,), ("PASS", "PASS")):
        with pytest.raises(ValueError):
            records.passed(documents, report(*states), "id", "o")


def test_pack_mapping(spark):
    factions = spark.createDataFrame([("f1", "Érin", 1), ("f2", "Old-Name", 2), ("f3", "Lone", 3), ("f4", None, 4), ("f1", "Void", 5)], "id string, name string, o int")
    sources = spark.createDataFrame(
        [("s0", "erin", "11", "Faction Pack", 1), ("s1", "ERIN", "11", "Faction Pack", 2), ("s2", "New Name", "11", "Faction Pack", 3), ("s3", "Lone", "10", "Faction Pack", 4), ("s4", "Void", "11", "Faction Pack", 5), ("s5", "Lone", "11", "Index", 6)],
        "id string, name string, edition string, type string, o int",
    )
    documents = spark.createDataFrame([("s1", "d1", 1), ("s1", "d2", 2), ("s2", "d3", 3), ("", "d4", 4), (None, "d5", 5)], "source_id string, document_id string, o int")
    got = C.pack_mapping(factions, sources, documents, {"old name": "new name"}, "o")
    assert sorted(map(tuple, got.collect())) == [("f1", "s1", "d2"), ("f2", "s2", "d3")]
    assert C.pack_mapping(factions, sources, documents.limit(0), {}, "o").collect() == []


def test_joined_if_same(spark):
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    sem = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 3, None)], "k string, o int, s string")
    atom = spark.createDataFrame([("a", 1, 7), ("b", 1, 8)], "k string, o int, n int")
    got = R.joined_if_same(first, {"sem": sem, "atom": atom}, "k", "o").select("k", "v", "sem.s", "atom.n")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [("a", 1, "new", 7), ("a", 2, "new", 7), ("b", 3, None, 8)]))
    extra = spark.createDataFrame([("c", 9, 9)], "k string, o int, n int")
    for x, y, z in ((first, sem, atom.union(extra)), (first.filter("k = 'a'"), sem, atom), (first, sem.filter("k = 'a'"), atom), (first.union(spark.createDataFrame([(None, 1)], "k string, v int")), sem, atom)):
        for read in (lambda df: df.collect(), lambda df: df.count()):
            with pytest.raises(Exception, match="identity sets differ"):
                read(R.joined_if_same(x, {"sem": y, "atom": z}, "k", "o"))


def test_runtime_sync_refuses(spark):
    side = "struct<checks: int, matched: int, known_drift_count: int, new_drift_count: int, known_drifts: array<struct<known_drift_id: string>>>"
    kind = f"schema_version string, status string, resolved int, points {side}, surfaces {side}"
    report = lambda schema, status, new, other=None: spark.createDataFrame([(schema, status, 5, (3, 2, 1, new, [("D1",), (None,)]), (4, 4, None, other, None))], kind)
    row = G.runtime_sync(report("2.0", "PASS_WITH_KNOWN_RUNTIME_DRIFT", 0)).first()
    assert (row["state"], row["known_runtime_drifts"], row["new_runtime_drifts"], row["active_known_drift_ids"], row["representative_surface_checks"]) == ("PASS_WITH_KNOWN_RUNTIME_DRIFT", 1, 0, ["D1"], 4)
    for bad in (report("1.0", "PASS", 0), report(None, "PASS", 0), report("2.0", "FAIL", 0), report("2.0", None, 0), report("2.0", "PASS", 1), report("2.0", "PASS", 1, -1)):
        for read in (lambda df: df.collect(), lambda df: df.count()):
            with pytest.raises(Exception, match="schema must be|unresolved state|unclassified drift"):
                read(G.runtime_sync(bad))


def test_contracts_scan_each_table_once(spark, tmp_path):
    spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, 7), (None, "a", 1), (None, "a", 1)], "k int, s string, v int").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(1,), (9,), (None,)], "k int").write.parquet(f"{tmp_path}/b")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")

    def rules(a, b):
        c = V.Contracts(a=a, b=b).unique("a", "ids", "k").unique("a", "pairs", "k", "s").vocabulary("a", "words", "k", "s", ["a"]).reference("a", "owner", "k", "b", "k").every("a", "value", "k", F.col("v") < 6, "v", "WARNING")
        return c.total("a", "sums", "v", 14, F.col("v")).total("a", "sums", "big", 3, when=F.col("v") > 4).total("b", "sums", "none", 0, when=F.lit(False)).schema("a", "schema", "k", {"required": ["s"]}).report()

    found = rules(a, b)
    assert sorted((r.contract, r.subject, r.detail, r.severity) for r in found.fillna("-").collect()) == sorted([
        ("ids", "1", "rows=2", "ERROR"), ("ids", "", "rows=2", "ERROR"), ("pairs", "a", "rows=2", "ERROR"), ("words", "1", "s=b", "ERROR"), ("words", "2", "s=null", "ERROR"), ("owner", "2", "rows=1", "ERROR"),
        ("value", "1", "v", "WARNING"), ("value", "2", "v", "WARNING"), ("sums", "big", "got=2 want=3", "ERROR"), ("schema", "2", "s.required", "ERROR"),
    ])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    empty = rules(a.limit(0), b.limit(0)).collect()
    assert sorted((r.subject, r.detail) for r in empty) == [("big", "got=0 want=3"), ("v", "got=0 want=14")]


def test_gap_audits(spark, tmp_path):
    rows = spark.createDataFrame([(1, {"a": 100, "b": 0}, True), (2, {"a": 40}, None), (3, None, True)], "k int, c map<string,int>, ok boolean")
    got = audit.gap_audit(rows, "k", "c", ["a", "b"], {"ok": F.col("ok"), "keys": F.col("k") > 0}, f"{tmp_path}/g")
    assert (got.rows, got.dimensions, got.passed) == (3, {"a": (1, 1), "b": (0, 3)}, {"ok": False, "keys": True})
    assert sorted(tuple(r) for r in got.gaps.collect()) == [(1, "b", 0, "OPEN"), (2, "a", 40, "PARTIAL"), (2, "b", 0, "OPEN"), (3, "a", 0, "OPEN"), (3, "b", 0, "OPEN")]
    assert got.next_milestone({"keys": "x", "ok": "y"}, "z") == "y" and got.layers() == {"ok": "PENDING", "keys": "CLOSED"}
    audit.as_json(got, f"{tmp_path}/report.json")
    assert json.loads((tmp_path / "report.json").read_text())["dimensions"]["b"] == {"complete": 0, "missing": 3}
    none = audit.gap_audit(rows.limit(0), "k", "c", ["a"], {"ok": F.col("ok")}, f"{tmp_path}/h")
    assert (none.rows, none.dimensions, none.passed, none.gaps.count()) == (0, {"a": (0, 0)}, {"ok": True}, 0)
    done = audit.structural_promotion(rows.fillna({"ok": False}).filter("c is not null"), "c", F.col("ok"), ["b", "x"], (1, 1))
    assert {r.k: r.c for r in done.collect()} == {1: {"a": 100, "b": 100, "x": 100}, 2: {"a": 40, "b": 0, "x": 0}}
    with pytest.raises(Exception, match="complete=1"):
        audit.structural_promotion(rows.filter("c is not null"), "c", F.col("ok"), ["b"], (2, 0)).collect()


# --- streams --------------------------------------------------------------------------------------------------------------


def test_release_states_stream_restarts_and_takes_late_events(spark, tmp_path):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def arrive(*rows):
        spark.createDataFrame(rows, releases.EVENTS).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = releases.release_states(spark.readStream.schema(releases.EVENTS).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in"))
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return {(r.key, r.nth): r.state for r in spark.read.schema(releases.CHANGES).parquet(f"{tmp_path}/out").collect()}

    try:
        first = arrive(("a", day(0), "scheduled", day(3).date()), ("b", day(0), "scheduled", day(30).date()), ("c", day(1), "confirmed", None), (None, day(1), "confirmed", None), ("n", None, "confirmed", None))
        assert first == {("a", 1): "PRE_RELEASE_HOLD", ("b", 1): "PRE_RELEASE_HOLD", ("c", 1): "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION"}
        # an event before the last one, though not behind the watermark; the date of a comes by its timer, b's is put off by an earlier one that is announced later
        then = arrive(("c", day(0.9), "upstream", None), ("d", day(10), "applied", None), ("b", day(2), "scheduled", day(4).date()))
        assert then == first | {("c", 2): "READY_FOR_GUARDED_REINGESTION", ("d", 1): "UPCOMING_HOLD_NO_RELEASE_DATE", ("a", 2): "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS", ("b", 2): "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS"}
        # behind the watermark: dropped
        assert arrive(("b", day(3), "confirmed", None), ("e", day(11), "confirmed", None)) == then | {("e", 1): "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION"}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    events = spark.createDataFrame([("a", day(0), "scheduled", day(3).date()), ("b", day(0), "scheduled", day(30).date()), ("c", day(1), "confirmed", None), ("c", day(0.9), "upstream", None), ("d", day(10), "applied", None), ("b", day(2), "scheduled", day(4).date())], releases.EVENTS)
    last = {k: s for (k, n), s in sorted(then.items())}
    assert {r.key: r.state for r in releases.batch_states(events, F.lit(day(9).date())).collect()} == last
