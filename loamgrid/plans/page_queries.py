"""Queries of page spans, outlines, lookups and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import unicode as U
from ..operators import aggregates as A
from ..operators import classify as K
from ..operators import corpus as C
from ..operators import gates as G
from ..operators import graph, records
from ..session import table
from . import api
from .base import query


def _turn_lines(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    return rows.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.posexplode(F.split("text", "\n")).alias("_i", "text")).select("doc_id", "page", (F.col("_i") + 1).cast("long").alias("line"), "text")


_TURN_LINES = "turn_lines AS (SELECT conv_id AS doc_id, turn AS page, unnest(generate_series(1, len(l))) AS line, unnest(l) AS text FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations WHERE text IS NOT NULL))"


@query(f"""
WITH {_TURN_LINES}, b AS (SELECT conv_id AS doc_id, min(turn) AS sp, max(turn) AS ep FROM conversations GROUP BY conv_id)
SELECT doc_id, page, line, sha256(text) AS text_sha256, 'body' AS section FROM turn_lines JOIN b USING (doc_id) WHERE (page > sp OR (page = sp AND line > 1)) AND (doc_id % 3 = 0 OR page < ep OR (page = ep AND line < 2))
""")
def lines_between_places(spark, sf_dir):
    """Lines strictly between a conversation's first line and the second of its last turn; a third of the ends are open."""
    ends = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min("turn").alias("start_page"), F.max("turn").alias("last"))
    open_ = F.col("doc_id") % 3 == 0
    bounds = ends.select("doc_id", F.lit("body").alias("section"), "start_page", F.lit(1).cast("long").alias("start_line"), F.when(~open_, F.col("last")).alias("end_page"), F.when(~open_, 2).cast("long").alias("end_line"))
    return C.between(_turn_lines(spark, sf_dir), bounds, ["doc_id"]).select("doc_id", "page", "line", F.sha2("text", 256).alias("text_sha256"), "section")


@query(f"WITH {_TURN_LINES} SELECT doc_id, page, sha256(arg_min(text, line)) AS title_sha256, 0 AS depth FROM turn_lines WHERE length(text) > 3 GROUP BY doc_id, page")
def sections_without_outline(spark, sf_dir):
    """The first heading of each page, at depth 0."""
    headings = _turn_lines(spark, sf_dir).filter(F.length("text") > 3).withColumnsRenamed({"line": "place", "text": "label"})
    return C.fallback_sections(headings).select("doc_id", "page", F.sha2("title", 256).alias("title_sha256"), "depth")


@query("""
SELECT l_orderkey AS doc_id, l_returnflag AS title, l_linenumber % 2 AS depth, l_linenumber - 1 AS page, min(l_partkey) AS ordinal FROM lineitem WHERE l_linenumber - 1 BETWEEN 1 AND 4 GROUP BY ALL
""")
def outline_entries(spark, sf_dir):
    """Outline entries on pages that exist, the first of each title, depth and page."""
    lines = table(spark, sf_dir, "lineitem")
    outline = lines.select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("title"), (F.col("l_linenumber") % 2).alias("depth"), (F.col("l_linenumber") - 1).alias("page"), F.col("l_partkey").alias("ordinal"))
    return C.outline_rows(outline, F.lit(4))


@query("""
WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber AS page, lpad(CAST(l_partkey % 24 + 1 AS VARCHAR), 2, '0') AS f, lpad(CAST(l_partkey % 24 + 1 AS VARCHAR), 2, '0') || '.' || lpad(CAST(CAST(l_quantity AS INT) % 6 + 1 AS VARCHAR), 2, '0') AS ref FROM lineitem),
m AS (SELECT *, f = lpad(CAST(doc_id % 24 + 1 AS VARCHAR), 2, '0') AND page BETWEEN 2 AND 4 AS inside FROM l)
SELECT doc_id, ref, string_agg(DISTINCT page, ',' ORDER BY page) AS pages, coalesce(string_agg(DISTINCT page, ',' ORDER BY page) FILTER (inside), '') AS family_pages, coalesce(string_agg(DISTINCT page, ',' ORDER BY page) FILTER (NOT inside), '') AS cross_pages
FROM m GROUP BY doc_id, ref
""")
def rule_references(spark, sf_dir):
    """Pages that mention each reference, inside the range of its family and outside."""
    lines = table(spark, sf_dir, "lineitem")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat(F.lit("see "), two(F.col("l_partkey") % 24 + 1), F.lit("."), two(F.col("l_quantity").cast("int") % 6 + 1), F.lit(", 7.25 and 123.45"))
    pages = lines.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), text.alias("text"))
    families = pages.select("doc_id").distinct().select("doc_id", two(F.col("doc_id") % 24 + 1).alias("family"), F.lit(2).alias("start_page"), F.lit(4).alias("end_page"))
    atoms = C.reference_atoms(pages, families)
    return atoms.select("doc_id", "ref", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("pages", "family_pages", "cross_pages")])


@query("SELECT doc_id, sha256(substring(text, length(text) // 4 + 1, length(text) // 2 + 1 - length(text) // 4)) AS sha256 FROM documents WHERE length(text) >= 2")
def child_spans(spark, sf_dir):
    """The characters of a span in the middle of every text, which must lie inside it."""
    n = F.length("text")
    span = C.span_text(F.col("text"), F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int") + 1, F.lit(0), n)
    return table(spark, sf_dir, "documents").filter(n >= 2).select("doc_id", F.sha2(span, 256).alias("sha256"))


@query("""
SELECT o_orderkey, 0 AS ordinal, 0 AS depth, 'Order ' || o_orderkey AS title, 1 AS page FROM orders
UNION ALL SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS INT), 1, 'Part ' || l_partkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def nested_outlines(spark, sf_dir):
    """Outlines given as nested lists, depth first."""
    entry = F.concat(F.lit('["Part '), "l_partkey", F.lit('",'), "l_linenumber", F.lit(",[]]"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", entry.alias("e")))), lambda x: x["e"]), ",").alias("children"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    outline = F.concat(F.lit('[["Order '), "o_orderkey", F.lit('",1,['), F.coalesce("children", F.lit("")), F.lit("]]]"))
    return graph.flatten_outline(rows.select("o_orderkey", outline.alias("outline")), "o_orderkey", "outline")


@query("""
SELECT DISTINCT * FROM (
    SELECT 'line' AS kind, l_orderkey || '|' || l_linenumber AS identity, unnest(['text', 'price']) AS field, unnest([CASE WHEN l_tax > 0 THEN sha256(CAST(l_partkey AS VARCHAR)) END, sha256(CAST(l_suppkey AS VARCHAR))]) AS expected FROM lineitem
) WHERE expected IS NOT NULL
""")
def stored_hashes(spark, sf_dir):
    """Every stored hash of the lines nested in orders, once."""
    line = F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.when(F.col("l_tax") > 0, F.col("l_partkey").cast("string")).alias("text"), F.col("l_suppkey").cast("string").alias("price"))
    docs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    docs = docs.withColumn("lines", F.transform("lines", lambda x: F.struct(x["order"].alias("order"), x["line"].alias("line"), F.sha2(x["text"], 256).alias("text"), F.sha2(x["price"], 256).alias("price"))))
    return records.expected_hashes(docs, {"line": ("lines", ["order", "line"], ["text", "price"])})


@query("""
SELECT l_orderkey, count(*) FILTER (l_returnflag IN ('A', 'R')) AS n, string_agg(f || '=' || c, ',' ORDER BY f) AS counts FROM (SELECT *, l_returnflag AS g FROM lineitem) JOIN (SELECT l_orderkey AS k, l_returnflag AS f, count(*) AS c FROM lineitem GROUP BY ALL) ON k = l_orderkey AND f = g GROUP BY l_orderkey
""".replace("string_agg(f || '=' || c, ',' ORDER BY f)", "string_agg(DISTINCT f || '=' || c, ',' ORDER BY f || '=' || c)"))
def signal_sums(spark, sf_dir):
    """Counts by signal as a map, its entries in order, and the sum over two of them."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("count"))
    pairs = counts.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("id"), "count")).alias("pairs"))
    mapped = pairs.withColumn("m", records.signal_map("pairs"))
    return mapped.select("l_orderkey", records.sum_of(F.col("m"), ["A", "R"]).cast("long").alias("n"), F.array_join(F.transform(F.map_entries(T.sorted_map("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("SELECT r_regionkey, r_name FROM region WHERE r_name = (SELECT min(r_name) FROM region)")
def one_region(spark, sf_dir):
    """The one region that a condition names; several would fail."""
    regions = table(spark, sf_dir, "region")
    first = regions.agg(F.min("r_name")).first()[0]
    return records.exactly_one(regions, F.col("r_name") == first, "region").select("r_regionkey", "r_name")


@query("SELECT o_orderkey, o_orderstatus AS status, 'CURRENT' AS source, true AS stamped FROM orders")
def stamped_records(spark, sf_dir):
    """A nested record of every order with its source and the time of the run set."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.lit("OLD").alias("source"), F.lit("").alias("at")).alias("record"))
    rows = records.stamped(records.stamped(rows, "record", "source", F.lit("CURRENT")), "record", "at", T.utc_stamp())
    now = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("record.at", "yyyy-MM-dd'T'HH:mm:ssX"))) < 3600
    return rows.select("o_orderkey", "record.status", "record.source", (F.col("record.at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$") & now).alias("stamped"))


@query("""
SELECT 'keywords' AS part, '' AS source, CAST(user_id AS VARCHAR) AS keyword, count(*) AS n FROM events GROUP BY user_id
UNION ALL SELECT 'pairs', event_type, CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'sample', event_type, CAST(user_id AS VARCHAR), 1 FROM (SELECT event_type, user_id FROM events ORDER BY event_type, user_id LIMIT 400)
""")
def source_diagnostics(spark, sf_dir):
    """Keywords, pairs of source and keyword, and the first 400 rows in order."""
    got = records.diagnostics(table(spark, sf_dir, "events").select("event_type", "user_id"), "event_type", "user_id")
    part = lambda name, source, n: got[name].select(F.lit(name).alias("part"), source.alias("source"), F.col("user_id").cast("string").alias("keyword"), n.cast("long").alias("n"))
    return part("keywords", F.lit(""), F.col("n")).union(part("pairs", F.col("event_type"), F.col("n"))).union(part("sample", F.col("event_type"), F.lit(1)))


@query("""
SELECT o_custkey, min(o_orderdate) AS first_date, min(o_orderkey) FILTER (o_orderdate = d) AS first_order, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderdate = d) AS first_status
FROM (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS d FROM orders) GROUP BY o_custkey
""")
def earliest_orders(spark, sf_dir):
    """Each customer's first order by date, then by key."""
    rows = A.earliest(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus"])
    return rows.select("o_custkey", F.col("o_orderdate").alias("first_date"), F.col("o_orderkey").alias("first_order"), F.col("o_orderstatus").alias("first_status"))


_KEEP = "lower(coalesce(text, ''))"
for _letters, _base in (("ä", "a"), ("ç", "c"), ("è", "e"), ("é", "e"), ("ê", "e"), ("í", "i"), ("ñ", "n"), ("ó", "o"), ("ö", "o"), ("ü", "u")):
    _KEEP = f"replace({_KEEP}, '{_letters}', '{_base} ')"
_KEEP = f"replace({_KEEP}, 'ß', 'ss')"


@query(f"SELECT doc_id, sha256(trim(regexp_replace({_KEEP}, '[^a-z0-9]+', ' ', 'g'))) AS kept FROM documents")
def accents_that_separate(spark, sf_dir):
    """The normal form in which an accent ends a word, of all texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.norm_keep(F.coalesce("text", F.lit(""))), 256).alias("kept"))


@query("""
SELECT l_orderkey, l_linenumber, first.l_partkey AS hit, first.l_suppkey AS source FROM (
    SELECT q.l_orderkey, q.l_linenumber, arg_min({'l_partkey': e.l_partkey, 'l_suppkey': e.l_suppkey}, [e.l_partkey, e.l_suppkey]) AS first
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) q JOIN lineitem e ON e.l_orderkey = q.l_orderkey AND (e.l_linenumber = q.l_linenumber OR e.l_linenumber = q.l_linenumber + 1) AND (q.l_orderkey % 2 = 0 OR e.l_returnflag = 'A')
    GROUP BY ALL)
""")
def first_hits(spark, sf_dir):
    """The first entity, in a stated order, that has a request's line or the next one; every other request names a kind too."""
    lines = table(spark, sf_dir, "lineitem")
    asked = lines.select("l_orderkey", "l_linenumber").distinct().withColumns({"also": F.col("l_linenumber") + 1, "kind": F.when(F.col("l_orderkey") % 2 == 1, "A")})
    entities = lines.select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("kind"), "l_partkey", "l_suppkey")
    found = records.first_hit(asked, entities, ["l_orderkey"], "line", ["l_linenumber", "also"], ["l_partkey", "l_suppkey"])
    return found.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("hit"), F.col("l_suppkey").alias("source"))


@query("""
SELECT 'part' AS kind, CAST(p_partkey AS VARCHAR) AS identity, CASE WHEN p_partkey % 3 = 0 THEN 'NO_SNAPSHOT_FINGERPRINT' WHEN p_partkey % 5 = 0 THEN 'SOURCE_DRIFT' ELSE 'SNAPSHOT_MATCH' END AS state FROM part WHERE p_type = 'ECONOMY'
""")
def semantics_of_a_type(spark, sf_dir):
    """Live hashes of one type's parts against those of the snapshot."""
    part = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("identity"), "p_partkey", "p_type", "p_name")
    live = part.withColumn("hash", F.sha2(F.expr("p_name || case when p_partkey % 5 = 0 then '!' else '' end"), 256))
    return api.semantics(part.filter("p_partkey % 3 > 0").withColumn("hash", F.sha2("p_name", 256)), live, "part", p_type="ECONOMY")


# --- the fixed lexicons over all texts -----------------------------------------------------------------------------------

_PHRASES = (
    "you must not move", "units cannot shoot", "they can't fight", "it must end", "it can go", "it may stay", "if so", "when it ends", "while there", "unless seen", "before that", "after that", "then stop", "this means more", "known as x",
    "referred to as y", "z instead", "adds one and subtract two", ". See also this", "in section 12.05", "on page 7", "nothing more",
)


def _phrased(spark, sf_dir) -> DataFrame:
    """Every text without marks, and one phrase of the fixed lexicon after it."""
    phrase = F.element_at(F.array(*[F.lit(p) for p in _PHRASES]), (F.pmod("doc_id", F.lit(len(_PHRASES))) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.replace(F.replace(U.without_marks(F.coalesce("text", F.lit(""))), F.lit("ß"), F.lit("ss")), F.lit("\n"), F.lit(" ")), F.lit(" "), phrase).alias("text"))


def _times(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '(?i){pattern}'))"


def _word(*words: str) -> str:
    return " + ".join(_times(rf"\b{w}\b") for w in words)


_CANT = r"\bcannot\b|\bcan(?:''|’)?t\b"
_FAMILIES_SQL = {
    "PROHIBITION": f"{_word(r'must\s+not')} + {_times(_CANT)}",
    "OBLIGATION": f"{_word('must')} - {_word(r'must\s+not')}",
    "PERMISSION": f"{_word('can', 'may')} - {_times(r'cannot\s+can\b')}",
    "CONDITION_OR_TRIGGER": _word("if", "when", "while", "unless"),
    "PROCEDURE_OR_SEQUENCE": _word("before", "after", "then") + " + " + _times(r"^\s*(?:\d{1,2}[.)]|(?-i:[A-Z])[.)])\s+"),
    "DEFINITION": _word("means", r"known\s+as", r"referred\s+to\s+as"),
    "MODIFICATION_OR_REPLACEMENT": _word("instead", "(?:add|adds|adding|subtract|subtracts|subtracting)"),
    "REFERENCE_OR_CROSS_REFERENCE": f"{_times(r'(?:^|[.;:]\s*)see\s+(?:also\s+)?')} + {_times(r'\b(?:rule|rules|section|sections)\s+\d{1,2}[.]\d{1,2}\b')} + {_times(r'\b(?:page|pg[.]?|p[.])\s*\d{1,3}\b')}",
}


@query(f"""
WITH d AS (SELECT doc_id, replace(replace(strip_accents(coalesce(text, '')), 'ß', 'ss'), chr(10), ' ') || ' ' || list_extract([{', '.join("'" + p.replace("'", "''") + "'" for p in _PHRASES)}], CAST(doc_id % {len(_PHRASES)} AS INT) + 1) AS t FROM documents)
SELECT doc_id, {', '.join(f'CAST({sql} AS INTEGER) AS {name.lower()}' for name, sql in _FAMILIES_SQL.items())} FROM d
""")
def fixed_signals(spark, sf_dir):
    """The fixed lexicon over all texts: how often each family occurs."""
    rows = _phrased(spark, sf_dir).withColumns(K.signal_columns("text")).withColumns(K.family_columns())
    return rows.select("doc_id", *[F.col(name).cast("int").alias(name.lower()) for name in _FAMILIES_SQL])


# --- rosters ---------------------------------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT l_suppkey AS transport, CASE l_returnflag WHEN 'A' THEN ['INFANTRY', 'SKITARII'] WHEN 'R' THEN ['INFANTRY', 'SKITARII', 'TERMINATOR'] ELSE ['INFANTRY'] END AS k, l_linenumber AS models FROM lineitem WHERE l_linenumber <= 1 OR l_suppkey % 3 = 0),
f AS (SELECT transport, sum(models * CASE WHEN list_contains(k, 'TERMINATOR') THEN 2 ELSE 1 END) AS used, bool_and(transport % 2 = 0 OR list_contains(k, 'SKITARII')) AS allowed FROM p GROUP BY transport)
SELECT transport, CAST(used AS BIGINT) AS used, 400 AS capacity, allowed, CASE WHEN allowed AND used <= 400 THEN 'PASS' ELSE 'FAIL' END AS status FROM f
""")
def transport_capacity(spark, sf_dir):
    """Passengers of each supplier's transport; every other transport asks for one of a group of keywords, one kind takes twice the space."""
    words = F.when(F.col("l_returnflag") == "A", F.array(F.lit("INFANTRY"), F.lit("SKITARII"))).when(F.col("l_returnflag") == "R", F.array(F.lit("INFANTRY"), F.lit("SKITARII"), F.lit("TERMINATOR"))).otherwise(F.array(F.lit("INFANTRY")))
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 1 OR l_suppkey % 3 = 0")
    riders = lines.select(F.col("l_suppkey").alias("transport"), words.alias("keywords"), F.col("l_linenumber").alias("models"))
    group = F.when(F.col("s_suppkey") % 2 == 1, F.array(F.array(F.lit("SKITARII"), F.lit("TECH-PRIEST"))))
    profiles = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("transport"), F.lit(400).alias("capacity"), F.array(F.lit("INFANTRY")).alias("requires_all"), group.alias("requires_any_groups"), F.array(F.lit("JUMP")).alias("excludes"), F.create_map(F.lit("TERMINATOR"), F.lit(2)).alias("multipliers"))
    return G.transport(riders, profiles, "transport").select("transport", F.col("used").cast("long").alias("used"), "capacity", "allowed", "status")


@query("""
WITH r AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'incursion' WHEN 1 THEN 'strike_force' ELSE 'other' END AS size FROM customer),
s AS (SELECT * FROM (VALUES ('incursion', 1000, 2, 2, 2), ('strike_force', 2000, 3, 4, 3)) AS t(size, points, dp, gifts, units)),
u AS (SELECT o_custkey AS k, o_orderpriority AS unit, CAST(o_totalprice / 1000 AS INT) AS points, o_orderstatus = 'F' AS epic FROM orders),
c AS (
    SELECT r.k, 'points' AS "check", '' AS subject, coalesce((SELECT sum(points) FROM u WHERE u.k = r.k), 0) AS value, points AS cap FROM r LEFT JOIN s USING (size)
    UNION ALL SELECT r.k, 'detachment_points', '', 3, CASE WHEN size = 'incursion' THEN 3 ELSE dp END FROM r LEFT JOIN s USING (size)
    UNION ALL SELECT r.k, 'same_detachment', 'Main', 1, 1 FROM r
    UNION ALL SELECT u.k, 'unit_copies', unit, count(*), CASE WHEN bool_or(epic) THEN 1 ELSE any_value(units) END FROM u JOIN r ON r.k = u.k LEFT JOIN s USING (size) GROUP BY u.k, unit
    UNION ALL SELECT r.k, 'enhancements', '', 0, gifts FROM r LEFT JOIN s USING (size)
)
SELECT k AS roster_id, "check", subject, CAST(value AS BIGINT) AS value, CAST(cap AS BIGINT) AS cap, CASE WHEN value IS NULL OR cap IS NULL THEN 'UNKNOWN' WHEN value <= cap THEN 'PASS' ELSE 'FAIL' END AS status FROM c
""")
def core_limits(spark, sf_dir):
    """A roster for each customer, its orders as units, against the limits of its battle size; one size has none."""
    size = F.element_at(F.array(F.lit("incursion"), F.lit("strike_force"), F.lit("other")), (F.col("c_custkey") % 3 + 1).cast("int"))
    rosters = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("roster_id"), size.alias("battle_size"), F.array(F.struct(F.lit("Main").alias("name"), F.lit(3).alias("cost"))).alias("detachments"))
    words = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("EPIC HERO"))).otherwise(F.array(F.lit("INFANTRY")))
    points = F.bround(F.col("o_totalprice") / 1000, 0).cast("int")
    units = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("roster_id"), F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("unit"), words.alias("keywords"), points.alias("points"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("attached_to"))
    none = spark.createDataFrame([], "roster_id long, unit_ref string, enhancement string, upgrade boolean, points int")
    sizes = spark.createDataFrame([("incursion", 1000, 2, 2, 2, 3), ("strike_force", 2000, 3, 4, 3, None)], "battle_size string, points_limit int, detachment_points_limit int, enhancement_limit int, unit_limit int, lone_detachment int")
    return G.core_limits(rosters, units, none, sizes).withColumn("subject", F.coalesce("subject", F.lit("")))


@query("""
WITH r AS (SELECT c_custkey AS k, c_custkey % 2 = 0 AS eaters, CASE c_custkey % 3 WHEN 0 THEN 500 WHEN 1 THEN 1000 END AS most, c_custkey % 4 = 1 AS renegade, CASE WHEN c_custkey % 8 = 1 THEN true WHEN c_custkey % 3 = 0 THEN false END AS flag FROM customer),
u AS (SELECT o_custkey AS k, CAST(o_totalprice / 1000 AS INT) AS points, o_orderpriority = '1-URGENT' AS warlord FROM orders WHERE o_orderstatus = 'F'),
a AS (SELECT r.k, sum(points) > any_value(most) AS "over", bool_or(warlord) AS led, any_value(most) IS NULL AS unknown FROM r JOIN u ON u.k = r.k WHERE eaters GROUP BY r.k),
x AS (
    SELECT r.k, 'allies' AS rule, list_filter([CASE WHEN led THEN 'ALLIED_WARLORD' END, CASE WHEN unknown THEN 'CAP?' END, CASE WHEN "over" THEN 'OVER_CAP' END], lambda v: v IS NOT NULL) AS reasons FROM r LEFT JOIN a ON a.k = r.k WHERE eaters
    UNION ALL SELECT k, 'no_cults', CASE WHEN flag THEN ['FORBIDDEN'] WHEN flag IS NULL THEN ['FLAG?'] ELSE [] END FROM r WHERE NOT eaters AND renegade
    UNION ALL SELECT k, 'new', ['KIND?'] FROM r WHERE eaters
)
SELECT k AS roster_id, rule, CASE WHEN len(list_filter(reasons, lambda v: NOT ends_with(v, '?'))) > 0 THEN 'FAIL' WHEN len(reasons) > 0 THEN 'UNKNOWN' ELSE 'PASS' END AS status, array_to_string(reasons, ',') AS reasons FROM x
""")
def faction_rules(spark, sf_dir):
    """A roster for each customer against the rules of its army: allies under a cap of points, a flag that forbids, and a kind of rule that isn't known."""
    k = F.col("c_custkey")
    army = F.when(k % 2 == 0, "eaters").otherwise("raiders")
    flags = F.when(k % 8 == 1, F.create_map(F.lit("cults"), F.lit(True))).when(k % 3 == 0, F.create_map(F.lit("cults"), F.lit(False))).otherwise(F.expr("cast(map() as map<string,boolean>)"))
    sizes = F.element_at(F.array(F.lit("incursion"), F.lit("strike_force"), F.lit("other")), (k % 3 + 1).cast("int"))
    rosters = table(spark, sf_dir, "customer").select(k.alias("roster_id"), army.alias("army_faction"), sizes.alias("battle_size"), F.array(F.when(k % 4 == 1, "Renegade").otherwise("Main")).alias("detachments"), flags.alias("flags"), F.expr("cast(map() as map<string,array<string>>)").alias("selections"))
    none = F.lit(None).cast("string")
    ally = F.col("o_orderstatus") == "F"
    units = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("roster_id"), F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("unit"), F.when(ally, "daemons").otherwise("eaters").alias("faction"), F.when(ally, F.array(F.lit("LEGION"))).otherwise(F.array(F.lit("X"))).alias("keywords"),
        F.bround(F.col("o_totalprice") / 1000, 0).cast("int").alias("points"), (F.col("o_orderpriority") == "1-URGENT").alias("warlord"), none.alias("mark"), none.alias("attached_to"), none.alias("transported_in"),
    )
    rules = [{"id": "allies", "army_faction": "eaters", "kind": "ally_keyword_cap", "required_all": ["LEGION"], "point_caps": {"incursion": 500, "strike_force": 1000}, "allied_warlord_forbidden": True}, {"id": "no_cults", "army_faction": "raiders", "detachment_required": "Renegade", "kind": "boolean_forbid", "roster_flag": "cults", "forbidden_value": True}, {"id": "new", "army_faction": "eaters", "kind": "other"}]
    names = [c.split()[0] for c in G.RULES.split(", ")]
    found = G.faction_rules(rosters, units, spark.createDataFrame([tuple(r.get(n) for n in names) for r in rules], G.RULES))
    return found.select("roster_id", "rule", "status", F.array_join("reasons", ",").alias("reasons"))


@query("""
WITH e AS (SELECT *, p_name || ' ' || p_partkey AS unit, p_size % 4 > 0 AS priced FROM part WHERE p_type = 'ECONOMY'), one AS (SELECT min(unit) AS unit FROM e WHERE priced)
SELECT 'all' AS what, '' AS name, count(*) AS units, count(*) FILTER (priced) AS points FROM e
UNION ALL SELECT 'base_only', '', count(*), count(*) FILTER (priced) FROM e WHERE p_size <= 20
UNION ALL SELECT 'base_plus_group', '', count(*), count(*) FILTER (priced) FROM e WHERE p_size <= 20 OR p_brand = 'Brand#1'
UNION ALL SELECT 'unit', unit || '/' || models, models, p_size * models FROM e JOIN one USING (unit), (VALUES (1), (2)) AS m(models)
UNION ALL SELECT 'detachment', p_brand, p_size, p_partkey FROM e WHERE p_brand = 'Brand#2'
""")
def points_of_a_faction(spark, sf_dir):
    """Points of one faction in whatever case: its summary by three views, the tiers of one unit, the enhancements of one detachment. A faction's units lie in several documents."""
    part = table(spark, sf_dir, "part").withColumn("unit", F.concat_ws(" ", "p_name", "p_partkey"))
    cost = lambda n: F.struct(F.lit(n).alias("models"), F.lit("").alias("desc"), (F.col("p_size") * n).alias("points"))
    band = F.struct(F.lit("[1,2]").alias("range"), F.lit("any").alias("label"), F.array(cost(1), cost(2)).alias("costs"))
    pricing = F.when(F.col("p_size") % 4 > 0, F.array(band)).otherwise(F.expr("cast(array() as array<struct<range:string,label:string,costs:array<struct<models:int,desc:string,points:int>>>>)"))
    unit = F.struct(F.col("unit").alias("name"), F.when(F.col("p_size") > 20, F.col("p_brand")).alias("groupTitle"), pricing.alias("pricing"))
    detachment = F.struct(F.col("p_brand").alias("name"), F.col("p_size").alias("dp"), F.array(F.struct(F.col("unit").alias("name"), F.col("p_partkey").alias("points"))).alias("enhancements"))
    docs = part.groupBy("p_type", F.floor(F.col("p_partkey") / 64)).agg(F.collect_list(unit).alias("units"), F.collect_list(detachment).alias("detachments"))
    snapshot = docs.select(F.struct(F.col("p_type").alias("slug")).alias("faction"), "units", "detachments")
    views = [api.points(snapshot, "Economy", mode=m, group="Brand#1").select(F.lit(m).alias("what"), F.lit("").alias("name"), "units", F.col("priced_units").alias("points")) for m in ("all", "base_only", "base_plus_group")]
    first = part.filter("p_type = 'ECONOMY' AND p_size % 4 > 0").agg(F.min("unit")).first()[0]
    tiers = api.points(snapshot, "economy", unit=(first or "").upper())
    views.append(tiers.select(F.lit("unit"), F.concat_ws("/", "unit", "models"), F.col("models").cast("long"), F.col("points").cast("long")))
    views.append(api.points(snapshot, "ECONOMY", detachment="brand#2").select(F.lit("detachment"), "name", F.col("dp").cast("long"), F.col("points").cast("long")))
    out = views[0]
    for v in views[1:]:
        out = out.unionAll(v)
    return out
