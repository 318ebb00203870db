"""Queries of sources and sinks (written, read back and compared), lookups, classes, contracts and the query surface over whole tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import classify as K
from ..operators import contracts as V
from ..operators import corpus as C
from ..operators import gates as G
from ..operators import graph, pricing, records
from ..operators import relational as R
from ..operators import solver as S
from ..session import table
from ..sources import paths, readers, sinks
from . import api
from .base import query


def _folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return paths.new_folder(spark, "round-trip")


# --- sources and sinks ---------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def json_lines_by_key(spark, sf_dir):
    """One folder of JSON lines for each nation, read back with a declared schema."""
    path = _folder(spark)
    sinks.by_key(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), path, "c_nationkey")
    return paths.read_and_removed(readers.json_lines(spark, path, "c_custkey long, c_name string, c_nationkey int"), path)


@query("SELECT c_nationkey, count(*) AS rows FROM customer GROUP BY c_nationkey")
def index_by_key(spark, sf_dir):
    path = _folder(spark)
    return paths.read_and_removed(sinks.by_key(table(spark, sf_dir, "customer"), path, "c_nationkey"), path)


@query("SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, min(o_orderpriority) AS first_priority FROM orders")
def json_report_read_back(spark, sf_dir):
    """A one-row report as an indented JSON file, read as one document."""
    folder = _folder(spark)
    path = f"{folder}/report.json"
    sinks.report_json(table(spark, sf_dir, "orders").agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.min("o_orderpriority").alias("first_priority")), path)
    return paths.read_and_removed(readers.json_document(spark, path, "orders long, customers long, first_priority string"), folder)


@query('''SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, '"' || s_name || '" | ' || s_suppkey || '\\' AS s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier''')
def pipe_table_read_back(spark, sf_dir):
    """A pipe table whose header starts with a byte order mark and whose cells have blanks, quotes, bars and backslashes, read as strings."""
    path = _folder(spark)
    quoted = F.concat(F.lit('  "'), "s_name", F.lit('" | '), "s_suppkey", F.lit("\\ "))
    padded = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("\ufeffS_SUPPKEY"), quoted.alias(" s_name"), F.col("s_nationkey").alias("S_NationKey "))
    padded.write.option("sep", "|").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return paths.read_and_removed(readers.pipe_table(spark, path, ["s_suppkey", "s_name", "s_nationkey"]), path)


@query("SELECT p_partkey, p_name, p_size FROM part")
def immutable_snapshot(spark, sf_dir):
    """A snapshot read back; writing it once more is refused, and a source that fails leaves a record instead of rows."""
    path, parts = _folder(spark), table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    sinks.snapshot(parts, path)
    try:
        sinks.snapshot(parts.limit(1), path)
        refused = False
    except AnalysisException:
        refused = True
    failed = not sinks.or_failure(lambda: spark.read.parquet(path).filter(F.raise_error(F.lit("no source")).isNull()), f"{path}-next", "2026-01-01")
    recorded = failed and "SOURCE_DRIFT" in (paths.read_text(spark, f"{path}-next.failure.json") or "")
    rows = sinks.compact(spark.read.parquet(path), "p_partkey", "p_name", "p_size").filter(F.lit(refused and recorded))
    return paths.read_and_removed(rows, path, f"{path}-next", f"{path}-next.failure.json")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 6 <> 0 THEN 'New ' || c_name ELSE c_name END AS c_name, c_nationkey FROM customer
UNION ALL SELECT -1 - r_regionkey, r_name, NULL FROM region
""")
def merged_sources(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    new = old.filter("c_custkey % 3 = 0").select("c_custkey", F.expr("case when c_custkey % 6 <> 0 then concat('New ', c_name) end").alias("c_name"))
    more = table(spark, sf_dir, "region").select((-1 - F.col("r_regionkey")).cast("long").alias("c_custkey"), F.col("r_name").alias("c_name"))
    return sinks.merge(old, new.union(more), "c_custkey")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS file, CASE WHEN o_orderkey % 5 = 0 THEN 'ADDED' WHEN o_orderkey % 7 = 0 THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM orders
WHERE (o_orderkey % 5 = 0) <> (o_orderkey % 7 = 0) OR (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0)
""")
def inventory_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    file = F.col("o_orderkey").cast("string").alias("file")
    before = orders.filter("o_orderkey % 5 <> 0").select(file, F.col("o_custkey").alias("bytes"), F.col("o_orderdate").alias("modified"))
    after = orders.filter("o_orderkey % 7 <> 0").select(file, F.expr("o_custkey + case when o_orderkey % 3 = 0 then 1 else 0 end").alias("bytes"), F.col("o_orderdate").alias("modified"))
    return sinks.inventory_changes(before, after)


@query("SELECT n_regionkey, count(*) + 1 AS records, '#' || n_regionkey AS last FROM nation GROUP BY n_regionkey")
def appended_evidence(spark, sf_dir):
    by = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("evidence"))
    rows = sinks.append_evidence(by, "evidence", F.concat(F.lit("#"), "n_regionkey"))
    return rows.select("n_regionkey", F.size("evidence").cast("long").alias("records"), F.element_at("evidence", -1).alias("last"))


@query("SELECT sha256(n_name || chr(10)) AS sha256, length(n_name) + 1 AS bytes, starts_with(n_name, 'NATION_1') AS magic_ok FROM nation")
def inventory_of_files(spark, sf_dir):
    """One text file for each nation, hashed where it lies."""
    path = _folder(spark)
    table(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("k")).repartition(32, "k").write.partitionBy("k").text(path)
    return paths.read_and_removed(readers.file_inventory(spark, path, b"NATION_1").filter("bytes > 0").select("sha256", "bytes", "magic_ok"), path)


@query("""
SELECT 'region' || r_regionkey || '.json' AS file, CASE WHEN r_regionkey % 2 = 1 THEN r_name END AS name, CASE WHEN r_regionkey % 2 = 1 THEN 'GOOD' ELSE 'NO_JSON' END AS state FROM region
UNION ALL SELECT 'empty.json', NULL, 'NO_JSON'
""")
def json_directory_with_broken_files(spark, sf_dir):
    """A document for each region, broken ones and an empty file among them: those that are read, and those that are no JSON."""
    path = _folder(spark)
    body = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("{broken "), "r_name")).otherwise(F.to_json(F.struct(F.col("r_name").alias("name"))))
    for key, text in table(spark, sf_dir, "region").select("r_regionkey", body).collect():
        paths.write_text(spark, f"{path}/region{key}.json", text)
    paths.write_text(spark, f"{path}/empty.json", "")
    named = F.element_at(F.split("file", "/"), -1).alias("file")
    good = readers.json_directory(spark, f"{path}/*.json", "name string").filter("name is not null").select(named, "name", F.lit("GOOD").alias("state"))
    return paths.read_and_removed(good.union(readers.json_problems(spark, path).select(named, F.lit(None).cast("string"), F.lit("NO_JSON"))), path)


@query("SELECT title, type FROM (SELECT p_name || ' ' || p_partkey AS title, p_brand AS type, p_type AS edition FROM part) WHERE type = 'Brand#13' AND edition = 'ECONOMY'")
def sources_of_a_kind(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("title"), F.col("p_brand").alias("type"), F.col("p_type").alias("edition"))
    return readers.source_list(parts, "Brand#13", "ECONOMY", "cold widget 0").select("title", "type")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def current_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("snapshot_date", F.to_date("o_orderdate"))
    return readers.current_snapshot(orders, orders.agg(F.max("snapshot_date").alias("snapshot_date"))).select("o_orderkey")


@query("SELECT column_name AS path FROM (DESCRIBE SELECT * FROM lineitem) WHERE column_name IN ('l_tax', 'l_discount', 'l_comment')")
def forbidden_columns(spark, sf_dir):
    found = R.forbidden_fields(table(spark, sf_dir, "lineitem").schema, {"l_tax", "l_discount", "l_comment"})
    return spark.createDataFrame([(x,) for x in found], "path string")


# --- predicates, lookups, windows ----------------------------------------------------------------------------------


@query("""
SELECT doc_id, length(text) >= 40 AND len(string_split(text, ' ')) >= 6 AS enough, regexp_full_match(k, '[A-Za-z0-9][A-Za-z0-9._-]*') AND NOT contains(k, '..') AS safe
FROM (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN source || '..' || lang WHEN 2 THEN '.' || source ELSE source || '/' || lang END AS k FROM documents)
""")
def evidence_and_keys(spark, sf_dir):
    k = F.expr("case doc_id % 4 when 0 then source when 1 then concat(source, '..', lang) when 2 then concat('.', source) else concat(source, '/', lang) end")
    return table(spark, sf_dir, "documents").withColumn("k", k).select("doc_id", R.enough_evidence("text").alias("enough"), R.safe_key("k").alias("safe"))


@query("""
SELECT c_custkey, u.s_name FROM customer LEFT JOIN (SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY s_nationkey HAVING count(*) = 1) u ON u.s_nationkey = c_nationkey
""")
def uniquely_resolved(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    return R.resolve_unique(requests, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), "s_name"), "k").select("c_custkey", "s_name")


@query("""
WITH l AS (SELECT doc_id, unnest(generate_series(1, len(s))) AS line, unnest(s) AS clean FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS s FROM documents WHERE text IS NOT NULL AND text <> '')),
c AS (SELECT doc_id, line, regexp_replace(clean, '\\r+$', '') AS clean FROM l), asked AS (SELECT doc_id, clean AS label FROM c WHERE line = 1),
n AS (SELECT doc_id, clean AS label, count(*) AS hits, min(line) AS line FROM c GROUP BY ALL)
SELECT doc_id, label, CASE WHEN hits = 1 THEN CAST(line AS BIGINT) END AS line, CASE WHEN hits = 1 THEN 'RESOLVED' ELSE 'HEADING_LINE_RECOVERY_GAP' END AS state FROM asked JOIN n USING (doc_id, label)
""")
def labels_to_lines(spark, sf_dir):
    lines = C.lines(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]).withColumn("clean", F.col("text"))
    labels = lines.filter("line = 1").select("doc_id", F.col("clean").alias("label"))
    return R.labels_to_lines(labels, lines.withColumn("line", F.col("line").cast("long")), ["doc_id"])


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS roster_id, l_linenumber AS leader_ref, l_linenumber + 1 AS bodyguard_ref, a AS leader, b AS bodyguard,
 CASE WHEN a IS NOT NULL AND b IS NOT NULL AND (a, b) IN (('A', 'N'), ('N', 'N'), ('R', 'A')) THEN 'PASS' ELSE 'FAIL' END AS status,
 CASE WHEN a IS NULL OR b IS NULL THEN 'UNKNOWN_REF' WHEN (a, b) NOT IN (('A', 'N'), ('N', 'N'), ('R', 'A')) THEN 'NOT_ALLOWED' END AS reason
FROM (SELECT x.l_orderkey, x.l_linenumber, x.l_returnflag AS a, y.l_returnflag AS b FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) x
 LEFT JOIN (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) y ON y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber + 1)
""")
def attached_units(spark, sf_dir):
    units = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("roster_id"), F.col("l_linenumber").alias("id")).agg(F.min("l_returnflag").alias("unit"))
    pairs = units.select("roster_id", F.col("id").alias("leader_ref"), (F.col("id") + 1).alias("bodyguard_ref"))
    return S.attachments(pairs, units, spark.createDataFrame([("A", "N"), ("N", "N"), ("R", "A")], "leader string, bodyguard string"))


@query("""
WITH found AS (SELECT l_suppkey AS catalog, p_size AS cost FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_name = 'cold widget' UNION ALL SELECT p_partkey, p_size FROM part WHERE p_name = 'cold widget')
SELECT catalog, CASE WHEN count(DISTINCT cost) = 1 THEN min(cost) END AS cost, CAST(count(DISTINCT cost) AS INTEGER) AS different FROM found GROUP BY catalog
""")
def linked_costs(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("catalog"), F.col("l_orderkey").alias("link_id"), F.col("l_partkey").alias("target_id"))
    entries = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("catalog"), F.col("p_name").alias("name"), F.col("p_size").alias("cost"))
    return graph.costs_of(links, entries, "cold widget")


@query("SELECT l_suppkey AS catalog, l_orderkey AS link_id, l_partkey AS target_id, p_brand AS entry_catalog, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey")
def linked_entries(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("catalog"), F.col("l_orderkey").alias("link_id"), F.col("l_partkey").alias("target_id"))
    entries = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("catalog"), F.col("p_name").alias("name"))
    return graph.linked_entries(links, entries).select("catalog", "link_id", "target_id", "entry_catalog", "name")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, bool_and(total = 100) AS complete FROM (SELECT l_returnflag, l_linestatus, sum(CASE l_linenumber WHEN 1 THEN 60 ELSE 40 END) OVER (PARTITION BY l_orderkey) AS total FROM lineitem) GROUP BY ALL
""")
def weights_and_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("w", F.when(F.col("l_linenumber") == 1, 60).otherwise(40))
    whole = lines.groupBy("l_orderkey").agg(A.weights_complete("w").alias("ok"))
    both = ["l_returnflag", "l_linestatus"]
    return A.counts(lines, *both).join(lines.join(whole, "l_orderkey").groupBy(*both).agg(F.bool_and("ok").alias("complete")), both)


@query("""
SELECT user_id, event_id, row_number() OVER w AS ordinal, lead(event_id) OVER w IS NULL AS ends_with_family, coalesce(lead(page) OVER w, 999) AS end_page
FROM (SELECT *, CAST(floor(value) AS BIGINT) AS page FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY page, event_id)
""")
def anchors_in_families(spark, sf_dir):
    anchors = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor("value").cast("long").alias("page"))
    numbered = C.occurrence_ordinals(anchors, ["user_id"], ["page", "event_id"])
    return C.next_anchor(numbered, ["user_id"], ["page", "event_id"], F.lit(999).cast("long")).select("user_id", "event_id", "ordinal", "ends_with_family", "end_page")


@query("""
WITH a AS (SELECT DISTINCT l_suppkey, l_linenumber + 3 AS page FROM lineitem WHERE l_returnflag = 'A'), seen AS (SELECT DISTINCT l_suppkey, l_linenumber AS p FROM lineitem WHERE l_linestatus = 'O')
SELECT a.l_suppkey, a.page, coalesce(min(p), a.page) AS start_page FROM a LEFT JOIN seen ON seen.l_suppkey = a.l_suppkey AND p BETWEEN page - 4 AND page GROUP BY a.l_suppkey, a.page
""")
def definition_starts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    anchors = lines.filter("l_returnflag = 'A'").select("l_suppkey", (F.col("l_linenumber") + 3).alias("page")).distinct()
    seen = lines.filter("l_linestatus = 'O'").select("l_suppkey", F.col("l_linenumber").alias("page")).distinct()
    return C.definition_start(anchors, seen, ["l_suppkey"]).select("l_suppkey", "page", "start_page")


@query("SELECT doc_id, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') AS words FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)")
def unique_in_order(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), " ").alias("w"))
    return words.select("doc_id", F.array_join(R.stable_unique("w"), " ").alias("words"))


@query("""
SELECT kind, identity, count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS chars FROM (SELECT 'doc' AS kind, source AS identity, coalesce(text, '') AS t FROM documents UNION ALL SELECT 'turn', role, coalesce(text, '') FROM conversations) GROUP BY ALL
""")
def bag_of_units(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    bag = records.bag(("doc", table(spark, sf_dir, "documents"), F.col("source"), text), ("turn", table(spark, sf_dir, "conversations"), F.col("role"), text))
    return bag.groupBy("kind", "identity").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


# --- classes, gates, contracts -------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CASE WHEN s AND d THEN 'FULL_REFINEMENT_ALLOWED' WHEN s OR d THEN 'PARTIAL_REFINEMENT_ALLOWED' ELSE 'OPAQUE_PRESERVED' END AS refinement,
 CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS exit, CASE WHEN o_orderkey % 3 = 0 THEN 'UNAVAILABLE' WHEN o_custkey % 2 = 0 THEN 'STRUCTURAL_COMPLETE' ELSE 'STRUCTURAL_PARTIAL' END AS view,
 NOT (o_orderstatus = 'F' AND o_custkey % 3 = 0) AS official_changed, CASE o_custkey % 3 WHEN 0 THEN 'No action required.' WHEN 1 THEN 'Do not change normative KB data. Gather additional source-lineage evidence before assigning ownership.' END AS advice
FROM (SELECT *, o_custkey % 5 > 1 AS s, o_orderstatus = 'O' AS d FROM orders)
""")
def gates_of_orders(spark, sf_dir):
    subject = F.when(F.col("o_custkey") % 5 > 1, "UNIT")
    status = F.element_at(F.array(*map(F.lit, ["SCOPED_RULES_PASS_PHYSICAL_FEASIBLE", "INVALID_SCOPED_RULES", "SCOPED_RULES_PASS_PHYSICAL_INFEASIBLE", "SCOPED_RULES_PASS_PHYSICAL_UNKNOWN"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    state = F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("ERROR")
    drift = F.element_at(F.array(F.lit("NORMATIVE_MATCH"), F.lit("UNKNOWN_RUNTIME_DRIFT"), F.lit("OTHER")), (F.col("o_custkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", K.refinement(subject, F.col("o_orderstatus") == "O").alias("refinement"), G.exit_code(status).alias("exit"), G.view_status(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 2).alias("view"),
        G.official_changed(state, F.col("o_custkey"), F.col("o_custkey") - F.col("o_custkey") % 3).alias("official_changed"), G.advice(drift).alias("advice"),
    )


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'CORE_PUBLIC_GLOBAL' WHEN user_id % 4 = 0 THEN 'NON_11_OR_LEGENDS_SOURCE' WHEN user_id % 4 = 1 THEN 'EDITION_11_SOURCE_MATCH_OUTSIDE_OWN_PACK' WHEN user_id % 4 = 2 AND event_id % 2 = 0 THEN 'UNKNOWN_SOURCE_ID'
 WHEN event_id % 3 > 0 THEN 'FACTION_ONLY_MATCH_OUTSIDE_OWN_PACK' ELSE 'NO_SOURCE_OR_FACTION_SCOPE' END AS class FROM events
""")
def unscoped_classes(spark, sf_dir):
    scope = F.when(F.col("event_type") == "error", "CORE_PUBLIC_TEXT_ONLY").otherwise("GLOBAL_PUBLIC_TEXT_ONLY")
    edition = F.expr("case user_id % 4 when 0 then '10' when 1 then '11' end")
    source, faction = F.expr("case when user_id % 4 = 2 and event_id % 2 = 0 then 's' else '' end"), F.expr("case when event_id % 3 > 0 then 'f' end")
    return table(spark, sf_dir, "events").select("event_id", K.unscoped_class(scope, source, edition, faction).alias("class"))


@query("""
WITH p AS (SELECT user_id, page, count(DISTINCT event_type) AS labels FROM (SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN event_id % 5 END AS page FROM events) GROUP BY ALL)
SELECT user_id, CASE WHEN count(page) = 0 THEN 'HEADING_RECOVERY_GAP' WHEN max(labels) FILTER (WHERE page IS NOT NULL) > 1 THEN 'MULTIPLE_LABELS_SAME_PAGE' WHEN count(page) > 1 THEN 'REPEATED_IN_FAMILY_HEADING' ELSE 'UNIQUE_IN_FAMILY_HEADING' END AS heading_class FROM p GROUP BY user_id
""")
def heading_classes(spark, sf_dir):
    headings = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("label"), F.expr("case when event_id % 3 = 0 then event_id % 5 end").alias("page"))
    return K.heading_evidence(headings, ["user_id"])


@query("""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS roster_id, 'c' || l_linenumber AS constraint_id FROM lineitem WHERE l_linenumber <= 2
UNION SELECT CAST(l_orderkey AS VARCHAR), 'w' || l_returnflag FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
""")
def unknown_constraints(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("roster_id", F.col("l_orderkey").cast("string"))
    components = lines.select("roster_id", F.col("l_linenumber").cast("string").alias("component_id"))
    wargear = lines.select("roster_id", F.col("l_returnflag").alias("unit"), F.col("l_linestatus").alias("item"))
    constraints = spark.createDataFrame([("c1", "1"), ("c2", "2"), ("cx", None)], "constraint_id string, component_id string")
    support = spark.createDataFrame([("R", "F", "UNKNOWN_SUPPLY", "wR"), ("A", "F", "KNOWN", "wA")], "unit string, item string, status string, constraint_id string")
    return S.unknown_triggers(components, wargear, constraints, support)


@query("""
SELECT 'pins' AS contract, CAST(c_custkey AS VARCHAR) AS subject, CASE WHEN c_custkey % 5 = 0 THEN 'missing' ELSE 'changed' END AS detail, 'ERROR' AS severity FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0
UNION ALL SELECT 'needs', CAST(o_orderkey AS VARCHAR), 'needs ' || (o_orderkey + 1), 'ERROR' FROM orders WHERE o_orderkey + 1 NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'rows', '{"n_name":"' || n_name || '"}', 'only left', 'ERROR' FROM nation WHERE n_nationkey % 4 = 0
UNION ALL SELECT 'fields', CAST(s_suppkey AS VARCHAR), 's_name: ' || s_name || ' / null', 'ERROR' FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'fields', CAST(s_suppkey AS VARCHAR), 's_nationkey: ' || s_nationkey || ' / ' || (s_nationkey + 1), 'ERROR' FROM supplier WHERE s_suppkey % 2 = 0
""")
def file_and_row_contracts(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    pins = c.select(F.col("c_custkey").cast("string").alias("file"), F.length("c_name").alias("bytes"), F.sha2("c_name", 256).alias("sha256"))
    have = c.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").cast("string").alias("file"), F.expr("length(c_name) + case when c_custkey % 7 = 0 then 1 else 0 end").alias("bytes"), F.sha2("c_name", 256).alias("sha256"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.col("o_orderkey") + 1, F.col("o_orderkey")).alias("needs"))
    nation = table(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    other = s.select("s_suppkey", F.expr("case when s_suppkey % 3 > 0 then s_name end").alias("s_name"), F.expr("s_nationkey + case when s_suppkey % 2 = 0 then 1 else 0 end").alias("s_nationkey"))
    return V.report(
        V.file_pins(have, "pins", pins), V.dependencies(orders, "needs", "o_orderkey", "needs"),
        V.same_rows(nation.select("n_name"), nation.filter("n_nationkey % 4 > 0").select("n_name"), "rows"), V.same_fields(s, other, "fields", "s_suppkey", ["s_name", "s_nationkey"]),
    )


@query("""
WITH copies AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders)
SELECT o_custkey, CAST(sum(CASE WHEN n <= 1 THEN 10 WHEN n <= 3 THEN 20 ELSE 30 END) AS BIGINT) AS old_points, CAST(sum(CASE WHEN n <= 2 THEN 15 ELSE 25 END) AS BIGINT) AS new_points,
 CAST(sum(CASE WHEN n <= 2 THEN 15 ELSE 25 END) - sum(CASE WHEN n <= 1 THEN 10 WHEN n <= 3 THEN 20 ELSE 30 END) AS BIGINT) AS delta FROM copies GROUP BY o_custkey
""")
def repriced_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.concat_ws("|", "o_custkey", "o_orderstatus").alias("own"))
    numbered = R.copy_number(rows, "own", "o_orderkey").withColumn("unit", F.lit("any"))
    bands = lambda *x: pricing.parse_bands(spark.createDataFrame([("any", i, r, p) for i, (r, p) in enumerate(x)], "unit string, band_no int, range string, points int"))
    return pricing.repricing(numbered, bands(("[1,1]", 10), ("[2,3]", 20), ("[4,)", 30)), bands(("[1,2]", 15), ("[3,)", 25)), "unit", "o_custkey")


@query("""
SELECT 'MISSING_SOURCE' AS problem, 'ERROR' AS severity, 1 AS n UNION ALL SELECT 'MISSING_VERSION', 'ERROR', count(*) FROM customer WHERE c_custkey % 10 = 0
UNION ALL SELECT 'DATE_ORDER', 'WARNING', count(*) FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 9 = 0
""")
def source_freshness(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("id"), F.expr("case when c_custkey % 20 = 0 then '' when c_custkey % 10 > 0 then 'v1' end").alias("version"),
        F.expr("case when c_custkey % 9 = 0 then date'2027-01-01' else date'2026-01-01' end").alias("updated"), F.expr("case when c_custkey % 4 = 0 then date'2025-01-01' else date'2027-02-01' end").alias("checked"),
    )
    found = records.freshness(rows, ["Customer#000000000", "nobody"], F.lit("2026-06-01").cast("date"))
    return found.groupBy("problem", "severity").agg(F.count("*").alias("n"))


# --- text scalars and the query surface ----------------------------------------------------------------------------


@query("""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS tokens, array_to_string(regexp_extract_all(t, '\\b(\\d{2}\\.\\d{2})\\b', 1), '|') AS refs, regexp_matches(t, '(^|[^0-9])04\\.01([^0-9]|$)') AS mentions,
 CAST(nullif(regexp_extract(lower(t), '(\\d+)\\s+models?\\b', 1), '') AS INTEGER) AS models, coalesce(nullif(source, ''), '_') || ':' || coalesce(nullif(lang, ''), '_') AS key, substr(text, 3, 5) AS piece,
 regexp_replace(t, '^see\\s+', '') AS bare
FROM (SELECT *, 'see ' || lpad(CAST(doc_id % 12 AS VARCHAR), 2, '0') || '.01, ' || (doc_id % 7) || ' Models and 104.01 or 03.04' AS t FROM documents)
""")
def text_scalars(spark, sf_dir):
    t = F.expr("concat('see ', lpad(cast(doc_id % 12 as string), 2, '0'), '.01, ', doc_id % 7, ' Models and 104.01 or 03.04')")
    docs = table(spark, sf_dir, "documents").withColumn("t", t)
    return docs.select(
        "doc_id", T.token_count("text").alias("tokens"), F.array_join(T.rule_refs("t"), "|").alias("refs"), T.mentions("t", F.lit("04.01")).alias("mentions"), T.model_count("t").alias("models"),
        T.composite_key("source", "lang").alias("key"), T.span("text", F.lit(2), F.lit(7)).alias("piece"), T.without_prefix("t", "see").alias("bare"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') || ' ' || strftime(o_orderdate, '%d/%m/%y') || ' ' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS forms,
 CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) END AS near FROM orders
""")
def date_forms(spark, sf_dir):
    text = F.concat(F.lit("2001-01-01 "), F.when(F.col("o_orderkey") % 3 > 0, "Updated: ").otherwise("New: "), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d MMMM yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.array_join(T.date_renderings("o_orderdate"), " ").alias("forms"), T.date_near(text, "Updated:").alias("near"))


@query("SELECT 1 AS op, s_suppkey AS id FROM supplier WHERE lower(s_name) = 'supplier#000000003' OR s_suppkey = 4 UNION ALL SELECT 2, p_partkey FROM part WHERE contains(lower(p_name), 'widget') OR contains(lower(p_brand), 'widget') UNION ALL SELECT 3, c_custkey FROM customer WHERE contains(lower(c_mktsegment), 'furn')")
def lookup_surface(spark, sf_dir):
    """Who leads whom, a search over several columns, and names by a fragment."""
    relations = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("leader"), F.expr("case when s_suppkey = 4 then 'Supplier#000000003' else 'x' end").alias("bodyguard"))
    led = api.leaders(relations, "SUPPLIER#000000003").select(F.lit(1).alias("op"), F.col("s_suppkey").alias("id"))
    found = api.search(table(spark, sf_dir, "part"), "WIDGET", "p_name", "p_brand").select(F.lit(2), "p_partkey")
    names = table(spark, sf_dir, "customer").select("c_custkey", F.lit("x").alias("name"), F.col("c_mktsegment").alias("detachment"))
    return led.union(found).union(api.stratagems(names, "FURN").select(F.lit(3), "c_custkey"))


@query("SELECT p_partkey, contains(p_name, 'a') AND contains(p_name, 'w') AS all_there, round(len(regexp_extract_all(p_type, '\\p{Lu}')) / len(regexp_extract_all(p_type, '\\p{L}')), 6) AS capitals FROM part")
def words_present(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", R.all_present(F.col("p_name"), F.array(F.lit("a"), F.lit("w"))).alias("all_there"), F.round(T.upper_ratio("p_type"), 6).alias("capitals"))


# --- gated and joined dimensions -----------------------------------------------------------------------------------


@query("SELECT p_brand, arg_max(p_name, p_partkey) AS p_name, max(p_partkey) AS p_partkey FROM part GROUP BY p_brand")
def passed_dimension(spark, sf_dir):
    """A dimension by key, taken only from a report that passed."""
    parts = table(spark, sf_dir, "part").select("p_brand", "p_name", "p_partkey")
    report = parts.agg(F.when(F.count_if(F.col("p_partkey").isNull()) == 0, "PASS").otherwise("FAIL").alias("status"))
    return records.passed(parts, report, "p_brand", "p_partkey")


@query("""
WITH s AS (SELECT lower(replace(p_brand, '#', ' ')) AS n, max(p_partkey) AS id FROM part WHERE p_size % 3 > 0 GROUP BY 1),
 f AS (SELECT s_suppkey, CASE s_nationkey WHEN 24 THEN 'brand 23' WHEN 0 THEN 'brand 11' ELSE 'brand ' || s_nationkey END AS n FROM supplier)
SELECT s_suppkey AS faction_id, id AS source_id, max(l_orderkey) AS document_id FROM f JOIN s USING (n) JOIN lineitem ON l_partkey = id GROUP BY s_suppkey, id
""")
def pack_mapping(spark, sf_dir):
    """Suppliers by the brand that their nation's number names, its last part, and the last order of that part."""
    factions = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("BRAND "), "s_nationkey").alias("name"), F.col("s_suppkey").alias("o"))
    sources = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.when(F.col("p_size") % 3 > 0, 11).otherwise(10).alias("edition"), F.lit("Faction Pack").alias("type"), F.col("p_partkey").alias("o"))
    documents = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("source_id"), F.col("l_orderkey").alias("document_id"), F.col("l_orderkey").alias("o"))
    return C.pack_mapping(factions, sources, documents, {"brand 24": "brand 23", "brand 0": "brand 11"}, "o")


@query("""
WITH l AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY o_custkey)
SELECT o_custkey, o_orderkey, price, priority FROM orders JOIN l USING (o_custkey)
""")
def three_way_identity_join(spark, sf_dir):
    """Every order with its customer's last price and priority, each from a table of its own that must know the same customers."""
    orders = table(spark, sf_dir, "orders")
    prices = orders.select("o_custkey", F.col("o_orderkey").alias("o"), F.col("o_totalprice").alias("price"))
    priorities = orders.select("o_custkey", F.col("o_orderkey").alias("o"), F.col("o_orderpriority").alias("priority"))
    joined = R.joined_if_same(orders.select("o_custkey", "o_orderkey"), {"sem": prices, "atom": priorities}, "o_custkey", "o")
    return joined.select("o_custkey", "o_orderkey", "sem.price", "atom.priority")


@query("""
SELECT 'PASS' AS state, count(DISTINCT o_custkey) AS resolved, count(*) AS checks, count(*) FILTER (o_orderstatus = 'F') AS matched, count(*) FILTER (o_orderstatus = 'P') + 2 AS known, 0 AS fresh, 'D1|D2' AS ids FROM orders
""")
def runtime_sync(spark, sf_dir):
    """What a runtime report over the orders adds to the release state."""
    drift = lambda *ids: F.array(*[F.struct(F.lit(i).cast("string").alias("known_drift_id")) for i in ids])
    points = F.struct(F.count("*").alias("checks"), F.count_if(F.col("o_orderstatus") == "F").alias("matched"), F.count_if(F.col("o_orderstatus") == "P").alias("known_drift_count"), F.lit(0).alias("new_drift_count"), drift("D1", None).alias("known_drifts"))
    surfaces = F.struct(F.count("*").alias("checks"), F.count("*").alias("matched"), F.lit(2).alias("known_drift_count"), F.lit(None).cast("int").alias("new_drift_count"), drift("D2", "").alias("known_drifts"))
    report = table(spark, sf_dir, "orders").agg(F.lit("2.0").alias("schema_version"), F.lit("PASS").alias("status"), F.count_distinct("o_custkey").alias("resolved"), points.alias("points"), surfaces.alias("surfaces"))
    found = G.runtime_sync(report)
    names = {"roster_identities_resolved": "resolved", "representative_point_checks": "checks", "representative_point_matches": "matched", "known_runtime_drifts": "known", "new_runtime_drifts": "fresh"}
    return found.select("state", *[F.col(a).alias(b) for a, b in names.items()], F.array_join("active_known_drift_ids", "|").alias("ids"))
