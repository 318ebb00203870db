"""Queries of sources, projections, joins, aggregations, windows and set operations over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import pricing as P
from ..operators import relational as R
from ..session import dealt, table
from ..sources.readers import clean_strings, link_map, page_links, plain_links, volume_guard
from .base import query

#: Price bands by copy number, an inline dimension.
BANDS = (("[1,1]", 10), ("[2,3]", 20), ("[4,)", 30))


def _bands(spark: SparkSession, units: list[str] | None = None) -> DataFrame:
    rows = [(u, i, r, p) for u in units or ["any"] for i, (r, p) in enumerate(BANDS)]
    return P.parse_bands(spark.createDataFrame(rows, "unit string, band_no int, range string, points int"))


_BANDS_SQL = "(VALUES (1, 1, 10), (2, 3, 20), (4, NULL, 30)) AS b(lo, hi, points)"


@query("""
SELECT trim(CAST(c_custkey AS VARCHAR)) AS c_custkey, trim(c_name) AS c_name, trim(CAST(c_nationkey AS VARCHAR)) AS c_nationkey, trim(c_mktsegment) AS c_mktsegment
FROM customer WHERE c_custkey IS NOT NULL OR trim(c_name) <> ''
""")
def scan_clean_strings(spark, sf_dir):
    return clean_strings(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@query("""
SELECT count(DISTINCT n_regionkey) >= 5 AS regions, count(*) >= 25 AS nations, max(length(n_name)) <= 25 AS names,
       count(DISTINCT n_regionkey) >= 5 AND count(*) >= 25 AND max(length(n_name)) <= 25 AS ok FROM nation
""")
def volume_guards(spark, sf_dir):
    return volume_guard(table(spark, sf_dir, "nation"), regions=F.count_distinct("n_regionkey") >= 5, nations=F.count("*") >= 25, names=F.max(F.length("n_name")) <= 25)


_ANCHORS_SQL = """
    anchors AS (
        SELECT page_id, regexp_extract(a, '>([^<]*)</a>', 1) AS text, regexp_extract(url, '^[a-z]+://[^/]*', 0) || regexp_extract(a, 'href="([^"]*)"', 1) AS url
        FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="/[^"]*">[^<]*</a>')) AS a FROM pages)
    )"""


@query(f"WITH {_ANCHORS_SQL} SELECT page_id, text, url FROM anchors")
def page_anchors(spark, sf_dir):
    """Anchors of all pages with absolute addresses, by the lenient table function."""
    return page_links(table(spark, sf_dir, "pages"))


@query("""
SELECT page_id, regexp_extract(a, '>([^<]*)</a>', 1) AS text, regexp_extract(a, 'href="([^"]*)"', 1) AS href
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS a FROM pages)
""")
def well_formed_anchors(spark, sf_dir):
    """Anchors without other attributes or markup inside, as they stand, in generated code."""
    return plain_links(table(spark, sf_dir, "pages"))


@query(f"WITH {_ANCHORS_SQL} SELECT lower(text) AS name, array_to_string(list_sort(list(DISTINCT url)), '|') AS urls FROM anchors GROUP BY 1")
def anchor_link_map(spark, sf_dir):
    """Anchor text, lower-cased, with its distinct absolute addresses."""
    links = link_map(page_links(table(spark, sf_dir, "pages")), F.lower)
    return links.select("name", F.array_join("urls", "|").alias("urls"))


@query("""
SELECT doc_id, nullif(trim(lang), '') AS lang, CASE WHEN trim(text) <> '' THEN sha256(trim(text)) END AS text_sha256, coalesce(trim(text) <> '', false) AS text_present FROM documents
""")
def prose_hash_projection(spark, sf_dir):
    return R.prose_hashes(table(spark, sf_dir, "documents"), ["doc_id", "lang"], ["text"])


@query("""
SELECT conv_id, sha256(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)) AS sha256, count(*) AS parts FROM conversations GROUP BY conv_id
""")
def doc_hash_from_pages(spark, sf_dir):
    return A.ordered_hash(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("""
SELECT conv_id, sha256(array_to_string(list_slice(list(sha256(coalesce(text, '')) ORDER BY turn), 2, 3), chr(10))) AS range_sha256 FROM conversations GROUP BY conv_id
""")
def page_range_hash(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    hashes = F.transform(F.array_sort(F.collect_list(F.struct("turn", "h"))), lambda x: x["h"])
    return turns.groupBy("conv_id").agg(hashes.alias("hs")).select("conv_id", A.range_hash(F.col("hs"), F.lit(2), F.lit(3)).alias("range_sha256"))


@query("""
SELECT o_orderkey, count(l_orderkey) AS lines, coalesce(sum(l_quantity), 0) AS quantity, coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey), '') AS numbers
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def nested_child_assembly(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    full = R.nest(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", {"lines": (child, "l_orderkey", ["l_linenumber", "l_partkey", "l_quantity"])})
    total = F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["l_quantity"])
    return full.select("o_orderkey", F.size("lines").cast("long").alias("lines"), total.alias("quantity"), F.array_join(F.transform("lines", lambda x: x["l_linenumber"].cast("string")), ",").alias("numbers"))


@query("""
SELECT l_orderkey, count(*) AS lines_count, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem GROUP BY l_orderkey
""")
def summary_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_returnflag")).alias("lines"))
    out = R.nested_counts(rows, "lines", large=lambda x: x["l_quantity"] > 25, returned=lambda x: x["l_returnflag"] == "R")
    return out.select("l_orderkey", *[F.col(c).cast("long").alias(c) for c in ("lines_count", "large", "returned")])


@query("""
SELECT p_brand AS unit, CAST(band AS BIGINT) AS band_no, range, CAST(models AS BIGINT) AS models, CAST(models * price AS BIGINT) AS points FROM (SELECT DISTINCT p_brand FROM part)
CROSS JOIN (VALUES (0, '[1,1]', 10), (1, '[2,)', 12)) AS b(band, range, price) CROSS JOIN (VALUES (5), (10)) AS m(models)
""")
def explode_price_rows(spark, sf_dir):
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    cost = lambda p: F.array(*[F.struct(F.lit(m).alias("models"), F.lit(None).cast("string").alias("desc"), F.lit(m * p).alias("points")) for m in (5, 10)])
    bands = F.array(*[F.struct(F.lit(r).alias("range"), F.lit("x").alias("label"), cost(p).alias("costs")) for r, p in (("[1,1]", 10), ("[2,)", 12))])
    rows = R.explode_tiers(brands.withColumn("pricing", bands))
    return rows.select("unit", F.col("band_no").cast("long").alias("band_no"), "range", F.col("models").cast("long").alias("models"), F.col("points").cast("long").alias("points"))


@query("SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def characteristics_pivot(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pairs = F.array(F.struct(F.lit("brand").alias("name"), F.col("p_brand").alias("value")), F.struct(F.lit("size").alias("name"), F.lit("?").alias("value")), F.struct(F.lit("size").alias("name"), F.col("p_size").cast("string").alias("value")))
    rows = part.select("p_partkey", pairs.alias("pairs"))
    pivot = rows.select("p_partkey", R.characteristics("pairs").alias("m"))
    return pivot.select("p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["size"].alias("size"))


@query("SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '[0-9]') AND regexp_full_match(CAST(c_nationkey AS VARCHAR), '[0-9]+') AND lower(c_mktsegment) = 'building'")
def predicate_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    return c.filter(F.col("c_name").rlike("[0-9]") & R.numeric_id("nation") & R.same_fold("c_mktsegment", "Building")).select("c_custkey", "c_name")


@query("""
SELECT p_partkey, mode FROM part CROSS JOIN (VALUES ('base_only'), ('base_plus_group'), ('all')) AS m(mode)
WHERE CASE mode WHEN 'base_only' THEN p_size <= 20 WHEN 'base_plus_group' THEN p_size <= 20 OR p_brand = 'Brand#1' ELSE true END
""")
def visibility_filter(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("grp", F.when(F.col("p_size") > 20, F.col("p_brand")))
    views = [part.filter(R.visible(m, F.col("grp"), "Brand#1")).select("p_partkey", F.lit(m).alias("mode")) for m in ("base_only", "base_plus_group", "all")]
    return views[0].union(views[1]).union(views[2])


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'widget') OR contains(lower(p_type), 'econ') OR contains(lower(p_brand), 'econ')")
def substring_any(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("tags", F.array("p_type", "p_brand"))
    return part.filter(R.has_any("Widget", "p_name") | R.has_any("ECON", arrays=["tags"])).select("p_partkey")


@query("""
SELECT page_id, coalesce(split_part(url, '://', 1) = 'https' AND (regexp_matches(lower(split_part(split_part(url, '://', 2), '/', 1)), '(^|[.])example[.]com$')), false) AS trusted FROM pages
""")
def trusted_hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", R.trusted_host("url", "example.com").alias("trusted"))


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 21")
def recent_window(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return e.filter(R.recent("day", e.agg(F.max("day")).scalar())).select("event_id")


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey % 5 AS k, count(*) OVER (PARTITION BY upper(substr(s_name, -4))) AS n, lower(substr(s_name, -4)) AS key FROM supplier),
     c AS (SELECT c_custkey, lower(substr(c_name, -4)) AS key, count(*) OVER (PARTITION BY lower(substr(c_name, -4))) AS n FROM customer)
SELECT s.key, s_suppkey, c_custkey FROM s JOIN c ON s.key = c.key WHERE s.n = 1 AND c.n = 1
""")
def unique_name_match(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.lower(F.substring("s_name", -4, 4)).alias("key"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.substring("c_name", -4, 4)).alias("key"))
    return R.unique_match(s, c, "key")


def _two_snapshots(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", F.floor("p_retailprice").cast("long").alias("price"))
    return part.filter("p_partkey % 7 <> 0"), part.filter("p_partkey % 11 <> 0").withColumn("price", F.expr("price + case when p_partkey % 5 = 0 then 3 when p_partkey % 5 = 1 then -2 else 0 end"))


@query("""
SELECT p_partkey, 'ADDED' AS change FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 7 = 0
UNION ALL SELECT p_partkey, 'REMOVED' FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 = 0
""")
def snapshot_added_removed(spark, sf_dir):
    return R.added_removed(*_two_snapshots(spark, sf_dir), "p_partkey")


@query("""
SELECT p_partkey, p_brand, old_value, old_value + delta AS new_value, delta FROM (
    SELECT p_partkey, p_brand, CAST(floor(p_retailprice) AS BIGINT) AS old_value, CAST(CASE p_partkey % 5 WHEN 0 THEN 3 WHEN 1 THEN -2 ELSE 0 END AS BIGINT) AS delta
    FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0) WHERE delta <> 0
""")
def snapshot_value_changes(spark, sf_dir):
    return R.value_changes(*_two_snapshots(spark, sf_dir), ["p_partkey", "p_brand"], "price")


@query("""
SELECT CAST(count(*) AS BIGINT) AS changed, CAST(count(*) FILTER (WHERE d > 0) AS BIGINT) AS up, CAST(count(*) FILTER (WHERE d < 0) AS BIGINT) AS down, CAST(sum(d) AS BIGINT) AS net FROM (
    SELECT CASE p_partkey % 5 WHEN 0 THEN 3 WHEN 1 THEN -2 ELSE 0 END AS d FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0) WHERE d <> 0
""")
def snapshot_change_summary(spark, sf_dir):
    changes = R.value_changes(*_two_snapshots(spark, sf_dir), ["p_partkey", "p_brand"], "price")
    return changes.agg(F.count("*").alias("changed"), *A.count_if(up=F.col("delta") > 0, down=F.col("delta") < 0), F.sum("delta").alias("net"))


@query("""
SELECT coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey, CASE WHEN a.s_suppkey IS NULL THEN 'ONLY_RIGHT' WHEN b.s_suppkey IS NULL THEN 'ONLY_LEFT' ELSE 'CHANGED' END AS drift
FROM (SELECT * FROM supplier WHERE s_suppkey % 7 <> 0) a FULL JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN upper(s_name) || '!' ELSE s_name END AS s_name, s_nationkey FROM supplier WHERE s_suppkey % 11 <> 0) b
ON a.s_suppkey = b.s_suppkey WHERE a.s_suppkey IS NULL OR b.s_suppkey IS NULL OR a.s_name <> b.s_name OR a.s_nationkey <> b.s_nationkey
""")
def catalog_drift_full_outer(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    b = s.filter("s_suppkey % 11 <> 0").withColumn("s_name", F.expr("case when s_suppkey % 5 = 0 then upper(s_name) || '!' else s_name end"))
    return R.catalog_drift(s.filter("s_suppkey % 7 <> 0"), b, "s_suppkey", ["s_name", "s_nationkey"])


@query("""
WITH sig AS (SELECT l_orderkey, l_returnflag AS side, list_sort(list(DISTINCT l_linenumber)) AS s FROM lineitem GROUP BY ALL)
SELECT a.l_orderkey FROM sig a JOIN sig b ON a.l_orderkey = b.l_orderkey AND a.side = 'A' AND b.side = 'N' WHERE a.s <> b.s
""")
def signature_set_compare(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    side = lambda f: A.signatures(li.filter(F.col("l_returnflag") == f), "l_orderkey", "l_linenumber")
    return A.signature_mismatch(side("A"), side("N"), "l_orderkey")


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, q AS left_value, q + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS right_value FROM x WHERE l_orderkey % 3 = 0
""")
def composite_key_mismatch(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    x = dealt(table(spark, sf_dir, "lineitem").select(*key, "l_quantity"), *key).groupBy(*key).agg(F.max("l_quantity").alias("q"))
    y = x.withColumn("q", F.expr("q + case when l_orderkey % 3 = 0 then 1 else 0 end"))
    return R.mismatches(x, y, key, "q")


@query("""
WITH last AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY o_custkey), first AS (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY o_custkey)
SELECT last.o_custkey, last.s AS left_value, first.s AS right_value FROM last JOIN first ON last.o_custkey = first.o_custkey WHERE last.s <> first.s
""")
def last_wins_mismatch(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return R.mismatches(R.last_by_key(o, "o_orderkey", "o_custkey"), R.first_by_key(o, ["o_orderkey"], "o_custkey"), ["o_custkey"], "o_orderstatus")


def _copies(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), "o_custkey", F.lit("any").alias("unit"), "o_orderdate")
    return R.copy_number(orders, "o_custkey", "o_orderdate", "row_id").drop("o_orderdate")


@query(f"""
WITH c AS (SELECT o_orderkey AS row_id, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS copy_no FROM orders)
SELECT row_id, o_custkey, copy_no, CAST(points AS BIGINT) AS points FROM c LEFT JOIN {_BANDS_SQL} ON copy_no >= lo AND (hi IS NULL OR copy_no <= hi)
""")
def copy_band_pricing(spark, sf_dir):
    priced = P.price(_copies(spark, sf_dir), _bands(spark), "unit")
    return priced.select("row_id", "o_custkey", F.col("copy_no").cast("long").alias("copy_no"), F.col("points").cast("long").alias("points"))


@query(f"""
WITH c AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS copy_no FROM orders)
SELECT o_custkey, CAST(sum(points) AS BIGINT) AS points, CAST(0 AS BIGINT) AS unpriced, CASE WHEN sum(points) <= 200 THEN 'PASS' ELSE 'FAIL' END AS status
FROM c LEFT JOIN {_BANDS_SQL} ON copy_no >= lo AND (hi IS NULL OR copy_no <= hi) GROUP BY o_custkey
""")
def points_limit_check(spark, sf_dir):
    return P.limit_check(P.price(_copies(spark, sf_dir), _bands(spark), "unit"), "o_custkey", 200)


@query("""
WITH x AS (SELECT l_partkey, s_suppkey, l_orderkey, l_linenumber, CASE WHEN s_nationkey < 5 THEN 20 ELSE 0 END + CASE WHEN s_acctbal > 0 THEN 5 ELSE 0 END AS score FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT l_partkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_orderkey, l_linenumber, s_suppkey) AS r FROM x) WHERE r = 1
""")
def best_candidate(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber").join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    score = F.when(F.col("s_nationkey") < 5, 20).otherwise(0) + F.when(F.col("s_acctbal") > 0, 5).otherwise(0)
    return R.best_candidate(pairs, "l_partkey", score, ["l_orderkey", "l_linenumber", "s_suppkey"]).select("l_partkey", "s_suppkey")


@query("""
WITH w AS (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'old ' || n_name WHEN n_nationkey % 3 = 1 THEN n_name ELSE 'gone' END AS name FROM nation)
SELECT w.n_nationkey, name, coalesce(d.n_regionkey, a.n_regionkey) AS n_regionkey, CASE WHEN d.n_name IS NOT NULL THEN 'DIRECT' WHEN a.n_name IS NOT NULL THEN 'ALIAS' ELSE 'UNRESOLVED' END AS resolution
FROM w LEFT JOIN nation d ON d.n_name = name LEFT JOIN nation a ON 'old ' || a.n_name = name
""")
def alias_fallback_join(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = n.select("n_nationkey", F.expr("case n_nationkey % 3 when 0 then 'old ' || n_name when 1 then n_name else 'gone' end").alias("name"))
    catalog = n.select(F.col("n_name").alias("name"), "n_regionkey")
    aliases = n.select(F.concat(F.lit("old "), "n_name").alias("name"), F.col("n_name").alias("alias"))
    return R.alias_lookup(rows, catalog, aliases, "name", "n_regionkey")


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN n_name WHEN n_nationkey % 4 = 1 THEN n_name WHEN n_nationkey % 4 = 2 THEN r_name END AS candidate,
       CASE n_nationkey % 4 WHEN 0 THEN 'DIRECT_NAME_MATCH' WHEN 1 THEN 'NAMING_ALIAS_CANDIDATE' WHEN 2 THEN 'PARENT_SOURCE_CANDIDATE' ELSE 'NO_MAPPING' END AS mapping_state
FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def precedence_mapping(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.join(r, F.col("r_regionkey") == F.col("n_regionkey")).select(
        "n_nationkey", F.expr("case when n_nationkey % 4 = 0 then n_name end").alias("a"), F.expr("case when n_nationkey % 4 = 1 then n_name end").alias("b"), F.expr("case when n_nationkey % 4 = 2 then r_name end").alias("c")
    )
    catalog = n.select(F.col("n_name").alias("k")).union(r.select("r_name"))
    return R.precedence_lookup(rows, catalog, [("a", "DIRECT_NAME_MATCH"), ("b", "NAMING_ALIAS_CANDIDATE"), ("c", "PARENT_SOURCE_CANDIDATE")], "k").select("n_nationkey", "candidate", "mapping_state")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 1) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 1)")
def or_key_semi_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").filter("p_size = 1").select(F.col("p_partkey").alias("l_partkey"), F.lit(None).cast("long").alias("l_suppkey"))
    supps = table(spark, sf_dir, "supplier").filter("s_nationkey = 1").select(F.lit(None).cast("long").alias("l_partkey"), F.col("s_suppkey").alias("l_suppkey"))
    return R.either_key(li, parts.union(supps), "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""
SELECT e.id, e."group", e.hash, CASE WHEN l.id IS NULL AND e."group" <> '' THEN 'MISSING_LIVE' WHEN e.id % 13 = 0 THEN 'MISSING_LIVE' WHEN e.id % 5 = 0 THEN 'DRIFT' ELSE 'MATCH' END AS status FROM (
    SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS "group", sha256(p_name) AS hash FROM part) e
LEFT JOIN (SELECT p_partkey AS id FROM part WHERE p_partkey % 13 <> 0) l ON l.id = e.id
""")
def fingerprint_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    expected = part.select(F.col("p_partkey").alias("id"), F.expr("case when p_partkey % 3 = 0 then '' else p_brand end").alias("group"), F.sha2("p_name", 256).alias("hash"))
    live = part.filter("p_partkey % 13 <> 0").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("group"), F.sha2(F.expr("p_name || case when p_partkey % 5 = 0 then '!' else '' end"), 256).alias("hash"))
    return R.fingerprint_status(expected, live)


@query("""
SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN 'LARGE' ELSE 'SMALL' END AS classification, CASE WHEN p_type = 'ECONOMY' AND p_size > 25 THEN 'KNOWN_ACTIVE' ELSE 'UNCLASSIFIED_OR_CHANGED' END AS drift_state FROM part
""")
def known_drift_registry(spark, sf_dir):
    """All parts as observed drift, against a registry of one kind of them."""
    part = table(spark, sf_dir, "part")
    observed = part.select("p_partkey", "p_brand", F.expr("case when p_size > 25 then 'LARGE' else 'SMALL' end").alias("classification"))
    registry = part.filter("p_type = 'ECONOMY'").select("p_partkey", "p_brand", F.lit("LARGE").alias("classification"))
    return R.known_drift(observed, registry, ["p_partkey", "p_brand"])


@query("SELECT p_partkey, p_brand FROM part WHERE p_size <= 25")
def resolved_drift(spark, sf_dir):
    """A registry of all parts against those that still drift."""
    part = table(spark, sf_dir, "part")
    return R.resolved_drift(part.filter("p_size > 25").select("p_partkey", "p_brand"), part.select("p_partkey", "p_brand"), ["p_partkey", "p_brand"])


@query("""
SELECT p_partkey, kw, CASE WHEN (kw = 'BRAND' AND p_brand = 'Brand#1') OR (kw = 'SMALL' AND p_size < 10) THEN 'PRESENT' WHEN p_partkey % 2 = 0 THEN 'ABSENT' ELSE 'UNKNOWN' END AS answer
FROM part CROSS JOIN (VALUES ('BRAND'), ('SMALL')) AS k(kw)
""")
def closed_world_keywords(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    asked = part.select("p_partkey", F.explode(F.array(F.lit("BRAND"), F.lit("SMALL"))).alias("kw"))
    facts = part.filter("p_brand = 'Brand#1'").select("p_partkey", F.lit("BRAND").alias("kw")).union(part.filter("p_size < 10").select("p_partkey", F.lit("SMALL").alias("kw")))
    return R.closed_world(asked, facts, part.select("p_partkey", F.expr("p_partkey % 2 = 0").alias("complete")), "p_partkey", "kw")


@query("SELECT CAST(n_regionkey AS BIGINT) AS k FROM nation WHERE n_nationkey >= 5 AND n_regionkey = 4")
def unresolved_references(spark, sf_dir):
    refs = table(spark, sf_dir, "nation").filter("n_nationkey >= 5").select(F.col("n_regionkey").cast("long").alias("k"))
    known = table(spark, sf_dir, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").cast("long").alias("k"))
    aliases = spark.createDataFrame([(3, 0), (4, 9)], "k long, alias long")
    return R.unresolved_references(refs, known, aliases, "k")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE EXISTS (SELECT 1 FROM (VALUES (1, 2, 0, 500), (4, 6, 100, 900)) AS s(a, b, c, d) WHERE l.l_linenumber BETWEEN a AND b AND l.l_partkey BETWEEN c AND d)
""")
def interval_containment(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(F.lit(1).alias("doc"), "l_orderkey", "l_linenumber", "l_partkey", F.col("l_linenumber").alias("line_start"), F.col("l_linenumber").alias("line_end"), F.col("l_partkey").alias("char_start"), F.col("l_partkey").alias("char_end"))
    spans = spark.createDataFrame([(1, 1, 2, 0, 500), (1, 4, 6, 100, 900)], "doc int, line_start int, line_end int, char_start long, char_end long")
    return R.inside_spans(points, spans, ["doc"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0), n AS (SELECT (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS missing, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS extra)
SELECT missing, extra, missing = 0 AND extra = 0 AS same FROM n
""")
def identity_sets(spark, sf_dir):
    """Customers who order against customers with a balance: both sides lack some."""
    return R.same_identity(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("""
SELECT coalesce(lang, 'ALL') AS lang, coalesce(CAST(toxic AS VARCHAR), 'ALL') AS toxic, count(*) AS n, CAST(grouping(lang, toxic) AS INTEGER) AS level
FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang, toxic)
""")
def by_kind_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    out = A.with_totals(rows, "lang", "toxic")
    return out.select(F.coalesce("lang", F.lit("ALL")).alias("lang"), F.coalesce(F.col("toxic").cast("string"), F.lit("ALL")).alias("toxic"), "n", "level")


@query("SELECT o_orderpriority, string_agg(o_orderstatus || '=' || n, ',' ORDER BY o_orderstatus) AS by_state FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderpriority")
def nested_state_counts(spark, sf_dir):
    m = A.nested_counts_map(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    return m.select("o_orderpriority", F.array_join(F.transform(F.map_entries("by_state"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("by_state"))


@query("""
SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, round(count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 4) AS share, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS states,
       CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS only_state FROM lineitem GROUP BY l_suppkey
""")
def supplier_return_profile(spark, sf_dir):
    returned = F.count_if(F.col("l_returnflag") == "R")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(returned.alias("returned"), A.ratio(returned, F.count("*")).alias("share"), A.set_list("l_linestatus").alias("states"), A.unique_or_null("l_linestatus").alias("only_state"))
    return rows.withColumn("states", F.array_join("states", ","))


@query("SELECT l_suppkey, count(DISTINCT p) AS pages FROM (SELECT l_suppkey, unnest(generate_series(l_linenumber, l_linenumber + 2)) AS p FROM lineitem) GROUP BY l_suppkey")
def page_coverage(spark, sf_dir):
    ranges = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("a"), (F.col("l_linenumber") + 2).alias("b"))
    return A.page_coverage(ranges, "l_suppkey", "a", "b")


@query("SELECT o_custkey, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)) WHERE r = 1")
def most_frequent_value(spark, sf_dir):
    return A.most_frequent(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("SELECT l_orderkey, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS contiguous FROM lineitem GROUP BY l_orderkey")
def contiguous_numbers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*A.contiguous("l_linenumber"))


@query("""
SELECT user_id, count(DISTINCT event_type) AS lineages, CASE WHEN count(DISTINCT event_type) >= 3 THEN 'HIGH' WHEN count(DISTINCT event_type) >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM events GROUP BY user_id
""")
def lineage_confidence(spark, sf_dir):
    return A.lineage_confidence(table(spark, sf_dir, "events"), "user_id", "event_type")


@query("""
SELECT user_id, CASE WHEN count(*) >= 100 THEN 'ROBUST' WHEN count(*) >= 30 THEN 'DIRECTIONAL' ELSE 'WEAK' END AS games, CASE WHEN count(DISTINCT CAST(ts AS DATE)) >= 10 THEN 'ROBUST' WHEN count(DISTINCT CAST(ts AS DATE)) >= 5 THEN 'DIRECTIONAL' ELSE 'WEAK' END AS lists,
       CAST(round(30 * (CASE WHEN count(*) >= 50 THEN 1.0 ELSE 0.0 END) + 70 * (CASE WHEN count(DISTINCT event_type) >= 5 THEN 1.0 ELSE 0.0 END), 4) AS DOUBLE) AS score FROM events GROUP BY user_id
""")
def evidence_bands(spark, sf_dir):
    by = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct(F.to_date("ts")).alias("days"), F.count_distinct("event_type").alias("kinds"))
    by = by.withColumns({"volume": (F.col("n") >= 50).cast("double"), "variety": (F.col("kinds") >= 5).cast("double")})
    return by.select("user_id", A.sample_band("faction_games", F.col("n")).alias("games"), A.sample_band("readable_winning_lists", F.col("days")).alias("lists"), A.evidence_score({"volume": 30, "variety": 70}).alias("score"))


@query("""SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS fingerprint FROM nation""")
def row_fingerprints(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", A.row_fingerprint("n_regionkey", "n_name").alias("fingerprint"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders")
def keep_first_duplicates(spark, sf_dir):
    return R.duplicate_ids(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


@query("SELECT c_custkey, sha256(c_mktsegment) AS h FROM (SELECT c_nationkey, c_mktsegment, max(c_custkey) AS c_custkey FROM customer GROUP BY ALL)")
def dedup_keep_last(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.sha2("c_mktsegment", 256).alias("h"))
    return R.keep_last(c, "c_custkey", "c_nationkey", "h").select("c_custkey", "h")


@query("SELECT l_partkey, n FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ORDER BY n DESC, l_partkey LIMIT 100")
def top_keywords(spark, sf_dir):
    return R.top_counts(table(spark, sf_dir, "lineitem"), "l_partkey", 100)


@query("""
SELECT 'union' AS op, count(*) AS n FROM (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer)
UNION ALL SELECT 'difference', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0)
""")
def set_operations(spark, sf_dir):
    s, c = table(spark, sf_dir, "supplier").select("s_nationkey"), table(spark, sf_dir, "customer").select("c_nationkey")
    half = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select("s_nationkey")
    parts = [R.set_operation(s, c, "union"), R.set_operation(s, c, "intersect"), R.set_operation(c, half, "difference")]
    out = [p.agg(F.lit(n).alias("op"), F.count("*").alias("n")) for n, p in zip(("union", "intersect", "difference"), parts, strict=True)]
    return out[0].union(out[1]).union(out[2])


@query("""
SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn, greatest(turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 99)) AS end_turn FROM conversations
""")
def family_boundaries(spark, sf_dir):
    from ..operators.corpus import family_ends

    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    out = family_ends(c, ["conv_id"], "turn", F.lit(99).cast("long"))
    return out.withColumn("next_turn", F.lead("turn").over(Window.partitionBy("conv_id").orderBy("turn"))).select("conv_id", "turn", "next_turn", F.col("end_page").alias("end_turn"))


@query("""
SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS normal, coalesce(nullif(left(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), ''), 'section') AS slug,
       concat_ws(':', p_brand, CAST(p_size AS VARCHAR), '_') AS key, CAST(len(regexp_extract_all(p_name, '\\S+')) AS BIGINT) AS tokens, sha256(trim(p_name)) AS name_sha256 FROM part
""")
def name_normalizers(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("blank", F.lit(""))
    return p.select("p_partkey", T.norm_strip("p_name").alias("normal"), T.slug("p_name").alias("slug"), T.composite_key("p_brand", "p_size", "blank").alias("key"), T.token_count("p_name").alias("tokens"), T.text_hash("p_name").alias("name_sha256"))
